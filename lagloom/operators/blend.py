"""Folds, combination, blending and alignment of predictions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagloom.functions import digests
from lagloom.operators.lookup import lookup
from lagloom.operators.metrics import class_rate


def _draw(*parts: Column) -> Column:
    """A number below 2**32 that depends on the parts alone, so reruns and partitions agree."""
    digest = F.md5(F.concat_ws("-", *[p.cast("string") for p in parts]))
    return F.conv(F.substr(digest, F.lit(1), F.lit(8)), 16, 10).cast("long")


def kfold_assign(id_col: Column, k: int, seed: int = 0) -> Column:
    """Fold 0..k-1 of an id."""
    return (_draw(id_col, F.lit(seed)) % k).cast("int")


def holdout_split(id_col: Column, share: float, repeat: Column | int = 0, seed: int = 0) -> Column:
    """True for about ``share`` of the ids, differently for each repeat."""
    r = F.lit(repeat) if isinstance(repeat, int) else repeat
    return _draw(id_col, r, F.lit(seed)) % 1_000_000 < int(round(share * 1_000_000))


def holdout_rows(ids: pa.Array, share: float, repeats: list[int], seed: int = 0) -> np.ndarray:
    """``holdout_split`` of ids already in Python, by (repeat, row): many repeats cost no text of their own."""
    nulls = ids.is_null().to_numpy(zero_copy_only=False)
    drawn = digests.leading(ids, [f"-{r}-{seed}" for r in repeats])
    if nulls.any():  # concat_ws leaves a null out
        drawn[:, nulls] = digests.leading(pa.array([""]), [f"{r}-{seed}" for r in repeats])
    return drawn % 1_000_000 < int(round(share * 1_000_000))


def two_stage_combine(p1: Column, p2: Column) -> tuple[Column, Column, Column]:
    """P(positive) and P(level 1 given positive) to the three class probabilities."""
    v1 = F.lit(1.0) - p1
    v2 = p1 * p2
    return v1, v2, F.lit(1.0) - v1 - v2


def blend_weights(scores: dict[str, float], base: float) -> dict[str, float]:
    """Weight of each member: base minus its score, normalised."""
    raw = {m: base - s for m, s in scores.items()}
    total = sum(raw.values())
    return {m: w / total for m, w in raw.items()}


def blend_weighted(members: DataFrame, weights: DataFrame, cols: list[str]) -> DataFrame:
    """Weighted sum of member predictions per id. ``members``: ``member, id, cols``; ``weights``:
    ``member, weight``, one row per member, written out so that the predictions stay in place."""
    joined = lookup(members, weights, "member", "inner", measure=True)
    return joined.groupBy("id").agg(*[F.sum(F.col(c) * F.col("weight")).alias(c) for c in cols])


def align_to_prior(predictions: DataFrame, cols: list[str], rates: list[float]) -> DataFrame:
    """Scale each class column so its share of the total becomes the given rate."""
    share = class_rate(predictions, cols).select(F.struct(*cols)).scalar()
    return predictions.withColumns(
        {c: F.col(c) * F.try_divide(F.lit(rate), share[c]) for c, rate in zip(cols, rates, strict=True)}
    )


def mean_predictions(long: DataFrame, cols: list[str], digits: int | None = 4) -> DataFrame:
    """Average over seeds and folds: ``id, seed, fold, cols`` -> ``id, cols``."""
    def out(c: str) -> Column:
        mean = F.avg(c)
        return (mean if digits is None else F.round(mean, digits)).alias(c)

    return long.groupBy("id").agg(*[out(c) for c in cols])


def override_with_known(prediction: Column, known: Column) -> Column:
    """The known value where there is a non-zero one."""
    return F.coalesce(F.nullif(known, F.lit(0)), prediction)


def clip_predictions(c: Column, low: float = 0.02) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(1.0 - low))


def submission_table(predictions: DataFrame, p_none: str, p_a: str, p_b: str) -> DataFrame:
    return predictions.select(
        F.col("id").alias("ID"), F.col(p_a).alias("A"), F.col(p_b).alias("B"), F.col(p_none).alias("NEITHER")
    )


def best_of_grid(scores: DataFrame, score: str, params: list[str]) -> DataFrame:
    """The parameter row with the lowest score; ties go to the smallest parameters."""
    best = F.min(F.struct(score, *params))
    return scores.agg(best.alias("_b")).select("_b.*")
