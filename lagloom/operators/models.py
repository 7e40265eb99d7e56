"""Fitting and predicting with Spark ML; every step outside the fit is plain columns."""

from __future__ import annotations

from itertools import product

from pyspark.ml.classification import (
    GBTClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagloom.operators import blend, metrics
from lagloom.session import cut_lineage

SEED = 1122


def assemble(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="features").transform(df)


def _probability(i: int, col: str = "probability") -> Column:
    return F.get(vector_to_array(F.col(col)), F.lit(i))


def _gbt(label: str, params: dict) -> GBTClassifier:
    return GBTClassifier(labelCol=label, featuresCol="features", seed=SEED, **params)


def _folded(df: DataFrame, folds: int, seed: int) -> DataFrame:
    """Rows with their fold, written out: every fit reads them again."""
    return cut_lineage(df.withColumn("_fold", blend.kfold_assign(F.col("id"), folds, seed)))


def _fold_scores(rows: DataFrame, label: str, params: dict, folds: int) -> DataFrame:
    scores = None
    for k in range(folds):
        model = _gbt(label, params).fit(rows.where(F.col("_fold") != k))
        held = model.transform(rows.where(F.col("_fold") == k))
        loss = metrics.log_loss(F.col(label).cast("int"), [_probability(0), _probability(1)])
        score = held.agg(loss.alias("score"), F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("fold"), "score", "n")
        scores = score if scores is None else scores.unionByName(score)
    return scores


def cv_fold_scores(df: DataFrame, label: str, params: dict, folds: int = 10, seed: int = SEED) -> DataFrame:
    """``fold, score, n``: log loss of a boosted binary classifier on the ``n`` rows of each fold, fitted on the rest.

    The loop is over folds, not rows; each fit and each prediction is distributed.
    """
    return _fold_scores(_folded(df, folds, seed), label, params, folds)


def grid_search(df: DataFrame, label: str, grid: dict[str, list], folds: int = 10, seed: int = SEED) -> DataFrame:
    """Cross-validated score of every parameter combination: the parameters and ``score``.

    All combinations share the rows and their folds.
    """
    names = sorted(grid)
    rows = _folded(df, folds, seed)
    table = None
    for values in product(*[grid[n] for n in names]):
        params = dict(zip(names, values, strict=True))
        mean = _fold_scores(rows, label, params, folds).agg(F.avg("score").alias("score"))
        row = mean.select(*[F.lit(v).alias(n) for n, v in params.items()], "score")
        table = row if table is None else table.unionByName(row)
    return table


def two_stage_classifier(
    train: DataFrame, test: DataFrame, label: str = "label", first: dict | None = None, second: dict | None = None
) -> DataFrame:
    """Is it positive; is a positive one level 1: ``id, predict_0, predict_1, predict_2``."""
    y1 = (F.col(label) > 0).cast("int")
    y2 = (F.col(label) == 1).cast("int")
    m1 = _gbt("_y", first or {"maxIter": 5, "maxDepth": 4}).fit(train.withColumn("_y", y1))
    m2 = _gbt("_y", second or {"maxIter": 5, "maxDepth": 3}).fit(
        train.where(F.col(label) > 0).withColumn("_y", y2)
    )
    p1 = m1.transform(test).select("id", "features", _probability(1).alias("p1"))
    both = m2.transform(p1).select("id", "p1", _probability(1).alias("p2"))
    v = blend.two_stage_combine(F.col("p1"), F.col("p2"))
    return both.select("id", *[c.alias(f"predict_{i}") for i, c in enumerate(v)])


def bagged_regression(
    train: DataFrame, test: DataFrame, target: str, repeats: int = 20, holdout: float = 0.001, params: dict | None = None
) -> DataFrame:
    """log1p target, one fit per repeat without its held-out rows, mean of the expm1 predictions.

    The models score a test row one after the other, so the test rows are read once and never shuffled.
    """
    rows = cut_lineage(train.withColumn("_y", F.log1p(F.col(target).cast("double"))))
    scored = test
    for r in range(repeats):
        fit = GBTRegressor(labelCol="_y", predictionCol=f"_p{r}", seed=SEED + r, **(params or {"maxIter": 5, "maxDepth": 4}))
        scored = fit.fit(rows.where(~blend.holdout_split(F.col("id"), holdout, r))).transform(scored)
    total = sum((F.expm1(f"_p{r}") for r in range(1, repeats)), F.expm1("_p0"))
    return scored.select("id", (total / repeats).alias("target"))


def _ovr_probabilities(base, train: DataFrame, test: DataFrame, label: str, classes: int) -> DataFrame:
    """One binary fit per class; the classes' scores normalised to sum 1."""
    scored, rows = test, cut_lineage(train)
    for k in range(classes):
        one = base.copy()
        one.setLabelCol("_y").setRawPredictionCol(f"_raw{k}").setProbabilityCol(f"_p{k}").setPredictionCol(f"_c{k}")
        scored = one.fit(rows.withColumn("_y", (F.col(label) == k).cast("int"))).transform(scored)
    scored = scored.select("id", *[_probability(1, f"_p{k}").alias(f"p{k}") for k in range(classes)])
    total = sum((F.col(f"p{k}") for k in range(1, classes)), F.col("p0"))
    return scored.select("id", *[F.try_divide(F.col(f"p{k}"), total).alias(f"p{k}") for k in range(classes)])


def one_vs_rest_forest(
    train: DataFrame, test: DataFrame, label: str = "label", classes: int = 3, trees: int = 1000, depth: int = 7
) -> DataFrame:
    base = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED)
    return _ovr_probabilities(base, train, test, label, classes)


def gradient_boosted_multiclass(
    train: DataFrame, test: DataFrame, label: str = "label", classes: int = 3, params: dict | None = None
) -> DataFrame:
    return _ovr_probabilities(GBTClassifier(seed=SEED, **(params or {"maxIter": 5, "maxDepth": 3})), train, test, label, classes)


def feature_importances(train: DataFrame, features: list[str], label: str, params: dict | None = None) -> DataFrame:
    """``feature, weight`` of a fitted ensemble; one row per feature."""
    model = _gbt(label, params or {"maxIter": 5, "maxDepth": 4}).fit(train)
    weights = model.featureImportances.toArray()
    rows = [(name, float(w)) for name, w in zip(features, weights, strict=True)]
    return train.sparkSession.createDataFrame(rows, "feature string, weight double")
