"""Vectors per record, segment and span."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten_layers(embeddings: Column) -> Column:
    """All layers of ``array<struct<index, values>>`` one after the other."""
    return F.flatten(F.transform(embeddings, lambda e: e["values"]))


def embedding_assemble(records: DataFrame) -> DataFrame:
    """Pronoun, A and B vectors (segments 0, 1, 2) side by side per ``df_idx``.

    A record without a pronoun vector is left out; a missing name vector is zeros. The record with
    the highest ``linex_index`` wins where a segment repeats.
    """
    flat = records.select("df_idx", "segment", "linex_index", flatten_layers(F.col("embeddings")).alias("v"))

    def pick(k: int) -> Column:
        at = F.when(F.col("segment") == k, F.col("linex_index"))
        return F.max_by("v", at).alias(f"v{k}")

    wide = flat.groupBy("df_idx").agg(pick(0), pick(1), pick(2)).where("v0 is not null")
    zeros = F.transform("v0", lambda _: F.lit(0.0))
    return wide.select(
        "df_idx", F.concat("v0", F.coalesce("v1", zeros), F.coalesce("v2", zeros)).alias("emb")
    )


def vector_mean(vectors: DataFrame, keys: list[str], vector: str = "v") -> DataFrame:
    """Element-wise mean of the vectors of each key.

    Elements are averaged one by one with partial aggregates, so a key of any size needs no
    gathering of its vectors.
    """
    parts = vectors.select(*keys, F.posexplode(vector).alias("_i", "_x"))
    means = parts.groupBy(*keys, "_i").agg(F.avg("_x").alias("_m"))
    packed = means.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_i", "_m"))).alias("_v"))
    return packed.select(*keys, F.transform("_v", lambda s: s["_m"]).alias("mean"))


def span_vector_mean(tokens: DataFrame, spans: DataFrame) -> DataFrame:
    """Mean vector of the tokens of a span: ``tokens(doc_id, tok, v)``, ``spans(doc_id, role, first, n)``.

    Spans meet tokens by document and place, so a long document is no hot key.
    """
    places = spans.where("n > 0").select("doc_id", "role", F.explode(F.expr("sequence(first, first + n - 1)")).alias("tok"))
    inside = tokens.join(places, ["doc_id", "tok"])
    return vector_mean(inside.select("doc_id", "role", "v"), ["doc_id", "role"])
