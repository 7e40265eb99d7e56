"""Compression distance of text pairs."""

from __future__ import annotations

import bz2

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType


@F.pandas_udf(LongType())
def compressed_size(texts: pd.Series) -> pd.Series:
    """Bytes after bz2; null stays null."""
    return texts.map(lambda t: None if t is None else len(bz2.compress(t.encode("utf-8")))).astype("Int64")


def pair_compression_distance(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """``texts(id, text)``, ``pairs(left, right)`` -> ``left, right, distance``.

    ``(C(xy) - min(C(x), C(y))) / max(C(x), C(y))``. Single sizes are computed once per text, the
    joint size only for the given pairs. A pair with a null text has a null distance.
    """
    sized = texts.select("id", "text", compressed_size("text").alias("c"))
    left = sized.select(F.col("id").alias("left"), F.col("text").alias("_x"), F.col("c").alias("_cx"))
    right = sized.select(F.col("id").alias("right"), F.col("text").alias("_y"), F.col("c").alias("_cy"))
    joint = compressed_size(F.concat("_x", "_y"))
    distance = (joint - F.least("_cx", "_cy")) / F.greatest("_cx", "_cy")
    return pairs.join(left, "left").join(right, "right").select(
        "left", "right", F.when(F.col("_cx").isNotNull() & F.col("_cy").isNotNull(), distance).alias("distance")
    )
