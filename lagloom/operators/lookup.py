"""Equi-joins against a table with one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagloom.session import cut_lineage


def lookup(
    probe: DataFrame, dim: DataFrame, on: list[str] | str, how: str = "left", measure: bool = False
) -> DataFrame:
    """Join ``probe`` to a ``dim`` holding one row per key, whatever the share of one probe key.

    ``measure``, for a dim likely to be small, writes it out first. The planner then knows its
    real size: below ``spark.sql.autoBroadcastJoinThreshold`` the probe is not shuffled at all,
    above it both sides are, and adaptive execution splits a hot key of the probe.

    Without it the dim stays part of the plan. An aggregate is already partitioned by its key,
    and a hot probe key cannot be split over a side that has no exchange of its own; joining on a
    hash next to the keys gives both sides one.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if measure:
        return probe.join(cut_lineage(dim), keys, how)
    mark = F.xxhash64(*keys)
    return (
        probe.withColumn("_hash", mark)
        .join(dim.withColumn("_hash", mark), ["_hash", *keys], how)
        .drop("_hash")
    )
