"""What several operators share: reading tables, Arrow columns, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagloom.operators.lookup import lookup
from lagloom.session import cut_lineage, discard


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """Only the columns an operator reads; a null text counts as empty."""
    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), *more)


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores until no column is called so."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def tiled(keyed: DataFrame, item: str, chunk: int) -> DataFrame:
    """``keyed`` (key, ``item``) dealt out and sorted by (key, tile).

    A key with more than ``chunk`` rows is cut into chunks by a hash of the item, and every two chunks meet in a tile, so
    no task holds more than two chunks of a key and every two rows of a key meet.
    """
    hot = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > chunk)
    k = F.ceil(F.col("n") / chunk).cast("long")
    zero = F.lit(0).cast("long")
    tiles = F.when(F.col("n").isNull(), F.array(zero)).otherwise(
        F.transform(
            F.filter(F.sequence(zero, k - 1), lambda x: x != F.col("own")),
            lambda x: F.least(x, F.col("own")) * F.col("n") + F.greatest(x, F.col("own")),
        )
    )
    spread = lookup(keyed, hot, "key").withColumn("own", F.pmod(F.xxhash64(item), k))
    n = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return spread.select("key", item, F.explode(tiles).alias("tile")).repartition(n, "key", "tile").sortWithinPartitions("key", "tile")


def raw(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, without decoding."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``size`` bytes in each; a row is never cut."""
    for batch in batches:
        lengths = np.array([0, *(pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist())], dtype=np.int64)
        ends, at = np.cumsum(lengths), 0
        while at < batch.num_rows:
            to = int(np.searchsorted(ends, ends[at] + size, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to
        del batch
        pa.default_memory_pool().release_unused()


def star(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within one task as (node, smallest node reachable), nodes that are their own left out."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        for end in (a, b):
            np.minimum.at(label, label[end], low)
            np.minimum.at(label, end, low)
        label = label[label]
        if np.array_equal(label, before):
            break
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def components(links: DataFrame) -> DataFrame:
    """Connected components of undirected links (a, b): one row (node, root) per node, root the smallest.

    Alternates the two star steps of the public two-phase algorithm: every node hands its larger
    neighbours, then its smaller ones, to the smallest it knows. Each round is joins over exchanges that
    adaptive execution can split at a hub, and ends in a table of the shared folder; the number of rounds
    grows with the logarithm of the longest path. Nothing but a row count and a sum comes to the driver.
    """
    def tidy(df: DataFrame) -> DataFrame:
        return df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def summary(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    edges = cut_lineage(tidy(links))
    before = summary(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = tidy(lookup(both, low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        pairs = F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        last, edges = edges, cut_lineage(tidy(lookup(large, low, "a").select(F.inline(pairs))))
        discard(last)
        after = summary(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
