"""Session settings and what needs the session: tables that cut lineage, category lists, spreading of work."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lagloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution on; ``conf`` keys use ``__`` for dots."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for k, v in {**defaults, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or the one already set on the context.

    A folder of our own is made only for a local master with neither.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="lagloom-")
        sc.setCheckpointDir(folder)
    return folder


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/lagloom-{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def without_leftovers(spark: SparkSession) -> Iterator[None]:
    """What is executed here deletes its shuffle files when it ends, instead of when the driver collects its garbage.

    Only for what reads no result twice, such as writing a table or bringing rows to the driver.
    """
    before = spark.conf.get(_CLEANUP, None)
    if before is not None:  # a Spark that knows the setting
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is not None:
            spark.conf.set(_CLEANUP, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write to a table of its own in the session's part of the shared folder and read it back.

    Unlike ``checkpoint()`` this computes the rows once, and readers prune columns. The tables stay until ``discard`` or
    ``release``, as a result may be read at any later time.
    """
    spark = df.sparkSession
    path = f"{_own_folder(spark)}/{uuid.uuid4().hex}"
    with without_leftovers(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._lagloom_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the table of a ``cut_lineage`` that nothing will read again, such as the last round's."""
    path = getattr(df, "_lagloom_path", None)
    if path:
        _delete(df.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Delete all tables that ``cut_lineage`` wrote in this session; results still unread are lost with them."""
    _delete(spark, _own_folder(spark))


def category_values(df: DataFrame, col: str) -> list:
    """Distinct values of a category column, sorted: the columns of a pivot."""
    return sorted(r[0] for r in df.select(col).distinct().collect() if r[0] is not None)


def widen(df: DataFrame, *cols: str) -> DataFrame:
    """Spread rows by ``cols`` over as many tasks as the session shuffles to.

    For rows that are few bytes but much work: adaptive execution merges partitions by size and
    would leave the work to few tasks; an explicit count stays.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)
