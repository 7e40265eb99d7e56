"""Tables whose parts count only once they are named by an empty manifest file, so a reader never sees half a write.

Rows are written to a folder of their own first. Then a manifest ``_commits/<name>.<folder>`` is made, which a file system does at once or not
at all. A run that failed midway has no manifest; its folder is passed over, and the run can be repeated.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

RUN = re.compile(r"[A-Za-z0-9_-]+")


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def committed(spark: SparkSession, path: str) -> dict[str, str]:
    """Folder of every committed name. If one name was committed twice at the same time, the first folder by name counts."""
    fs, target = _at(spark, f"{path}/_commits")
    if not fs.exists(target):
        return {}
    found = sorted(s.getPath().getName() for s in fs.listStatus(target))
    out: dict[str, str] = {}
    for name, _, folder in (f.rpartition(".") for f in found if RUN.fullmatch(f.rpartition(".")[0])):
        out.setdefault(name, f"{path}/{folder}")
    return out


def commit(df: DataFrame, path: str, name: str) -> None:
    """Write ``df`` to a folder of its own and name it; letters, digits, ``_`` and ``-`` make a name."""
    if not RUN.fullmatch(name):
        raise ValueError(f"not a name of a run: {name!r}")
    folder = f"part-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    fs, manifest = _at(df.sparkSession, f"{path}/_commits/{name}.{folder}")
    fs.create(manifest, False).close()


def append_once(df: DataFrame, path: str, run: str) -> bool:
    """Add the rows of a run; False, and nothing is written, if the run is already there."""
    if run in committed(df.sparkSession, path):
        return False
    commit(df, path, run)
    return True


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all committed runs."""
    folders = list(committed(spark, path).values())
    if not folders:
        raise FileNotFoundError(f"no committed run in {path}")
    return spark.read.parquet(*folders)


def replace_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Commit ``df`` as the next version and read it; earlier versions stay for those who read them until ``forget``."""
    last = max((int(v) for v in committed(df.sparkSession, path)), default=0)
    commit(df, path, f"{last + 1:012d}")
    return read_snapshot(df.sparkSession, path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed version."""
    versions = committed(spark, path)
    if not versions:
        raise FileNotFoundError(f"no committed version in {path}")
    return spark.read.parquet(versions[max(versions)])


def forget(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Delete all versions but the newest ``keep``, the manifest of each before its rows."""
    versions = committed(spark, path)
    for name in sorted(versions)[: -keep or None]:
        folder = versions[name]
        for target in (f"{path}/_commits/{name}.{folder.rpartition('/')[2]}", folder):
            fs, at = _at(spark, target)
            fs.delete(at, True)
