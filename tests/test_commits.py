import pytest
from pyspark.sql import functions as F

from lagloom.sources import commits


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_a_repeated_run_changes_nothing(spark, tmp_path):
    path = f"{tmp_path}/m"
    assert commits.append_once(spark.range(2), path, "a") and commits.append_once(spark.range(5, 6), path, "b")
    assert not commits.append_once(spark.range(2), path, "a")
    assert ids(commits.read_runs(spark, path)) == [0, 1, 5]
    with pytest.raises(ValueError):
        commits.append_once(spark.range(1), path, "a/b")


def test_a_run_that_fails_midway_is_not_seen_and_can_be_repeated(spark, tmp_path):
    path = f"{tmp_path}/m"
    commits.append_once(spark.range(2), path, "a")
    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        commits.append_once(broken, path, "b")
    assert ids(commits.read_runs(spark, path)) == [0, 1]
    commits.append_once(spark.range(7, 8), path, "b")
    assert ids(commits.read_runs(spark, path)) == [0, 1, 7]


def test_a_snapshot_is_replaced_at_once(spark, tmp_path):
    path = f"{tmp_path}/s"
    with pytest.raises(FileNotFoundError):
        commits.read_snapshot(spark, path)
    old = commits.replace_snapshot(spark.range(3), path)
    new = commits.replace_snapshot(old.where("id > 0"), path)  # from itself
    broken = spark.range(1).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        commits.replace_snapshot(broken, path)
    assert ids(old) == [0, 1, 2] and ids(new) == ids(commits.read_snapshot(spark, path)) == [1, 2]
    commits.forget(spark, path)
    assert ids(commits.read_snapshot(spark, path)) == [1, 2] and len(commits.committed(spark, path)) == 1
