"""Properties of the plans that decide how the jobs scale."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lagloom.operators import lag as L
from lagloom.operators.lookup import lookup
from lagloom.plans import fixtures as X

SF = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def query_plan(spark, name):
    return plan(entry.queries()[name](spark, SF))


@pytest.mark.parametrize(
    "name",
    [
        "confusion_by_group", "scorecard", "value_target_mean", "lag_match_best", "lag_match_tuple", "join_wildcard",
        "syntactic_onehot", "join_mention_pairs", "cluster_membership_by_parts", "token_dictionary", "normalise_by_max",
        "align_to_prior", "embedding_assemble", "panel_full_stats", "running_count_in_file_order",
    ],
)
def test_no_pairwise_join_and_no_row_python(spark, name):
    text = query_plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text


def test_scans_read_only_what_is_used(spark):
    text = query_plan(spark, "panel_basic_stats")
    schema = re.search(r"ReadSchema: (struct<[^\n]*)", text).group(1)
    assert set(re.findall(r"(l_\w+):", schema)) == {"l_partkey", "l_suppkey", "l_quantity", "l_shipdate"}
    filtered = plan(X.entity(spark, SF).where("row_pos > 10").select("id"))
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,10)]" in filtered


def test_panel_statistics_add_no_shuffle(spark):
    exchanges = lambda t: len(re.findall(r"^\s*[+:\- ]*Exchange \(", t, re.M))
    base = exchanges(plan(X.panel(spark, SF).select("id")))
    for name in ("panel_full_stats", "panel_order_stats", "panel_first_three_nonzero", "panel_share_of_total"):
        assert exchanges(query_plan(spark, name)) == base, name


def test_tuple_match_is_one_shuffle_after_the_panel(spark):
    rows = spark.createDataFrame(
        [(1, True, [[1, 2, 3, 4]])], "id long, is_train boolean, series array<array<long>>"
    )
    text = plan(L.lag_match_tuple(rows, 4, 3))
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 1 and "Join" not in text


def test_lookup_gives_both_sides_an_exchange(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        probe = spark.range(1000).select((F.col("id") % 5).alias("k"), "id")
        dim = probe.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        text = plan(lookup(probe, dim, "k"))
        # One for the aggregate, and one for each side of the join.
        assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 3
        assert lookup(probe, dim, "k").where("n = 200").count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_hot_probe_key_is_split(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50)
        probe = spark.range(0, 60000, 1, 8).select(key.alias("k"), "id", F.uuid().alias("pad"))
        dim = spark.range(50).select(F.col("id").alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        joined = lookup(probe, dim, "k")
        assert len(joined.collect()) == 60000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_small_measured_dim_leaves_the_probe_in_place(spark):
    probe = spark.range(1000).select((F.col("id") % 5).alias("k"), "id")
    dim = probe.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    text = plan(lookup(probe, dim, "k", measure=True))
    assert "BroadcastHashJoin" in text and not re.search(r"^\(\d+\) Exchange", text, re.M)


def test_assembled_features_are_all_there(spark):
    assert len(entry.queries()["feature_assembly"](spark, SF).columns) == 1 + 69
