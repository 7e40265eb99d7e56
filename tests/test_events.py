import random

import pytest
from pyspark.sql import functions as F

from lagloom.operators import events as E


@pytest.mark.parametrize("chunk", [3, 50, 1 << 20])
def test_running_count_with_a_hot_key(spark, chunk):
    rng = random.Random(chunk)
    rows = [(pos, "hot" if rng.random() < 0.5 else rng.choice("abc")) for pos in rng.sample(range(500), 200)]
    seen, want = {}, {}
    for pos, key in sorted(rows):
        seen[key] = seen.get(key, 0) + 1
        want[pos] = seen[key]
    df = spark.createDataFrame(rows, "row_pos long, location string").repartition(5)
    got = E.running_count_in_file_order(df, "location", chunk=chunk).collect()
    assert {r.row_pos: r.appearance for r in got} == want


def test_codes_by_first_appearance_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "b", 0), (1, "a", 1), (1, "b", 2), (2, "c", 3)], "id int, v string, row_pos long")
    codes = E.first_appearance_code(df, "v")
    assert {r.v: r.code for r in codes.collect()} == {"b": 0, "a": 1, "c": 2}
    summed = {r.id: [tuple(x) for x in r.m] for r in E.bitmask_sum(df, codes, "v", "m").collect()}
    assert summed == {1: [(0, 2), (1, 1)], 2: [(2, 1)]}
    assert {r.id: r.m for r in E.bitmask_sum(df, codes, "v", "m", distinct=True).collect()} == {1: [0, 1], 2: [2]}
    assert {r.id: [tuple(x) for x in r.m] for r in E.bitmask_sum(df, codes, "v", "m", values=["b"]).collect()} == {1: [(0, 2)]}


def test_codes_of_many_values_with_repeated_rows(spark):
    df = spark.range(800).select(F.lit(1).alias("id"), (199 - F.col("id") % 200).cast("string").alias("v"), F.col("id").alias("row_pos"))
    codes = E.first_appearance_code(df.repartition(5), "v")
    assert {int(r.v): r.code for r in codes.collect()} == {199 - k: k for k in range(200)}
    assert [tuple(x) for x in E.bitmask_sum(df, codes, "v", "m").first().m] == [(k, 4) for k in range(200)]


def test_first_and_last_rows(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 2, "y"), (2, 1, "z")], "id int, row_pos long, v string")
    assert {r.id: r.v for r in E.first_row_per_key(df, ["id"]).collect()} == {1: "y", 2: "z"}
    assert {r.id: r.v for r in E.last_row_per_key(df, ["id"]).collect()} == {1: "x", 2: "z"}
    pivot = E.pivot_last_value(df.withColumn("n", F.col("row_pos") * 10), "v", "n", ["x", "y", "q"])
    assert sorted(tuple(r) for r in pivot.collect()) == [(1, 50, 20, 0), (2, 0, 0, 0)]


def test_pairs_come_from_the_end_of_the_list(spark):
    df = spark.createDataFrame([(1, 1, 0, 2, 3)], "id int, a int, b int, c int, d int")
    got = E.pair_indicator(df, ["z", "a", "b", "c", "d"]).first().asDict()
    assert [k for k in got if k.startswith("pair")] == [
        "pair_d_c", "pair_d_b", "pair_d_a", "pair_c_b", "pair_c_a", "pair_b_a",
    ]
    assert (got["pair_d_c"], got["pair_d_b"], got["pair_c_a"], got["pair_b_a"]) == (1, 0, 1, 0)


def test_dense_codes_over_many_partitions(spark):
    values = [f"{random.Random(i).random():.6f}" for i in range(500)] + [None, "é", "Z", "a"]
    df = spark.createDataFrame([(v,) for v in values * 2], "v string").repartition(7)
    got = {r.v: r.code for r in E.dense_codes(df, "v").collect()}
    order = sorted({v for v in values if v is not None}, key=lambda v: v.encode())
    assert got == {v: i for i, v in enumerate(order)}


def test_counts_cover_all_parts(spark):
    a = spark.createDataFrame([(1, 7), (2, 8)], "id int, loc int")
    b = spark.createDataFrame([(3, 7)], "id int, loc int")
    assert {r.id: r.n for r in E.count_over_union([a, b], "loc", "n").collect()} == {1: 2, 2: 1, 3: 2}
    kids = spark.createDataFrame([(1,), (1,)], "id int")
    assert {r.id: r.n for r in E.child_count(a, kids, "n").collect()} == {1: 2, 2: 0}


def test_feature_tables_stack_to_an_outer_join(spark):
    base = spark.createDataFrame([(1,)], "id int")
    x = spark.createDataFrame([(1, 5), (2, 6)], "id int, x int")
    y = spark.createDataFrame([(3, 7)], "id int, y int")
    got = sorted((r.id, r.x, r.y) for r in E.join_feature_tables(base, [x, y]).collect())
    assert got == [(1, 5, 0), (2, 6, 0), (3, 0, 7)]


def test_labels_from_flags(spark):
    df = spark.createDataFrame([(True, True), (True, False), (False, None)], "a boolean, b boolean")
    label = E.label_from_flags(df, "a", "b")
    assert [r[0] for r in df.select(label).collect()] == [2, 1, 0]
    assert [r[0] for r in df.select(E.label_from_flags(df, "a", "b", a_wins=True)).collect()] == [1, 1, 0]
    fixed = df.withColumns({"a_fixed": F.lit(False), "b_fixed": F.lit(True)})
    assert [r[0] for r in fixed.select(E.label_from_flags(fixed, "a", "b")).collect()] == [2, 2, 2]
