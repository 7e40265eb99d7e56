import math
import random

import pytest
from pyspark.sql import functions as F

from lagloom.operators import panel as P


def one(spark, series, stats, kind="long"):
    df = spark.createDataFrame([(1, series)], f"id long, a array<{kind}>")
    return P.spread(df, ["id"], stats(F.col("a"))).first().asDict()


def test_basic_stats_of_zero_row(spark):
    got = one(spark, [0, 0], P.basic_stats)
    assert (got["nz_mean"], got["nz_max"], got["ez"], got["mean"], got["max"]) == (None, None, 2, 0.0, 0)


def test_full_stats_single_value(spark):
    got = one(spark, [0, 6, 0], P.full_stats)
    assert got["full_nzvar"] is None and got["full_nzmean"] == 6.0 and got["full_median"] == 0.0
    assert math.isclose(got["full_var"], 12.0)


def test_number_stats_counts_zeros_as_divided(spark):
    got = one(spark, ["0", "0.0", "1000.0", "1000.0", "333.34", "1.125"], P.number_stats, "string")
    assert got == {"id": 1, "cnt_nz": 4, "len_nz": 3, "cnt_mode_nz": 2, "cnt_div": 4, "cnt_fake": 1, "cnt_norm": 3}
    assert one(spark, [], P.number_stats, "string")["cnt_mode_nz"] == 0


def test_digit_histogram_and_numbers(spark):
    cells = ["2531000.0", "31000", "999", "000", "41000.0"]
    df = spark.createDataFrame([(1, cells)], "id long, a array<string>").select("id", P.digit_histogram(F.col("a")).alias("h"))
    h = df.first().h
    assert h[0][1] == 3 and h[1][3] == 2 and h[1][4] == 1 and h[2][5] == 1 and h[3][2] == 1
    assert sum(map(sum, h)) == 8
    got = P.spread(df, ["id"], P.digit_numbers(F.col("h"))).first()
    # Most frequent digits 1, 3, 5, 2 from the right; unused positions give 0.
    assert got.dig_mode == 2531000.0
    assert got.dig_nz == 1000 * 1 + 10000 * 2 + 100000 + 1000000
    assert math.isclose(got.dig_mean, 0.3 * 1000 + 0.3 * 10000 + 0.1 * 100000 + 0.1 * 1000000)


def test_string_stats(spark):
    got = one(spark, ["12000.0", "5", "3000000", "0"], P.string_stats, "string")
    assert got["str_zeros_mean"] == 4.5 and got["str_len_mean"] == 14 / 4
    assert got["spec_mean"] == 1506000.0 and got["str_nz_mean"] == 2.0 and got["str_nz_mean_full"] == 3.0
    assert one(spark, ["1"], P.string_stats, "string")["spec_mean"] == 0.0


def test_first_three_nonzero(spark):
    got = one(spark, [0, 5, 0, 0, 7], P.first_three_nonzero)
    assert (got["time_delta"], got["time2_delta"], got["time3_delta"]) == (1, 2, -1)
    assert math.isclose(got["prev_value"], math.log(6)) and got["prev3_value"] == 0.0


def test_shares_and_axes(spark):
    series = [[1, 0], [2, 0], [2, 0]]
    df = spark.createDataFrame([(1, series)], "id long, series array<array<long>>")
    share = df.select(P.share_of_total(F.col("series"), 0, [1, 2]).alias("s")).first().s
    assert share == [0.25, -1.0]
    by_pos = df.select(P.day_stats(F.col("series")).alias("s")).first().s
    by_grp = df.select(P.day_stats(F.col("series"), axis="grp").alias("s")).first().s
    assert [(r.nz_mean, r.ez) for r in by_pos] == [(5 / 3, 0), (None, 3)]
    assert [(r.nz_mean, r.ez) for r in by_grp] == [(1.0, 1), (2.0, 1), (2.0, 1)]


def test_assemble_round_trip(spark):
    rng = random.Random(1)
    cells = {(i, g, p): rng.randrange(1, 9) for i in range(20) for g in range(3) for p in range(5) if rng.random() < 0.4}
    df = spark.createDataFrame([(*k, v) for k, v in cells.items()], "id long, grp int, pos int, value long")
    back = P.unpivot_panel(P.assemble_panel(df, 3, 5), ["id"])
    assert back.count() == 15 * df.select("id").distinct().count()
    got = {(r.id, r.grp, r.pos): r.value for r in back.where("value <> 0").collect()}
    assert got == cells


@pytest.mark.parametrize("oof", [False, True])
def test_value_target_mean_brute_force(spark, oof):
    rng = random.Random(2)
    rows = [(i, rng.choice([0, 5, 9]), i % 7 == 0, [[rng.choice([0, 0, 1, 2, 3]) for _ in range(4)]]) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, target long, is_fake boolean, series array<array<long>>")
    table = {}
    for _, t, fake, s in rows:
        for v in s[0]:
            if not fake and t > 0 and v > 0:
                a, b = table.get(v, (0, 0))
                table[v] = (a + t, b + 1)
    want = {}
    for i, t, fake, s in rows:
        if fake:
            continue
        hits = [table[v] for v in s[0] if v in table and table[v][1] >= 3]
        own = len(hits) if oof and t > 0 else 0
        want[i] = (sum(a for a, _ in hits) - own * t) / (sum(b for _, b in hits) - own + 0.000001)
    for parts in (1, 7):
        got = {r.id: r.simple_predict for r in P.value_target_mean(df.repartition(parts), 3, oof).collect()}
        assert got.keys() == want.keys()
        assert all(math.isclose(got[k], want[k], abs_tol=1e-6) for k in want)


def test_select_columns_without_absolute_difference(spark):
    rows = [(i, 10, [[10 if i < 4 else 100, 0]]) for i in range(10)]
    df = spark.createDataFrame(rows, "id long, target long, series array<array<long>>")
    got = {(r.grp, r.pos): (r.n_equal, r.n_close) for r in P.select_columns_by_data(df, -1, -1).collect()}
    # A zero cell is far below the target and so counts as close.
    assert got == {(0, 0): (4, 4), (0, 1): (0, 10)}
    strict = {(r.grp, r.pos): r.n_close for r in P.select_columns_by_data(df, -1, -1, absolute=True).collect()}
    assert strict == {(0, 0): 4, (0, 1): 0}
