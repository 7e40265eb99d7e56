import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lagloom.operators import lag as L

N, G = 12, 3
SCHEMA = "id long, target long, is_train boolean, is_fake boolean, row_pos long, series array<array<long>>"


def make_rows(seed, n=60, hot=20):
    """Random sparse rows, shifted children of some, and a third of all rows alike."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        s = [[rng.choice([0, 0, 1, 2, 5]) for _ in range(N)] for _ in range(G)]
        rows.append([i, i % 3 != 0, i % 10 == 1, s])
    for i in range(0, n, 2):
        shift = 2 + i % 4
        kid = [g[shift:] + [rng.randrange(6, 99) for _ in range(shift)] for g in rows[i][3]]
        rows.append([1000 + i, rows[i][1], False, kid])
    same = [[4, 4, 0, 2] + [7, 1] * 4 for _ in range(G)]
    rows += [[2000 + i, True, False, same] for i in range(hot)]
    rng.shuffle(rows)
    return [(i, s[0][0], train, fake, pos, s) for pos, (i, train, fake, s) in enumerate(rows)]


def first_match(rows, nonzero_min=2):
    """Dictionaries filled and read in file order, one group and shift after the other."""
    def changes(v):
        prev, out = -1, []
        for x in v:
            out.append(1 if x > 0 and x != prev else 0)
            prev = x
        return out

    used = sorted((r for r in rows if r[2] or not r[3]), key=lambda r: r[4])
    out = []
    for g in range(G):
        for s in range(2, N - 2):
            table = {}
            for i, _, train, _, _, series in used:
                v, target = series[g], series[0][s - 2]
                nz = sum(changes(v)[s:])
                if nz >= nonzero_min and target > 0:
                    table.setdefault((train, tuple(v[s:])), (i, target, nz))
            for i, _, train, _, _, series in used:
                v = series[g]
                hit = table.get((train, tuple(v[: N - s])))
                if sum(changes(v)[: N - s]) >= nonzero_min and hit:
                    out.append((i, hit[0], train, g, s, hit[1], hit[2]))
    return out


@pytest.mark.parametrize("seed,parts", [(1, 1), (2, 7), (3, 16)])
def test_first_best_and_edges_equal_dictionaries(spark, seed, parts):
    rows = make_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    want = first_match(rows)
    matches = L.lag_match_first(df, N)
    got = sorted(tuple(r) for r in matches.select("child_id", "parent_id", "is_train", "grp", "shift", "target", "nz").collect())
    assert got == sorted(want) and len(got) > 50

    best, edges = {}, {}
    for child, parent, _, g, s, target, nz in want:
        cur = best.get(child)
        if cur is None or nz > cur[1] or (nz == cur[1] and s < cur[3]):
            best[child] = (target, nz, g, s)
        edges[parent, child] = s
    rows_best = L.lag_match_best(matches).collect()
    assert {r.child_id: (r.found_target, r.found_len, r.round_num, r["shift"]) for r in rows_best} == best
    assert {(r.parent_id, r.child_id): r["shift"] for r in L.lag_link_edges(matches).collect()} == edges

    assert L.verify_pairs(matches, df, N).count() == len(want)
    broken = matches.withColumn("shift", F.lit(N - 3))
    assert L.verify_pairs(broken, df, N).count() < len(want)


def test_matches_by_groups_are_those_of_one_pass(spark, monkeypatch):
    df = spark.createDataFrame(make_rows(8), SCHEMA).repartition(5)
    whole = sorted(tuple(r) for r in L.lag_match_first(df, N).collect())
    calls, real = [], L._first_matches
    monkeypatch.setattr(L, "_first_matches", lambda *a: calls.append(a) or real(*a))
    monkeypatch.setattr(L, "SLICES", 2 * df.count())
    got = sorted(tuple(r) for r in L.lag_match_first(df, N).collect())
    assert got == whole and len(got) > 50 and len(calls) == 2


def test_a_row_asks_once_for_slices_that_differ_by_zeros_at_their_end():
    v = [0, 3, 0, 0, 5, 0, 0, 0, 7, 0, 0, 0]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([True]), pa.array([1], pa.int32()), pa.array([v]), pa.array([[1] * N])], ["is_train", "grp", "v", "first"]
    )
    slices = L.Slices(batch, N)
    row, low, high, *_ = slices.prefixes(2)
    # up to the 7, shifts 2 and 3; up to the 5, shifts 4 to 7; eight of them are asked for otherwise
    assert [row.tolist(), low.tolist(), high.tolist()] == [[0, 0], [2, 4], [3, 7]]
    row, shift, h1, h2, nz = slices.suffixes(2, 2)
    assert shift.tolist() == [2, 3, 4] and nz.tolist() == [2, 2, 2] and len(set(h1.tolist())) == 3


def test_nulls_and_short_rows_are_no_zeros():
    def keys(v):
        batch = pa.RecordBatch.from_arrays(
            [pa.array([None], pa.bool_()), pa.array([0], pa.int32()), pa.array([v], pa.list_(pa.int64())), pa.array([[1] * N])], ["is_train", "grp", "v", "first"]
        )
        return tuple(L.Slices(batch, N).sums[0][0].tolist())

    v = [1, 2, 0, 4] + [0] * 8
    assert len({keys(v), keys(v[:-1]), keys([1, 2, None, 4] + [0] * 8), keys(v[:-1] + [None])}) == 4


def test_written_keys_equal_slices(spark):
    rows = [(1, [[0, 3, 3, 0, 12, 0, 7, 0], [0] * 8]), (2, [[5, None, 5, -2, 0, 1, 0, 9], [1, 2, 3, 4, 5, 6, 7, 8]])]
    df = spark.createDataFrame(rows, "id long, series array<array<long>>")
    got = {(r.id, r.grp, r["shift"]): r for r in L.lag_keys(df, 8).collect()}
    assert len(got) == 2 * 2 * 4
    for i, series in rows:
        for g, v in enumerate(series):
            ch = [x is not None and x > 0 and x != (-1 if k == 0 or v[k - 1] is None else v[k - 1]) for k, x in enumerate(v)]
            for s in range(2, 6):
                r, t = got[i, g, s], series[0][s - 2]
                join = lambda a: "_".join(str(x) for x in a if x is not None)
                ok = sum(ch[s:]) >= 2 and t is not None and t > 0
                assert (r.suffix_nz, r.prefix_nz, r.target) == (sum(ch[s:]), sum(ch[: 8 - s]), t if ok else -1)
                assert (r.suffix_key, r.prefix_key) == (join(v[s:]) if ok else "", join(v[: 8 - s]) if sum(ch[: 8 - s]) >= 2 else "")


def test_tables_that_cut_lineage_drop_their_shuffle_files(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from lagloom import session

    seen, real = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a: seen.append(spark.conf.get(session._CLEANUP)) or real(self, *a))
    before = spark.conf.get(session._CLEANUP)
    assert session.cut_lineage(spark.range(100, numPartitions=3).repartition(5, "id")).count() == 100
    assert seen == ["true"] and spark.conf.get(session._CLEANUP) == before


def cascade(rows, max_offset, first_to):
    """Per part: every pass and offset in turn, unique keys on both sides only."""
    out = {}
    for train in (True, False):
        data = [r for r in rows if r[2] == train]
        for number, last in ((0, max_offset), (1, first_to)):
            for o in range(2, last + 1):
                need = 3 if number == 1 or o > 37 else 1
                later, earlier = {}, {}
                for i, _, _, _, _, s in data:
                    groups = [s[0], *s] if number == 0 else [s[0], s[0]]
                    if sum(x > 0 for g in groups for x in g[: N - o]) >= need:
                        later.setdefault(tuple(x for g in groups for x in g[: N - o]), []).append(i)
                    if s[0][o - 2] != 0:
                        earlier.setdefault(tuple(x for g in groups for x in g[o:]), []).append((i, s[0][o - 2]))
                for key, kids in later.items():
                    if len(kids) == 1 and len(earlier.get(key, [])) == 1:
                        out[train, number, o, kids[0]] = earlier[key][0]
    return out


@pytest.mark.parametrize("seed,parts", [(4, 1), (5, 9)])
def test_tuple_match_and_cascade_equal_loops(spark, seed, parts):
    rows = make_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    matches = L.lag_match_tuple(df, N, N - 1, first_group_to=8)
    want = cascade(rows, N - 1, 8)
    got = {(r.is_train, r["pass"], r.offset, r.child_id): (r.parent_id, r.pred) for r in matches.collect()}
    assert got == want and len(got) > 10
    first = {}
    for (train, number, o, kid), (_, pred) in sorted(want.items(), key=lambda kv: kv[0][1:3]):
        first.setdefault((kid, train), pred)
    assert {(r.child_id, r.is_train): r.pred for r in L.lag_match_cascade(matches).collect()} == first
    assert L.verify_pairs(matches, df, N, shift="offset").count() == len(want)


def test_planted_children_find_their_parents(spark):
    rng = random.Random(6)
    rows, want = [], {}
    for i in range(40):
        s = [[rng.randrange(1, 10**6) for _ in range(N)] for _ in range(G)]
        shift = 2 + i % 5
        rows.append((i, 0, True, False, i, s))
        rows.append((100 + i, s[0][shift - 2], True, False, 100 + i, [g[shift:] + [rng.randrange(1, 10**6) for _ in range(shift)] for g in s]))
        want[100 + i] = s[0][shift - 2]
    df = spark.createDataFrame(rows, SCHEMA)
    best = L.lag_match_best(L.lag_match_first(df, N))
    assert {r.child_id: r.found_target for r in best.collect()} == want
    cascade_rows = L.lag_match_cascade(L.lag_match_tuple(df, N, N - 1, first_group_to=8)).collect()
    assert {r.child_id: r.pred for r in cascade_rows} == want
    quality = L.lag_match_quality(best, df.select("id", "target")).first()
    assert (quality.matched, quality.good, quality.bad, quality.ratio) == (40, 40, 0, 1.0)


def test_quality_without_matches(spark):
    df = spark.createDataFrame([(1, 0, True, False, 0, [[0] * N] * G)], SCHEMA)
    q = L.lag_match_quality(L.lag_match_best(L.lag_match_first(df, N)), df.select("id", "target")).first()
    assert (q.matched, q.ratio) == (0, None)


def test_unique_keys_drop_every_repeat(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3), ("z", 4)], "k string, l int")
    b = spark.createDataFrame([("x", 1), ("y", 5), ("z", 6), ("z", 7)], "k string, r int")
    assert [tuple(r) for r in L.join_unique_keys(a, b, "k").collect()] == [("y", 3, 5)]
    assert sorted(r.k for r in L.drop_all_duplicates(a.select("k"), "k").collect()) == ["y", "z"]
