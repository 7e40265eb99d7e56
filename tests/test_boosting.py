"""Boosted trees against a plain version on the same bins, and what makes them scale."""

import contextlib
import io
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from lagloom.operators import blend
from lagloom.operators import boosting as G

PLAIN = G.Settings(rounds=3, depth=3, rate=0.3, child=0.5, penalty=0.2, ridge=1.0, rows=1.0, columns=1.0)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    out = []
    for i in range(240):
        x = [float(rng.randrange(9)), rng.random(), float(rng.randrange(3)), float("nan") if i % 17 == 0 else 1.0]
        out.append((i, x, int(x[0] > 3) + int(x[0] > 6 and x[2] > 0)))
    return spark.createDataFrame(out, "id long, x array<double>, label int").cache()


def plain_fit(x, target, s):
    """Trees grown one by one over all rows; x holds bins. Returns the margins."""
    n, k = len(x), s.classes
    start = 0.5 if s.loss == "squared" else 0.0
    margins = np.full((n, k), start)
    if s.loss == "softmax":
        margins[:] = np.log(np.bincount(target.astype(int), minlength=k) / n)

    def weight(g, h):
        return g * g / (h + s.ridge) if h + s.ridge > 0 else 0.0

    def grow(at, g, h, depth):
        own = -s.rate * g[at].sum() / (h[at].sum() + s.ridge) if h[at].sum() + s.ridge > 0 else 0.0
        best = (-1.0, 0, 0)
        if depth < s.depth:
            for f in range(x.shape[1]):
                for b in sorted(set(x[at, f]))[:-1]:
                    left, right = at[x[at, f] <= b], at[x[at, f] > b]
                    if h[left].sum() >= s.child and h[right].sum() >= s.child:
                        gain = round(weight(g[left].sum(), h[left].sum()) + weight(g[right].sum(), h[right].sum()) - weight(g[at].sum(), h[at].sum()), 9)
                        best = max(best, (gain, -f, -int(b)))
        if best[0] <= G.LEAST_GAIN:
            return [(at, own)], 0
        f, b = -best[1], -best[2]
        a, leaf_a = grow(at[x[at, f] <= b], g, h, depth + 1)
        c, leaf_c = grow(at[x[at, f] > b], g, h, depth + 1)
        if not leaf_a and not leaf_c and best[0] < s.penalty:
            return [(at, own)], 0
        return a + c, 1

    for _ in range(s.rounds):
        gs, hs = G.gradients(s.loss, margins, target)
        step = np.zeros_like(margins)
        for j in range(k):
            for at, value in grow(np.arange(n), gs[:, j], hs[:, j], 0)[0]:
                step[at, j] = value
        margins += step
    return margins


@pytest.mark.parametrize("loss, classes", [("logistic", 1), ("squared", 1), ("softmax", 3)])
def test_trees_are_those_of_a_plain_fit(rows, loss, classes):
    s = replace(PLAIN, loss=loss, classes=classes)
    target = (F.col("label") > 0).cast("int") if loss == "logistic" else F.col("label")
    fitted = G.fit(rows, "x", [G.Model(s, target)])
    got = fitted.margins(rows, "x").orderBy("id").toPandas()
    bins = G._coded(np.array(got.x.tolist()), fitted.cuts)
    y = got.label.to_numpy()
    expected = plain_fit(bins, (y > 0).astype(float) if loss == "logistic" else y.astype(float), s)
    assert np.allclose(np.array(got.margins.tolist()), expected, atol=1e-9)


def test_models_side_by_side_are_those_fitted_alone(rows):
    y = (F.col("label") > 0).cast("int")
    models = [G.Model(PLAIN, y), G.Model(replace(PLAIN, loss="softmax", classes=3, depth=2, rounds=2), F.col("label")), G.Model(replace(PLAIN, ridge=0.0, child=3), F.when(F.col("id") % 2 == 0, y))]
    together = G.fit(rows, "x", models).margins(rows, "x").orderBy("id").toPandas().margins.tolist()
    alone = [G.fit(rows, "x", [m]).margins(rows, "x").orderBy("id").toPandas().margins.tolist() for m in models]
    assert np.allclose(np.array(together), np.hstack([np.array(a) for a in alone]), atol=1e-9)


def test_sparse_cells_and_margins_written_out_change_nothing(rows, monkeypatch):
    model = G.Model(replace(PLAIN, rows=0.8, columns=0.7, level_columns=0.7), (F.col("label") > 0).cast("int"))
    expected = G.fit(rows, "x", [model]).margins(rows, "x").orderBy("id").toPandas().margins.tolist()
    monkeypatch.setattr(G, "DENSE", 0)
    monkeypatch.setattr(G, "KEEP", 1)
    got = G.fit(rows, "x", [model]).margins(rows, "x").orderBy("id").toPandas().margins.tolist()
    assert np.allclose(np.array(got), np.array(expected), atol=1e-9)


def test_scans_do_not_grow_with_the_grid(rows, monkeypatch):
    calls = []
    real = G.level_sums
    monkeypatch.setattr(G, "level_sums", lambda *a: calls.append(a) or real(*a))
    df = rows.withColumn("y", (F.col("label") > 0).cast("int"))
    G.grid_search(df, "y", PLAIN, {"penalty": [0.2]}, folds=2)
    one = len(calls)
    table = G.grid_search(df, "y", PLAIN, {"penalty": [0.2, 0.7], "child": [0.5, 2.0]}, folds=2).collect()
    assert len(table) == 4 and len(calls) - one <= PLAIN.rounds * PLAIN.depth and one <= PLAIN.rounds * PLAIN.depth
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        G.best_splits(real(*calls[-1]), calls[-1][1]).explain("formatted")
    assert out.getvalue().split("(1)")[0].count("Scan parquet") == 1


def test_a_tree_of_few_bins_takes_one_scan_a_round(rows, monkeypatch):
    calls = []
    real = G.level_sums
    monkeypatch.setattr(G, "level_sums", lambda *a: calls.append(a) or real(*a))
    y = (F.col("label") > 0).cast("int")
    deep = replace(PLAIN, depth=9, child=0.0, penalty=0.0)
    G.fit(rows, "x", [G.Model(deep, y), G.Model(replace(deep, rate=0.1), y)])
    assert len(calls) == PLAIN.rounds
    monkeypatch.setattr(G, "HELD", 1)
    calls.clear()
    G.fit(rows, "x", [G.Model(deep, y), G.Model(replace(deep, rate=0.1), y)])
    assert len(calls) == 2 * PLAIN.rounds  # what a task cannot hold at once takes more scans


@pytest.mark.parametrize("limit", [1, 6, 40, 1 << 20])
def test_rows_find_their_leaves_by_tables_of_any_size(limit):
    rng = np.random.default_rng(3)
    tree = G.Tree()
    for node in range(60):
        tree.split(node, int(rng.integers(4)), int(rng.integers(0, 255)), 1.0, (rng.random(), rng.random()))
    tree.feature[7] = -1  # taken back
    bins = rng.integers(0, 256, (4, 500)).astype(np.uint8)

    def leaf(row):
        node = 0
        while tree.feature[node] >= 0:
            node = tree.left[node] + int(row[tree.feature[node]] > tree.bin[node])
        return node

    want = [leaf(bins[:, i].astype(int)) for i in range(500)]
    finder = G.Finder(tree, limit)
    assert finder.leaves(bins).tolist() == want and np.asarray(finder.scores(bins)).tolist() == [tree.value[n] for n in want]
    assert len(finder.nodes) <= limit


def test_blocks_hold_targets_that_differ_by_more_than_their_gaps(rows):
    models = [G.Model(PLAIN, F.col("label")), G.Model(PLAIN, F.when(F.col("id") % 3 > 0, 2 - F.col("label")))]
    for kept in (models, models[1:]):
        table = G.binned(rows, "x", kept, G.find_cuts(rows, "x"), [0.0] * len(kept)).collect()
        assert all((r.targets is None) == (len(kept) == 1) for r in table)
        got = {}
        for r in table:
            block = G.Block(r.asDict())
            for m in range(len(kept)):
                has, target = block.target(m)
                got |= {(m, int(k)): t for k, t, h in zip(block.key.view(np.int64), target, has) if h}
        want = rows.select(F.xxhash64("id").alias("k"), *[m.target.alias(f"t{i}") for i, m in enumerate(kept)]).collect()
        assert got == {(m, r.k): r[f"t{m}"] for r in want for m in range(len(kept)) if r[f"t{m}"] is not None}


def test_held_out_rows_are_those_of_the_split_without_its_column(spark, rows, monkeypatch):
    named = rows.withColumn("id", F.when(F.col("id") != 5, F.concat(F.lit("row "), F.col("id"))))
    for df in (rows, named):
        models = [G.Model(PLAIN, F.col("label"), (0.3, r)) for r in range(4)]
        got = [set() for _ in models]
        for r in G.binned(df, "x", models, G.find_cuts(df, "x"), [0.0] * 4).collect():
            block = G.Block(r.asDict())
            for m in range(4):
                got[m] |= set(block.key[block.target(m)[0]].view(np.int64).tolist())
        want = [{r.k for r in df.where(~blend.holdout_split(F.col("id"), 0.3, m)).select(F.xxhash64("id").alias("k")).collect()} for m in range(4)]
        assert got == want and len(set(map(len, got))) > 1
    monkeypatch.setattr(blend, "holdout_split", None)  # 20 digests a row as text took most of the time
    assert G.bagged_regression(rows, rows, "label", repeats=2, settings=replace(PLAIN, loss="squared")).count() == 240


def test_cuts_explode_no_row(spark, rows, monkeypatch):
    cuts = G.find_cuts(rows, "x", 8)
    monkeypatch.setattr(G, "TOGETHER", 3)
    assert [c.tolist() for c in G.find_cuts(rows, "x", 8)] == [c.tolist() for c in cuts] and len(cuts) == 4
    assert cuts[2].tolist() == [0.0, 1.0, 2.0] and cuts[3].tolist() == [1.0]
    monkeypatch.setattr(F, "posexplode", None)
    G.find_cuts(rows, "x", 8)


def test_probabilities_add_up_as_they_are(rows):
    p = G.joint_multiclass(rows, rows, settings=replace(G.JOINT, rounds=8))
    assert p.count() == 240 and p.where("abs(p0 + p1 + p2 - 1) > 1e-12").count() == 0
    hit = p.join(rows, "id").where(F.greatest("p0", "p1", "p2") == F.get(F.array("p0", "p1", "p2"), F.col("label")))
    assert hit.count() == 240


def test_stages_bags_and_importances(rows):
    two = G.two_stage_classifier(rows, rows, first=PLAIN, second=PLAIN)
    assert two.where("abs(predict_0 + predict_1 + predict_2 - 1) > 1e-9").count() == 0
    assert two.join(rows, "id").where("(predict_0 > 0.5) = (label = 0)").count() == 240
    bag = G.bagged_regression(rows, rows, "label", repeats=3, settings=replace(PLAIN, loss="squared", rounds=12))
    assert bag.join(rows, "id").where("abs(target - label) > 0.35").count() == 0
    weights = {r.feature: r.weight for r in G.feature_importances(rows, list("abcd"), "label", replace(G.JOINT, rounds=2)).collect()}
    assert abs(sum(weights.values()) - 1) < 1e-9 and max(weights, key=weights.get) == "a"
    folds = G.cv_fold_scores(rows.withColumn("y", (F.col("label") > 0).cast("int")), "y", PLAIN, folds=3).collect()
    assert sum(r.n for r in folds) == 240 and all(0 < r.score < 0.5 for r in folds)


def test_edge_tables(spark, rows):
    assert G.joint_multiclass(rows.limit(0), rows, settings=replace(G.JOINT, rounds=1)).count() in (0, 240)
    blank = rows.withColumn("x", F.when(F.col("id") > 100, F.col("x")))
    assert G.joint_multiclass(rows, blank, settings=replace(G.JOINT, rounds=1)).where("p0 is null").count() == 0
    same = spark.createDataFrame([(i, [1.0, None], 1) for i in range(5)], "id long, x array<double>, label int")
    got = G.cv_fold_scores(same, "label", PLAIN, folds=2).collect()
    assert sum(r.n for r in got) == 5


def test_penalties_prune_and_bound():
    tree = G.Tree()
    tree.split(0, 0, 1, 0.1, (1.0, -1.0))
    tree.split(1, 1, 1, 2.0, (2.0, 0.5))
    tree.prune(0.5)
    assert tree.feature[:2] == [0, 1]  # a weak split above a strong one stays
    tree.gain[1] = 0.2
    tree.prune(0.5)
    assert tree.feature[:2] == [-1, -1]
