from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lagloom.operators import blend as B
from lagloom.operators import networks as N


def loss_of(p, x, target, mask, keep, ridge):
    """Plain mean loss of one network, row by row."""
    use = [i for i in range(len(x)) if mask[i]]
    z = np.array([x[i] @ p["w1"] + p["b1"] for i in use])
    y = (z - z.mean(axis=0)) / np.sqrt(z.var(axis=0) + N.EPSILON) * p["scale"] + p["shift"]
    out = 0.0
    for i, row in zip(use, y, strict=True):
        logits = (np.maximum(row, 0) * keep[i]) @ p["w2"] + p["b2"]
        out -= logits[target[i].argmax()] - np.log(np.exp(logits).sum())
    return out / len(use) + ridge * (p["w2"] ** 2).sum()


def test_gradients_are_differences_of_the_loss():
    draw, shapes = np.random.default_rng(5), N.Shapes(3, 4, 3)
    vectors = np.stack([shapes.start(1), shapes.start(2)])
    vectors += draw.normal(0, 0.1, vectors.shape)
    x, target = draw.normal(size=(9, 3)), np.eye(3)[draw.integers(0, 3, 9)]
    mask, keep = draw.random((2, 9)) < 0.7, (draw.random((2, 9, 4)) < 0.8) / 0.8
    slopes, _, _ = N.gradients(shapes.split(vectors), x, target, mask.astype(float), keep, 0.1)
    for net in range(2):
        for name in shapes.learned:
            flat = slopes[name][net].ravel()
            for j in range(len(flat)):
                sides = []
                for h in (1e-5, -1e-5):
                    moved = vectors.copy()
                    p = {k: v[net] for k, v in shapes.split(moved).items()}
                    p[name].reshape(-1)[j] += h
                    sides.append(loss_of(p, x, target, mask[net], keep[net], 0.1))
                assert flat[j] == pytest.approx((sides[0] - sides[1]) / 2e-5, abs=1e-6)


def test_a_network_keeps_its_best_weights():
    net = N.Network(1, 0, np.zeros(1))
    for epoch, (loss, kept) in enumerate([(1.0, 0), (0.5, 1), (0.7, 1), (0.4, 3), (0.6, 3), (0.6, 3)]):
        net.weights, net.epoch = np.full(1, epoch), epoch
        net.judge(loss, 2)
        assert net.best_epoch == kept and net.best[0] == kept
    assert net.stopped and net.loss == 0.4


SMALL = N.Settings(hidden=8, drop=0.1, rate=0.01, ridge=0.001, epochs=100, patience=20, passes=5)


@pytest.fixture(scope="module")
def points(spark):
    rows = [(i, [float(i % 10), float((i * 7) % 13)], (i % 10 > 3) + (i % 10 > 7)) for i in range(300)]
    return spark.createDataFrame(rows, "id long, v array<double>, label int").select("id", array_to_vector("v").alias("features"), "label").persist()


def test_out_of_fold_covers_every_id_once_per_seed(spark, points):
    long = N.mlp_classifier_cv(points, points.limit(5), 2, folds=2, seeds=(1, 2), settings=SMALL).persist()
    oof = long.where("part = 'oof'")
    assert oof.count() == 600 and oof.select("id", "seed").distinct().count() == 600
    assert oof.where(F.col("fold") != F.when(F.col("seed") == 1, B.kfold_assign(F.col("id"), 2, 1)).otherwise(B.kfold_assign(F.col("id"), 2, 2))).count() == 0
    assert long.where("part = 'test'").groupBy("id").count().where("count <> 4").count() == 0
    assert oof.where("abs(p0 + p1 + p2 - 1) > 1e-9 or best_epoch > last_epoch or last_epoch > 100 or fold_loss is null").count() == 0
    right = oof.join(points, "id").where("greatest(p0, p1, p2) = element_at(array(p0, p1, p2), label + 1)").count()
    assert right > 540
    # the loss told is the loss of the rows scored
    own = oof.join(points, "id").groupBy("seed", "fold").agg(F.avg(-F.log(F.expr("element_at(array(p0, p1, p2), label + 1)"))).alias("a"), F.max("fold_loss").alias("b"))
    assert own.where("abs(a - b) > 1e-9").count() == 0


def test_chunks_are_averaged_and_odd_rows_left_out(spark, points):
    odd = spark.createDataFrame([(None, [1.0, 2.0], 1), (900, [float("nan"), 0.0], 1), (901, [1.0, 1.0], None)], "id long, v array<double>, label int")
    more = points.unionByName(odd.select("id", array_to_vector("v").alias("features"), "label"))
    more = more.unionByName(spark.createDataFrame([(902, None, 1)], points.schema))
    parts = replace(SMALL, chunk=64)
    got = [
        N.mlp_classifier_cv(more.repartition(k), more, 2, folds=2, seeds=(1,), settings=parts).orderBy("part", "id", "fold").collect() for k in (1, 5)
    ]
    assert len(got[0]) == len(got[1]) == 300 + 2 * 302
    pairs = [(a, b) for a, b in zip(*got, strict=True) if a.id is not None]
    assert max(abs(a.p0 - b.p0) for a, b in pairs) < 1e-6
    assert sum(a.id is None for a in got[0]) == 2


def test_no_rows(spark, points):
    got = N.mlp_classifier_cv(points.limit(0), points.limit(3), 2, folds=2, seeds=(1,), settings=SMALL)
    assert [(r.best_epoch, r.last_epoch, r.fold_loss) for r in got.collect()] == [(0, 0, None)] * 6
