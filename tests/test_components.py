import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lagloom.operators import components as C


def frame(spark, x, more=()):
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + list(more)
    return spark.createDataFrame(rows, "id long, v array<double>").select(
        "id", F.when(F.col("v").isNotNull(), array_to_vector(F.coalesce("v", F.array(F.lit(0.0))))).alias("features")
    )


def plain(x):
    """All components by the full matrix, largest first."""
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True).reshape(x.shape[1], x.shape[1]))
    return values[::-1], vectors[:, ::-1]


@pytest.mark.parametrize(("n", "width", "fall"), [(300, 40, 0.9), (60, 120, 0.999), (50, 2, 0.5), (200, 60, 1.0)])
def test_components_are_those_of_the_full_matrix(spark, n, width, fall):
    draw = np.random.default_rng(width)
    x = draw.normal(size=(n, width)) * fall ** np.arange(width) * 100 + draw.normal(size=width) * 1000
    found = C.fit_components(frame(spark, x).repartition(3), 3)["pca"]
    k = min(3, width)
    values, vectors = plain(x)
    assert np.allclose(found.variances, values[:k], rtol=1e-8)
    assert np.allclose(found.directions.T @ found.directions, np.eye(k), atol=1e-10)
    assert np.allclose(np.abs((found.directions * vectors[:, :k]).sum(axis=0)), 1, atol=1e-6)
    assert np.allclose(found.mean, x.mean(axis=0))


def test_a_wide_table_holds_no_square_matrix(spark):
    draw = np.random.default_rng(1)
    x = (draw.normal(size=(120, 4)) * [9, 5, 3, 1]) @ draw.normal(size=(4, 3480)) + 0.01 * draw.normal(size=(120, 3480))
    found = C.fit_components(frame(spark, x), 3)["pca"]
    spread = np.linalg.svd(x - x.mean(axis=0), compute_uv=False)[:3] ** 2 / len(x)
    assert np.allclose(found.variances, spread, rtol=1e-8) and found.residual <= 1e-8 * spread[0]


def test_equal_and_missing_variances(spark):
    ties = np.vstack([np.eye(4), -np.eye(4)])  # every direction has the same variance
    assert np.allclose(C.fit_components(frame(spark, ties), 2)["pca"].variances, 0.25)
    same = C.fit_components(frame(spark, np.ones((5, 4))), 2)["pca"]
    assert np.allclose(same.variances, 0) and np.isfinite(same.directions).all()
    line = np.outer(np.arange(6.0), [1, 2, 3])  # one direction only
    assert np.allclose(C.fit_components(frame(spark, line), 2)["pca"].variances, [plain(line)[0][0], 0])


def test_projections_are_centred_nested_and_keep_odd_rows(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(80, 6)) * [9, 7, 5, 3, 2, 1]
    df = frame(spark, x, [(1000, None), (1001, [float("nan")] + [0.0] * 5), (None, [1.0] * 6), (None, [1.0] * 6)])
    both = df.withColumn("again", F.when(F.col("id") % 2 == 0, F.col("features"))).repartition(3)
    got = C.pca_features(both, (1, 2), {"pca": "features", "half_pca": "again"})
    assert got.columns == ["id", "pca1_0", "pca2_0", "pca2_1", "half_pca1_0", "half_pca2_0", "half_pca2_1"]
    rows = got.collect()
    assert len(rows) == 84 and sum(r.pca1_0 is None for r in rows) == 2
    assert all(r.pca1_0 == r.pca2_0 for r in rows)
    assert abs(np.mean([r.pca2_1 for r in rows if r.pca2_1 is not None])) < 1e-9
    own = np.array([x[r.id] for r in rows if r.id is not None and r.half_pca2_0 is not None])
    scores = np.array([r.half_pca2_0 for r in rows if r.id is not None and r.half_pca2_0 is not None])
    direction = plain(own)[1][:, 0]
    assert len(own) == 40 and np.allclose(np.abs((own - own.mean(axis=0)) @ direction), np.abs(scores), atol=1e-6)


def test_no_rows(spark):
    empty = frame(spark, np.ones((1, 2))).where("id < 0")
    assert C.fit_components(empty, 2) == {} and C.pca_features(empty, 2).columns == ["id", "pca2_0", "pca2_1"]
    assert C.pca_features(empty, 2).count() == 0
