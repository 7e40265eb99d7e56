"""Every registered query against its SQL on the smallest tables."""

import math
import sys

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
# Each fits a model; covered by smaller fixtures in test_metrics_blend.
FITS = {
    "cv_score", "grid_search", "two_stage_classifier", "bagged_regression", "one_vs_rest_forest",
    "gradient_boosted_multiclass", "feature_importances", "mlp_classifier_cv", "pca_features", "gradient_boosted_embeddings",
}


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, (int, str)):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return float(f"{float(v):.9g}") if hasattr(v, "as_integer_ratio") else v


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - FITS))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    order = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    rel = duck.execute(sql)
    names = [c[0] for c in rel.description]
    assert sorted(names) == order
    want = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in rel.fetchall()), key=repr)
    assert got == want


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_check_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert "duckdb" not in {m for m in sys.modules if m.startswith("lagloom")}
