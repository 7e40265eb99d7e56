"""The pipeline against each stage's own brute-force meaning, and on edge cases."""

import corpus_pipeline
from lagloom.llm import pii
from test_operators import COLUMNS, EDGE, plain_groups, plain_simhash

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {"start": docs}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == kept["start"].columns
        kept[name] = docs
    rows = [sorted((r.doc_id, r.text) for r in d.collect()) for d in kept.values()]
    assert set(rows[1]) <= set(rows[0]) and len(rows[1]) >= 0.98 * len(rows[0])
    groups = plain_groups([(i, plain_simhash(t)) for i, t in rows[1]])
    assert rows[2] == [(i, t) for i, t in rows[1] if groups[i] == i]
    assert [i for i, _ in rows[3]] == [i for i, _ in rows[2]] and not any(pii.base_spans(t) for _, t in rows[3])
    mixed = {i for i, _ in rows[4]}
    assert set(rows[4]) <= set(rows[3]) and 0.8 * len(rows[3]) <= len(mixed) < len(rows[4])
    out = corpus_pipeline.run(spark, SF).toPandas()
    assert set(out.doc_id) == {i for i, _ in rows[4]} and (out.groupby("sequence_id").length.sum() <= 1024).all()


def test_edge_tables(spark):
    edge = spark.createDataFrame(EDGE, COLUMNS).selectExpr("*", "1 as score", "2 as fp")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, edge, SF)
        assert out.columns == edge.columns, name
        out.collect()
        assert stage(spark, edge.limit(0), SF).count() == 0, name


def test_one_python_worker_a_task_and_each_text_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plan = stage(spark, docs, SF)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") <= 1, name
        assert "struct(" not in plan, name


def test_own_columns_survive_mixing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "'a' as _tokens", "doc_id as _posterior", "1 as _copies", "2 as _copy")
    plain = corpus_pipeline.mixed(spark, docs.drop("_tokens", "_posterior", "_copies", "_copy"), SF)
    out = corpus_pipeline.mixed(spark, docs, SF)
    assert out.columns == docs.columns and out.where("_tokens <> 'a' or _posterior <> doc_id or _copies <> 1 or _copy <> 2").isEmpty()
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(r.doc_id for r in plain.select("doc_id").collect())
