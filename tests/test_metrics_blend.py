import math

import pytest
from pyspark.sql import functions as F

from lagloom.operators import blend as B
from lagloom.operators import embeddings as V
from lagloom.operators import metrics as M


def test_missing_system_output_is_a_false_negative(spark):
    gold = spark.createDataFrame([(1, True, False, "F"), (2, False, False, "M")], "id int, a_coref boolean, b_coref boolean, gender string")
    system = spark.createDataFrame([(1, True, True)], "id int, a_coref boolean, b_coref boolean")
    tallies = M.confusion_by_group(M.join_gold_system(gold, system))
    got = {r.grp: (r.tp, r.fp, r.tn, r.fn) for r in tallies.collect()}
    assert got == {"Overall": (1, 1, 0, 2), "F": (1, 1, 0, 0), "M": (0, 0, 0, 2)}
    assert sum(got["Overall"]) == 2 * gold.count()
    card = {r.grp: r for r in M.scorecard(tallies).collect()}
    assert card["F"].precision == 50.0 and card["F"].recall == 100.0 and math.isclose(card["F"].f1, 200 / 3)
    assert card["M"].f1 == 0.0 and card["M"].bias == "-"


def test_bias_is_the_ratio_of_f1(spark):
    t = spark.createDataFrame([("Overall", 2, 1, 0, 1), ("F", 1, 1, 0, 0), ("M", 1, 0, 0, 1)], "grp string, tp long, fp long, tn long, fn long")
    assert {r.bias for r in M.scorecard(t).collect()} == {"1.00"}


def test_log_loss_clips_and_normalises(spark):
    df = spark.createDataFrame([(0, 2.0, 2.0), (1, 1.0, 0.0)], "y int, p double, q double")
    got = df.agg(M.log_loss(F.col("y"), [F.col("p"), F.col("q")])).first()[0]
    assert math.isclose(got, (math.log(2) - math.log(M.EPSILON)) / 2)


def test_errors_and_accuracy(spark):
    df = spark.createDataFrame([(0.0, 0.0), (3.0, 7.0)], "y double, p double")
    assert math.isclose(df.agg(M.rmsle(F.col("y"), F.col("p"))).first()[0], math.sqrt(math.log(2) ** 2 / 2))
    assert math.isclose(df.agg(M.rmse(F.col("y"), F.col("p"))).first()[0], math.sqrt(8))
    hard = spark.createDataFrame([(1, 0, 1, 0), (0, 1, 1, 0), (0, 0, 0, 0)], "y1 int, y2 int, h1 int, h2 int")
    assert math.isclose(hard.agg(M.accuracy([F.col("y1"), F.col("y2")], [F.col("h1"), F.col("h2")])).first()[0], 2 / 3)
    got = M.precision_f1(hard, ["y1", "y2"], ["h1", "h2"]).first()
    # The second label is never predicted: precision and F1 count as 0.
    assert (got.precision_macro, got.precision_micro) == (0.25, 0.5)
    assert math.isclose(got.f1_macro, 1 / 3) and math.isclose(got.f1_micro, 0.5)


def test_normalise_by_max_with_a_zero_column(spark):
    df = spark.createDataFrame([(1, 2.0, 0.0), (2, 4.0, 0.0)], "id int, x double, z double")
    got = sorted(tuple(r) for r in M.normalise_by_max(df, ["x", "z"]).collect())
    assert got == [(1, 0.5, 0.0), (2, 1.0, 0.0)]


def test_folds_do_not_depend_on_partitions(spark):
    ids = spark.range(2000)
    folds = [
        {r.id: r.f for r in ids.repartition(n).select("id", B.kfold_assign(F.col("id"), 5, 1).alias("f")).collect()} for n in (1, 7)
    ]
    assert folds[0] == folds[1]
    sizes = [list(folds[0].values()).count(k) for k in range(5)]
    assert min(sizes) > 300 and sum(sizes) == 2000
    held = ids.where(B.holdout_split(F.col("id"), 0.2, 3)).count()
    assert 300 < held < 500


def test_two_stage_alignment_and_blend(spark):
    df = spark.createDataFrame([(1, 0.25, 0.5), (2, 1.0, 0.0)], "id int, p1 double, p2 double")
    v = B.two_stage_combine(F.col("p1"), F.col("p2"))
    assert [tuple(r) for r in df.orderBy("id").select(*v).collect()] == [(0.75, 0.125, 0.125), (0.0, 0.0, 1.0)]
    p = spark.createDataFrame([(1, 0.5, 0.5), (2, 0.1, 0.9)], "id int, x double, y double")
    aligned = B.align_to_prior(p, ["x", "y"], [0.6, 0.4])
    rates = M.class_rate(aligned, ["x", "y"]).first()
    assert math.isclose(rates.x, 0.6) and math.isclose(rates.y, 0.4)
    w = B.blend_weights({"a": 1.0, "b": 2.0}, 4.0)
    assert w == {"a": 0.6, "b": 0.4}
    members = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 0.0)], "member string, id int, x double")
    weights = spark.createDataFrame(list(w.items()), "member string, weight double")
    assert math.isclose(B.blend_weighted(members, weights, ["x"]).first().x, 0.6)


def test_override_clip_grid(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 0.0), (3.0, 9.0)], "p double, k double")
    assert [r[0] for r in df.select(B.override_with_known(F.col("p"), F.col("k"))).collect()] == [1.0, 2.0, 9.0]
    assert [r[0] for r in df.select(B.clip_predictions(F.col("p") / 3, 0.4)).collect()] == [0.4, 0.6, 0.6]
    grid = spark.createDataFrame([(3, 0.5), (2, 0.5), (1, 0.7)], "depth int, score double")
    assert B.best_of_grid(grid, "score", ["depth"]).first().depth == 2


RECORD = "linex_index long, df_idx string, segment int, embeddings array<struct<index: int, values: array<double>>>"


def test_embedding_assembly(spark):
    rows = [
        (0, "x", 0, [(-4, [1.0]), (-5, [2.0])]),
        (1, "x", 2, [(-4, [5.0]), (-5, [6.0])]),
        (2, "y", 1, [(-4, [7.0]), (-5, [8.0])]),
        (3, "x", 2, [(-4, [9.0]), (-5, [3.0])]),
    ]
    got = {r.df_idx: r.emb for r in V.embedding_assemble(spark.createDataFrame(rows, RECORD)).collect()}
    # No pronoun vector, no record; a missing name is zeros; the last of a repeated segment stays.
    assert got == {"x": [1.0, 2.0, 0.0, 0.0, 9.0, 3.0]}


def test_vector_mean_of_a_span(spark):
    toks = spark.createDataFrame([(1, i, [float(i), 1.0]) for i in range(5)], "doc_id int, tok int, v array<double>")
    spans = spark.createDataFrame([(1, "a", 1, 3)], "doc_id int, role string, first int, n int")
    assert V.span_vector_mean(toks, spans).first()["mean"] == [2.0, 1.0]


@pytest.fixture(scope="module")
def labelled(spark):
    from lagloom.operators import models as ML

    rows = [(i, float(i % 10), float((i * 7) % 13), (i % 10 > 3) + (i % 10 > 7)) for i in range(300)]
    return ML.assemble(spark.createDataFrame(rows, "id long, x double, y double, label int"), ["x", "y"])


def test_two_stage_and_multiclass_probabilities(spark, labelled):
    from lagloom.operators import models as ML

    small = {"maxIter": 2, "maxDepth": 3}
    two = ML.two_stage_classifier(labelled, labelled, first=small, second=small)
    assert two.count() == 300
    assert two.where("abs(predict_0 + predict_1 + predict_2 - 1) > 1e-9").count() == 0
    right = two.join(labelled, "id").where("(predict_0 > 0.5) = (label = 0)").count()
    assert right > 280
    ovr = ML.gradient_boosted_multiclass(labelled, labelled, params=small)
    assert ovr.where("abs(p0 + p1 + p2 - 1) > 1e-9").count() == 0
    top = ML.feature_importances(labelled.withColumn("b", (F.col("label") > 0).cast("int")), ["x", "y"], "b", small)
    assert top.orderBy(F.desc("weight")).first().feature == "x"


def test_repeated_regressions_score_every_row_once(spark, labelled):
    from lagloom.operators import models as ML

    got = ML.bagged_regression(labelled, labelled, "x", repeats=2, params={"maxIter": 2, "maxDepth": 3})
    assert got.count() == 300 and got.select("id").distinct().count() == 300
    assert got.join(labelled, "id").where("abs(target - x) > 3").count() == 0
