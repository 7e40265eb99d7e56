"""Queries over predictions, scores, embeddings and fitted models."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagloom.functions import arrays as A
from lagloom.operators import blend as B
from lagloom.operators import boosting as G
from lagloom.operators import components as C
from lagloom.operators import embeddings as V
from lagloom.operators import metrics as M
from lagloom.operators import models as ML
from lagloom.operators import networks as N
from lagloom.plans import fixtures as X
from lagloom.plans.panel_queries import SIX
from lagloom.plans.registry import query
from lagloom.session import cut_lineage

P = ["p0", "p1", "p2"]


def r6(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


# --- grouped evaluation ------------------------------------------------------------------------------

_JOINED = """
    joined AS (SELECT g.id, g.gender, g.a_coref, g.b_coref, s.a_coref AS a_system, s.b_coref AS b_system
               FROM gold g LEFT JOIN system s ON s.id = g.id)"""
_TALLIES = f"""{_JOINED},
    flags AS (SELECT gender, a_coref AS gold_flag, a_system AS sys_flag FROM joined UNION ALL SELECT gender, b_coref, b_system FROM joined),
    tallies AS (SELECT CASE WHEN grouping(gender) = 1 THEN 'Overall' ELSE gender END AS grp,
                  count(*) FILTER (gold_flag AND sys_flag) AS tp, count(*) FILTER (NOT gold_flag AND sys_flag) AS fp,
                  count(*) FILTER (NOT gold_flag AND NOT sys_flag) AS tn,
                  count(*) FILTER (sys_flag IS NULL OR (gold_flag AND NOT sys_flag)) AS fn
           FROM flags GROUP BY ROLLUP (gender))"""


def _joined(spark, d):
    return M.join_gold_system(X.gold(spark, d), X.system(spark, d))


@query("join_gold_system", f"WITH {_JOINED} SELECT * FROM joined")
def join_gold_system(spark, d):
    return _joined(spark, d)


@query("confusion_by_group", f"WITH {_TALLIES} SELECT * FROM tallies")
def confusion_by_group(spark, d):
    return M.confusion_by_group(_joined(spark, d))


@query(
    "scorecard",
    f"""WITH {_TALLIES},
        s AS (SELECT *, CASE WHEN tp + fn > 0 THEN 100.0 * tp / (tp + fn) ELSE 0 END AS recall,
                     CASE WHEN tp + fp > 0 THEN 100.0 * tp / (tp + fp) ELSE 0 END AS precision FROM tallies),
        f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM s),
        b AS (SELECT max(f1) FILTER (grp = 'F') AS ff, max(f1) FILTER (grp = 'M') AS fm FROM f)
        SELECT grp, tp, fp, tn, fn, round(recall, 6) AS recall, round(precision, 6) AS precision, round(f1, 6) AS f1,
               CASE WHEN ff > 0 AND fm > 0 THEN printf('%.2f', ff / fm) ELSE '-' END AS bias FROM f CROSS JOIN b""",
)
def scorecard(spark, d):
    return r6(M.scorecard(M.confusion_by_group(_joined(spark, d))), ["recall", "precision", "f1"])


# --- metrics ------------------------------------------------------------------------------------------

@query(
    "metric_log_loss",
    """SELECT round(avg(-ln(least(greatest([p0, p1, p2][label + 1] / (p0 + p1 + p2), 2.220446049250313e-16), 1 - 2.220446049250313e-16))), 6) AS log_loss
       FROM predictions""",
)
def metric_log_loss(spark, d):
    loss = M.log_loss(F.col("label"), [F.col(p) for p in P])
    return X.predictions(spark, d).agg(F.round(loss, 6).alias("log_loss"))


@query(
    "metric_rmsle",
    "SELECT round(sqrt(avg(pow(ln(1 + o_totalprice * 1.1) - ln(1 + o_totalprice), 2))), 6) AS rmsle, "
    "round(sqrt(avg(pow(ln(1 + o_totalprice / 2) - ln(1 + o_totalprice), 2))), 6) AS rmsle_half FROM orders",
)
def metric_rmsle(spark, d):
    y = F.col("o_totalprice")
    return X.read(spark, d, "orders").agg(
        F.round(M.rmsle(y, y * 1.1), 6).alias("rmsle"), F.round(M.rmsle(y, y / 2), 6).alias("rmsle_half")
    )


@query(
    "metric_rmse",
    "SELECT round(sqrt(avg(pow(ln(1 + l_quantity) - ln(1 + l_quantity * (1 + l_discount)), 2))), 6) AS rmse FROM lineitem",
)
def metric_rmse(spark, d):
    q = F.col("l_quantity")
    return X.read(spark, d, "lineitem").agg(
        F.round(M.rmse(F.log1p(q * (1 + F.col("l_discount"))), F.log1p(q)), 6).alias("rmse")
    )


_HARD = """
    hard AS (SELECT CAST(label = 0 AS INT) AS y0, CAST(label = 1 AS INT) AS y1, CAST(label = 2 AS INT) AS y2,
                    CAST(p0 > 0.4 AS INT) AS h0, CAST(p1 > 0.4 AS INT) AS h1, CAST(p2 > 0.4 AS INT) AS h2 FROM predictions)"""
_Y, _H = ["y0", "y1", "y2"], ["h0", "h1", "h2"]


def _hard(spark, d):
    return X.predictions(spark, d).select(
        *[(F.col("label") == k).cast("int").alias(f"y{k}") for k in range(3)],
        *[(F.col(f"p{k}") > 0.4).cast("int").alias(f"h{k}") for k in range(3)],
    )


@query("metric_accuracy", f"WITH {_HARD} SELECT round(avg(CAST(y0 = h0 AND y1 = h1 AND y2 = h2 AS INT)), 6) AS accuracy FROM hard")
def metric_accuracy(spark, d):
    return _hard(spark, d).agg(
        F.round(M.accuracy([F.col(c) for c in _Y], [F.col(c) for c in _H]), 6).alias("accuracy")
    )


@query(
    "metric_precision_f1",
    f"""WITH {_HARD},
        l AS (SELECT 0 AS k, y0 AS y, h0 AS h FROM hard UNION ALL SELECT 1, y1, h1 FROM hard UNION ALL SELECT 2, y2, h2 FROM hard),
        t AS (SELECT k, count(*) FILTER (y = 1 AND h = 1) AS tp, count(*) FILTER (y = 0 AND h = 1) AS fp, count(*) FILTER (y = 1 AND h = 0) AS fn FROM l GROUP BY k)
        SELECT round(avg(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END), 6) AS precision_macro,
               round(sum(tp) / sum(tp + fp), 6) AS precision_micro,
               round(avg(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END), 6) AS f1_macro,
               round(2 * sum(tp) / sum(2 * tp + fp + fn), 6) AS f1_micro FROM t""",
)
def metric_precision_f1(spark, d):
    rows = M.precision_f1(_hard(spark, d), _Y, _H)
    return r6(rows, rows.columns)


@query(
    "metric_cv_summary",
    """WITH f AS (SELECT id % 5 AS fold, avg(-ln([p0, p1, p2][label + 1])) AS score FROM predictions GROUP BY 1)
       SELECT round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS std FROM f""",
)
def metric_cv_summary(spark, d):
    folds = X.predictions(spark, d).groupBy((F.col("id") % 5).alias("fold")).agg(
        M.log_loss(F.col("label"), [F.col(p) for p in P]).alias("score")
    )
    return r6(M.cv_summary(folds, "score"), ["mean", "std"])


@query(
    "class_rate",
    "SELECT round(sum(p0) / sum(p0 + p1 + p2), 6) AS p0, round(sum(p1) / sum(p0 + p1 + p2), 6) AS p1, round(sum(p2) / sum(p0 + p1 + p2), 6) AS p2 FROM predictions",
)
def class_rate(spark, d):
    return r6(M.class_rate(X.predictions(spark, d), P), P)


@query(
    "normalise_by_max",
    """SELECT o_orderkey, round(o_totalprice / max(o_totalprice) OVER (), 6) AS o_totalprice,
              round(o_custkey / max(o_custkey) OVER (), 6) AS o_custkey FROM orders""",
)
def normalise_by_max(spark, d):
    rows = X.read(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    return r6(M.normalise_by_max(rows, ["o_totalprice", "o_custkey"]), ["o_totalprice", "o_custkey"])


# --- blending -----------------------------------------------------------------------------------------

_W = B.blend_weights(X.MEMBER_SCORES, X.BASE_SCORE)


@query(
    "blend_weighted",
    """WITH w AS (SELECT k, (0.4215::DOUBLE - s) AS raw FROM (VALUES ('0', 0.42089::DOUBLE), ('1', 0.42110::DOUBLE), ('2', 0.42117::DOUBLE), ('3', 0.42054::DOUBLE)) t(k, s)),
            n AS (SELECT k, raw / (SELECT sum(raw) FROM w) AS weight FROM w)
       SELECT id, round(sum(p0 * weight), 6) AS p0, round(sum(p1 * weight), 6) AS p1, round(sum(p2 * weight), 6) AS p2
       FROM member_predictions JOIN n ON n.k = member GROUP BY id""",
)
def blend_weighted(spark, d):
    weights = spark.createDataFrame(list(_W.items()), "member string, weight double")
    return r6(B.blend_weighted(X.member_predictions(spark, d), weights, P), P)


# Class shares of the training labels.
PRIOR = [0.6481506570925348, 0.2534886871697602, 0.09836065573770492]


@query(
    "align_to_prior",
    "WITH s AS (SELECT sum(p0) AS s0, sum(p1) AS s1, sum(p2) AS s2, sum(p0 + p1 + p2) AS t FROM predictions) SELECT id, "
    + ", ".join(f"round(p{i} * {r} / (s{i} / t), 6) AS p{i}" for i, r in enumerate(PRIOR))
    + " FROM predictions CROSS JOIN s",
)
def align_to_prior(spark, d):
    return r6(B.align_to_prior(X.predictions(spark, d).select("id", *P), P, PRIOR), P)


@query(
    "two_stage_combine",
    "SELECT id, round(1 - p0, 6) AS v0, round(p0 * p1, 6) AS v1, round(1 - (1 - p0) - p0 * p1, 6) AS v2 FROM predictions",
)
def two_stage_combine(spark, d):
    v = B.two_stage_combine(F.col("p0"), F.col("p1"))
    return X.predictions(spark, d).select("id", *[F.round(c, 6).alias(f"v{i}") for i, c in enumerate(v)])


@query(
    "oof_seed_blend",
    "SELECT id, round(avg(p0), 4) AS p0, round(avg(p1), 4) AS p1, round(avg(p2), 4) AS p2 FROM member_predictions GROUP BY id",
)
def oof_seed_blend(spark, d):
    return B.mean_predictions(X.member_predictions(spark, d), P)


@query(
    "override_with_known",
    """SELECT e.id, CASE WHEN coalesce(k.total, 0) <> 0 THEN k.total ELSE e.label END AS value FROM entity e
       LEFT JOIN (SELECT id, CAST(sum(volume) AS BIGINT) AS total FROM child_events GROUP BY id) k ON k.id = e.id""",
)
def override_with_known(spark, d):
    known = X.child_events(spark, d).groupBy("id").agg(F.sum("volume").alias("total"))
    return X.entity(spark, d).join(known, "id", "left").select(
        "id", B.override_with_known(F.col("label").cast("bigint"), F.col("total")).alias("value")
    )


@query("clip_predictions", "SELECT id, least(greatest(p0, 0.2), 0.8) AS p0, least(greatest(p1, 0.2), 0.8) AS p1, least(greatest(p2, 0.2), 0.8) AS p2 FROM predictions")
def clip_predictions(spark, d):
    return X.predictions(spark, d).select("id", *[B.clip_predictions(F.col(p), 0.2).alias(p) for p in P])


@query("submission_table", 'SELECT id AS "ID", round(p1, 6) AS "A", round(p2, 6) AS "B", round(p0, 6) AS "NEITHER" FROM predictions')
def submission_table(spark, d):
    return r6(B.submission_table(X.predictions(spark, d), "p0", "p1", "p2"), ["A", "B", "NEITHER"])


@query(
    "best_of_grid",
    """WITH g AS (SELECT member, avg(-ln([m.p0, m.p1, m.p2][p.label + 1])) AS score FROM member_predictions m JOIN predictions p ON p.id = m.id GROUP BY member)
       SELECT round(score, 6) AS score, member FROM g ORDER BY score, member LIMIT 1""",
)
def best_of_grid(spark, d):
    labels = X.predictions(spark, d).select("id", "label")
    scores = X.member_predictions(spark, d).join(labels, "id").groupBy("member").agg(
        M.log_loss(F.col("label"), [F.col(p) for p in P]).alias("score")
    )
    return r6(B.best_of_grid(scores, "score", ["member"]), ["score"])


def _draw_sql(*parts: str) -> str:
    text = " || '-' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


@query("kfold_assign", f"SELECT o_orderkey, CAST({_draw_sql('o_orderkey', '1122')} % 10 AS INT) AS fold FROM orders")
def kfold_assign(spark, d):
    return X.read(spark, d, "orders").select("o_orderkey", B.kfold_assign(F.col("o_orderkey"), 10, 1122).alias("fold"))


@query(
    "holdout_split",
    f"""SELECT o_orderkey, CAST(r.range AS INT) AS r FROM orders CROSS JOIN range(20) r
        WHERE {_draw_sql('o_orderkey', 'r.range', '0')} % 1000000 < 1000""",
)
def holdout_split(spark, d):
    repeats = F.explode(F.sequence(F.lit(0), F.lit(19)))
    return (
        X.read(spark, d, "orders").select("o_orderkey", repeats.alias("r"))
        .where(B.holdout_split(F.col("o_orderkey"), 0.001, F.col("r")))
    )


# --- embeddings ---------------------------------------------------------------------------------------

def _norm(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """A vector as its length, rounded sum and position-weighted sum."""
    v = F.col(vector)
    weighted = F.aggregate(F.transform(v, lambda x, i: x * (i % 17 + 1)), F.lit(0.0), lambda s, x: s + x)
    return df.select(*keys, F.size(v).alias("n"), F.round(A.total(v), 5).alias("s"), F.round(weighted, 4).alias("w"))


_NORM = """CAST(len(v) AS INT) AS n, round(list_sum(v), 5) AS s,
           round(list_sum(list_transform(v, lambda x, i: x * ((i - 1) % 17 + 1))), 4) AS w"""
_SEGMENTS = """
    seg AS (SELECT df_idx, arg_max(flat, linex_index) FILTER (segment = 0) AS v0, arg_max(flat, linex_index) FILTER (segment = 1) AS v1,
                   arg_max(flat, linex_index) FILTER (segment = 2) AS v2 FROM embedding_records GROUP BY df_idx),
    emb AS (SELECT df_idx, v0, coalesce(v1, list_transform(v0, lambda x: 0.0)) AS v1, coalesce(v2, list_transform(v0, lambda x: 0.0)) AS v2
            FROM seg WHERE v0 IS NOT NULL)"""


@query("embedding_assemble", f"WITH {_SEGMENTS} SELECT df_idx, {_NORM} FROM (SELECT df_idx, list_concat(list_concat(v0, v1), v2) AS v FROM emb)")
def embedding_assemble(spark, d):
    return _norm(V.embedding_assemble(X.embedding_records(spark, d)), ["df_idx"], "emb")


@query("vector_subtract", f"WITH {_SEGMENTS} SELECT df_idx, {_NORM} FROM (SELECT df_idx, list_transform(list_zip(v0, v1), lambda z: z[1] - z[2]) AS v FROM emb)")
def vector_subtract(spark, d):
    p, a, _ = A.vector_split(F.col("emb"))
    rows = V.embedding_assemble(X.embedding_records(spark, d)).select("df_idx", A.vector_subtract(p, a).alias("v"))
    return _norm(rows, ["df_idx"], "v")


@query("vector_split", f"WITH {_SEGMENTS} SELECT df_idx, {_NORM} FROM (SELECT df_idx, v2 AS v FROM emb)")
def vector_split(spark, d):
    rows = V.embedding_assemble(X.embedding_records(spark, d)).select("df_idx", A.vector_split(F.col("emb"))[2].alias("v"))
    return _norm(rows, ["df_idx"], "v")


@query(
    "vector_concat",
    f"""SELECT vec_id, {_NORM} FROM (SELECT vec_id, list_concat(list_transform(embedding, lambda x: CAST(x AS DOUBLE)),
               [CAST(label AS DOUBLE), CAST(vec_id AS DOUBLE)]) AS v FROM embeddings)""",
)
def vector_concat(spark, d):
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    both = A.vector_concat(doubles, F.array(F.col("label").cast("double"), F.col("vec_id").cast("double")))
    return _norm(X.read(spark, d, "embeddings").select("vec_id", both.alias("v")), ["vec_id"], "v")


@query(
    "vector_mean",
    """SELECT label, CAST(i - 1 AS INT) AS i, round(avg(x), 6) AS x FROM (
           SELECT label, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) GROUP BY label, i""",
)
def vector_mean(spark, d):
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    rows = X.read(spark, d, "embeddings").select("label", doubles.alias("v"))
    return V.vector_mean(rows, ["label"]).select("label", F.posexplode("mean").alias("i", "x")).select(
        "label", "i", F.round("x", 6).alias("x")
    )


@query(
    "nan_row_to_zero",
    f"""SELECT vec_id, {_NORM} FROM (SELECT vec_id, CASE WHEN vec_id % 4 = 0 THEN list_transform(embedding, lambda x: 0.0::DOUBLE)
               ELSE list_transform(embedding, lambda x: CAST(x AS DOUBLE)) END AS v FROM embeddings)""",
)
def nan_row_to_zero(spark, d):
    broken = F.transform(
        "embedding",
        lambda x, i: F.when((F.col("vec_id") % 4 == 0) & (i == 3), F.lit(float("nan"))).otherwise(x.cast("double")),
    )
    rows = X.read(spark, d, "embeddings").select("vec_id", A.nan_row_to_zero(broken).alias("v"))
    return _norm(rows, ["vec_id"], "v")


# --- fitted models ------------------------------------------------------------------------------------

ITEM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
# Rounds of the boosted fits: a level takes a single machine about 0.75 s however many models grow in it, so the published rounds
# (500 of depth 9, 1,500 of depth 13, 1,800 of depth 5, 100 of depth 3) take from four minutes to hours. All else is as published.
ROUNDS = 4
# Trees of each forest, at full depth; a thousand, the operator's own setting, take a single machine over six minutes.
TREES = 30
# Seeds of the network's cross-validation.
SEEDS = (1, 6003, 10000007)


def _items(spark, d) -> DataFrame:
    """Line items with a three-level label from the return flag; the id is the columns of the key themselves."""
    flag = F.col("l_returnflag")
    rows = X.read(spark, d, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("id"),
        *ITEM_FEATURES,
        F.when(flag == "R", 2).when(flag == "A", 1).otherwise(0).alias("label"),
        F.col("l_shipdate").alias("when"),
    )
    return ML.assemble(rows, ITEM_FEATURES)


def _halves(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    held = B.holdout_split(F.col("id"), 0.2)
    return rows.where(~held), rows.where(held)


def _item_rows(spark, d) -> DataFrame:
    """The same rows with their features as an array, and whether they are positive."""
    features = F.array(*[F.col(c).cast("double") for c in ITEM_FEATURES])
    return _items(spark, d).select("id", "label", "l_extendedprice", features.alias("x"), (F.col("label") > 0).cast("int").alias("y"))


def _vectors(spark, d) -> DataFrame:
    return X.read(spark, d, "embeddings").select(
        F.col("vec_id").alias("id"), (F.col("label") % 3).alias("label"),
        array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"),
    )


@query("cv_score")
def cv_score(spark, d):
    return M.cv_summary(G.cv_fold_scores(_item_rows(spark, d), "y", replace(G.BINARY, rounds=ROUNDS)), "score")


@query("grid_search")
def grid_search(spark, d):
    """Depth, penalty and least child weight, eight points times ten folds in the same scans."""
    grid = {"depth": [6, 9], "penalty": [0.7, 0.93], "child": [0.4, 1.0]}
    table = G.grid_search(_item_rows(spark, d), "y", replace(G.BINARY, rounds=2), grid)
    return B.best_of_grid(table, "score", ["child", "depth", "penalty"])


@query("two_stage_classifier")
def two_stage_classifier(spark, d):
    train, test = _halves(_item_rows(spark, d))
    return G.two_stage_classifier(train, test, first=replace(G.FIRST, rounds=ROUNDS), second=replace(G.SECOND, rounds=ROUNDS))


@query("bagged_regression")
def bagged_regression(spark, d):
    train, test = _halves(_item_rows(spark, d))
    return G.bagged_regression(train, test, "l_extendedprice", settings=replace(G.REGRESSION, rounds=ROUNDS))


@query("one_vs_rest_forest")
def one_vs_rest_forest(spark, d):
    train, test = _halves(_items(spark, d))
    return ML.one_vs_rest_forest(train, test, trees=TREES)


@query("gradient_boosted_multiclass")
def gradient_boosted_multiclass(spark, d):
    train, test = _halves(_item_rows(spark, d))
    return G.joint_multiclass(train, test, settings=replace(G.JOINT, rounds=3 * ROUNDS))


@query("feature_importances")
def feature_importances(spark, d):
    return G.feature_importances(_item_rows(spark, d), ITEM_FEATURES, "label", replace(G.JOINT, rounds=3 * ROUNDS))


@query("mlp_classifier_cv")
def mlp_classifier_cv(spark, d):
    train, test = _halves(_vectors(spark, d))
    return B.mean_predictions(N.mlp_classifier_cv(train, test, 64, seeds=SEEDS), P)


@query("gradient_boosted_embeddings")
def gradient_boosted_embeddings(spark, d):
    """Boosting on vectors and other features side by side; a broken vector is zeros, a missing feature -1."""
    v = A.nan_row_to_zero(F.transform("embedding", lambda x: x.cast("double")))
    more = [F.coalesce(c, F.lit(-1.0)) for c in (F.array_max("v"), F.array_min("v"), F.try_divide(F.array_max("v"), F.array_min("v")))]
    rows = X.read(spark, d, "embeddings").select(F.col("vec_id").alias("id"), (F.col("label") % 3).alias("label"), v.alias("v")).select(
        "id", "label", F.concat("v", F.array(*more)).alias("x")
    )
    return G.joint_multiclass(*_halves(rows), settings=replace(G.JOINT, rounds=3 * ROUNDS))


def _panel_vectors(spark, d) -> DataFrame:
    vector = lambda cells: array_to_vector(F.transform(cells, lambda x: x.cast("double")))
    return cut_lineage(X.panel(spark, d).where(~F.col("is_fake")).select(
        "id", vector(F.flatten("series")).alias("features"), *[vector(F.get("series", F.lit(g))).alias(f"g{g}") for g in SIX]
    ))


@query("pca_features")
def pca_features(spark, d):
    """All columns, and each of the six groups by itself: two and three components."""
    return C.pca_features(_panel_vectors(spark, d), (2, 3), {"pca": "features"} | {f"core{g}_pca": f"g{g}" for g in SIX})


def _level_values(sums: DataFrame, cuts: list) -> DataFrame:
    """Sums of a level by the value of the feature, which is the cut its bin ends at."""
    value = F.get(F.get(F.array(*[F.lit(np.asarray(c, dtype=float)) for c in cuts]), F.col("feature")), F.col("bin"))
    return sums.select("tree", "node", "feature", value.alias("value"), F.round("g", 6).alias("g"), F.round("h", 6).alias("h"), "n")


@query(
    "boosting_level_sums",
    """WITH r AS (SELECT CASE WHEN l_discount <= 0.04 THEN 1 ELSE 2 END AS node, CASE WHEN l_returnflag IN ('R', 'A') THEN 1 ELSE 0 END AS y,
                         1 / (1 + exp(-CASE WHEN l_linenumber <= 3 THEN -0.2 ELSE 0.3 END)) AS p, l_discount, l_tax, l_linenumber FROM lineitem),
            f AS (SELECT node, p - y AS g, p * (1 - p) AS h, unnest([2, 3, 4]) AS feature,
                         unnest([CAST(l_discount AS DOUBLE), CAST(l_tax AS DOUBLE), CAST(l_linenumber AS DOUBLE)]) AS value FROM r)
       SELECT 0 AS tree, node, feature, value, round(sum(g), 6) AS g, round(sum(h), 6) AS h, count(*) AS n FROM f GROUP BY node, feature, value""",
)
def boosting_level_sums(spark, d):
    """Gradients and curvatures of the second level of a fixed tree, after a fixed first tree."""
    rows, model = _item_rows(spark, d), G.Model(replace(G.BINARY, rows=1.0), F.col("y"))
    cuts = G.find_cuts(rows, "x")
    before, tree = G.Tree(), G.Tree()
    before.split(0, 4, int(np.searchsorted(cuts[4], 3.0)), 1.0, (-0.2, 0.3))
    tree.split(0, 2, int(np.searchsorted(cuts[2], 0.04)), 1.0, (0.0, 0.0))
    tree.opened = 1
    sums = G.level_sums(G.binned(rows, "x", [model], cuts, [0.0]), [model.settings], [[before]], [tree], [np.array([2, 3, 4])])
    return _level_values(sums, cuts)


@query(
    "softmax_first_gradients",
    """WITH r AS (SELECT CASE l_returnflag WHEN 'R' THEN 2 WHEN 'A' THEN 1 ELSE 0 END AS label, CAST(l_linenumber AS DOUBLE) AS value FROM lineitem),
            s AS (SELECT label AS tree, count(*) / (SELECT count(*) FROM r) AS p FROM r GROUP BY label)
       SELECT CAST(tree AS INT) AS tree, 0 AS node, 4 AS feature, value, round(sum(p - CASE WHEN label = tree THEN 1 ELSE 0 END), 6) AS g,
              round(sum(p * (1 - p) * 1.5), 6) AS h, count(*) AS n FROM r CROSS JOIN s GROUP BY tree, value""",
)
def softmax_first_gradients(spark, d):
    """Gradients of the three classes before the first joint trees, by line number."""
    rows, model = _item_rows(spark, d), G.Model(G.JOINT, F.col("label"))
    cuts = G.find_cuts(rows, "x")
    table = G.binned(rows, "x", [model], cuts, G.first_margins(rows, [model]))
    sums = G.level_sums(table, [G.JOINT], [[], [], []], [G.Tree(), G.Tree(), G.Tree()], [np.array([4])] * 3)
    return _level_values(sums, cuts)


# --- what SQL can tell of the fits ---------------------------------------------------------------------

_ITEM_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)"


@query(
    "cv_fold_rows",
    f"""SELECT fold, n, true AS is_loss FROM (SELECT CAST({_draw_sql(_ITEM_ID, '1122')} % 10 AS INT) AS fold, count(*) AS n FROM lineitem GROUP BY 1)""",
)
def cv_fold_rows(spark, d):
    """Every row is scored in its own fold, and every fold gives a loss."""
    scores = G.cv_fold_scores(_item_rows(spark, d), "y", replace(G.BINARY, rounds=ROUNDS))
    return scores.select("fold", "n", ((F.col("score") > 0) & (F.col("score") < 1)).alias("is_loss"))


def _sums(scored: DataFrame, cols: list[str]) -> DataFrame:
    off = F.abs(sum((F.col(c) for c in cols[1:]), F.col(cols[0])) - 1) > 1e-9
    return scored.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("n_ids"), F.count_if(off).alias("n_off"))


_HELD = "count(*) AS n, count(DISTINCT {id}) AS n_ids, 0::BIGINT AS n_off FROM {table} WHERE {draw} % 1000000 < 200000"


@query("two_stage_sums", "SELECT " + _HELD.format(id=_ITEM_ID, table="lineitem", draw=_draw_sql(_ITEM_ID, "0", "0")))
def two_stage_sums(spark, d):
    """Every held-out row gets probabilities that add up to one."""
    return _sums(two_stage_classifier(spark, d), ["predict_0", "predict_1", "predict_2"])


@query("boosted_sums", "SELECT " + _HELD.format(id="vec_id", table="embeddings", draw=_draw_sql("vec_id", "0", "0")))
def boosted_sums(spark, d):
    """Every held-out vector gets probabilities that add up to one."""
    return _sums(gradient_boosted_embeddings(spark, d), P)


_SEEDS_SQL = ", ".join(f"({s})" for s in SEEDS)


@query(
    "mlp_stopping_rounds",
    f"""WITH r AS (SELECT vec_id, {_draw_sql('vec_id', '0', '0')} % 1000000 < 200000 AS held FROM embeddings),
            o AS (SELECT 'oof' AS part, CAST(seed AS INT) AS seed, CAST(CAST('0x' || substr(md5(vec_id::VARCHAR || '-' || seed), 1, 8) AS BIGINT) % 5 AS INT) AS fold
                  FROM r CROSS JOIN (VALUES {_SEEDS_SQL}) v(seed) WHERE NOT held),
            t AS (SELECT 'test' AS part, CAST(seed AS INT) AS seed, CAST(k AS INT) AS fold FROM r CROSS JOIN (VALUES {_SEEDS_SQL}) v(seed) CROSS JOIN range(5) f(k) WHERE held)
       SELECT part, seed, fold, count(*) AS n, true AS one_round, true AS stopped_in_time, true AS own_loss, 0::BIGINT AS n_off
       FROM (SELECT * FROM o UNION ALL SELECT * FROM t) GROUP BY part, seed, fold""",
)
def mlp_stopping_rounds(spark, d):
    """Every network scores its own fold and all test rows; it ended by its patience or its last pass, and its loss is that of its fold."""
    train, test = _halves(_vectors(spark, d))
    usual, labels = N.Settings(), train.select("id", "label")
    long = N.mlp_classifier_cv(train, test, 64, seeds=SEEDS).join(labels, "id", "left")
    right = F.get(F.array(*P), F.col("label"))
    ended = (F.max("last_epoch") == usual.epochs) | (F.max("last_epoch") - F.max("best_epoch") >= usual.patience)
    off = F.abs(F.col("p0") + F.col("p1") + F.col("p2") - 1) > 1e-9
    return long.groupBy("part", "seed", "fold").agg(
        F.count(F.lit(1)).alias("n"), (F.countDistinct("best_epoch", "last_epoch", "fold_loss") == 1).alias("one_round"),
        ((F.max("best_epoch") <= F.max("last_epoch")) & ended).alias("stopped_in_time"),
        ((F.col("part") == "test") | (F.abs(F.avg(-F.log(right)) - F.max("fold_loss")) < 1e-6)).alias("own_loss"), F.count_if(off).alias("n_off"),
    )


@query(
    "pca_variances",
    "SELECT count(*) AS n, true AS centred, true AS falling, true AS nested FROM panel WHERE id % 13 <> 0",
)
def pca_variances(spark, d):
    """Components are centred, the variance falls, and two components are the first two of three."""
    got = C.pca_features(_panel_vectors(spark, d), (2, 3))
    spread = F.var_pop("pca3_0")
    return got.agg(
        F.count(F.lit(1)).alias("n"),
        F.greatest(*[F.abs(F.avg(f"pca3_{i}")) for i in range(3)]).alias("mean"),
        spread.alias("v0"), F.var_pop("pca3_1").alias("v1"), F.var_pop("pca3_2").alias("v2"),
        F.bool_and((F.col("pca2_0") == F.col("pca3_0")) & (F.col("pca2_1") == F.col("pca3_1"))).alias("nested"),
    ).select(
        "n", (F.col("mean") <= 1e-6 * F.sqrt("v0")).alias("centred"),
        ((F.col("v0") >= F.col("v1")) & (F.col("v1") >= F.col("v2"))).alias("falling"), "nested",
    )


# --- vectors of spans ----------------------------------------------------------------------------------

@query(
    "span_vector_mean",
    """WITH s AS (SELECT doc_id, r.* FROM spans CROSS JOIN (VALUES ('a', 2, 2), ('b', 8, 1), ('p', 5, 3)) r(role, lo, k))
       SELECT s.doc_id, s.role, round(avg(t.tok), 6) AS m0, round(avg(t.char_off), 6) AS m1, round(avg(length(t.text)), 6) AS m2
       FROM s JOIN tokens t ON t.doc_id = s.doc_id AND t.tok >= s.lo AND t.tok < s.lo + s.k GROUP BY 1, 2""",
)
def span_vector_mean(spark, d):
    vector = F.array(*[c.cast("double") for c in (F.col("tok"), F.col("char_off"), F.length("text"))])
    rows = F.array(*[F.struct(F.lit(r).alias("role"), F.lit(lo).alias("first"), F.lit(k).alias("n")) for r, lo, k in (("a", 2, 2), ("b", 8, 1), ("p", 5, 3))])
    means = V.span_vector_mean(X.tokens(spark, d).select("doc_id", "tok", vector.alias("v")), X.spans(spark, d).select("doc_id", F.inline(rows)))
    return means.select("doc_id", "role", *[F.round(F.get("mean", F.lit(i)), 6).alias(f"m{i}") for i in range(3)])


@query(
    "pca_residual_flags",
    "SELECT unnest(['pca', "
    + ", ".join(f"'core{g}_pca'" for g in SIX)
    + "]) AS part, 3 AS n_components, true AS orthonormal, true AS satisfied, true AS told FROM (SELECT count(*) AS n FROM panel WHERE id % 13 <> 0) WHERE n > 0",
)
def pca_residual_flags(spark, d):
    """Of every group of columns: the components are orthonormal and the covariance only stretches them, by the variance told."""
    rows = _panel_vectors(spark, d)
    vectors = {"pca": "features"} | {f"core{g}_pca": f"g{g}" for g in SIX}
    found = C.fit_components(rows, 3, vectors)
    flags = []
    for part, c in found.items():
        off = np.abs(c.directions.T @ c.directions - np.eye(c.directions.shape[1])).max()
        flags.append((part, c.directions.shape[1], bool(off < 1e-9), bool(c.residual <= 1e-6 * c.variances[0]), c.variances.tolist()))
    scored = C.pca_features(rows, 3, vectors)
    told = scored.agg(*(F.array(*(F.var_pop(f"{p}3_{i}") for i in range(3))).alias(p) for p in vectors))
    seen = told.select(F.inline(F.array(*(F.struct(F.lit(p).alias("part"), F.col(p).alias("seen")) for p in vectors))))
    table = spark.createDataFrame(flags, "part string, n_components int, orthonormal boolean, satisfied boolean, variances array<double>")
    near = lambda a, b: F.abs(a - b) <= 1e-6 * F.col("variances")[0]
    return table.join(seen, "part").select(
        "part", "n_components", "orthonormal", "satisfied", F.forall(F.zip_with("variances", "seen", near), lambda x: x).alias("told")
    )
