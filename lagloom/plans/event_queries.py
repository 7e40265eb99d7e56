"""Queries over the entities and their child rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from lagloom.operators import events as E
from lagloom.operators.lookup import lookup
from lagloom.plans import fixtures as X
from lagloom.plans.registry import query
from lagloom.session import category_values

#: Columns of the SQL checks, which must name them; the queries pivot whatever values the data hold.
FLAGS = ["A", "N", "R"]
TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "count_over_union",
    "SELECT id, is_train, location, count(*) OVER (PARTITION BY location) AS loc_counts FROM entity",
)
def count_over_union(spark, d):
    rows = X.entity(spark, d).select("id", "is_train", "location")
    return E.count_over_union([rows.where("is_train"), rows.where("not is_train")], "location", "loc_counts").select(
        "id", "is_train", "location", "loc_counts"
    )


@query(
    "child_count",
    """SELECT e.id, coalesce(n, 0) AS event_cnt FROM entity e
       LEFT JOIN (SELECT id, count(*) AS n FROM child_items GROUP BY id) c ON c.id = e.id""",
)
def child_count(spark, d):
    return E.child_count(X.entity(spark, d).select("id"), X.child_items(spark, d), "event_cnt")


@query("value_histogram", "SELECT label, count(*) AS n FROM entity GROUP BY label")
def value_histogram(spark, d):
    return E.value_histogram(X.entity(spark, d), "label")


@query("distinct_first_appearance", "SELECT event_type, min(row_pos) AS first_pos FROM child_events GROUP BY event_type")
def distinct_first_appearance(spark, d):
    return E.distinct_first_appearance(X.child_events(spark, d), "event_type")


_CODES = """
    codes AS (SELECT event_type, row_number() OVER (ORDER BY p, event_type) - 1 AS code
              FROM (SELECT event_type, min(row_pos) AS p FROM child_events GROUP BY event_type))"""


@query("first_appearance_code", f"WITH {_CODES} SELECT event_type, code FROM codes")
def first_appearance_code(spark, d):
    return E.first_appearance_code(X.child_events(spark, d), "event_type")


@query(
    "bitmask_sum",
    f"""WITH {_CODES}
        SELECT id, string_agg(code || ':' || n, ',' ORDER BY code) AS event_mask,
               coalesce(string_agg(code || ':' || n, ',' ORDER BY code) FILTER (event_type IN ('click', 'error')), '') AS listed_mask
        FROM (SELECT id, event_type, code, count(*) AS n FROM child_events JOIN codes USING (event_type) GROUP BY ALL) GROUP BY id""",
)
def bitmask_sum(spark, d):
    rows = X.child_events(spark, d)
    codes = E.first_appearance_code(rows, "event_type")

    def mask(out: str, values: list | None = None):
        text = F.array_join(F.transform(out, lambda m: F.concat_ws(":", m["code"].cast("string"), m["n"].cast("string"))), ",")
        return E.bitmask_sum(rows, codes, "event_type", out, values=values).select("id", text.alias(out))

    both = mask("event_mask").join(mask("listed_mask", ["click", "error"]), "id", "left")
    return both.withColumn("listed_mask", F.coalesce("listed_mask", F.lit("")))


def _flags(items):
    return E.pivot_onehot(items, "category", category_values(items, "category"))


def _last_values(events):
    return E.pivot_last_value(events, "event_type", "volume", category_values(events, "event_type"))


_ONEHOT = "SELECT id, " + ", ".join(
    f"max(CASE WHEN category = '{v}' THEN 1 ELSE 0 END) AS {v}" for v in FLAGS
) + " FROM child_items GROUP BY id"


@query("pivot_onehot", _ONEHOT)
def pivot_onehot(spark, d):
    return _flags(X.child_items(spark, d))


_LAST = "SELECT id, " + ", ".join(
    f"coalesce(arg_max(volume, row_pos) FILTER (event_type = '{v}'), 0) AS {v}" for v in TYPES
) + " FROM child_events GROUP BY id"


@query("pivot_last_value", _LAST)
def pivot_last_value(spark, d):
    return _last_values(X.child_events(spark, d))


@query(
    "pair_indicator",
    f"""SELECT *, CAST("view" > 0 AND signup > 0 AS INT) AS pair_view_signup, CAST("view" > 0 AND purchase > 0 AS INT) AS pair_view_purchase,
               CAST("view" > 0 AND error > 0 AS INT) AS pair_view_error, CAST(signup > 0 AND purchase > 0 AS INT) AS pair_signup_purchase,
               CAST(signup > 0 AND error > 0 AS INT) AS pair_signup_error, CAST(purchase > 0 AND error > 0 AS INT) AS pair_purchase_error
        FROM ({_LAST})""",
)
def pair_indicator(spark, d):
    events = X.child_events(spark, d)
    return E.pair_indicator(_last_values(events), category_values(events, "event_type"))


@query(
    "running_count_in_file_order",
    "SELECT id, location, row_number() OVER (PARTITION BY location ORDER BY row_pos) AS appearance FROM entity",
)
def running_count_in_file_order(spark, d):
    rows = X.entity(spark, d).select("id", "location", "row_pos")
    return E.running_count_in_file_order(rows, "location").select("id", "location", "appearance")


@query(
    "first_row_per_key",
    "SELECT id, arg_min(category, row_pos) AS category, arg_min(quantity, row_pos) AS quantity FROM child_items GROUP BY id",
)
def first_row_per_key(spark, d):
    return E.first_row_per_key(X.child_items(spark, d), ["id"]).select("id", "category", "quantity")


@query(
    "last_row_per_key",
    "SELECT id, arg_max(category, row_pos) AS category, arg_max(quantity, row_pos) AS quantity FROM child_items GROUP BY id",
)
def last_row_per_key(spark, d):
    return E.last_row_per_key(X.child_items(spark, d), ["id"]).select("id", "category", "quantity")


@query(
    "label_encode",
    """SELECT id, is_train, priority, c.code AS priority_code FROM entity JOIN (
           SELECT priority, row_number() OVER (ORDER BY priority) - 1 AS code FROM (SELECT DISTINCT priority FROM entity)) c USING (priority)""",
)
def label_encode(spark, d):
    rows = X.entity(spark, d).select("id", "is_train", "priority")
    return E.label_encode([rows.where("is_train"), rows.where("not is_train")], "priority", "priority_code").select(
        "id", "is_train", "priority", "priority_code"
    )


# --- projections, filters, assignment -------------------------------------------------------------

@query("project_drop_rename", "SELECT o_orderkey, o_totalprice, o_orderdate AS ordered_on FROM orders")
def project_drop_rename(spark, d):
    raw = X.read(spark, d, "orders").withColumnsRenamed({"o_orderkey": "O-Orderkey", "o_totalprice": "O-TotalPrice"})
    return (
        E.tidy_names(raw)
        .drop("o_custkey", "o_orderstatus", "o_orderpriority")
        .withColumnRenamed("o_orderdate", "ordered_on")
    )


@query("filter_rows", "SELECT id, label FROM entity WHERE is_train AND label > 0")
def filter_rows(spark, d):
    return X.entity(spark, d).where(F.col("is_train") & (F.col("label") > 0)).select("id", "label")


@query("mask_assign", "SELECT id, CASE WHEN is_train THEN label ELSE -1 END AS label FROM entity")
def mask_assign(spark, d):
    return X.entity(spark, d).select(
        "id", E.mask_assign(F.col("label"), ~F.col("is_train"), F.lit(-1)).alias("label")
    )


@query(
    "fill_nulls",
    """SELECT e.id, coalesce(c.volume, 0) AS volume, coalesce(c.n, -1) AS n FROM entity e LEFT JOIN (
           SELECT id, max(volume) AS volume, count(*) AS n FROM child_events GROUP BY id) c ON c.id = e.id""",
)
def fill_nulls(spark, d):
    extra = X.child_events(spark, d).groupBy("id").agg(F.max("volume").alias("volume"), F.count(F.lit(1)).alias("n"))
    return X.entity(spark, d).select("id").join(extra, "id", "left").na.fill({"volume": 0, "n": -1})


@query(
    "label_from_flags",
    """SELECT id, CASE WHEN b_coref THEN 2 WHEN a_coref THEN 1 ELSE 0 END AS label,
              CASE WHEN a_coref THEN 1 WHEN b_coref THEN 2 ELSE 0 END AS a_first,
              CAST(NOT a_coref AND NOT b_coref AS INT) AS is_n, CAST(a_coref AND NOT b_coref AS INT) AS is_a,
              CAST(b_coref AS INT) AS is_b FROM gold""",
)
def label_from_flags(spark, d):
    rows = X.gold(spark, d)
    label = E.label_from_flags(rows, "a_coref", "b_coref")
    n, a, b = E.one_hot(label)
    return rows.select(
        "id", label.alias("label"), E.label_from_flags(rows, "a_coref", "b_coref", a_wins=True).alias("a_first"),
        n.alias("is_n"), a.alias("is_a"), b.alias("is_b"),
    )


@query("neither_flag", "SELECT id, 1 - (CAST(a_coref AS INT) + CAST(b_coref AS INT)) AS neither FROM gold")
def neither_flag(spark, d):
    return X.gold(spark, d).select("id", E.neither_flag(F.col("a_coref"), F.col("b_coref")).alias("neither"))


@query(
    "binary_target_split",
    "SELECT id, CAST(label > 0 AS INT) AS y1, CASE WHEN label > 0 THEN CAST(label = 1 AS INT) END AS y2 FROM entity",
)
def binary_target_split(spark, d):
    y1, y2 = E.binary_targets(F.col("label"))
    return X.entity(spark, d).select("id", y1.alias("y1"), y2.alias("y2"))


@query("membership_filter", "SELECT row_pos, id, event_type FROM child_events WHERE event_type IN ('click', 'view')")
def membership_filter(spark, d):
    return X.child_events(spark, d).where(F.col("event_type").isin("click", "view")).select("row_pos", "id", "event_type")


# --- joins -----------------------------------------------------------------------------------------

@query("join_inner_id", "SELECT e.row_pos, e.id, e.event_type, n.label FROM child_events e JOIN entity n ON n.id = e.id")
def join_inner_id(spark, d):
    return X.child_events(spark, d).select("row_pos", "id", "event_type").join(
        X.entity(spark, d).select("id", "label"), "id", "inner"
    )


@query(
    "join_left_fill",
    """SELECT e.id, coalesce(CAST(c.total AS BIGINT), 0) AS total FROM entity e
       LEFT JOIN (SELECT id, sum(volume) AS total FROM child_events GROUP BY id) c ON c.id = e.id""",
)
def join_left_fill(spark, d):
    totals = X.child_events(spark, d).groupBy("id").agg(F.sum("volume").alias("total"))
    return X.entity(spark, d).select("id").join(totals, "id", "left").select(
        "id", F.coalesce("total", F.lit(0)).alias("total")
    )


@query(
    "join_lookup",
    "SELECT e.id, n.n_name AS location_name FROM entity e LEFT JOIN nation n ON n.n_nationkey = e.location",
)
def join_lookup(spark, d):
    names = X.read(spark, d, "nation").select(F.col("n_nationkey").alias("location"), F.col("n_name").alias("location_name"))
    return lookup(X.entity(spark, d).select("id", "location"), names, "location").select("id", "location_name")


@query(
    "join_semi_anti",
    """SELECT id, CASE WHEN id IN (SELECT id FROM child_events) THEN 'in' ELSE 'out' END AS side FROM entity""",
)
def join_semi_anti(spark, d):
    rows, ids = X.entity(spark, d).select("id"), X.child_events(spark, d).select("id")
    inside = rows.join(ids, "id", "left_semi").withColumn("side", F.lit("in"))
    return inside.unionByName(rows.join(ids, "id", "left_anti").withColumn("side", F.lit("out")))


@query(
    "join_positional",
    """SELECT coalesce(l.row_pos, r.row_pos) AS row_pos, l.volume, r.location FROM child_events l
       FULL OUTER JOIN entity r ON r.row_pos = l.row_pos""",
)
def join_positional(spark, d):
    left = X.child_events(spark, d).select("row_pos", "volume")
    return left.join(X.entity(spark, d).select("row_pos", "location"), "row_pos", "full_outer")


@query(
    "union_all",
    """SELECT id, row_pos, 'event' AS src FROM child_events UNION ALL SELECT id, row_pos, 'entity' FROM entity""",
)
def union_all(spark, d):
    a = X.child_events(spark, d).select("id", "row_pos", F.lit("event").alias("src"))
    return a.unionByName(X.entity(spark, d).select("id", "row_pos", F.lit("entity").alias("src")))


@query(
    "join_feature_tables_outer",
    f"""WITH t1 AS ({_ONEHOT}), t2 AS ({_LAST}), t3 AS (SELECT id, count(*) AS n FROM child_events GROUP BY id)
        SELECT id, coalesce(A, 0) AS A, coalesce(N, 0) AS N, coalesce(R, 0) AS R, coalesce(click, 0) AS click,
               coalesce(error, 0) AS error, coalesce(purchase, 0) AS purchase, coalesce(signup, 0) AS signup,
               coalesce("view", 0) AS "view", coalesce(cnt, 0) AS cnt
        FROM t1 FULL OUTER JOIN t2 USING (id) FULL OUTER JOIN (SELECT id, n AS cnt FROM t3) USING (id)
        FULL OUTER JOIN (SELECT id FROM entity) USING (id)""",
)
def join_feature_tables_outer(spark, d):
    events = X.child_events(spark, d)
    return E.join_feature_tables(
        X.entity(spark, d),
        [
            _flags(X.child_items(spark, d)),
            _last_values(events),
            events.groupBy("id").agg(F.count(F.lit(1)).alias("cnt")),
        ],
    )


@query("limit_head", "SELECT row_pos, id, event_type, volume FROM child_events ORDER BY row_pos LIMIT 20")
def limit_head(spark, d):
    return X.child_events(spark, d).orderBy("row_pos").limit(20)
