"""Inputs derived from the driver tables, as DataFrames and as equivalent SQL.

Every input covers its whole source table. ``SQL`` holds the same definitions as common table
expressions; ``with_ctes`` prepends the ones a statement names, dependencies first.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lagloom.operators.panel import assemble_panel

GROUPS, POSITIONS = 8, 40
CHILD_ID, COPY_ID = 1_000_000_000, 2_000_000_000
URL_HEAD = "http://en.example.org/a/wiki/"  # 29 characters
DEPS = ("nsubj", "dobj", "pobj", "poss", "compound", "punct", "conj", "ROOT")
PRONOUN_LIST = ("he", "she", "him", "her", "his", "hers")

assert len(URL_HEAD) == 29


def read(spark: SparkSession, d: str, table: str) -> DataFrame:
    df = spark.read.parquet(f"{d}/{table}.parquet")
    # Long texts are much work per byte, and the small test files hold a single row group.
    return df


# --- entities and their child rows ------------------------------------------------------------

def entity(spark: SparkSession, d: str) -> DataFrame:
    customer = read(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return read(spark, d, "orders").join(customer, "o_custkey", "left").select(
        F.col("o_orderkey").alias("id"),
        F.coalesce("c_nationkey", F.lit(-1)).alias("location"),
        ((F.substr("o_orderpriority", F.lit(1), F.lit(1)).cast("int") - 1) % 3).alias("label"),
        (F.col("o_orderkey") % 3 != 0).alias("is_train"),
        F.col("o_orderkey").alias("row_pos"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
    )


def child_events(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").select(
        F.col("user_id").alias("id"),
        "event_type",
        F.round(F.col("value") * 100).cast("long").alias("volume"),
        F.col("event_id").alias("row_pos"),
    )


def child_items(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_returnflag").alias("category"),
        F.col("l_quantity").cast("long").alias("quantity"),
        F.struct(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
        ).alias("row_pos"),
    )


# --- panel --------------------------------------------------------------------------------------

def cells(spark: SparkSession, d: str) -> DataFrame:
    """Non-zero cells ``(id, grp, pos, value)``."""
    when = F.col("l_shipdate")
    return (
        read(spark, d, "lineitem")
        .select(
            F.col("l_partkey").alias("id"),
            (F.col("l_suppkey") % GROUPS).cast("int").alias("grp"),
            ((F.year(when) * 12 + F.month(when)) % POSITIONS).cast("int").alias("pos"),
            F.col("l_quantity").cast("long").alias("q"),
        )
        .groupBy("id", "grp", "pos")
        .agg((F.sum("q") * 1000).alias("value"))
    )


def panel(spark: SparkSession, d: str) -> DataFrame:
    """``id, target, is_train, is_fake, row_pos, series`` with an 8 x 40 array of longs."""
    wide = assemble_panel(cells(spark, d), GROUPS, POSITIONS)
    return wide.select(
        "id",
        F.array_max(F.flatten("series")).alias("target"),
        (F.col("id") % 3 != 0).alias("is_train"),
        (F.col("id") % 13 == 0).alias("is_fake"),
        F.col("id").alias("row_pos"),
        "series",
    )


def _cell_text(i: Column, g: Column, p: Column, v: Column) -> Column:
    third = F.floor(v / 3).cast("long")
    rest = v % 3
    plain = F.concat(v.cast("string"), F.lit(".0"))
    return (
        F.when(v == 0, F.when((i + p) % 2 == 0, "0.0").otherwise("0"))
        .when(i % 13 == 0, F.concat(v.cast("string"), F.lit(".125")))
        .when(
            (i * 31 + g * 7 + p) % 7 == 0,
            F.when(rest == 1, F.concat(third.cast("string"), F.lit(".34")))
            .when(rest == 2, F.concat(third.cast("string"), F.lit(".66")))
            .otherwise(F.concat(third.cast("string"), F.lit(".0"))),
        )
        .otherwise(plain)
    )


def text_panel(spark: SparkSession, d: str) -> DataFrame:
    """``id, cells`` with an 8 x 40 array of cell texts."""
    return panel(spark, d).select(
        "id", "is_train", "is_fake", "series",
        F.transform(
            "series",
            lambda row, g: F.transform(row, lambda v, p: _cell_text(F.col("id"), g, p, v)),
        ).alias("cells"),
    )


def planted(spark: SparkSession, d: str) -> DataFrame:
    """Panel rows, a left-moved child of each and a copy of every 11th; one pass over the panel."""
    p = panel(spark, d)
    shift = (F.col("id") % 6 + 2).cast("int")
    child = F.transform(
        "series",
        lambda row: F.concat(
            F.slice(row, shift + 1, F.lit(POSITIONS) - shift),
            F.transform(
                F.sequence(F.lit(POSITIONS) - shift, F.lit(POSITIONS - 1)),
                lambda k: (F.col("id") + k + 1) * 1000,
            ),
        ),
    )
    first = F.get("series", F.lit(0))

    def made(new_id: Column, target: Column, series: Column) -> Column:
        return F.struct(new_id.alias("id"), target.alias("target"), series.alias("series"))

    own = made(F.col("id"), F.col("target"), F.col("series"))
    kid = made(F.col("id") + CHILD_ID, F.get(first, shift - 2), child)
    twin = made(F.col("id") + COPY_ID, F.col("target"), F.col("series"))
    rows = F.when(F.col("id") % 11 == 0, F.array(own, kid, twin)).otherwise(F.array(own, kid))
    return (
        p.select("is_train", "is_fake", F.explode(rows).alias("r"))
        .select("r.id", "r.target", "is_train", "is_fake", F.col("r.id").alias("row_pos"), "r.series")
    )


# --- text with spans ----------------------------------------------------------------------------

def spans(spark: SparkSession, d: str) -> DataFrame:
    """Words 3, 6 and 9 of every document (its last word when shorter) as A, pronoun and B."""
    words = F.split("text", " ", -1)

    def at(k: int) -> Column:
        return F.least(F.lit(k), F.size("words"))

    def offset(k: int) -> Column:
        before = F.slice("words", F.lit(1), at(k) - 1)
        return F.aggregate(before, F.lit(0), lambda s, w: s + F.length(w) + 1)

    base = (
        read(spark, d, "documents")
        .select("doc_id", "text", words.alias("words"))
        .select(
            "doc_id", "text",
            F.element_at("words", at(3)).alias("a"), offset(3).alias("a_off"),
            F.element_at("words", at(6)).alias("pronoun"), offset(6).alias("p_off"),
            F.element_at("words", at(9)).alias("b"), offset(9).alias("b_off"),
            F.element_at("words", at(4)).alias("fourth"),
        )
    )
    name = F.when(F.col("doc_id") % 3 == 0, F.concat("a", F.lit("_"))).when(
        F.col("doc_id") % 3 == 1, F.concat("b", F.lit("_"))
    ).otherwise("")
    return base.select(
        "doc_id", "text", "a", "a_off", "pronoun", "p_off", "b", "b_off",
        F.concat(F.lit(URL_HEAD), name, "fourth").alias("url"),
        F.get(F.array(*[F.lit(p) for p in PRONOUN_LIST]), (F.col("doc_id") % 6).cast("int")).alias("pron"),
    )


def gold(spark: SparkSession, d: str) -> DataFrame:
    return (
        read(spark, d, "labels")
        .join(read(spark, d, "documents").select("doc_id"), "doc_id")
        .select(
            F.col("doc_id").alias("id"),
            (F.col("quality") == 1).alias("a_coref"),
            (F.col("toxic") == 1).alias("b_coref"),
            F.when(F.col("doc_id") % 2 == 0, "F").otherwise("M").alias("gender"),
        )
    )


def system(spark: SparkSession, d: str) -> DataFrame:
    flip = F.col("id") % 5 == 0
    return gold(spark, d).where(F.col("id") % 17 != 0).select(
        "id",
        (F.col("a_coref") != flip).alias("a_coref"),
        (F.col("b_coref") != flip).alias("b_coref"),
    )


def tokens(spark: SparkSession, d: str) -> DataFrame:
    """``doc_id, tok, char_off, text, dep, head_tok, sent``, one row per word of every document."""
    doc = W.partitionBy("doc_id").orderBy("tok")
    before = doc.rowsBetween(W.unboundedPreceding, -1)
    words = read(spark, d, "documents").select(
        "doc_id", F.posexplode(F.split("text", " ", -1)).alias("tok", "text")
    )
    placed = words.select(
        "doc_id", "tok", "text",
        F.coalesce(F.sum(F.length("text") + 1).over(before), F.lit(0)).alias("char_off"),
        F.coalesce(F.sum(F.endswith("text", F.lit(".")).cast("int")).over(before), F.lit(0)).alias("sent"),
    )
    start = F.min("tok").over(W.partitionBy("doc_id", "sent"))
    return placed.select(
        "doc_id", "tok", "char_off", "text",
        F.get(F.array(*[F.lit(x) for x in DEPS]), F.length("text") % 8).alias("dep"),
        (start + F.floor((F.col("tok") - start) / 2)).cast("int").alias("head_tok"),
        "sent",
    )


def entities(spark: SparkSession, d: str) -> DataFrame:
    return (
        read(spark, d, "documents")
        .select("doc_id", F.explode(F.split("text", " ", -1)).alias("ent_text"))
        .where(F.col("ent_text").rlike("^[A-Z]"))
        .select("doc_id", "ent_text", F.when(F.length("ent_text") % 2 == 0, "PERSON").otherwise("ORG").alias("label"))
    )


def mentions(spark: SparkSession, d: str) -> DataFrame:
    """Capitalised words and the three span words; ``m`` counts them per document."""
    words = read(spark, d, "documents").select(
        "doc_id", F.posexplode(F.split("text", " ", -1)).alias("tok", "text")
    )
    return (
        words.where(F.col("text").rlike("^[A-Z]") | F.col("tok").isin(2, 5, 8))
        .select(
            "doc_id",
            (F.row_number().over(W.partitionBy("doc_id").orderBy("tok")) - 1).alias("m"),
            "text",
            (F.length("text") % 3).alias("cluster_id"),
            (((F.col("tok") * 5) % 13 - 6) / 2.0).alias("head_score"),
            "tok",
        )
    )


def antecedents(spark: SparkSession, d: str) -> DataFrame:
    """The up to three mentions before each mention."""
    return (
        mentions(spark, d)
        .select("doc_id", "m", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("back"))
        .where("m >= back")
        .select(
            "doc_id", "m", (F.col("m") - F.col("back")).alias("ant"),
            ((F.col("m") * 7 + (F.col("m") - F.col("back")) * 3) % 11 - 5).cast("double").alias("score"),
        )
    )


def vocab_terms(spark: SparkSession, d: str) -> DataFrame:
    """Distinct words of at least four ASCII letters in the benchmark texts."""
    return (
        read(spark, d, "benchmark")
        .select(F.explode(F.split("text", "[^A-Za-z]+")).alias("term"))
        .where(F.length("term") >= 4)
        .distinct()
    )


def starred(spark: SparkSession, d: str) -> DataFrame:
    """Documents with the third letter of every longer word starred."""
    return read(spark, d, "documents").select(
        "doc_id",
        F.regexp_replace("text", "([A-Za-z]{2})[A-Za-z]([A-Za-z]+)", "$1*$2").alias("text"),
    )


# --- predictions and vectors -------------------------------------------------------------------

def predictions(spark: SparkSession, d: str) -> DataFrame:
    """``id, label, p0, p1, p2`` for every labelled document."""
    a, b = F.col("doc_id") % 7 + 1, F.col("doc_id") % 11 + 1
    s = (a + b + 3).cast("double")
    return read(spark, d, "labels").select(
        F.col("doc_id").alias("id"),
        F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 1).otherwise(0).alias("label"),
        (a / s).alias("p0"), (b / s).alias("p1"), (F.lit(3) / s).alias("p2"),
    )


# Published scores of the four blended members and the score their weights start from.
MEMBER_SCORES = {"0": 0.42089, "1": 0.42110, "2": 0.42117, "3": 0.42054}
BASE_SCORE = 0.4215


def member_predictions(spark: SparkSession, d: str) -> DataFrame:
    """Four members per labelled document: ``member, id, p0, p1, p2``."""
    k = F.col("member")
    a, b = (F.col("doc_id") * (k + 1)) % 7 + 1, (F.col("doc_id") + k) % 11 + 1
    s = (a + b + 2).cast("double")
    return (
        read(spark, d, "labels")
        .select("doc_id", F.explode(F.array(*[F.lit(i) for i in range(4)])).alias("member"))
        .select(
            k.cast("string").alias("member"), F.col("doc_id").alias("id"),
            (a / s).alias("p0"), (b / s).alias("p1"), (F.lit(2) / s).alias("p2"),
        )
    )


def embedding_records(spark: SparkSession, d: str) -> DataFrame:
    """``linex_index, df_idx, segment, embeddings[{index, values}]``, two layers each."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    layers = F.array(
        F.struct(F.lit(-4).alias("index"), v.alias("values")),
        F.struct(F.lit(-5).alias("index"), F.transform(v, lambda x: x * 2).alias("values")),
    )
    return read(spark, d, "embeddings").select(
        F.col("vec_id").alias("linex_index"),
        F.floor(F.col("vec_id") / 3).cast("string").alias("df_idx"),
        (F.col("vec_id") % 3).cast("int").alias("segment"),
        layers.alias("embeddings"),
    )


# --- the same inputs in SQL ----------------------------------------------------------------------

_DEP_LIST = "[" + ", ".join(f"'{x}'" for x in DEPS) + "]"
_PRON_LIST = "[" + ", ".join(f"'{x}'" for x in PRONOUN_LIST) + "]"

SQL: dict[str, str] = {
    "entity": """
        SELECT o_orderkey AS id, coalesce(c_nationkey, -1) AS location,
               (CAST(substr(o_orderpriority, 1, 1) AS INT) - 1) % 3 AS label,
               o_orderkey % 3 <> 0 AS is_train, o_orderkey AS row_pos,
               o_orderpriority AS priority, o_orderstatus AS status
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "child_events": """
        SELECT user_id AS id, event_type, CAST(round(value * 100) AS BIGINT) AS volume,
               event_id AS row_pos FROM events""",
    "child_items": """
        SELECT l_orderkey AS id, l_returnflag AS category, CAST(l_quantity AS BIGINT) AS quantity,
               row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                   l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS row_pos
        FROM lineitem""",
    "cells": f"""
        SELECT l_partkey AS id, CAST(l_suppkey % {GROUPS} AS INT) AS grp,
               CAST((year(l_shipdate) * 12 + month(l_shipdate)) % {POSITIONS} AS INT) AS pos,
               CAST(sum(CAST(l_quantity AS BIGINT)) * 1000 AS BIGINT) AS value
        FROM lineitem GROUP BY 1, 2, 3""",
    "dense": f"""
        SELECT i.id, g.grp, p.pos, coalesce(c.value, 0) AS value
        FROM (SELECT DISTINCT id FROM cells) i
        CROSS JOIN (SELECT CAST(range AS INT) AS grp FROM range({GROUPS})) g
        CROSS JOIN (SELECT CAST(range AS INT) AS pos FROM range({POSITIONS})) p
        LEFT JOIN cells c ON c.id = i.id AND c.grp = g.grp AND c.pos = p.pos""",
    "text_cells": """
        SELECT id, grp, pos, value,
               CASE WHEN value = 0 THEN CASE WHEN (id + pos) % 2 = 0 THEN '0.0' ELSE '0' END
                    WHEN id % 13 = 0 THEN CAST(value AS VARCHAR) || '.125'
                    WHEN (id * 31 + grp * 7 + pos) % 7 = 0 THEN
                         CAST(value // 3 AS VARCHAR) ||
                         CASE value % 3 WHEN 1 THEN '.34' WHEN 2 THEN '.66' ELSE '.0' END
                    ELSE CAST(value AS VARCHAR) || '.0' END AS txt
        FROM dense""",
    "group_rows": """
        SELECT id, grp, list(value ORDER BY pos) AS g FROM dense GROUP BY id, grp""",
    "panel": """
        SELECT id, list(g ORDER BY grp) AS series FROM group_rows GROUP BY id""",
    "panel_target": "SELECT id, max(value) AS target FROM cells GROUP BY id",
    "planted": f"""
        SELECT p.id, t.target, p.id % 3 <> 0 AS is_train, p.id % 13 = 0 AS is_fake, p.series
        FROM panel p JOIN panel_target t ON t.id = p.id
        UNION ALL
        SELECT p.id + {CHILD_ID}, p.series[1][p.id % 6 + 1], p.id % 3 <> 0, p.id % 13 = 0,
               list_transform(p.series, lambda g: list_concat(
                   g[p.id % 6 + 3:{POSITIONS}],
                   list_transform(range({POSITIONS} - p.id % 6 - 2, {POSITIONS}),
                                  lambda k: CAST((p.id + k + 1) * 1000 AS BIGINT))))
        FROM panel p
        UNION ALL
        SELECT p.id + {COPY_ID}, t.target, p.id % 3 <> 0, p.id % 13 = 0, p.series
        FROM panel p JOIN panel_target t ON t.id = p.id WHERE p.id % 11 = 0""",
    "spans": f"""
        SELECT doc_id, text, w[n3] AS a, o3 AS a_off, w[n6] AS pronoun, o6 AS p_off, w[n9] AS b, o9 AS b_off,
               '{URL_HEAD}' || CASE doc_id % 3 WHEN 0 THEN w[n3] || '_' WHEN 1 THEN w[n9] || '_' ELSE '' END
               || w[least(4, len(w))] AS url,
               {_PRON_LIST}[doc_id % 6 + 1] AS pron
        FROM (SELECT *, CAST(coalesce(list_sum(list_transform(w[1:n3 - 1], lambda x: length(x) + 1)), 0) AS INT) AS o3,
                     CAST(coalesce(list_sum(list_transform(w[1:n6 - 1], lambda x: length(x) + 1)), 0) AS INT) AS o6,
                     CAST(coalesce(list_sum(list_transform(w[1:n9 - 1], lambda x: length(x) + 1)), 0) AS INT) AS o9
              FROM (SELECT doc_id, text, string_split(text, ' ') AS w, least(3, len(string_split(text, ' '))) AS n3,
                           least(6, len(string_split(text, ' '))) AS n6, least(9, len(string_split(text, ' '))) AS n9
                    FROM documents))""",
    "gold": """
        SELECT doc_id AS id, quality = 1 AS a_coref, toxic = 1 AS b_coref,
               CASE WHEN doc_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender
        FROM labels JOIN documents USING (doc_id)""",
    "system": """
        SELECT id, a_coref <> (id % 5 = 0) AS a_coref, b_coref <> (id % 5 = 0) AS b_coref
        FROM gold WHERE id % 17 <> 0""",
    "words": """
        SELECT doc_id, CAST(generate_subscripts(w, 1) - 1 AS INT) AS tok, unnest(w) AS text
        FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)""",
    "tokens": f"""
        SELECT doc_id, tok, char_off, text, {_DEP_LIST}[length(text) % 8 + 1] AS dep,
               CAST(start + (tok - start) // 2 AS INT) AS head_tok, sent
        FROM (SELECT *, min(tok) OVER (PARTITION BY doc_id, sent) AS start FROM (
            SELECT doc_id, tok, text,
                   CAST(coalesce(sum(length(text) + 1) OVER b, 0) AS BIGINT) AS char_off,
                   CAST(coalesce(sum(CASE WHEN text LIKE '%.' THEN 1 ELSE 0 END) OVER b, 0) AS BIGINT) AS sent
            FROM words
            WINDOW b AS (PARTITION BY doc_id ORDER BY tok ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))""",
    "entities": """
        SELECT doc_id, text AS ent_text, CASE WHEN length(text) % 2 = 0 THEN 'PERSON' ELSE 'ORG' END AS label
        FROM words WHERE regexp_matches(text, '^[A-Z]')""",
    "mentions": """
        SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY tok) - 1 AS INT) AS m, text,
               CAST(length(text) % 3 AS INT) AS cluster_id, ((tok * 5) % 13 - 6) / 2.0 AS head_score, tok
        FROM words WHERE regexp_matches(text, '^[A-Z]') OR tok IN (2, 5, 8)""",
    "antecedents": """
        SELECT doc_id, m, m - back AS ant, CAST((m * 7 + (m - back) * 3) % 11 - 5 AS DOUBLE) AS score
        FROM mentions CROSS JOIN (SELECT CAST(range AS INT) AS back FROM range(1, 4)) WHERE m >= back""",
    "vocab_terms": """
        SELECT DISTINCT term FROM (
            SELECT unnest(regexp_split_to_array(text, '[^A-Za-z]+')) AS term FROM benchmark)
        WHERE length(term) >= 4""",
    "starred": r"""
        SELECT doc_id, regexp_replace(text, '([A-Za-z]{2})[A-Za-z]([A-Za-z]+)', '\1*\2', 'g') AS text
        FROM documents""",
    "predictions": """
        SELECT id, label, a / s AS p0, b / s AS p1, 3 / s AS p2
        FROM (SELECT doc_id AS id, CASE WHEN toxic = 1 THEN 2 WHEN quality = 1 THEN 1 ELSE 0 END AS label,
                     doc_id % 7 + 1 AS a, doc_id % 11 + 1 AS b,
                     CAST(doc_id % 7 + 1 + doc_id % 11 + 1 + 3 AS DOUBLE) AS s FROM labels)""",
    "member_predictions": """
        SELECT CAST(k AS VARCHAR) AS member, id, a / s AS p0, b / s AS p1, 2 / s AS p2
        FROM (SELECT k, doc_id AS id, (doc_id * (k + 1)) % 7 + 1 AS a, (doc_id + k) % 11 + 1 AS b,
                     CAST((doc_id * (k + 1)) % 7 + 1 + (doc_id + k) % 11 + 1 + 2 AS DOUBLE) AS s
              FROM labels CROSS JOIN (SELECT range AS k FROM range(4)))""",
    "embedding_records": """
        SELECT vec_id AS linex_index, CAST(vec_id // 3 AS VARCHAR) AS df_idx, CAST(vec_id % 3 AS INT) AS segment,
               list_concat(v, list_transform(v, lambda x: x * 2)) AS flat
        FROM (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings)""",
}


def with_ctes(statement: str) -> str:
    """Prepend the definitions a statement names, in dependency order."""
    needed: list[str] = []

    def visit(sql: str, skip: str = "") -> None:
        for name in SQL:
            if name != skip and name not in needed and re.search(rf"\b{name}\b", sql):
                visit(SQL[name], name)
                if name not in needed:
                    needed.append(name)

    visit(statement)
    body = statement.strip()
    if not needed:
        return body
    heads = ",\n".join(f"{n} AS ({SQL[n].strip()})" for n in needed)
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {heads},\n{body[len('WITH RECURSIVE'):].strip()}"
    if body.upper().startswith("WITH"):
        return f"WITH {heads},\n{body[4:].strip()}"
    return f"WITH {heads}\n{body}"
