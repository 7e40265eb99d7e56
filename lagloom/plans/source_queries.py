"""Queries that write a table to a folder of their own and read it back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lagloom.operators.metrics import confusion_by_group, join_gold_system
from lagloom.plans import fixtures as X
from lagloom.plans.registry import query
from lagloom.session import shared_folder
from lagloom.sources import commits, scans, sinks

ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/lagloom-{name}-{uuid.uuid4().hex}"


def _orders(spark, d):
    return X.read(spark, d, "orders").drop("o_orderdate")


_ALL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"


@query("scan_csv", _ALL)
def scan_csv(spark, d):
    path = _folder(spark, "csv")
    sinks.sink_csv(_orders(spark, d), path)
    return scans.scan_csv(spark, path, ORDERS)


@query("scan_csv_projected", "SELECT o_orderkey, o_totalprice FROM orders")
def scan_csv_projected(spark, d):
    path = _folder(spark, "csv")
    sinks.sink_csv(_orders(spark, d), path)
    return scans.scan_csv_projected(spark, path, ORDERS, ["o_orderkey", "o_totalprice"])


@query("scan_tsv", _ALL)
def scan_tsv(spark, d):
    path = _folder(spark, "tsv")
    sinks.sink_tsv(_orders(spark, d), path)
    return scans.scan_tsv(spark, path, ORDERS)


@query("sink_csv", "SELECT p_partkey, p_name, p_brand, p_retailprice FROM part")
def sink_csv(spark, d):
    path = _folder(spark, "csv")
    sinks.sink_csv(X.read(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice"), path)
    return scans.scan_csv(spark, path, "p_partkey long, p_name string, p_brand string, p_retailprice double")


@query("sink_tsv", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def sink_tsv(spark, d):
    path = _folder(spark, "tsv")
    sinks.sink_tsv(X.read(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal"), path)
    return scans.scan_tsv(spark, path, "c_custkey long, c_name string, c_acctbal double")


@query("scan_raw_text_cells", "SELECT CAST(id AS VARCHAR) AS id, grp, pos, txt FROM text_cells")
def scan_raw_text_cells(spark, d):
    names = [f"g{g}_p{p}" for g in range(X.GROUPS) for p in range(X.POSITIONS)]
    flat = X.text_panel(spark, d).select("id", F.flatten("cells").alias("c"))
    path = _folder(spark, "cells")
    sinks.sink_csv(flat.select("id", *[F.get("c", F.lit(i)).alias(n) for i, n in enumerate(names)]), path)
    rows = scans.scan_raw_text_cells(spark, path, ["id", *names], keep=1)
    return (
        rows.select("id", F.posexplode("cells").alias("k", "txt"))
        .select("id", F.floor(F.col("k") / X.POSITIONS).cast("int").alias("grp"), (F.col("k") % X.POSITIONS).alias("pos"), "txt")
    )


_FLAT = """
    SELECT linex_index, df_idx, segment, CAST(list_sum(list_transform(flat, lambda x: CAST(round(round(x, 6) * 1000000) AS BIGINT))) AS BIGINT) AS s FROM embedding_records"""


def _sum_values(df):
    values = F.flatten(F.transform("embeddings", lambda e: e["values"]))
    millionths = F.transform(values, lambda x: F.round(F.round(x, 6) * 1000000).cast("long"))
    total = F.aggregate(millionths, F.lit(0).cast("long"), lambda s, x: s + x)
    return df.select("linex_index", "df_idx", "segment", total.alias("s"))


@query("scan_jsonl_nested", _FLAT)
def scan_jsonl_nested(spark, d):
    path = _folder(spark, "jsonl")
    X.embedding_records(spark, d).write.json(path)
    return _sum_values(scans.scan_jsonl_nested(spark, path))


@query("sink_jsonl_nested", _FLAT)
def sink_jsonl_nested(spark, d):
    path = _folder(spark, "jsonl")
    sinks.sink_jsonl_nested(X.embedding_records(spark, d), path)
    return _sum_values(scans.scan_jsonl_nested(spark, path))


@query(
    "scan_annotations",
    """SELECT CAST(g.id AS VARCHAR) AS id, CASE WHEN g.gender = 'F' THEN 'She' ELSE 'His' END AS pronoun, g.a_coref AS gold_a, g.b_coref AS gold_b,
              s.a_coref AS sys_a, s.b_coref AS sys_b FROM gold g LEFT JOIN system s ON s.id = g.id""",
)
def scan_annotations(spark, d):
    gold = X.gold(spark, d)
    path_g, path_s = _folder(spark, "gold"), _folder(spark, "system")
    blank, zero = F.lit("t"), F.lit("0")
    pronoun = F.when(F.col("gender") == "F", "She").otherwise("His")
    sinks.sink_tsv(
        gold.select(
            F.col("id").alias("ID"), blank.alias("Text"), pronoun.alias("Pronoun"), zero.alias("Pronoun-offset"), blank.alias("A"),
            zero.alias("A-offset"), F.upper(F.col("a_coref").cast("string")).alias("A-coref"), blank.alias("B"), zero.alias("B-offset"),
            F.col("b_coref").cast("string").alias("B-coref"), blank.alias("URL"),
        ),
        path_g,
    )
    X.system(spark, d).select("id", F.col("a_coref").cast("string"), F.col("b_coref").cast("string")).write.option("sep", "\t").csv(path_s)
    theirs = scans.scan_annotations(spark, path_s, is_gold=False).select("id", F.col("a_coref").alias("sys_a"), F.col("b_coref").alias("sys_b"))
    ours = scans.scan_annotations(spark, path_g, is_gold=True).select(
        "id", "pronoun", F.col("a_coref").alias("gold_a"), F.col("b_coref").alias("gold_b")
    )
    return ours.join(theirs, "id", "left")


@query(
    "scan_vocab",
    r"""SELECT term, ord FROM (SELECT w AS term, row_number() OVER (ORDER BY w) - 1 AS ord
            FROM (SELECT DISTINCT unnest(regexp_split_to_array(text, '[ \n]+')) AS w FROM benchmark))
        WHERE length(term) >= 3 AND NOT regexp_matches(term, '[\[#0-9]')""",
)
def scan_vocab(spark, d):
    path = _folder(spark, "vocab")
    words = X.read(spark, d, "benchmark").select(F.explode(F.split("text", "[ \\n]+")).alias("term")).distinct()
    words.orderBy("term").write.text(path)
    return scans.scan_vocab(spark, path)


@query("sink_sorted_table", _ALL)
def sink_sorted_table(spark, d):
    path = _folder(spark, "sorted")
    sinks.sink_sorted_table(_orders(spark, d), path, "o_orderkey")
    return spark.read.parquet(path)


@query("sink_snapshot", "SELECT id, target FROM panel_target")
def sink_snapshot(spark, d):
    path = _folder(spark, "snapshot")
    first = commits.replace_snapshot(X.panel(spark, d).select("id", "target").where("id % 2 = 0"), path)
    return commits.replace_snapshot(first.unionByName(X.panel(spark, d).select("id", "target").where("id % 2 <> 0")), path)


@query(
    "sink_metric_append",
    """SELECT r.range AS round, count(*) FILTER (g.a_coref AND s.a_coref) + count(*) FILTER (g.b_coref AND s.b_coref) AS tp
       FROM gold g JOIN system s ON s.id = g.id CROSS JOIN range(2) r GROUP BY 1""",
)
def sink_metric_append(spark, d):
    path = _folder(spark, "metrics")
    scored = confusion_by_group(join_gold_system(X.gold(spark, d), X.system(spark, d))).where("grp = 'Overall'")
    for r in (0, 1, 1):  # a repeated run adds nothing
        commits.append_once(scored.select(F.lit(r).cast("bigint").alias("round"), "tp"), path, f"round-{r}")
    return commits.read_runs(spark, path)
