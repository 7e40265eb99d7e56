"""Readers. Schemas are given, never inferred, so a scan is one pass and columns are pruned."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagloom.functions.text import parse_bool_text
from lagloom.operators.lookup import lookup
from lagloom.session import cut_lineage

# Annotation columns in file order.
GOLD_FIELDS = (
    "ID", "Text", "Pronoun", "Pronoun-offset", "A", "A-offset", "A-coref", "B", "B-offset", "B-coref", "URL",
)
SYSTEM_FIELDS = ("ID", "A-coref", "B-coref")

EMBEDDING_SCHEMA = (
    "linex_index long, df_idx string, segment int, "
    "embeddings array<struct<index: int, values: array<double>>>"
)


def scan_csv(spark: SparkSession, path: str, schema: str, sep: str = ",", header: bool = True) -> DataFrame:
    return (
        spark.read.schema(schema).option("header", header).option("sep", sep).option("escape", '"')
        .option("enforceSchema", not header).csv(path)
    )


def scan_csv_projected(spark: SparkSession, path: str, schema: str, columns: list[str]) -> DataFrame:
    """Only the named columns are parsed."""
    return scan_csv(spark, path, schema).select(*columns)


def scan_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tab-separated with a header; a leading index column is an ordinary column of the schema."""
    return scan_csv(spark, path, schema, sep="\t")


def scan_raw_text_cells(spark: SparkSession, path: str, columns: list[str], keep: int) -> DataFrame:
    """The first ``keep`` columns, and the cells of all others as untouched text in one array."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
    return rows.select(*[F.col(f"`{c}`") for c in columns[:keep]], F.array(*[F.col(f"`{c}`") for c in columns[keep:]]).alias("cells"))


def scan_jsonl_nested(spark: SparkSession, path: str, schema: str = EMBEDDING_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).json(path)


def scan_annotations(spark: SparkSession, path: str, is_gold: bool) -> DataFrame:
    """``id``, the pronoun in gold files, and both flags; the first of a repeated id wins.

    Gold files have a header, system files none. A file is ordered by path, then by line.
    """
    fields = GOLD_FIELDS if is_gold else SYSTEM_FIELDS
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    rows = spark.read.schema(schema).option("header", is_gold).option("sep", "\t").option("escape", '"').csv(path)
    columns = [
        *([F.col("Pronoun").alias("pronoun")] if is_gold else []),
        parse_bool_text(F.col("`A-coref`")).alias("a_coref"),
        parse_bool_text(F.col("`B-coref`")).alias("b_coref"),
    ]
    # Within one file the id grows with the line: splits are numbered in file order.
    at = F.struct(F.input_file_name(), F.input_file_block_start(), F.monotonically_increasing_id())
    return (
        rows.select(F.col("ID").alias("id"), F.struct(*columns).alias("_row"), at.alias("_at"))
        .groupBy("id")
        .agg(F.min_by("_row", "_at").alias("_row"))
        .select("id", "_row.*")
    )


def scan_vocab(spark: SparkSession, path: str, filtered: bool = True) -> DataFrame:
    """One term per line: ``term, ord``, where ``ord`` is the number of the line from 0, files in order of their path.

    ``filtered`` drops terms of fewer than three characters and those with '[', '#' or a digit; the others keep
    their numbers. Lines are numbered inside each split and the sizes of the earlier splits are added; they are
    written out first, so both uses see the same splits.
    """
    split = ["file", "block"]
    lines = cut_lineage(
        spark.read.text(path).select(
            F.btrim("value").alias("term"), F.input_file_name().alias("file"),
            F.input_file_block_start().alias("block"), F.monotonically_increasing_id().alias("line"),
        )
    )
    sizes = lines.groupBy(*split).agg(F.count(F.lit(1)).alias("n"), F.min("line").alias("first"))
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*split, (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    kept = lines.where((F.length("term") >= 3) & ~F.col("term").rlike(r"[\[#0-9]")) if filtered else lines
    return lookup(kept, starts, split, "inner", measure=True).select("term", (F.col("line") + F.col("shift")).alias("ord"))
