"""Writers. Each writes one directory with a file per task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def sink_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> None:
    # Quotes inside a field are doubled on writing and read back the same way.
    df.write.mode(mode).option("header", True).option("sep", sep).option("escape", '"').csv(path)


def sink_tsv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    sink_csv(df, path, sep="\t", mode=mode)


def sink_sorted_table(df: DataFrame, path: str, key: str, mode: str = "errorifexists") -> None:
    """Files in key order and sorted inside. Equal keys may split over two files when one is hot."""
    salted = F.pmod(F.xxhash64(*df.columns), F.lit(1024))
    df.withColumn("_salt", salted).repartitionByRange(key, "_salt").sortWithinPartitions(key).drop("_salt").write.mode(
        mode
    ).parquet(path)


def sink_jsonl_nested(df: DataFrame, path: str, digits: int = 6, mode: str = "errorifexists") -> None:
    """Embedding records with values rounded."""
    layers = F.transform(
        "embeddings",
        lambda e: F.struct(
            e["index"].alias("index"), F.transform(e["values"], lambda x: F.round(x, digits)).alias("values")
        ),
    )
    df.withColumn("embeddings", layers).write.mode(mode).json(path)


def sink_snapshot(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write a prepared table and read it back."""
    df.write.mode(mode).parquet(path)
    return load_snapshot(df.sparkSession, path)


def load_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def sink_metric_append(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("append").parquet(path)
