"""From raw documents to packed training sequences.

Every stage works on all rows its predecessor kept; stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagloom.llm import language, mixing, packing, pii, simhash
from lagloom.llm.common import table
from lagloom.llm.queries import RANKS, VOCABULARY, tokenizer_file
from lagloom.session import cut_lineage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is told: texts without a letter and long texts with two languages nearly alike go.

    ``lang`` stays as it was. A null text goes; if no language is named in the table, every row goes.
    """
    return language.with_known_language(docs, language.learn(docs))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest doc_id of every near-duplicate group, once; rows without doc_id go."""
    groups = simhash.near_groups(docs)
    kept = groups.where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(docs.columns)


def without_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, with personal data and the terms that give it away replaced in its text; n_chars follows."""
    return pii.sanitise(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the rates for the target weights say, fewer of the toxic ones; all if nothing is labelled."""
    return mixing.mix(docs, mixing.label_domains(table(spark, sf_dir, "labels")), mixing.SHARES)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows with their sequence and place."""
    return packing.packed_sequences(docs, tokenizer_file(VOCABULARY), tokenizer_file(RANKS))


STAGES = [
    ("language_id", known_language),
    ("simhash_near_dedup", without_near_duplicates),
    ("private_data", without_private_data),
    ("mix_to_target_weights", mixed),
    ("best_fit_packing", packed),
]
#: Hashing, compression, tokenizers and fitted models have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
