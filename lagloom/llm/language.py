"""Language identification by compression.

Each language has a zstandard raw-content dictionary of its own training texts. A text, reduced to lower-case letters
and spaces, is cut into pieces that fit the dictionary's window; all pieces are encoded with every dictionary, and
the language that needs the fewest bytes wins. Every piece of every text is encoded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagloom.llm.common import slices
from lagloom.operators.lookup import lookup

UNKNOWN = "und"
NOT_LETTERS = regex.compile(r"[^\p{L}]+")
DICTIONARY = 64 << 10  # bytes of a language's dictionary
EXCERPT = 2048  # letters that one training text gives to it
SAMPLE = 256  # training texts drawn per language: the bound on the labelled sample
PIECE = 2000  # bytes encoded at once
NARROW, ENOUGH = 0.002, 200  # reject below this margin, if there are so many letters to judge by
HALF = 0.02  # margin that scores 0.5


def letters(text: str) -> str:
    """Lower-case letters of a text, everything else as single spaces."""
    return NOT_LETTERS.sub(" ", text.lower()).strip()


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, sample: int = SAMPLE) -> dict[str, bytes]:
    """Dictionaries of the languages named in rows of ``docs`` that are not held out.

    At most ``sample`` texts per language are drawn, those with the smallest hash of the id; a language with fewer
    gives all it has. The languages with most training texts come first.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(3)), F.lit(1 << 40)) / float(1 << 40)
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))
    drawn = known.select("lang", draw.alias("draw"), F.col("doc_id").cast("string").alias("doc_id"), "text")
    few = lookup(drawn, counts, "lang", "inner", measure=True).where(F.col("draw") * F.col("n") < 2 * sample)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id", "text"))
    rows = few.withColumn("rank", rank).where(F.col("rank") <= sample).select("n", "lang", "rank", "text").collect()
    out: dict[str, bytes] = {}
    for _, lang, _, text in sorted(rows, key=lambda r: (-r.n, r.lang, r["rank"])):
        held = out.get(lang, b"")
        if len(held) < DICTIONARY:
            out[lang] = held + letters(text)[:EXCERPT].encode() + b" "
    return {lang: content[:DICTIONARY] for lang, content in out.items() if content.strip()}


def encoders(dictionaries: dict[str, bytes]) -> dict[str, zstandard.ZstdCompressor]:
    params = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_GREEDY, min_match=4, search_log=4, window_log=17, hash_log=16, chain_log=16,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    out = {}
    for lang, content in dictionaries.items():
        raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(compression_params=params)
        out[lang] = zstandard.ZstdCompressor(compression_params=params, dict_data=raw)
    return out


def classify(text: str | None, by: dict[str, zstandard.ZstdCompressor]) -> tuple[str, float, bool]:
    """(language, score, rejected); equal sizes go to the first language of ``by``."""
    bare = letters(text).encode() if text else b""
    if not bare or not by:
        return UNKNOWN, 0.0, True
    pieces = [bare[i : i + PIECE] for i in range(0, len(bare), PIECE)]
    sizes = {lang: sum(len(c.compress(p)) for p in pieces) for lang, c in by.items()}
    best, *others = sorted(sizes, key=sizes.__getitem__)
    margin = 1 - sizes[best] / sizes[others[0]] if others else 1.0
    return best, margin / (margin + HALF), margin < NARROW and len(bare) >= ENOUGH


def identify(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """doc_id, lang_pred, score and rejected for every row of ``docs``.

    A null text, or one without a letter, is ``und`` with score 0 and rejected; so is every text if no language was
    learned. A long text whose two best sizes are nearly equal is rejected and keeps its prediction. Very long texts
    are judged whole, piece by piece. Neither source, lang nor id is read for a prediction; repeated rows are
    predicted alike.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = encoders(dictionaries)
        for batch in slices(batches, "text", 2 << 20):
            found = [classify(t, by) for t in batch.column("text").to_pylist()]
            pred, score, rejected = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(np.array(score, dtype=float)), pa.array(rejected, pa.bool_())],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def with_known_language(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """Rows of ``docs`` that ``classify`` does not reject, all columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = encoders(dictionaries)
        for batch in slices(batches, "text", 2 << 20):
            yield batch.filter(pa.array([not classify(t, by)[2] for t in batch.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected), learned from the rows of ``docs`` that are not held out."""
    out = identify(docs, learn(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
