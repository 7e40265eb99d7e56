"""Word pieces of a corpus, and fixed windows of pieces around a span.

A word is split once however often it occurs: texts are cut into words by expressions, only the
distinct words are split further, and counts are joined back by word.
"""

from __future__ import annotations

import string
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from lagloom.functions.arrays import let
from lagloom.functions.text import char_slice, strip_stars
from lagloom.operators.lookup import lookup
from lagloom.session import cut_lineage, widen

# Marker pieces, and the longest word that is split.
UNKNOWN, CLS, SEP, MASK = "[UNK]", "[CLS]", "[SEP]", "[MASK]"
MAX_WORD = 200
# Blocks of ideographs, each of which is a word of its own.
IDEOGRAPHS = (
    r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}"
    r"\x{2B740}-\x{2B81F}\x{2B820}-\x{2CEAF}\x{F900}-\x{FAFF}\x{2F800}-\x{2FA1F}"
)
# ASCII signs that count as punctuation, beside the Unicode punctuation classes.
SIGNS = frozenset(string.punctuation)


def words_of(text: Column) -> Column:
    """Words in order: control characters removed, ideographs apart, split at white space.

    Words made only of combining marks are left out, as nothing remains of them. A text with
    none of these characters, the usual case, is only searched once and split.
    """
    blank = r"[ \t\n\r\p{Zs}\x{2028}\x{2029}]+"
    control = r"[\p{Cc}\p{Cf}\x{FFFD}&&[^\t\n\r]]"

    def split(t: Column) -> Column:
        return F.array_remove(F.split(t, blank), "")

    apart = F.regexp_replace(F.regexp_replace(text, control, ""), f"([{IDEOGRAPHS}])", " $1 ")
    careful = F.filter(split(apart), lambda w: ~w.rlike(r"^\p{Mn}+$"))
    special = text.rlike(rf"[\p{{Cc}}\p{{Cf}}\p{{Mn}}\x{{FFFD}}{IDEOGRAPHS}&&[^\t\n\r]]")
    return F.when(special, careful).otherwise(split(text))


def _split_word(word: str, lower: bool) -> list[str]:
    if lower:
        marks = unicodedata.normalize("NFD", word.lower())
        word = "".join(c for c in marks if unicodedata.category(c) != "Mn")
    apart = (f" {c} " if c in SIGNS or unicodedata.category(c)[0] == "P" else c for c in word)
    return "".join(apart).split()


def _parts(lower: bool):
    @F.pandas_udf(ArrayType(StringType()))
    def split(words: pd.Series) -> pd.Series:
        return words.map(lambda w: _split_word(w, lower))

    return split


def word_parts(words: DataFrame, lower: bool = True) -> DataFrame:
    """``word`` (distinct) -> ``word, parts``: lower-cased, accents stripped, punctuation apart.

    Unicode decomposition has no built-in expression, hence the vectorised function.
    """
    return widen(words, "word").select("word", _parts(lower)("word").alias("parts"))


def part_pieces(parts: DataFrame, vocab: DataFrame) -> DataFrame:
    """``part`` (distinct) -> ``part, pieces``: greedy longest match against ``vocab(term)``.

    Every stretch of a part that could be a term is joined with the vocabulary, the longest hit
    per start is kept, and a part walks its own at most 200 starts. A part that cannot be covered,
    or is longer, is unknown.
    """
    longest = vocab.agg(F.max(F.length(F.regexp_replace("term", "^##", "")))).scalar()
    short = parts.where(F.length("part") <= MAX_WORD)
    starts = F.explode(F.sequence(F.lit(0), F.length("part") - 1)).alias("start")
    stretches = (
        short.where("part <> ''")
        .select("part", starts)
        .select(
            "part", "start",
            F.explode(F.sequence(F.lit(1), F.least(F.length("part") - F.col("start"), longest))).alias("n"),
        )
        .select(
            "part", "start", "n",
            F.concat(F.when(F.col("start") > 0, "##").otherwise(""), F.substr("part", F.col("start") + 1, F.col("n"))).alias("term"),
        )
    )
    # short stretches are in most words: a small vocabulary leaves the stretches in place, beside a large one a hot term is split
    hits = lookup(stretches, vocab.select("term").distinct(), "term", "inner", measure=True).groupBy("part", "start").agg(F.max("n").alias("n"))
    by_part = hits.groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("start", "n"))).alias("_len")
    )

    def step(s: Column, _: Column) -> Column:
        n = F.try_element_at("_len", s["pos"])
        piece = F.concat(F.when(s["pos"] > 0, "##").otherwise(""), F.substr("part", s["pos"] + 1, n))
        moved = F.struct((s["pos"] + n).alias("pos"), F.concat(s["out"], F.array(piece)).alias("out"))
        return F.when((s["pos"] >= F.length("part")) | n.isNull(), s).otherwise(moved)

    first = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))
    walked = F.aggregate(F.sequence(F.lit(1), F.length("part")), first, step)
    covered = let(walked, lambda w: F.when(w["pos"] >= F.length("part"), w["out"]))
    found = by_part.select("part", covered.alias("pieces"))
    return parts.join(found, "part", "left").select(
        "part", F.coalesce("pieces", F.array(F.lit(UNKNOWN))).alias("pieces")
    )


def word_dictionary(words: DataFrame, vocab: DataFrame, lower: bool = True) -> DataFrame:
    """``word`` (distinct) -> ``word, pieces``.

    The split words are needed twice and written out once.
    """
    split = cut_lineage(word_parts(words, lower).select("word", F.posexplode("parts").alias("i", "part")))
    pieces = part_pieces(widen(split.select("part").distinct(), "part"), vocab)
    return lookup(split, pieces, "part").groupBy("word").agg(
        F.flatten(
            F.transform(F.array_sort(F.collect_list(F.struct("i", "pieces"))), lambda s: s["pieces"])
        ).alias("pieces")
    )


def token_dictionary(texts: DataFrame, vocab: DataFrame, lower: bool = True) -> DataFrame:
    """``piece, n``: how often each piece occurs in the corpus.

    The corpus is read once: its word counts are written out before they are used twice.
    """
    counts = cut_lineage(
        texts.select(F.explode(words_of(F.col("text"))).alias("word")).groupBy("word").agg(
            F.count(F.lit(1)).alias("n")
        )
    )
    pieces = word_dictionary(counts.select("word"), vocab, lower)
    return counts.join(pieces, "word").select(F.explode("pieces").alias("piece"), "n").groupBy("piece").agg(
        F.sum("n").alias("n")
    )


def token_window(
    spans: DataFrame, vocab: DataFrame, length: int = 64, shift: int = 0, lower: bool = True
) -> DataFrame:
    """``doc_id, role, target, tokens, mask``: ``length`` pieces around each span of a document.

    The names A and B become a mask piece. The window is centred on the span, kept inside the
    text, and moved left off continuation pieces as long as the span stays inside. It never
    reaches further than ``length`` pieces to a side, so of all the words only the nearest
    ``length`` on either side are split into pieces; these are written out, so the texts are read
    once.
    """
    size = length - 2
    reach = size + abs(shift)
    text, off = F.col("text"), F.col("off")
    rows = F.array(
        *[
            F.struct(
                F.lit(role).alias("role"), F.col(f"{role}_off").alias("off"), F.col(name).alias("name"),
                F.lit(role != "p").alias("masked"),
            )
            for role, name in (("p", "pronoun"), ("a", "a"), ("b", "b"))
        ]
    )
    end = off + F.length("name")
    before = words_of(strip_stars(char_slice(text, F.lit(0), off)))
    after = words_of(strip_stars(char_slice(text, end, F.length("text"))))
    inside = F.when(F.col("masked"), F.array().cast("array<string>")).otherwise(words_of(char_slice(text, off, end)))
    cut = spans.select("doc_id", "text", F.inline(rows)).select(
        "doc_id", "role", "masked", before.alias("_b"), inside.alias("_t"), after.alias("_a")
    )
    near = cut_lineage(
        cut.select(
            "doc_id", "role", "masked",
            F.slice("_b", F.greatest(F.size("_b") - reach, F.lit(1)), reach + 1).alias("_b"),
            "_t", F.slice("_a", 1, reach + 1).alias("_a"),
        )
    )

    def numbered(k: int, c: str) -> Column:
        return F.transform(c, lambda w, i: F.struct(F.lit(k).alias("side"), i.alias("i"), w.alias("word")))

    sides = F.concat(numbered(0, "_b"), numbered(1, "_t"), numbered(2, "_a"))
    words = near.select("doc_id", "role", F.inline(sides))
    pieces = word_dictionary(words.select("word").distinct(), vocab, lower)
    ordered = (
        lookup(words, pieces, "word")
        .groupBy("doc_id", "role")
        .agg(F.array_sort(F.collect_list(F.struct("side", "i", "pieces"))).alias("_p"))
    )

    def side(k: int) -> Column:
        return F.flatten(F.transform(F.filter("_p", lambda s: s["side"] == k), lambda s: s["pieces"]))

    none = F.array().cast("array<string>")
    joined = near.select("doc_id", "role", "masked").join(ordered, ["doc_id", "role"], "left")
    parts = joined.select(
        "doc_id", "role",
        F.coalesce(side(0), none).alias("_b"),
        F.when(F.col("masked"), F.array(F.lit(MASK))).otherwise(F.coalesce(side(1), none)).alias("_t"),
        F.coalesce(side(2), none).alias("_a"),
    ).select("doc_id", "role", F.concat("_b", "_t", "_a").alias("_all"), F.size("_b").alias("_at"))
    long = F.size("_all") > size
    start = F.least(
        F.greatest(F.floor(F.col("_at") - size / 2 + shift).cast("int"), F.lit(0)), F.size("_all") - size
    )
    settled = F.coalesce(
        F.array_max(
            F.filter(
                F.sequence(F.lit(0), F.greatest(start, F.lit(0))),
                lambda p: ~F.startswith(F.get("_all", p), F.lit("#")) | (p <= F.col("_at") + 1 - size),
            )
        ),
        F.lit(0),
    )
    placed = parts.withColumn("_s", F.when(long, settled).otherwise(0))
    tokens = F.concat(
        F.array(F.lit(CLS)), F.slice("_all", F.col("_s") + 1, F.lit(size)), F.array(F.lit(SEP))
    )
    return placed.select(
        "doc_id", "role", (F.col("_at") - F.col("_s") + 1).alias("target"), tokens.alias("tokens")
    ).withColumn("mask", pad(F.transform("tokens", lambda _: F.lit(1)), length))


def pad(a: Column, length: int) -> Column:
    """Zeros appended up to ``length``."""
    return F.concat(a, F.array_repeat(F.lit(0), F.greatest(F.lit(length) - F.size(a), F.lit(0))))


def token_ids(rows: DataFrame, keys: list[str], vocab: DataFrame, length: int | None = None) -> DataFrame:
    """``keys, ids``: pieces of ``tokens`` as ordinals of ``vocab(term, ord)``; unknown ones raise."""
    flat = rows.select(*keys, F.posexplode("tokens").alias("i", "term"))
    known = F.coalesce("ord", F.raise_error(F.concat(F.lit("not in the vocabulary: "), "term")).cast("long"))
    joined = lookup(flat, vocab.select("term", "ord"), "term").select(*keys, "i", known.alias("ord"))
    packed = joined.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("i", "ord"))).alias("_p"))
    ids = F.transform("_p", lambda s: s["ord"].cast("int"))
    return packed.select(*keys, (ids if length is None else pad(ids, length)).alias("ids"))


def ids_to_tokens(rows: DataFrame, keys: list[str], vocab: DataFrame) -> DataFrame:
    """``keys, tokens``: the terms of an array of ordinals."""
    flat = rows.select(*keys, F.posexplode("ids").alias("i", "ord"))
    joined = lookup(flat, vocab.select(F.col("ord").cast("int").alias("ord"), "term"), "ord", "inner")
    packed = joined.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("i", "term"))).alias("_p"))
    return packed.select(*keys, F.transform("_p", lambda s: s["term"]).alias("tokens"))
