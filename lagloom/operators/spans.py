"""Features of a text with three marked spans: a pronoun and two names.

Columns: ``doc_id, text, a, a_off, pronoun, p_off, b, b_off, url``. All row-local.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagloom.functions import text as T


def position_features() -> dict[str, Column]:
    a, b, p = F.col("a_off"), F.col("b_off"), F.col("p_off")
    return {
        "a_then_pronoun": (a < p).cast("int"),
        "b_then_pronoun": (b < p).cast("int"),
        "pronoun_first": ((p < a) & (p < b)).cast("int"),
        "pronoun_last": ((p > a) & (p > b)).cast("int"),
        "a_dist": F.abs(p - a),
        "b_dist": F.abs(p - b),
    }


def sentence_features() -> dict[str, Column]:
    """Whether sentence ends ('.', for the neighbour flags also ';') stand between the spans."""
    text = F.col("text")
    a, b, p = F.col("a_off"), F.col("b_off"), F.col("p_off")

    def ends(start: Column, end: Column, marks: str = ".;") -> Column:
        part = T.char_slice(text, start, end)
        hit = F.contains(part, F.lit(marks[0]))
        for mark in marks[1:]:
            hit = hit | F.contains(part, F.lit(mark))
        return hit

    whole = ends(F.least(a, b, p), F.greatest(a, b, p), ".")
    return {
        "all_in_one_sent": (~whole).cast("int"),
        "pronoun_in_next_sent": (ends(F.greatest(a, b), p) & (a < p) & (b < p)).cast("int"),
        "b_in_next_sent": (ends(F.greatest(a, p), b) & (a < b) & (p < b)).cast("int"),
        "pronoun_in_prev_sent": (ends(p, F.least(a, b)) & (p < a) & (p < b)).cast("int"),
        "a_in_prev_sent": (ends(a, F.least(p, b)) & (a < b) & (a < p)).cast("int"),
    }


def frequency_features() -> dict[str, Column]:
    return {f"freq_{n}": T.substring_count(F.col("text"), F.col(n)) for n in ("a", "b")}


def url_features(prefix: int = T.URL_PREFIX_LENGTH) -> dict[str, Column]:
    title = T.url_title(F.col("url"), prefix)
    return {f"{n}_in_url": T.name_in_text(F.col(n), title) for n in ("a", "b")}


def extents() -> dict[str, Column]:
    """Span ends and the section they cover together."""
    ends = {f"{n}_end": F.col(f"{n}_off") + F.length(c) for n, c in (("p", "pronoun"), ("a", "a"), ("b", "b"))}
    return {
        **ends,
        "section_min": F.least("p_off", "a_off", "b_off"),
        "section_max": F.greatest(*ends.values()),
        "a_dist": F.abs(F.col("p_off") - F.col("a_off")),
        "b_dist": F.abs(F.col("p_off") - F.col("b_off")),
    }


def snippet(compat: bool = False) -> Column:
    e = extents()
    return T.sentence_snippet(F.col("text"), e["section_min"], e["section_max"], compat)


def anonymised(first: str = "subjectone", second: str = "subjecttwo") -> Column:
    return T.anonymise_name(T.anonymise_name(F.col("text"), F.col("a"), first), F.col("b"), second)


def ratio_features() -> dict[str, Column]:
    n = F.length("text").cast("double")
    return {f"{k}_rel": F.try_divide(F.col(f"{k}_off").cast("double"), n) for k in ("a", "b", "p")}


def span_rows(spans: DataFrame) -> DataFrame:
    """One row per document and span: ``doc_id, role, name, off``."""
    rows = F.array(
        *[
            F.struct(F.lit(role).alias("role"), F.col(name).alias("name"), F.col(f"{role}_off").alias("off"))
            for role, name in (("a", "a"), ("b", "b"), ("p", "pronoun"))
        ]
    )
    return spans.select("doc_id", F.inline(rows))
