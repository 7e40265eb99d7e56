"""Span and name expressions on text. Offsets count characters from 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The six pronouns and their gender, by grammatical use.
GENDER = {"she": "F", "her": "F", "hers": "F", "he": "M", "his": "M", "him": "M"}
MALE, SUBJECT, OBJECT, POSSESSIVE = ("he", "his", "him"), ("he", "she"), ("him", "her"), ("his", "hers")
# Fixed value: length of the address prefix before the page title.
URL_PREFIX_LENGTH = 29


def char_slice(text: Column, start: Column, end: Column) -> Column:
    """``text[start:end]`` for non-negative offsets; '' when the end is not after the start."""
    return F.substr(text, (start + 1).cast("int"), F.greatest(end - start, F.lit(0)).cast("int"))


def substring_count(text: Column, needle: Column) -> Column:
    """Non-overlapping occurrences; an empty needle counts once around every character."""
    hits = (F.length(text) - F.length(F.replace(text, needle, F.lit("")))) / F.nullif(
        F.length(needle), F.lit(0)
    )
    return F.when(needle == "", F.length(text) + 1).otherwise(hits.cast("int"))


def last_before(text: Column, needle: str, end: Column) -> Column:
    """Offset of the last occurrence of a one-character needle before ``end``, or -1."""
    head = char_slice(text, F.lit(0), end)
    back = F.instr(F.reverse(head), F.lit(needle))
    return F.when(back > 0, F.length(head) - back).otherwise(F.lit(-1))


def first_from(text: Column, needle: str, start: Column) -> Column:
    """Offset of the first occurrence at or after ``start``, or -1."""
    return F.position(F.lit(needle), text, (start + 1).cast("int")) - 1


def sentence_snippet(text: Column, low: Column, high: Column, compat: bool = False) -> Column:
    """Text from after the last '.' before ``low`` up to the first '.' at or after ``high``.

    Without a later '.', the snippet runs to the end of the text; with ``compat`` it loses the
    last character, as slicing to index -1 does.
    """
    right = first_from(text, ".", high)
    none = F.length(text) - 1 if compat else F.length(text)
    return char_slice(text, last_before(text, ".", low) + 1, F.when(right >= 0, right).otherwise(none))


def url_title(url: Column, prefix: int = URL_PREFIX_LENGTH) -> Column:
    return F.replace(F.lower(F.substr(url, F.lit(prefix + 1))), F.lit("_"), F.lit(" "))


def name_in_text(name: Column, text: Column) -> Column:
    return F.contains(text, F.lower(name)).cast("int")


def title_class(a: Column, b: Column, url: Column) -> Column:
    """0 when A is in the page title, else 1 when B is, else 2."""
    title = url_title(url)
    return F.when(name_in_text(a, title) == 1, 0).when(name_in_text(b, title) == 1, 1).otherwise(2)


def pronoun_flags(pronoun: Column) -> dict[str, Column]:
    p = F.lower(pronoun)
    return {
        "male": p.isin(*MALE).cast("int"),
        "subj": p.isin(*SUBJECT).cast("int"),
        "obj": p.isin(*OBJECT).cast("int"),
        "poss": p.isin(*POSSESSIVE).cast("int"),
    }


def gender_of_pronoun(pronoun: Column, strict: bool = True) -> Column:
    """'F' or 'M'. An unknown pronoun raises, or gives NULL when not ``strict``."""
    p = F.lower(pronoun)
    branch = None
    for word, gender in GENDER.items():
        branch = F.when(p == word, gender) if branch is None else branch.when(p == word, gender)
    if strict:
        return branch.otherwise(F.raise_error(F.concat(F.lit("unknown pronoun: "), pronoun)))
    return branch


def parse_bool_text(c: Column) -> Column:
    low = F.lower(c)
    return F.when(low == "true", True).when(low == "false", False)


def strip_stars(c: Column) -> Column:
    return F.replace(c, F.lit("*"), F.lit(""))


def anonymise_name(text: Column, name: Column, placeholder: str) -> Column:
    """Replace the full name, then every space-separated part of it, by the placeholder.

    An empty part is skipped.
    """
    def swap(t: Column, n: Column) -> Column:
        return F.when(n == "", t).otherwise(F.replace(t, n, F.lit(placeholder)))

    return F.aggregate(F.split(name, " "), swap(text, name), swap)
