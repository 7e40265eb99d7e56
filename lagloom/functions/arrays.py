"""Statistics over one array column, evaluated inside the row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once.

    An expression named inside a lambda is computed again for every element; binding it to a
    one-element array makes it a variable.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def nonzero(a: Column) -> Column:
    return F.filter(a, lambda x: x != 0)


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def mean(a: Column) -> Column:
    """NULL for an empty array."""
    return F.try_divide(total(a), F.size(a).cast("double"))


def variance(a: Column) -> Column:
    """Sample variance (n - 1); NULL below two values."""
    packed = F.aggregate(
        a,
        F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("m"), F.lit(0.0).alias("q")),
        lambda s, x: F.struct(
            (s.n + 1.0).alias("n"),
            (s.m + (x - s.m) / (s.n + 1.0)).alias("m"),
            (s.q + (x - s.m) * (x - (s.m + (x - s.m) / (s.n + 1.0)))).alias("q"),
        ),
        lambda s: F.try_divide(s.q, s.n - 1.0),
    )
    return F.when(F.size(a) > 1, packed)


def median(a: Column) -> Column:
    """Mean of the two middle values; NULL for an empty array."""
    return let(
        F.array_sort(a),
        lambda s: (
            F.get(s, F.floor((F.size(s) - 1) / 2).cast("int")).cast("double")
            + F.get(s, F.floor(F.size(s) / 2).cast("int"))
        )
        / 2.0,
    )


def argmax(a: Column) -> Column:
    """0-based index of the largest element, the lowest one on ties; -1 for an empty array."""
    return F.coalesce(F.array_position(a, F.array_max(a)).cast("int") - 1, F.lit(-1))


def change_flags(a: Column) -> Column:
    """1 where a value is positive and differs from the one before it (-1 before the first)."""
    return F.transform(
        a,
        lambda v, i: ((v > 0) & (v != F.coalesce(F.get(a, i - 1), F.lit(-1).cast("long")))).cast("int"),
    )


def count_changes(a: Column) -> Column:
    return F.aggregate(change_flags(a), F.lit(0), lambda s, x: s + x)


def nonzero_gaps(a: Column) -> Column:
    """Distances between successive non-zero positions."""
    at = F.filter(F.transform(a, lambda v, i: F.when(v != 0, i)), lambda i: i.isNotNull())
    return let(
        at,
        lambda p: F.zip_with(
            F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))),
            F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0))),
            lambda b, c: b - c,
        ),
    )


# --- vectors -------------------------------------------------------------------------------

def vector_subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def vector_concat(*cols: Column) -> Column:
    return F.concat(*cols)


def vector_split(v: Column, parts: int = 3) -> list[Column]:
    """Equal slices of a vector whose length is a multiple of ``parts``."""
    width = F.floor(F.size(v) / parts).cast("int")
    return [F.slice(v, width * i + 1, width) for i in range(parts)]


def nan_row_to_zero(v: Column) -> Column:
    """A vector holding any NaN becomes all zeros of the same length."""
    return F.when(F.exists(v, F.isnan), F.transform(v, lambda _: F.lit(0.0))).otherwise(v)
