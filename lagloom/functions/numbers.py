"""Numbers kept as text: what the way a number is written tells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lagloom.functions.arrays import let

# Divisors tried, in this order, when repairing a number.
REPAIR_FACTORS = (3, 7, 9, 11, 13, 15, 17, 19, 31)
# Integer parts counted as special.
SPECIAL_VALUES = (
    20000000, 10000000, 2000000, 4000000, 1000000, 200000, 400000, 6000000, 600000, 40000000, 3000000,
)


def int_part(c: Column) -> Column:
    return F.split_part(c, F.lit("."), F.lit(1))


def frac_part(c: Column) -> Column:
    """Text after the first point, '' without one."""
    return F.split_part(c, F.lit("."), F.lit(2))


def is_zero(c: Column) -> Column:
    return c.isin("0", "0.0")


def is_nonzero(c: Column) -> Column:
    return ~is_zero(c)


def compare_numeric_text(a: Column, b: Column) -> Column:
    """Equal texts, where a text without a point stands for the same text with '.0'."""
    def pointed(c: Column) -> Column:
        return F.when(c.contains("."), c).otherwise(F.concat(c, F.lit(".0")))

    both_plain = ~a.contains(".") & ~b.contains(".")
    return F.when(both_plain, a == b).otherwise(pointed(a) == pointed(b))


def is_fake_number(c: Column) -> Column:
    return F.length(frac_part(c)) > 2


def is_divided_number(c: Column) -> Column:
    last, frac = F.right(int_part(c), F.lit(1)), frac_part(c)
    return ((frac == "66") & (last == "6")) | ((frac == "34") & (last == "3"))


def is_weird_number(c: Column) -> Column:
    """Not divided, and not a whole number of thousands; a zero is weird too."""
    whole = int_part(c)
    return ~is_divided_number(c) & ~((F.length(whole) >= 3) & whole.endswith("000"))


def has_int_value(cells: Column) -> Column:
    """Any positive cell with an integer value."""
    return F.exists(
        F.transform(cells, lambda x: x.cast("double")), lambda d: (d > 0) & (d == F.rint(d))
    )


def is_fake_row(cells: Column) -> Column:
    return F.exists(cells, is_fake_number) & ~has_int_value(cells)


def round_to_long(c: Column) -> Column:
    """Half-even rounding of a numeric text or number."""
    return F.rint(c.cast("double")).cast("long")


def repair_value(c: Column) -> Column:
    """``struct(text, factor)``.

    Factor 1 for a whole number, 0 when nothing fits, otherwise the first factor whose rounded
    product is a non-zero number of thousands.
    """
    value, frac = c.cast("double"), frac_part(c)
    products = F.transform(
        F.array(*[F.lit(f) for f in REPAIR_FACTORS]),
        lambda f: F.struct(f.alias("factor"), F.rint(value * f).cast("long").alias("product")),
    )
    hit = F.get(
        F.filter(products, lambda p: (F.abs(p.product) >= 1000) & (p.product % 1000 == 0)), F.lit(0)
    )

    def out(text: Column, factor: Column) -> Column:
        return F.struct(text.alias("text"), factor.cast("int").alias("factor"))

    divided = let(
        hit,
        lambda h: F.when(
            h.isNotNull(), out(F.concat(h.product.cast("string"), F.lit(".0")), h.factor)
        ).otherwise(out(c, F.lit(0))),
    )
    return (
        F.when(~c.contains(".") | frac.isin("0", "00"), out(c, F.lit(1)))
        .when(F.length(frac) > 2, out(c, F.lit(0)))
        .otherwise(divided)
    )


def count_trailing_zeros(c: Column) -> Column:
    return F.length(F.regexp_extract(c, "(0*)$", 1))


def is_thousands(c: Column) -> Column:
    """Integer part longer than three digits and ending in 000."""
    whole = int_part(c)
    return (F.length(whole) > 3) & whole.endswith("000")
