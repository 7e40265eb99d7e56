"""Features of keyed entities from child rows whose file order counts."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lagloom.operators.lookup import lookup
from lagloom.session import cut_lineage



def count_over_union(parts: list[DataFrame], col: str, out: str) -> DataFrame:
    """Frequency of a value over all parts, attached to every row of all parts."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    counts = rows.groupBy(col).agg(F.count(F.lit(1)).alias(out))
    return lookup(rows, counts, col, measure=True)


def child_count(entities: DataFrame, children: DataFrame, out: str, on: str = "id") -> DataFrame:
    """Child rows per entity, 0 without any."""
    counts = children.groupBy(on).agg(F.count(F.lit(1)).alias(out))
    return entities.join(counts, on, "left").withColumn(out, F.coalesce(out, F.lit(0)))


def value_histogram(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def distinct_first_appearance(df: DataFrame, col: str, row_pos: str = "row_pos") -> DataFrame:
    """Distinct values with the position they first appear at."""
    return df.groupBy(col).agg(F.min(row_pos).alias("first_pos"))


def first_appearance_code(df: DataFrame, col: str, row_pos: str = "row_pos") -> DataFrame:
    """``(value, code)``: the ordinal, from 0, of each value by first appearance, for any number of values.

    The power of two that a small table would use as mask is ``2 ** code``.
    """
    return _numbered(distinct_first_appearance(df, col, row_pos), ["first_pos", col], "code").select(col, "code")


def bitmask_sum(
    children: DataFrame, codes: DataFrame, col: str, out: str, on: str = "id",
    values: list | None = None, distinct: bool = False,
) -> DataFrame:
    """The sum of ``2 ** code`` over an entity's children, written as ``[(code, n), ...]`` in the order of the codes.

    Repeated values add up, so n may be any number; with ``distinct`` only the codes are listed. In this form
    neither the number of codes nor that of repeats can overflow.
    """
    rows = children if values is None else children.where(F.col(col).isin(*values))
    counts = lookup(rows.select(on, col), codes, col, "inner").groupBy(on, "code").agg(F.count("*").alias("n"))
    term = F.col("code") if distinct else F.struct("code", "n")
    return counts.groupBy(on).agg(F.array_sort(F.collect_list(term)).alias(out))


def pivot_onehot(children: DataFrame, col: str, values: list, on: str = "id") -> DataFrame:
    """One 0/1 column per listed value."""
    return children.groupBy(on).agg(
        *[F.max(F.when(F.col(col) == v, 1).otherwise(0)).alias(str(v)) for v in values]
    )


def pivot_last_value(
    children: DataFrame, col: str, value: str, values: list, on: str = "id", row_pos: str = "row_pos"
) -> DataFrame:
    """One column per listed category holding the value of its last row, 0 without one."""
    last = children.groupBy(on, col).agg(F.max_by(value, row_pos).alias("_v"))
    return last.groupBy(on).agg(
        *[F.coalesce(F.max(F.when(F.col(col) == v, F.col("_v"))), F.lit(0)).alias(str(v)) for v in values]
    )


def pair_indicator(df: DataFrame, names: list[str], last: int = 4) -> DataFrame:
    """For each pair of the last entries of the list, 1 where both columns are positive.

    Pairs are named from the end of the list backwards.
    """
    pairs = combinations(reversed(names[-last:]), 2)
    return df.select(
        "*",
        *[
            F.when((F.col(f"`{a}`") > 0) & (F.col(f"`{b}`") > 0), 1).otherwise(0).alias(f"pair_{a}_{b}")
            for a, b in pairs
        ],
    )


def running_count_in_file_order(
    df: DataFrame, key: str, out: str = "appearance", row_pos: str = "row_pos", chunk: int = 1 << 20
) -> DataFrame:
    """How many rows of the same key stand at or before this row in the file.

    The file is cut into runs of ``chunk`` positions; rows are numbered inside ``(key, run)`` and
    the counts of the earlier runs are added. So the rows of one key, however many, are never
    sorted in one task; only their per-run counts are.
    """
    rows = df.withColumn("_run", F.floor(F.col(row_pos) / chunk))
    runs = rows.groupBy(key, "_run").agg(F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy(key).orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    offsets = runs.select(key, "_run", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy(key, "_run").orderBy(row_pos))
    return (
        rows.withColumn("_k", inside)
        .join(offsets, [key, "_run"])
        .withColumn(out, F.col("_k") + F.col("_before"))
        .drop("_run", "_k", "_before")
    )


def first_row_per_key(df: DataFrame, on: list[str], row_pos: str = "row_pos") -> DataFrame:
    return _edge_row(df, on, F.min_by, row_pos)


def last_row_per_key(df: DataFrame, on: list[str], row_pos: str = "row_pos") -> DataFrame:
    return _edge_row(df, on, F.max_by, row_pos)


def _edge_row(df: DataFrame, on: list[str], pick, row_pos: str) -> DataFrame:
    rest = [c for c in df.columns if c not in on]
    return df.groupBy(*on).agg(pick(F.struct(*rest), row_pos).alias("_row")).select(*on, "_row.*")


def _numbered(distinct: DataFrame, order: list[str], out: str) -> DataFrame:
    """Distinct rows with their position in ``order`` from 0.

    Rows are range-sorted over partitions and numbered inside each; the sizes of the earlier partitions are added from a
    table with one row per partition. The sorted rows are written out first, so both uses see the same bounds.
    """
    at = F.monotonically_increasing_id()
    ordered = cut_lineage(
        distinct.orderBy(*order).select("*", F.shiftright(at, 33).alias("_part"), at.bitwiseAND((1 << 33) - 1).alias("_k"))
    )
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # One row per partition of the sort, so bounded by spark.sql.shuffle.partitions.
    return ordered.join(F.broadcast(offsets), "_part").select(*distinct.columns, (F.col("_k") + F.col("_before")).alias(out))


def dense_codes(df: DataFrame, col: str, out: str = "code") -> DataFrame:
    """``(value, code)``: 0-based codes of the distinct values in sorted order."""
    return _numbered(df.select(col).where(F.col(col).isNotNull()).distinct(), [col], out)


def label_encode(parts: list[DataFrame], col: str, out: str) -> DataFrame:
    """Replace a text column by its code over all parts."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return lookup(rows, dense_codes(rows, col, out), col, measure=True)


def join_feature_tables(base: DataFrame, tables: list[DataFrame], on: str = "id") -> DataFrame:
    """Outer join of feature tables on one key, missing values 0.

    Stacking the tables and aggregating once needs one shuffle; a chain of full outer joins would
    shuffle the growing result again at every step.
    """
    rows = base.select(on)
    for t in tables:
        rows = rows.unionByName(t, allowMissingColumns=True)
    names = [c for c in rows.columns if c != on]
    return rows.groupBy(on).agg(
        *[F.coalesce(F.first(c, ignorenulls=True), F.lit(0)).alias(c) for c in names]
    )


# --- row-wise label and assignment expressions ------------------------------------------------

def label_from_flags(df: DataFrame, a: str, b: str, a_wins: bool = False) -> Column:
    """1 for A, 2 for B, else 0; B wins when both hold. ``*_fixed`` columns are preferred."""
    def flag(name: str) -> Column:
        use = f"{a}_fixed" in df.columns
        return F.coalesce(F.col(f"{name}_fixed" if use else name), F.lit(False))

    if a_wins:
        return F.when(flag(a), 1).when(flag(b), 2).otherwise(0)
    return F.when(flag(b), 2).when(flag(a), 1).otherwise(0)


def one_hot(label: Column, classes: int = 3) -> list[Column]:
    return [(label == k).cast("int") for k in range(classes)]


def neither_flag(a: Column, b: Column) -> Column:
    return F.lit(1) - (a.cast("int") + b.cast("int"))


def binary_targets(label: Column) -> tuple[Column, Column]:
    """Stage labels: is it positive; and, of the positive ones, is it 1 (NULL elsewhere)."""
    return (label > 0).cast("int"), F.when(label > 0, (label == 1).cast("int"))


def mask_assign(old: Column, mask: Column, new: Column) -> Column:
    return F.when(mask, new).otherwise(old)


def tidy_names(df: DataFrame) -> DataFrame:
    """Lower-case column names with '-' as '_'."""
    return df.withColumnsRenamed({c: c.lower().replace("-", "_") for c in df.columns})
