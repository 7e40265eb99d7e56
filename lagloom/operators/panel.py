"""Wide panels: a fixed number of groups, each an ordered run of positions, as nested arrays.

All statistics are expressions over the row's arrays, so they need no shuffle. Those with several
values return one struct, whose shared parts are computed once; ``spread`` turns it into columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagloom.functions import arrays as A
from lagloom.functions import numbers as N
from lagloom.operators.lookup import lookup
from lagloom.session import cut_lineage, widen

DIGIT_POSITIONS = 7


def assemble_panel(cells: DataFrame, groups: int, positions: int) -> DataFrame:
    """``(id, grp, pos, value)`` with unique positions -> ``(id, series)``, zeros where absent.

    A row gathers at most ``groups * positions`` cells, whatever the size of the input.
    """
    # Grouping gathers cells anyway, so this is its only shuffle.
    packed = widen(cells, "id").groupBy("id").agg(
        F.collect_list(F.struct("grp", "pos", "value")).alias("_cells")
    )
    by_group = F.transform(
        F.sequence(F.lit(0), F.lit(groups - 1)),
        lambda g: F.map_from_entries(
            F.transform(
                F.filter("_cells", lambda c: c.grp == g),
                lambda c: F.struct(c.pos.cast("int"), c.value),
            )
        ),
    )
    return packed.select("id", by_group.alias("_groups")).select(
        "id",
        F.transform(
            "_groups",
            lambda m: F.transform(
                F.sequence(F.lit(0), F.lit(positions - 1)),
                lambda p: F.coalesce(F.try_element_at(m, p), F.lit(0).cast("long")),
            ),
        ).alias("series"),
    )


def spread(df: DataFrame, keep: list[str], stats: Column) -> DataFrame:
    """``keep`` and the fields of a struct expression as columns."""
    return df.select(*keep, stats.alias("_stats")).select(*keep, "_stats.*")


def _struct(**fields: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def panel_from_columns(df: DataFrame, columns: list[list[str]], keep: list[str]) -> DataFrame:
    """A wide table -> nested arrays, by the ordered column names of each group."""
    return df.select(*keep, F.array(*[F.array(*names) for names in columns]).alias("series"))


def unpivot_panel(df: DataFrame, keep: list[str], series: str = "series") -> DataFrame:
    """One row per cell: ``keep..., grp, pos, value``."""
    return df.select(*keep, F.posexplode(series).alias("grp", "_row")).select(
        *keep, "grp", F.posexplode("_row").alias("pos", "value")
    )


def basic_stats(values: Column) -> Column:
    return A.let(
        values,
        lambda a: A.let(
            A.nonzero(a),
            lambda nz: _struct(
                nz_mean=A.mean(nz), nz_max=F.array_max(nz), nz_min=F.array_min(nz),
                ez=F.size(a) - F.size(nz),
                mean=A.mean(a), max=F.array_max(a), min=F.array_min(a),
            ),
        ),
    )


def group_stats(series: Column) -> Column:
    """Array of ``struct(nz_mean, ez)``, one per group."""
    return F.transform(
        series,
        lambda g: A.let(
            A.nonzero(g), lambda nz: _struct(nz_mean=A.mean(nz), ez=F.size(g) - F.size(nz))
        ),
    )


def day_stats(series: Column, axis: str = "pos") -> Column:
    """``axis="pos"``: the same statistics per position over the groups.

    ``axis="grp"`` gives the group's own values under the position's name.
    """
    if axis == "grp":
        return group_stats(series)
    by_position = F.transform(
        F.get(series, F.lit(0)), lambda _, p: F.transform(series, lambda g: F.get(g, p))
    )
    return group_stats(by_position)


def full_stats(values: Column) -> Column:
    def both(a: Column, nz: Column) -> Column:
        return A.let(
            F.array(A.variance(a), A.variance(nz)),
            lambda v: _struct(
                full_sum=A.total(a), full_var=F.get(v, F.lit(0)), full_nzvar=F.get(v, F.lit(1)),
                full_median=A.median(a), full_mean=A.mean(a), full_nzmean=A.mean(nz),
                full_std=F.sqrt(F.get(v, F.lit(0))), full_nzstd=F.sqrt(F.get(v, F.lit(1))),
            ),
        )

    return A.let(values, lambda a: A.let(A.nonzero(a), lambda nz: both(a, nz)))


def order_stats(group: Column) -> Column:
    """The group's values in ascending order."""
    return F.array_sort(group)


def log_stats(group: Column) -> Column:
    return A.let(
        A.nonzero(group),
        lambda nz: _struct(
            nz_mean_log=F.log1p(A.mean(nz)),
            nz_log_mean=A.mean(F.transform(nz, lambda x: F.log1p(x.cast("double")))),
            nz_median_log=F.log1p(A.median(nz)),
        ),
    )


def number_stats(cells: Column) -> Column:
    """Counts over an array of cell texts; the largest frequency of an empty set is 0."""
    def counts(all_cells: Column, nz: Column, distinct: Column) -> Column:
        frequency = F.array_max(
            F.transform(distinct, lambda v: F.size(F.filter(nz, lambda x: x == v)))
        )
        divided = F.filter(all_cells, lambda x: N.is_divided_number(x) | N.is_weird_number(x))
        return A.let(
            F.size(F.filter(nz, N.is_fake_number)),
            lambda fake: _struct(
                cnt_nz=F.size(nz), len_nz=F.size(distinct),
                cnt_mode_nz=F.coalesce(frequency, F.lit(0)),
                cnt_div=F.size(divided), cnt_fake=fake, cnt_norm=F.size(nz) - fake,
            ),
        )

    return A.let(
        cells,
        lambda a: A.let(
            F.filter(a, N.is_nonzero),
            lambda nz: A.let(F.array_distinct(nz), lambda distinct: counts(a, nz, distinct)),
        ),
    )


def digit_histogram(cells: Column) -> Column:
    """``[position][digit]`` counts over the cells that are whole thousands, from the right."""
    keys = F.flatten(
        F.transform(
            F.filter(cells, N.is_thousands),
            lambda c: F.transform(
                F.split(F.reverse(F.regexp_replace(N.int_part(c), "000$", "")), ""),
                lambda ch, p: p * 10 + ch.cast("int"),
            ),
        )
    )
    return A.let(
        keys,
        lambda a: F.transform(
            F.sequence(F.lit(0), F.lit(DIGIT_POSITIONS - 1)),
            lambda p: F.transform(
                F.sequence(F.lit(0), F.lit(9)),
                lambda d: F.size(F.filter(a, lambda k: k == p * 10 + d)),
            ),
        ),
    )


def digit_numbers(histogram: Column) -> Column:
    """Base-10 compositions of the histogram, the first position weighing 1000."""
    def compose(score) -> Column:
        parts = F.transform(histogram, lambda row, p: score(row) * F.pow(F.lit(10.0), p + 3))
        return F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)

    return _struct(
        dig_mode=compose(A.argmax), dig_mean=compose(A.mean),
        dig_nz=compose(lambda row: F.size(A.nonzero(row))),
    )


def repair_cells(cells: Column) -> Column:
    """Array of ``struct(text, factor)``."""
    return F.transform(cells, N.repair_value)


def repair_histogram(repaired: Column) -> Column:
    """Per row count of each repair factor."""
    factors = F.filter(F.transform(repaired, lambda r: r.factor), lambda f: f > 1)
    return A.let(
        factors,
        lambda a: _struct(
            **{f"rep_factor_{k}": F.size(F.filter(a, lambda f: f == k)) for k in N.REPAIR_FACTORS}
        ),
    )


def repaired_group_mean(groups: Column, wanted: list[int]) -> dict[str, Column]:
    """Non-zero mean of the repaired values of the wanted groups of an array of cell arrays."""
    def values(g: int) -> Column:
        return F.transform(F.get(groups, F.lit(g)), lambda c: N.repair_value(c).text.cast("double"))

    return {f"rep_gr{g}_nz_mean": A.mean(A.nonzero(values(g))) for g in wanted}


def special_value_counts(cells: Column, values: tuple[int, ...] = N.SPECIAL_VALUES) -> Column:
    wanted = [str(v) for v in values]
    return A.let(
        F.filter(F.transform(cells, N.int_part), lambda x: x.isin(*wanted)),
        lambda a: _struct(
            **{f"v{v}_cnt": F.size(F.filter(a, lambda x: x == v)) for v in wanted}
        ),
    )


def string_stats(cells: Column) -> Column:
    """Statistics of the integer parts ending in at least three zeros; 0 where there is none."""
    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    def digits(round_ones: Column) -> Column:
        text = F.regexp_replace(F.array_join(round_ones, ""), "[^1-9]", "")
        return F.transform(
            F.filter(F.split(text, ""), lambda x: x != ""), lambda x: x.cast("int")
        )

    def stats(whole: Column, round_ones: Column) -> Column:
        n = F.size(round_ones).cast("double")
        return A.let(
            digits(round_ones),
            lambda dig: _struct(
                str_zeros_mean=ratio(A.total(F.transform(round_ones, N.count_trailing_zeros)), n),
                str_len_mean=ratio(A.total(F.transform(whole, F.length)), F.size(whole).cast("double")),
                spec_mean=ratio(A.total(F.transform(round_ones, lambda x: x.cast("double"))), n),
                str_nz_mean=ratio(A.total(dig), F.size(dig).cast("double")),
                str_nz_mean_full=ratio(A.total(dig), n),
            ),
        )

    return A.let(
        F.transform(cells, N.int_part),
        lambda whole: A.let(
            F.filter(whole, lambda x: x.endswith("000")), lambda round_ones: stats(whole, round_ones)
        ),
    )


def share_of_total(series: Column, group: int, reference: list[int]) -> Column:
    """Per position, the group's value over the sum of the reference groups; -1 when that is 0."""
    def at(g: int, p: Column) -> Column:
        return F.get(F.get(series, F.lit(g)), p).cast("double")

    def share(p: Column) -> Column:
        denominator = sum((at(g, p) for g in reference[1:]), at(reference[0], p))
        return F.coalesce(F.try_divide(at(group, p), denominator), F.lit(-1.0))

    return F.transform(F.get(series, F.lit(group)), lambda _, p: share(p))


def first_three_nonzero(values: Column) -> Column:
    """log1p of the first three positive values (0 if missing) and the gaps before them (-1)."""
    hits = F.filter(
        F.transform(values, lambda v, i: F.struct(i.alias("i"), v.cast("double").alias("v"))),
        lambda z: z.v > 0,
    )

    def fields(h: Column) -> Column:
        z = [F.get(h, F.lit(k)) for k in range(3)]
        value = [F.coalesce(F.log1p(x.v), F.lit(0.0)) for x in z]
        gap = [z[0].i, z[1].i - z[0].i - 1, z[2].i - z[1].i - 1]
        gap = [F.coalesce(g, F.lit(-1)) for g in gap]
        return _struct(
            prev_value=value[0], prev2_value=value[1], prev3_value=value[2],
            time_delta=gap[0], time2_delta=gap[1], time3_delta=gap[2],
        )

    return A.let(hits, fields)


# --- jobs over cells -------------------------------------------------------------------------

def value_target_mean(panel: DataFrame, min_support: int = 10, out_of_fold: bool = False) -> DataFrame:
    """Score of a row from the targets of the rows sharing its cell values.

    ``panel``: ``id, target, is_fake, series``. Fake rows are left out; a row's own target counts
    too unless ``out_of_fold``. Values are aggregated on the map side, so a value held by a third
    of the cells stays one row per task.
    """
    rows = panel.where(~F.col("is_fake"))
    cells = rows.select(
        "id", "target",
        F.explode_outer(F.filter(F.flatten("series"), lambda v: v > 0)).alias("value"),
    )
    table = (
        cells.where((F.col("target") > 0) & F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.sum("target").alias("s"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_support)
    )
    own = F.when(F.col("target") > 0, 1).otherwise(0) if out_of_fold else F.lit(0)
    scored = lookup(cells, table, "value", measure=True).select(
        "id",
        (F.col("s") - F.col("target") * own).alias("s"),
        (F.col("n") - own).alias("n"),
    )
    return scored.groupBy("id").agg(
        (F.coalesce(F.sum("s"), F.lit(0)) / (F.coalesce(F.sum("n"), F.lit(0)) + 0.000001)).alias(
            "simple_predict"
        )
    )


def select_columns_by_data(
    panel: DataFrame, min_equal: int = 30, min_close: int = 3500, close: float = 0.05, absolute: bool = False
) -> DataFrame:
    """Columns ``(grp, pos)`` equal to the target, or close to it, in more than so many rows."""
    diff = F.try_divide((F.col("value") - F.col("target")).cast("double"), F.col("target").cast("double"))
    diff = F.abs(diff) if absolute else diff
    return (
        unpivot_panel(panel, ["target"])
        .groupBy("grp", "pos")
        .agg(
            F.count_if(F.col("value") == F.col("target")).alias("n_equal"),
            F.count_if(diff < close).alias("n_close"),
        )
        .where((F.col("n_equal") > min_equal) & (F.col("n_close") > min_close))
    )


def stats_over_selected(panel: DataFrame, columns: DataFrame) -> DataFrame:
    """``basic_stats`` over the selected columns only, one row per id.

    The column list has at most one row per column of the panel. It is written out, so the planner
    knows whether to send it to every task and leave the cells in place until they are combined per row.
    """
    v, nz = F.col("value"), F.col("value") != 0
    return (
        unpivot_panel(panel, ["id"])
        .join(cut_lineage(columns.select("grp", "pos")), ["grp", "pos"])
        .groupBy("id")
        .agg(
            F.avg(F.when(nz, v)).alias("nz_mean"), F.max(F.when(nz, v)).alias("nz_max"),
            F.min(F.when(nz, v)).alias("nz_min"), F.count_if(~nz).alias("ez"),
            F.avg(v).alias("mean"), F.max(v).alias("max"), F.min(v).alias("min"),
        )
    )


def select_features_by_weight(
    features: DataFrame, weights: DataFrame, threshold: float = 0.0007
) -> DataFrame:
    """Long features ``(id, feature, value)`` without those weighing less than the threshold.

    The list of names to drop is written out, so the planner knows its size and sends it to every task
    only if it is small.
    """
    low = cut_lineage(weights.where(F.col("weight") < threshold).select("feature"))
    return features.join(low, "feature", "left_anti")


def ordered_columns(columns: DataFrame, grouped: DataFrame) -> DataFrame:
    """Sort key per column: grouped columns first in group order, the rest in their own order.

    ``columns``: ``(col, ord)``; ``grouped``: ``(grp, pos, col)``.
    """
    first = grouped.select("col", F.lit(0).alias("section"), "grp", "pos")
    rest = columns.join(grouped, "col", "left_anti").select(
        "col", F.lit(1).alias("section"), F.lit(0).alias("grp"), F.col("ord").alias("pos")
    )
    return first.unionByName(rest)
