"""Queries over the panel inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagloom.functions import arrays as A
from lagloom.functions import numbers as N
from lagloom.operators import lag as L
from lagloom.operators import panel as P
from lagloom.operators.lookup import lookup
from lagloom.plans import fixtures as X
from lagloom.plans.registry import query
from lagloom.session import cut_lineage, widen

GROUPS, POSITIONS = X.GROUPS, X.POSITIONS
SIX = [0, 1, 2, 4, 5, 7]


def r6(c: Column) -> Column:
    return F.round(c.cast("double"), 6)


def rounded(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in cols})


def group(g: int) -> Column:
    return F.get("series", F.lit(g))


# --- horizontal statistics ----------------------------------------------------------------------

_BASIC = """
    round(avg(value) FILTER (value <> 0), 6) AS nz_mean, CAST(max(value) FILTER (value <> 0) AS DOUBLE) AS nz_max,
    CAST(min(value) FILTER (value <> 0) AS DOUBLE) AS nz_min, count(*) FILTER (value = 0) AS ez,
    round(avg(value), 6) AS mean, CAST(max(value) AS DOUBLE) AS max, CAST(min(value) AS DOUBLE) AS min"""


@query("panel_basic_stats", f"SELECT id, {_BASIC} FROM dense WHERE grp = 0 GROUP BY id")
def panel_basic_stats(spark, d):
    stats = P.spread(X.panel(spark, d), ["id"], P.basic_stats(group(0)))
    return rounded(stats, ["nz_mean", "nz_max", "nz_min", "mean", "max", "min"])


@query(
    "panel_group_stats",
    """SELECT id, grp, round(avg(value) FILTER (value <> 0), 6) AS nz_mean,
              CAST(count(*) FILTER (value = 0) AS INT) AS ez
       FROM dense WHERE grp > 0 GROUP BY id, grp""",
)
def panel_group_stats(spark, d):
    return (
        X.panel(spark, d)
        .select("id", F.posexplode(P.group_stats(F.col("series"))).alias("grp", "s"))
        .where("grp > 0")
        .select("id", "grp", r6(F.col("s.nz_mean")).alias("nz_mean"), "s.ez")
    )


@query(
    "panel_day_stats",
    """SELECT id, pos, round(avg(value) FILTER (value <> 0), 6) AS nz_mean,
              CAST(count(*) FILTER (value = 0) AS INT) AS ez
       FROM dense GROUP BY id, pos""",
)
def panel_day_stats(spark, d):
    return X.panel(spark, d).select(
        "id", F.posexplode(P.day_stats(F.col("series"))).alias("pos", "s")
    ).select("id", "pos", r6(F.col("s.nz_mean")).alias("nz_mean"), "s.ez")


@query(
    "panel_full_stats",
    """SELECT id, CAST(sum(value) AS DOUBLE) AS full_sum, round(var_samp(value), 3) AS full_var,
              round(var_samp(value) FILTER (value <> 0), 3) AS full_nzvar, median(value) AS full_median,
              round(avg(value), 6) AS full_mean, round(avg(value) FILTER (value <> 0), 6) AS full_nzmean,
              round(stddev_samp(value), 6) AS full_std,
              round(stddev_samp(value) FILTER (value <> 0), 6) AS full_nzstd
       FROM dense GROUP BY id""",
)
def panel_full_stats(spark, d):
    stats = P.spread(X.panel(spark, d), ["id"], P.full_stats(F.flatten("series")))
    variances = ["full_var", "full_nzvar"]
    others = [c for c in stats.columns if c not in ("id", *variances)]
    return rounded(rounded(stats, variances, 3), others)


@query(
    "panel_order_stats",
    f"""SELECT id, grp, CAST(o AS INT) AS o, value FROM (
            SELECT id, grp, row_number() OVER (PARTITION BY id, grp ORDER BY value) - 1 AS o, value
            FROM dense WHERE grp IN ({', '.join(map(str, SIX))}))""",
)
def panel_order_stats(spark, d):
    ordered = F.transform(
        F.array(*[F.struct(F.lit(g).alias("grp"), P.order_stats(group(g)).alias("v")) for g in SIX]),
        lambda s: s,
    )
    return (
        X.panel(spark, d)
        .select("id", F.inline(ordered))
        .select("id", "grp", F.posexplode("v").alias("o", "value"))
    )


@query(
    "panel_log_stats",
    f"""SELECT id, grp, round(ln(1 + avg(value) FILTER (value <> 0)), 6) AS nz_mean_log,
               round(avg(ln(1 + value)) FILTER (value <> 0), 6) AS nz_log_mean,
               round(ln(1 + median(value) FILTER (value <> 0)), 6) AS nz_median_log
        FROM dense WHERE grp IN ({', '.join(map(str, SIX))}) GROUP BY id, grp""",
)
def panel_log_stats(spark, d):
    rows = F.array(*[F.struct(F.lit(g).alias("grp"), P.log_stats(group(g)).alias("s")) for g in SIX])
    stats = X.panel(spark, d).select("id", F.inline(rows)).select("id", "grp", "s.*")
    return rounded(stats, ["nz_mean_log", "nz_log_mean", "nz_median_log"])


_NUMBER_FLAGS = """
    SELECT id, grp, txt, txt NOT IN ('0', '0.0') AS nz,
           (split_part(txt, '.', 2) = '66' AND right(split_part(txt, '.', 1), 1) = '6')
           OR (split_part(txt, '.', 2) = '34' AND right(split_part(txt, '.', 1), 1) = '3') AS divided,
           length(split_part(txt, '.', 2)) > 2 AS fake,
           length(split_part(txt, '.', 1)) >= 3 AND split_part(txt, '.', 1) LIKE '%000' AS thousands
    FROM text_cells"""
_NUMBER_STATS = """
    WITH f AS ({flags}),
    m AS (SELECT id, max(n) AS mode FROM (SELECT id, txt, count(*) AS n FROM f WHERE nz {group} GROUP BY id, txt) GROUP BY id)
    SELECT f.id, count(*) FILTER (nz) AS cnt_nz, count(DISTINCT txt) FILTER (nz) AS len_nz,
           coalesce(max(m.mode), 0) AS cnt_mode_nz,
           count(*) FILTER (divided OR NOT thousands) AS cnt_div, count(*) FILTER (fake) AS cnt_fake,
           count(*) FILTER (nz) - count(*) FILTER (fake) AS cnt_norm
    FROM f LEFT JOIN m ON m.id = f.id WHERE true {group} GROUP BY f.id"""


def _number_query(spark, d, cells: Column) -> DataFrame:
    return P.spread(X.text_panel(spark, d), ["id"], P.number_stats(cells))


@query("panel_number_stats", _NUMBER_STATS.format(flags=_NUMBER_FLAGS, group=""))
def panel_number_stats(spark, d):
    return _number_query(spark, d, F.flatten("cells"))


@query("panel_number_stats_group", _NUMBER_STATS.format(flags=_NUMBER_FLAGS, group="AND grp = 3"))
def panel_number_stats_group(spark, d):
    return _number_query(spark, d, F.get("cells", F.lit(3)))


_DIGITS = """
    SELECT id, CAST(pos AS INT) AS dpos, CAST(ch AS INT) AS digit, count(*) AS n FROM (
        SELECT id, generate_subscripts(chars, 1) - 1 AS pos, unnest(chars) AS ch FROM (
            SELECT id, list_reverse(string_split(left(w, length(w) - 3), '')) AS chars
            FROM (SELECT id, split_part(txt, '.', 1) AS w FROM text_cells)
            WHERE length(w) > 3 AND w LIKE '%000'))
    WHERE pos < 7 GROUP BY 1, 2, 3"""


@query(
    "panel_digit_histogram",
    f"""WITH h AS ({_DIGITS})
        SELECT i.id, CAST(p.range AS INT) AS dpos, CAST(g.range AS INT) AS digit, coalesce(h.n, 0) AS n
        FROM (SELECT DISTINCT id FROM cells) i CROSS JOIN range(7) p CROSS JOIN range(10) g
        LEFT JOIN h ON h.id = i.id AND h.dpos = p.range AND h.digit = g.range""",
)
def panel_digit_histogram(spark, d):
    return (
        X.text_panel(spark, d)
        .select("id", F.posexplode(P.digit_histogram(F.flatten("cells"))).alias("dpos", "h"))
        .select("id", "dpos", F.posexplode("h").alias("digit", "n"))
        .withColumn("n", F.col("n").cast("bigint"))
    )


@query(
    "panel_digit_numbers",
    f"""WITH h AS ({_DIGITS}),
        full_h AS (SELECT i.id, p.range AS dpos, g.range AS digit, coalesce(h.n, 0) AS n
              FROM (SELECT DISTINCT id FROM cells) i CROSS JOIN range(7) p CROSS JOIN range(10) g
              LEFT JOIN h ON h.id = i.id AND h.dpos = p.range AND h.digit = g.range),
        per_pos AS (SELECT id, dpos, arg_max(digit, n * 100 - digit) AS mode, avg(n) AS mean,
                           count(*) FILTER (n <> 0) AS nz FROM full_h GROUP BY id, dpos)
        SELECT id, sum(mode * pow(10.0, dpos + 3)) AS dig_mode, round(sum(mean * pow(10.0, dpos + 3)), 3) AS dig_mean,
               sum(nz * pow(10.0, dpos + 3)) AS dig_nz
        FROM per_pos GROUP BY id""",
)
def panel_digit_numbers(spark, d):
    hist = X.text_panel(spark, d).select("id", P.digit_histogram(F.flatten("cells")).alias("h"))
    return rounded(P.spread(hist, ["id"], P.digit_numbers(F.col("h"))), ["dig_mean"], 3)


_REPAIR = """
    SELECT id, grp, pos, txt,
           CASE WHEN NOT contains(txt, '.') OR split_part(txt, '.', 2) IN ('0', '00') THEN 1
                WHEN length(split_part(txt, '.', 2)) > 2 THEN 0
                ELSE coalesce(list_filter([3, 7, 9, 11, 13, 15, 17, 19, 31], lambda k:
                     abs(round_even(CAST(txt AS DOUBLE) * k, 0)) >= 1000
                     AND CAST(round_even(CAST(txt AS DOUBLE) * k, 0) AS BIGINT) % 1000 = 0)[1], 0) END AS factor
    FROM text_cells"""
_REPAIRED = f"""
    SELECT *, CASE WHEN factor > 1 THEN
                  CAST(CAST(round_even(CAST(txt AS DOUBLE) * factor, 0) AS BIGINT) AS VARCHAR) || '.0' ELSE txt END AS fixed
    FROM ({_REPAIR})"""


@query("panel_repair_values", f"SELECT id, grp, pos, fixed, CAST(factor AS INT) AS factor FROM ({_REPAIRED})")
def panel_repair_values(spark, d):
    return (
        X.text_panel(spark, d)
        .select("id", F.posexplode("cells").alias("grp", "c"))
        .select("id", "grp", F.posexplode(P.repair_cells(F.col("c"))).alias("pos", "r"))
        .select("id", "grp", "pos", F.col("r.text").alias("fixed"), "r.factor")
    )


@query(
    "panel_repair_histogram",
    "SELECT id, " + ", ".join(f"count(*) FILTER (factor = {k}) AS rep_factor_{k}" for k in N.REPAIR_FACTORS)
    + f" FROM ({_REPAIR}) GROUP BY id",
)
def panel_repair_histogram(spark, d):
    return P.spread(
        X.text_panel(spark, d), ["id"], P.repair_histogram(P.repair_cells(F.flatten("cells")))
    )


@query("repair_factor_totals", f"SELECT CAST(factor AS INT) AS factor, count(*) AS n FROM ({_REPAIR}) WHERE factor > 1 GROUP BY 1")
def repair_factor_totals(spark, d):
    return (
        X.text_panel(spark, d)
        .select(F.explode(P.repair_cells(F.flatten("cells"))).alias("r"))
        .where("r.factor > 1")
        .groupBy("r.factor")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "panel_repaired_group_mean",
    "SELECT id, " + ", ".join(
        f"round(avg(CAST(fixed AS DOUBLE)) FILTER (grp = {g} AND CAST(fixed AS DOUBLE) <> 0), 6) AS rep_gr{g}_nz_mean" for g in SIX
    ) + f" FROM ({_REPAIRED}) GROUP BY id",
)
def panel_repaired_group_mean(spark, d):
    return X.text_panel(spark, d).select(
        "id", *[r6(c).alias(n) for n, c in P.repaired_group_mean(F.col("cells"), SIX).items()]
    )


_SPECIAL = (1000, 2000, 5000, 10000, 11000, 20000, 30000, 40000, 41000, 45000, 50000)


@query(
    "panel_special_value_counts",
    "SELECT id, " + ", ".join(f"count(*) FILTER (split_part(txt, '.', 1) = '{v}') AS v{v}_cnt" for v in _SPECIAL)
    + " FROM text_cells GROUP BY id",
)
def panel_special_value_counts(spark, d):
    return P.spread(X.text_panel(spark, d), ["id"], P.special_value_counts(F.flatten("cells"), _SPECIAL))


@query(
    "panel_string_stats",
    """WITH w AS (SELECT id, split_part(txt, '.', 1) AS w FROM text_cells),
       t AS (SELECT id, length(w) AS len, length(regexp_extract(w, '(0*)$', 1)) AS tz, CAST(w AS BIGINT) AS val,
                    list_sum(list_transform(string_split(w, ''), lambda ch: CAST(ch AS INT))) AS dsum,
                    length(replace(w, '0', '')) AS dcnt FROM w),
       s AS (SELECT id, count(*) AS n_all, sum(len) AS lens, count(*) FILTER (tz >= 3) AS n,
                    coalesce(sum(tz) FILTER (tz >= 3), 0) AS zs, coalesce(sum(val) FILTER (tz >= 3), 0) AS vs,
                    coalesce(sum(dsum) FILTER (tz >= 3), 0) AS ds, coalesce(sum(dcnt) FILTER (tz >= 3), 0) AS dc
             FROM t GROUP BY id)
       SELECT id, round(CASE WHEN n > 0 THEN zs / n ELSE 0 END, 6) AS str_zeros_mean,
              round(lens / n_all, 6) AS str_len_mean, round(CASE WHEN n > 0 THEN vs / n ELSE 0 END, 6) AS spec_mean,
              round(CASE WHEN dc > 0 THEN ds / dc ELSE 0 END, 6) AS str_nz_mean,
              round(CASE WHEN n > 0 THEN ds / n ELSE 0 END, 6) AS str_nz_mean_full
       FROM s""",
)
def panel_string_stats(spark, d):
    stats = P.spread(X.text_panel(spark, d), ["id"], P.string_stats(F.flatten("cells")))
    return rounded(stats, [c for c in stats.columns if c != "id"])


@query(
    "panel_share_of_total",
    """SELECT id, pos, round(CASE WHEN s = 0 THEN -1 ELSE v0 / s END, 6) AS f0, round(CASE WHEN s = 0 THEN -1 ELSE v3 / s END, 6) AS f3
       FROM (SELECT id, pos, sum(value) FILTER (grp BETWEEN 1 AND 6) AS s, sum(value) FILTER (grp = 0) AS v0,
                    sum(value) FILTER (grp = 3) AS v3 FROM dense GROUP BY id, pos)""",
)
def panel_share_of_total(spark, d):
    refs = [1, 2, 3, 4, 5, 6]
    shares = F.arrays_zip(
        P.share_of_total(F.col("series"), 0, refs).alias("f0"), P.share_of_total(F.col("series"), 3, refs).alias("f3")
    )
    return (
        X.panel(spark, d)
        .select("id", F.posexplode(shares).alias("pos", "s"))
        .select("id", "pos", r6(F.col("s").getField("f0")).alias("f0"), r6(F.col("s").getField("f3")).alias("f3"))
    )


@query(
    "panel_first_three_nonzero",
    f"""WITH h AS (SELECT id, grp, list(struct_pack(i := pos, v := value) ORDER BY pos) FILTER (value > 0) AS z FROM dense
                  WHERE grp IN ({', '.join(map(str, SIX))}) GROUP BY id, grp)
       SELECT id, grp, round(coalesce(ln(1 + z[1].v), 0), 6) AS prev_value, round(coalesce(ln(1 + z[2].v), 0), 6) AS prev2_value,
              round(coalesce(ln(1 + z[3].v), 0), 6) AS prev3_value, coalesce(z[1].i, -1) AS time_delta,
              coalesce(z[2].i - z[1].i - 1, -1) AS time2_delta, coalesce(z[3].i - z[2].i - 1, -1) AS time3_delta
       FROM h""",
)
def panel_first_three_nonzero(spark, d):
    rows = F.array(
        *[F.struct(F.lit(g).alias("grp"), P.first_three_nonzero(group(g)).alias("s")) for g in SIX]
    )
    stats = X.panel(spark, d).select("id", F.inline(rows)).select("id", "grp", "s.*")
    return rounded(stats, ["prev_value", "prev2_value", "prev3_value"])


@query(
    "panel_min_max_span",
    "SELECT doc_id, least(a_off, p_off, b_off) AS section_min, greatest(a_off, p_off, b_off) AS section_max FROM spans",
)
def panel_min_max_span(spark, d):
    offs = ["a_off", "p_off", "b_off"]
    return X.spans(spark, d).select(
        "doc_id", F.least(*offs).alias("section_min"), F.greatest(*offs).alias("section_max")
    )


@query(
    "change_count",
    """SELECT id, grp, count(*) FILTER (value > 0 AND value <> prev) AS n FROM (
           SELECT id, grp, value, lag(value, 1, -1) OVER (PARTITION BY id, grp ORDER BY pos) AS prev FROM dense)
       GROUP BY id, grp""",
)
def change_count(spark, d):
    return X.panel(spark, d).select("id", F.posexplode("series").alias("grp", "v")).select(
        "id", "grp", A.count_changes(F.col("v")).cast("bigint").alias("n")
    )


@query(
    "gap_between_nonzero",
    """SELECT id, grp, pos, pos - prev AS gap FROM (
           SELECT id, grp, pos, lag(pos) OVER (PARTITION BY id, grp ORDER BY pos) AS prev FROM cells)
       WHERE prev IS NOT NULL""",
)
def gap_between_nonzero(spark, d):
    at = F.filter(F.transform("v", lambda v, i: F.when(v != 0, i)), lambda i: i.isNotNull())
    rows = X.panel(spark, d).select("id", F.posexplode("series").alias("grp", "v"))
    pairs = F.arrays_zip(F.slice("at", 2, POSITIONS).alias("pos"), A.nonzero_gaps(F.col("v")).alias("gap"))
    return rows.withColumn("at", at).select("id", "grp", F.inline(pairs).alias("pos", "gap"))


@query(
    "argmax_per_row",
    """SELECT id, grp, CAST(arg_max(pos, value * 100 - pos) AS INT) AS best FROM dense GROUP BY id, grp""",
)
def argmax_per_row(spark, d):
    return X.panel(spark, d).select("id", F.posexplode("series").alias("grp", "v")).select(
        "id", "grp", A.argmax(F.col("v")).alias("best")
    )


# --- number-text scalars --------------------------------------------------------------------------

def _flag_query(name: str, flag, sql: str) -> None:
    @query(name, f"SELECT id, count(*) FILTER ({sql}) AS n FROM text_cells GROUP BY id")
    def run(spark, d):
        hits = F.filter(F.flatten("cells"), flag)
        return X.text_panel(spark, d).select("id", F.size(hits).cast("bigint").alias("n"))


_DIV = """((split_part(txt, '.', 2) = '66' AND right(split_part(txt, '.', 1), 1) = '6')
          OR (split_part(txt, '.', 2) = '34' AND right(split_part(txt, '.', 1), 1) = '3'))"""
_flag_query("is_zero", N.is_zero, "txt IN ('0', '0.0')")
_flag_query("is_nonzero", N.is_nonzero, "txt NOT IN ('0', '0.0')")
_flag_query("is_fake_number", N.is_fake_number, "length(split_part(txt, '.', 2)) > 2")
_flag_query("is_divided_number", N.is_divided_number, _DIV)
_flag_query(
    "is_weird_number", N.is_weird_number,
    f"NOT {_DIV} AND (length(split_part(txt, '.', 1)) < 3 OR right(split_part(txt, '.', 1), 3) <> '000')",
)
_flag_query(
    "compare_numeric_text", lambda c: N.compare_numeric_text(c, N.int_part(c)),
    "txt = split_part(txt, '.', 1) OR txt = split_part(txt, '.', 1) || '.0'",
)


def _sum_query(name: str, value, sql: str) -> None:
    @query(name, f"SELECT id, round(sum({sql}), 4) AS n FROM text_cells GROUP BY id")
    def run(spark, d):
        values = F.transform(F.flatten("cells"), lambda c: value(c).cast("double"))
        return X.text_panel(spark, d).select("id", F.round(A.total(values), 4).alias("n"))


_sum_query("count_trailing_zeros", N.count_trailing_zeros, "CAST(length(regexp_extract(txt, '(0*)$', 1)) AS DOUBLE)")
_sum_query("round_to_long", N.round_to_long, "CAST(CAST(round_even(CAST(txt AS DOUBLE), 0) AS BIGINT) AS DOUBLE)")
_sum_query("log1p", lambda c: F.log1p(c.cast("double")), "ln(1 + CAST(txt AS DOUBLE))")
_sum_query("expm1", lambda c: F.expm1(c.cast("double") / 10000.0), "exp(CAST(txt AS DOUBLE) / 10000.0) - 1")


def _row_flag_query(name: str, flag, sql: str) -> None:
    @query(name, f"SELECT id, {sql} AS flag FROM text_cells GROUP BY id")
    def run(spark, d):
        return X.text_panel(spark, d).select("id", flag(F.flatten("cells")).alias("flag"))


_INT = "coalesce(bool_or(CAST(txt AS DOUBLE) > 0 AND CAST(txt AS DOUBLE) = round_even(CAST(txt AS DOUBLE), 0)), false)"
_row_flag_query("has_int_value", N.has_int_value, _INT)
_row_flag_query("is_fake_row", N.is_fake_row, f"bool_or(length(split_part(txt, '.', 2)) > 2) AND NOT {_INT}")


@query(
    "repair_value",
    f"SELECT txt, any_value(fixed) AS fixed, CAST(any_value(factor) AS INT) AS factor FROM ({_REPAIRED}) GROUP BY txt",
)
def repair_value(spark, d):
    texts = X.text_panel(spark, d).select(F.explode(F.flatten("cells")).alias("txt")).distinct()
    return texts.select("txt", N.repair_value(F.col("txt")).alias("r")).select(
        "txt", F.col("r.text").alias("fixed"), "r.factor"
    )


@query(
    "drop_fake_rows",
    f"""SELECT id, CAST(sum(value) AS BIGINT) AS total FROM text_cells GROUP BY id
        HAVING NOT (bool_or(length(split_part(txt, '.', 2)) > 2) AND NOT {_INT})""",
)
def drop_fake_rows(spark, d):
    kept = X.text_panel(spark, d).where(~N.is_fake_row(F.flatten("cells")))
    return kept.select("id", A.total(F.flatten("series")).cast("bigint").alias("total"))


# --- jobs over cells ------------------------------------------------------------------------------

_VALUE_TABLE = """
    t AS (SELECT c.value, sum(p.target) AS s, count(*) AS n
          FROM cells c JOIN panel_target p ON p.id = c.id WHERE c.id % 13 <> 0 AND p.target > 0
          GROUP BY c.value HAVING count(*) >= 10)"""


@query(
    "value_target_mean",
    f"""WITH {_VALUE_TABLE}
        SELECT c.id, round(coalesce(sum(t.s), 0) / (coalesce(sum(t.n), 0) + 0.000001), 4) AS simple_predict
        FROM cells c LEFT JOIN t ON t.value = c.value WHERE c.id % 13 <> 0 GROUP BY c.id""",
)
def value_target_mean(spark, d):
    scored = P.value_target_mean(X.panel(spark, d))
    return scored.select("id", F.round("simple_predict", 4).alias("simple_predict"))


@query(
    "join_value_dictionary",
    f"""WITH {_VALUE_TABLE}
        SELECT c.id, count(t.n) AS hits, CAST(coalesce(sum(t.n), 0) AS BIGINT) AS support
        FROM cells c LEFT JOIN t ON t.value = c.value GROUP BY c.id""",
)
def join_value_dictionary(spark, d):
    panel = X.panel(spark, d)
    cells = X.cells(spark, d)
    table = (
        panel.where(~F.col("is_fake") & (F.col("target") > 0))
        .select(F.explode(A.nonzero(F.flatten("series"))).alias("value"))
        .groupBy("value").agg(F.count(F.lit(1)).alias("n")).where("n >= 10")
    )
    return lookup(cells, table, "value", measure=True).groupBy("id").agg(
        F.count("n").alias("hits"), F.coalesce(F.sum("n"), F.lit(0)).alias("support")
    )


_COLUMN_TEST = """
    SELECT grp, pos, count(*) FILTER (value = target) AS n_equal,
           count(*) FILTER ((value - target) / target < 0.05) AS n_close
    FROM dense JOIN panel_target USING (id) WHERE id % 3 <> 0 GROUP BY grp, pos
    HAVING count(*) FILTER (value = target) > 2 AND count(*) FILTER ((value - target) / target < 0.05) > 100"""


def _selected(spark, d) -> DataFrame:
    return P.select_columns_by_data(X.panel(spark, d).where("is_train"), min_equal=2, min_close=100)


@query("select_columns_by_data", _COLUMN_TEST)
def select_columns_by_data(spark, d):
    return _selected(spark, d)


@query(
    "panel_stats_selected_columns",
    f"""WITH chosen AS ({_COLUMN_TEST}) SELECT id, {_BASIC} FROM dense JOIN chosen USING (grp, pos) GROUP BY id""",
)
def panel_stats_selected_columns(spark, d):
    stats = P.stats_over_selected(X.panel(spark, d), _selected(spark, d))
    return stats.select("id", *[r6(F.col(c)).alias(c) if c != "ez" else "ez" for c in stats.columns if c != "id"])


@query(
    "column_set_difference",
    f"WITH chosen AS ({_COLUMN_TEST}) SELECT grp, pos FROM chosen WHERE grp <> 0",
)
def column_set_difference(spark, d):
    group_zero = X.cells(spark, d).where("grp = 0").select("grp", "pos").distinct()
    return _selected(spark, d).select("grp", "pos").join(group_zero, ["grp", "pos"], "left_anti")


def _weights(spark, d) -> DataFrame:
    """Each column's thousands in per mille of a fixed base, exact in binary."""
    return X.cells(spark, d).groupBy("grp", "pos").agg((F.sum("value") / 1048576.0).alias("weight")).select(
        F.concat(F.lit("g"), "grp", F.lit("_p"), "pos").alias("feature"), "weight"
    )


_WEIGHTS = "SELECT 'g' || grp || '_p' || pos AS feature, sum(value) / 1048576.0 AS weight FROM cells GROUP BY grp, pos"


@query(
    "select_features_by_weight",
    f"""WITH w AS ({_WEIGHTS})
        SELECT id, count(*) AS n, CAST(sum(value) AS BIGINT) AS total FROM cells
        WHERE 'g' || grp || '_p' || pos NOT IN (SELECT feature FROM w WHERE weight < 4.0) GROUP BY id""",
)
def select_features_by_weight(spark, d):
    features = X.cells(spark, d).select("id", F.concat(F.lit("g"), "grp", F.lit("_p"), "pos").alias("feature"), "value")
    kept = P.select_features_by_weight(features, _weights(spark, d), threshold=4.0)
    return kept.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query("top_weights", f"SELECT feature, weight FROM ({_WEIGHTS}) ORDER BY weight DESC, feature LIMIT 20")
def top_weights(spark, d):
    return _weights(spark, d).orderBy(F.desc("weight"), "feature").limit(20)


@query(
    "reorder_columns",
    """SELECT 'g' || grp || '_p' || pos AS col, CASE WHEN grp < 4 THEN 0 ELSE 1 END AS section,
              CASE WHEN grp < 4 THEN grp ELSE 0 END AS grp, CASE WHEN grp < 4 THEN pos ELSE grp * 40 + pos END AS pos
       FROM (SELECT DISTINCT grp, pos FROM cells)""",
)
def reorder_columns(spark, d):
    name = F.concat(F.lit("g"), "grp", F.lit("_p"), "pos")
    known = X.cells(spark, d).select("grp", "pos", name.alias("col")).distinct()
    columns = known.select("col", (F.col("grp") * POSITIONS + F.col("pos")).alias("ord"))
    return P.ordered_columns(columns, known.where("grp < 4"))


# --- lag matching -----------------------------------------------------------------------------------

_SHIFT_KEYS = f"""
    rows_all AS (SELECT id, is_train, is_fake, grp.range AS grp, series[1] AS first, series[grp.range + 1] AS v
                 FROM planted CROSS JOIN range({GROUPS}) grp),
    flags AS (SELECT *, list_transform(range(1, {POSITIONS + 1}), lambda i:
                  CASE WHEN v[i] > 0 AND v[i] <> coalesce(v[i - 1], -1) THEN 1 ELSE 0 END) AS ch FROM rows_all),
    keys AS (SELECT id, is_train, is_fake, grp, s.range AS shift, first[s.range - 1] AS t,
                    list_sum(ch[s.range + 1:{POSITIONS}]) AS suffix_nz, list_sum(ch[1:{POSITIONS} - s.range]) AS prefix_nz,
                    v[s.range + 1:{POSITIONS}] AS suffix, v[1:{POSITIONS} - s.range] AS prefix
             FROM flags CROSS JOIN range(2, {POSITIONS - 2}) s)"""
_FIRST_MATCH = f"""{_SHIFT_KEYS},
    used AS (SELECT * FROM keys WHERE is_train OR NOT is_fake),
    build AS (SELECT is_train, grp, shift, suffix AS k, arg_min(id, id) AS parent_id, arg_min(t, id) AS target,
                     arg_min(suffix_nz, id) AS nz
              FROM used WHERE suffix_nz >= 2 AND t > 0 GROUP BY is_train, grp, shift, suffix),
    matches AS (SELECT u.id AS child_id, b.parent_id, u.is_train, u.grp, u.shift, b.target, b.nz
                FROM used u JOIN build b ON b.is_train = u.is_train AND b.grp = u.grp AND b.shift = u.shift
                     AND b.k = u.prefix WHERE u.prefix_nz >= 2)"""
_BEST_MATCH = f"""{_FIRST_MATCH},
    best AS (SELECT child_id, is_train, arg_max(struct_pack(t := target, n := nz, g := grp, s := shift),
                    nz * 1000000 - shift * 1000 - grp) AS b FROM matches GROUP BY child_id, is_train)"""


@query(
    "lag_keys",
    f"""WITH {_SHIFT_KEYS}
        SELECT id, CAST(shift AS INT) AS shift,
               count(*) FILTER (suffix_nz >= 2 AND t > 0) AS n_suffix, count(*) FILTER (prefix_nz >= 2) AS n_prefix,
               CAST(sum(CASE WHEN suffix_nz >= 2 AND t > 0 THEN t ELSE -1 END) AS BIGINT) AS targets,
               CAST(sum(suffix_nz) AS BIGINT) AS suffix_changes, CAST(sum(prefix_nz) AS BIGINT) AS prefix_changes,
               CAST(sum(CASE WHEN suffix_nz >= 2 AND t > 0 THEN length(array_to_string(suffix, '_')) ELSE 0 END) AS BIGINT) AS suffix_chars,
               CAST(sum(CASE WHEN prefix_nz >= 2 THEN length(array_to_string(prefix, '_')) ELSE 0 END) AS BIGINT) AS prefix_chars
        FROM keys GROUP BY id, shift""",
)
def lag_keys(spark, d):
    # spread by id, so that the sums over the groups of a row, 36 a row, need no exchange
    keys = L.lag_keys(widen(X.planted(spark, d), "id"), POSITIONS)
    return keys.groupBy("id", "shift").agg(
        F.count_if(F.col("suffix_key") != "").alias("n_suffix"),
        F.count_if(F.col("prefix_key") != "").alias("n_prefix"),
        F.sum("target").alias("targets"),
        F.sum("suffix_nz").alias("suffix_changes"), F.sum("prefix_nz").alias("prefix_changes"),
        F.sum(F.length("suffix_key")).alias("suffix_chars"), F.sum(F.length("prefix_key")).alias("prefix_chars"),
    )


@query(
    "lag_match_first",
    f"""WITH {_FIRST_MATCH}
        SELECT child_id, CAST(shift AS INT) AS shift, count(*) AS n, CAST(sum(target) AS BIGINT) AS targets,
               CAST(sum(nz) AS BIGINT) AS changes, min(parent_id) AS low_parent, max(parent_id) AS high_parent
        FROM matches GROUP BY child_id, shift""",
)
def lag_match_first(spark, d):
    matches = L.lag_match_first(X.planted(spark, d), POSITIONS)
    return matches.groupBy("child_id", "shift").agg(
        F.count(F.lit(1)).alias("n"), F.sum("target").alias("targets"), F.sum("nz").alias("changes"),
        F.min("parent_id").alias("low_parent"), F.max("parent_id").alias("high_parent"),
    )


@query(
    "lag_verify_pairs",
    f"""WITH {_FIRST_MATCH}
        SELECT child_id, parent_id, CAST(grp AS INT) AS grp, CAST(shift AS INT) AS shift FROM matches""",
)
def lag_verify_pairs(spark, d):
    """The matched pairs whose slices are equal value by value; the SQL compares values, so none may be missing."""
    planted = cut_lineage(X.planted(spark, d))  # read three times
    pairs = L.verify_pairs(L.lag_match_first(planted, POSITIONS), planted, POSITIONS)
    return pairs.select("child_id", "parent_id", F.col("grp").cast("int").alias("grp"), F.col("shift").cast("int").alias("shift"))


@query(
    "lag_match_best",
    f"""WITH {_BEST_MATCH}
        SELECT child_id, is_train, b.t AS found_target, CAST(b.n AS INT) AS found_len, CAST(b.g AS INT) AS round_num,
               CAST(b.s AS INT) AS shift FROM best""",
)
def lag_match_best(spark, d):
    return L.lag_match_best(L.lag_match_first(X.planted(spark, d), POSITIONS))


@query(
    "lag_link_edges",
    f"""WITH {_FIRST_MATCH}
        SELECT parent_id, child_id, CAST(arg_max(shift, grp * 100 + shift) AS INT) AS shift FROM matches GROUP BY 1, 2""",
)
def lag_link_edges(spark, d):
    return L.lag_link_edges(L.lag_match_first(X.planted(spark, d), POSITIONS))


@query(
    "lag_match_quality",
    f"""WITH {_BEST_MATCH},
        known AS (SELECT b.b.t = p.target AS good FROM best b JOIN planted p ON p.id = b.child_id WHERE b.is_train)
        SELECT count(*) AS matched, count(*) FILTER (good) AS good, count(*) FILTER (NOT good) AS bad,
               round(count(*) FILTER (good) / count(*), 6) AS ratio FROM known""",
)
def lag_match_quality(spark, d):
    planted = X.planted(spark, d)
    best = L.lag_match_best(L.lag_match_first(planted, POSITIONS))
    return L.lag_match_quality(best, planted.select("id", "target")).withColumn("ratio", F.round("ratio", 6))


_TUPLE = f"""
    offs AS (SELECT p.id, p.is_train, 0 AS pass, o.range AS o, p.series AS data, p.series AS w, p.series[1] AS first
             FROM planted p CROSS JOIN range(2, 40) o
             UNION ALL
             SELECT p.id, p.is_train, 1, o.range, [p.series[1]], [p.series[1]], p.series[1]
             FROM planted p CROSS JOIN range(2, 20) o),
    sides AS (SELECT id, is_train, pass, o, first[o - 1] AS pred,
                     md5(CAST(list_transform(data, lambda g: g[1:{POSITIONS} - o]) AS VARCHAR)) AS prefix,
                     md5(CAST(list_transform(data, lambda g: g[o + 1:{POSITIONS}]) AS VARCHAR)) AS suffix,
                     list_sum(list_transform(w, lambda g: len(list_filter(g[1:{POSITIONS} - o], lambda x: x > 0))))
                       + len(list_filter(first[1:{POSITIONS} - o], lambda x: x > 0)) AS nz
              FROM offs),
    later AS (SELECT is_train, pass, o, prefix AS k, any_value(id) AS child_id FROM sides
              WHERE nz >= CASE WHEN pass = 1 OR o > 37 THEN 3 ELSE 1 END
              GROUP BY is_train, pass, o, prefix HAVING count(*) = 1),
    earlier AS (SELECT is_train, pass, o, suffix AS k, any_value(id) AS parent_id, any_value(pred) AS pred FROM sides
                WHERE pred <> 0 GROUP BY is_train, pass, o, suffix HAVING count(*) = 1),
    matches AS (SELECT l.is_train, l.pass, l.o, l.child_id, e.parent_id, e.pred
                FROM later l JOIN earlier e USING (is_train, pass, o, k))"""


@query(
    "lag_match_tuple",
    f"""WITH {_TUPLE}
        SELECT is_train, CAST(pass AS INT) AS pass, CAST(o AS INT) AS "offset", child_id, parent_id, pred FROM matches""",
)
def lag_match_tuple(spark, d):
    return L.lag_match_tuple(X.planted(spark, d), POSITIONS, POSITIONS - 1)


@query(
    "lag_match_cascade",
    f"""WITH {_TUPLE}
        SELECT child_id, is_train, arg_min(pred, pass * 100 + o) AS pred, CAST(min(pass * 100 + o) // 100 AS INT) AS pass,
               CAST(min(pass * 100 + o) % 100 AS INT) AS "offset" FROM matches GROUP BY child_id, is_train""",
)
def lag_match_cascade(spark, d):
    return L.lag_match_cascade(L.lag_match_tuple(X.planted(spark, d), POSITIONS, POSITIONS - 1))


@query(
    "lag_match_per_offset",
    f"""WITH {_TUPLE}
        SELECT child_id, is_train, CAST(o AS INT) AS "offset", arg_max(pred, pass) AS pred FROM matches GROUP BY 1, 2, 3""",
)
def lag_match_per_offset(spark, d):
    return L.lag_match_per_offset(L.lag_match_tuple(X.planted(spark, d), POSITIONS, POSITIONS - 1))


@query(
    "lag_offset_sweep",
    f"""WITH {_TUPLE},
        swept AS (SELECT m.range AS max_offset, child_id, arg_min(pred, pass * 100 + o) AS pred
                  FROM matches CROSS JOIN range(35, 40) m WHERE is_train AND (pass = 1 OR o <= m.range) GROUP BY 1, 2)
        SELECT CAST(max_offset AS INT) AS max_offset, count(*) AS predicted, count(*) FILTER (s.pred = p.target) AS good
        FROM swept s JOIN planted p ON p.id = s.child_id GROUP BY 1""",
)
def lag_offset_sweep(spark, d):
    planted = X.planted(spark, d)
    matches = L.lag_match_tuple(planted, POSITIONS, POSITIONS - 1)
    return L.lag_offset_sweep(matches, planted.select("id", "target"))


@query(
    "join_unique_keys",
    """SELECT l.first AS key, l.id AS left_id, r.id AS right_id
       FROM (SELECT md5(CAST(series[1] AS VARCHAR)) AS k, any_value(series[1]) AS first, any_value(id) AS id FROM planted GROUP BY 1 HAVING count(*) = 1) l
       JOIN (SELECT md5(CAST(series[1] AS VARCHAR)) AS k, any_value(id) AS id FROM panel GROUP BY 1 HAVING count(*) = 1) r USING (k)
    """.replace("l.first AS key", "CAST(list_sum(l.first) AS BIGINT) AS key_sum"),
)
def join_unique_keys(spark, d):
    left = X.planted(spark, d).select(group(0).alias("key"), F.col("id").alias("left_id"))
    right = X.panel(spark, d).select(group(0).alias("key"), F.col("id").alias("right_id"))
    return L.join_unique_keys(left, right, "key").select(
        A.total(F.col("key")).cast("bigint").alias("key_sum"), "left_id", "right_id"
    )


@query(
    "drop_all_duplicates",
    "SELECT pos, value, any_value(id) AS id, CAST(any_value(grp) AS INT) AS grp FROM cells GROUP BY pos, value HAVING count(*) = 1",
)
def drop_all_duplicates(spark, d):
    return L.drop_all_duplicates(X.cells(spark, d), ["pos", "value"])


@query("sort_by_id", "SELECT id, target FROM panel_target ORDER BY id")
def sort_by_id(spark, d):
    return X.panel(spark, d).select("id", "target").orderBy("id")
