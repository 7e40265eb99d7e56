"""Scores of predictions, as global or grouped aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: clip of probabilities in a log loss (machine epsilon of doubles).
EPSILON = 2.220446049250313e-16


def log_loss(label: Column, probabilities: list[Column], eps: float = EPSILON) -> Column:
    """Mean negative log of the true class's probability, rows normalised, clipped at ``eps``."""
    total = sum(probabilities[1:], probabilities[0])
    chosen = F.get(F.array(*probabilities), label) / total
    return F.avg(-F.ln(F.least(F.greatest(chosen, F.lit(eps)), F.lit(1.0 - eps))))


def rmsle(target: Column, prediction: Column) -> Column:
    return F.sqrt(F.avg(F.pow(F.log1p(prediction) - F.log1p(target), 2)))


def rmse(target: Column, prediction: Column) -> Column:
    return F.sqrt(F.avg(F.pow(prediction - target, 2)))


def accuracy(labels: list[Column], predicted: list[Column]) -> Column:
    """Share of rows with every label equal."""
    same = F.lit(True)
    for x, y in zip(labels, predicted, strict=True):
        same = same & (x == y)
    return F.avg(same.cast("double"))


def precision_f1(df: DataFrame, labels: list[str], predicted: list[str]) -> DataFrame:
    """Macro and micro precision and F1 of 0/1 label columns; 0 where undefined."""
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("k"), F.col(y).cast("int").alias("y"), F.col(p).cast("int").alias("p"))
            for i, (y, p) in enumerate(zip(labels, predicted, strict=True))
        ]
    )
    y, p = F.col("y") == 1, F.col("p") == 1
    tallies = df.select(F.inline(rows)).groupBy("k").agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn")
    )

    def safe(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return tallies.agg(
        F.avg(safe(tp, tp + fp)).alias("precision_macro"),
        safe(F.sum(tp), F.sum(tp) + F.sum(fp)).alias("precision_micro"),
        F.avg(safe(tp * 2, tp * 2 + fp + fn)).alias("f1_macro"),
        safe(F.sum(tp) * 2, F.sum(tp) * 2 + F.sum(fp) + F.sum(fn)).alias("f1_micro"),
    )


def cv_summary(scores: DataFrame, col: str) -> DataFrame:
    """Mean and population deviation of fold scores."""
    return scores.agg(F.avg(col).alias("mean"), F.stddev_pop(col).alias("std"))


def class_rate(df: DataFrame, cols: list[str]) -> DataFrame:
    """Each column's share of the grand total."""
    sums = df.agg(*[F.sum(c).alias(c) for c in cols])
    total = sum((F.col(c) for c in cols[1:]), F.col(cols[0]))
    return sums.select(*[F.try_divide(F.col(c), total).alias(c) for c in cols])


def normalise_by_max(df: DataFrame, cols: list[str]) -> DataFrame:
    """Divide each column by its maximum; 0 where the maximum is 0. The maxima are a scalar."""
    top = df.agg(F.struct(*[F.max(c).cast("double").alias(c) for c in cols])).scalar()
    return df.withColumns(
        {c: F.coalesce(F.try_divide(F.col(c).cast("double"), top[c]), F.lit(0.0)) for c in cols}
    )


# --- grouped evaluation -------------------------------------------------------------------------

def confusion_tallies() -> list[Column]:
    """Counts over boolean ``gold`` and ``system``; a missing system value is a false negative."""
    gold, system = F.coalesce("gold", F.lit(False)), F.col("system")
    return [
        F.count_if(gold & system).alias("tp"),
        F.count_if(~gold & system).alias("fp"),
        F.count_if(~gold & ~system).alias("tn"),
        F.count_if(system.isNull() | (gold & ~system)).alias("fn"),
    ]


def join_gold_system(gold: DataFrame, system: DataFrame) -> DataFrame:
    """Gold rows with the system's flags, NULL where the system has none."""
    theirs = system.select("id", F.col("a_coref").alias("a_system"), F.col("b_coref").alias("b_system"))
    return gold.join(theirs, "id", "left")


def confusion_by_group(joined: DataFrame) -> DataFrame:
    """Tallies over both names, overall and per gender."""
    flags = F.array(
        F.struct(F.col("a_coref").alias("gold"), F.col("a_system").alias("system")),
        F.struct(F.col("b_coref").alias("gold"), F.col("b_system").alias("system")),
    )
    grouped = joined.select("gender", F.inline(flags)).rollup("gender").agg(
        *confusion_tallies(), F.grouping("gender").alias("_all")
    )
    name = F.when(F.col("_all") == 1, "Overall").otherwise(F.col("gender"))
    return grouped.select(name.alias("grp"), "tp", "fp", "tn", "fn")


def scorecard(tallies: DataFrame) -> DataFrame:
    """Recall, precision and F1 in percent per group, and the F/M ratio of F1 or '-'."""
    def percent(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a * 100.0, b.cast("double")), F.lit(0.0))

    scored = tallies.select(
        "*",
        percent(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        percent(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
    ).withColumn(
        "f1",
        F.coalesce(
            F.try_divide(F.col("precision") * F.col("recall") * 2, F.col("precision") + F.col("recall")), F.lit(0.0)
        ),
    )
    every = Window.partitionBy(F.lit(0))  # one row per group: few, and tallied once
    women = F.max(F.when(F.col("grp") == "F", F.col("f1"))).over(every)
    men = F.max(F.when(F.col("grp") == "M", F.col("f1"))).over(every)
    ratio = F.when((women > 0) & (men > 0), F.format_string("%.2f", women / men)).otherwise("-")
    return scored.withColumn("bias", ratio)
