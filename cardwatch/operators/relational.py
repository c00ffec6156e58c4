"""Counts, rates, distributions and comparisons for exploration and reports."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.functions.columns import pct_change
from cardwatch.operators.ordered import exact_quantiles, value_table


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows per label and percent of the total; the window runs over one row per label."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.select(label, "n", F.round(F.col("n") * 100.0 / total, 2).alias("pct"))


def hourly_rate(df: DataFrame, ts: str, label: str) -> DataFrame:
    flag = F.col(label).cast("int")
    return (
        df.groupBy(F.hour(ts).alias("hour_of_day"))
        .agg(F.count(F.lit(1)).alias("transactions"), F.sum(flag).alias("frauds"),
             F.round(F.avg(flag.cast("double")), 4).alias("fraud_rate"))
        .orderBy("hour_of_day")
    )


def amount_hist(df: DataFrame, col: str, label: str, width: float) -> DataFrame:
    """Rows per label and fixed-width bin of the amount."""
    low = F.floor(F.col(col) / F.lit(width)) * F.lit(width)
    return df.groupBy(label, low.alias("bin_low")).agg(F.count(F.lit(1)).alias("n"))


def amount_quantiles(df: DataFrame, col: str, label: str, probs: dict[str, float]) -> DataFrame:
    """Exact quantiles per label, from counts per value in place of a buffer of all rows."""
    return exact_quantiles(value_table(df, [label], col), [label], col, probs)


def correlation(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson matrix in one pass; a pair uses the rows where both columns are known."""
    pairs = list(combinations(cols, 2))
    row = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        cells += [(a, b, F.col(f"c{i}")), (b, a, F.col(f"c{i}"))]
    cells += [(c, c, F.lit(1.0)) for c in cols]
    entries = [F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), r.alias("r")) for a, b, r in cells]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def counts_with_total(df: DataFrame, key: str) -> DataFrame:
    """Rows per key plus a total row with a NULL key."""
    return df.rollup(key).agg(F.count(F.lit(1)).alias("n"))


def means(df: DataFrame, cols: list[str], value: str = "mean") -> DataFrame:
    """Mean per column in one aggregate, as (column_name, mean) rows."""
    return (
        df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols])
        .unpivot([], cols, "column_name", value)
    )


def mean_shift(base: DataFrame, cur: DataFrame, cols: list[str]) -> DataFrame:
    """Baseline and current mean per column with the shift in percent to one digit."""
    joined = means(base, cols, "baseline_mean").join(means(cur, cols, "drift_mean"), "column_name")
    return joined.withColumn(
        "shift_pct", F.round(pct_change(F.col("drift_mean"), F.col("baseline_mean")), 1))


def metric_compare(champion: DataFrame, challenger: DataFrame) -> DataFrame:
    """(metric, value) tables side by side over all metric names; a missing one shows 0.0."""
    left = champion.select("metric", F.col("value").alias("champion"))
    right = challenger.select("metric", F.col("value").alias("challenger"))
    filled = [F.round(F.coalesce(F.col(c), F.lit(0.0)), 4).alias(c) for c in ("champion", "challenger")]
    return left.join(right, "metric", "full").select("metric", *filled).orderBy("metric")


def key_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).subtract(b.select(key))


def name_union(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    return a.select(name).union(b.select(name)).distinct()
