"""Calendar features, tumbling windows and the SQL functions built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# granularity -> (truncation unit, length); weeks start on Monday.
GRAINS = {
    "1 hour": ("hour", "INTERVAL 1 HOUR"),
    "1 day": ("day", "INTERVAL 1 DAY"),
    "1 week": ("week", "INTERVAL 7 DAYS"),
}


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """Monday is 0, in training, batch scoring and serving alike."""
    return F.weekday(ts)


def with_time_features(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns({
        "hour_of_day": hour_of_day(F.col(ts)),
        "day_of_week": day_of_week(F.col(ts)),
    })


def spans(ts: Column, granularities: tuple[str, ...]) -> Column:
    """Array of (granularity, window_start, window_end), one entry per granularity."""
    entries = []
    for name in granularities:
        unit, length = GRAINS[name]
        start = F.date_trunc(unit, ts)
        entries.append(F.struct(
            F.lit(name).alias("granularity"),
            start.alias("window_start"),
            (start + F.expr(length)).alias("window_end"),
        ))
    return F.array(*entries)


def windows(df: DataFrame, ts: str, granularities: tuple[str, ...] = ("1 day", "1 week")) -> DataFrame:
    """Each row once per granularity, tagged with its tumbling window. No shuffle."""
    return df.withColumn("_span", F.explode(spans(F.col(ts), granularities))).select("*", "_span.*").drop("_span")


def register_time_functions(spark: SparkSession) -> dict[str, str]:
    """Named SQL functions with SQL bodies: Catalyst inlines them, no Python worker runs."""
    names = {"hour": "extract_hour_of_day", "weekday": "extract_day_of_week"}
    for builtin, name in names.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(ts TIMESTAMP) RETURNS INT RETURN {builtin}(ts)"
        )
    return names


def apply_functions(df: DataFrame, bindings: list[tuple[str, str, str]]) -> DataFrame:
    """Apply named functions: each binding is (function, input column, output column)."""
    return df.withColumns({out: F.expr(f"{fn}(`{col}`)") for fn, col, out in bindings})
