"""Quality gate, model aliases and the champion/challenger decision as small tables.

Model and metric tables have one row per version, so they are joined and windowed freely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.columns import archive_alias, hash_word
from cardwatch.sources.payload import latest_per

# Minimum fraud-class metrics of the gate.
GATE = {"recall": 0.30, "precision": 0.40, "f1_score": 0.35}


def alias_resolve(aliases: DataFrame, versions: DataFrame, metrics: DataFrame) -> DataFrame:
    """alias -> version -> run -> metric rows; an alias without a run keeps a NULL metric."""
    return (
        aliases.join(versions, "version", "left").join(metrics, "run_id", "left")
        .select("alias", "version", "run_id", "metric", "value")
    )


def quality_gate(metrics: DataFrame, by: list[str], limits: dict[str, float] | None = None) -> DataFrame:
    """Verdict per model and the sorted list of failed checks; a missing metric fails.

    ``metrics`` has one row per model with a column per metric. The caller stops its job on
    a REJECTED row.
    """
    limits = limits or GATE
    checks = []
    for name, low in sorted(limits.items()):
        value = F.col(name) if name in metrics.columns else F.lit(None).cast("double")
        shown = F.format_string("%.4f", value)
        checks.append(
            F.when(value.isNull(), F.lit(f"{name} missing"))
            .when(value < low, F.concat(F.lit(f"{name} "), shown, F.lit(f" < {low}"))))
    failures = F.filter(F.array(*checks), lambda c: c.isNotNull())
    return metrics.select(*by, failures.alias("_failures")).select(
        *by, F.when(F.size("_failures") == 0, "PASSED").otherwise("REJECTED").alias("verdict"),
        F.array_join("_failures", "; ").alias("failures"))


def latest_per_model(profile: DataFrame, metric: Column, granularity: str = "1 week") -> DataFrame:
    """Newest whole-table score per model: (model_version, window_end, score)."""
    rows = profile.filter(
        (F.col("granularity") == granularity) & (F.col("column_name") == ":table") & F.col("slice_key").isNull()
    ).select("model_version", F.col("window.end").alias("window_end"), metric.alias("score"))
    return latest_per(rows.filter(F.col("score").isNotNull()), ["model_version"], ["window_end"])


def pair_scores(latest: DataFrame, aliases: DataFrame) -> DataFrame:
    """One row with the champion's and the challenger's monitoring score."""
    named = aliases.join(latest, "model_version", "left")

    def of(alias: str) -> Column:
        return F.max(F.when(F.col("alias") == alias, F.col("score")))

    return named.agg(of("champion").alias("champion_score"), of("challenger").alias("challenger_score"))


def _of(alias: str, col: str) -> Column:
    return F.max(F.when(F.col("alias") == alias, F.col(col)))


def _split_status() -> Column:
    a, b = F.col("champion_version"), F.col("challenger_version")
    return (
        F.when(a.isNull(), "NO_CHAMPION").when(b.isNull(), "NO_CHALLENGER")
        .when(a == b, "SAME_VERSION").otherwise("ACTIVE")
    )


def active_split(aliases: DataFrame) -> DataFrame:
    """Whether both aliases exist and differ, as one row with their versions."""
    both = aliases.agg(*[_of(a, "version").alias(f"{a}_version") for a in ("champion", "challenger")])
    return both.withColumn("status", _split_status())


def ab_scores(aliases: DataFrame, versions: DataFrame, profile: DataFrame, run_metrics: DataFrame,
              metric: str = "recall", path: str = "recall.weighted") -> DataFrame:
    """One row with the split's versions and status, the score pair and its source.

    Monitoring counts only if both models have a score; the two scores never come from
    different sources.
    """
    latest = latest_per_model(profile, F.col(path))
    trained = alias_resolve(aliases.select("alias", "version"), versions.select("version", "run_id"), run_metrics)
    trained = trained.filter(F.col("metric") == metric).select("alias", F.col("value").alias("trained"))
    rows = aliases.join(latest, "model_version", "left").join(trained, "alias", "left")
    names = ("champion", "challenger")
    wide = rows.agg(*[_of(a, c).alias(f"{a}_{c}") for a in names for c in ("version", "score", "trained")])
    watched = F.col("champion_score").isNotNull() & F.col("challenger_score").isNotNull()
    return wide.select(
        *[f"{a}_version" for a in names], _split_status().alias("status"),
        *[F.when(watched, F.col(f"{a}_score")).otherwise(F.col(f"{a}_trained")).alias(f"{a}_metric") for a in names],
        F.when(watched, "monitoring_1week").otherwise("training").alias("metric_source"))


def ab_resolve(aliases: DataFrame, versions: DataFrame, profile: DataFrame, run_metrics: DataFrame, now: str,
               metric: str = "recall", path: str = "recall.weighted") -> DataFrame:
    """The decision row; no row without an active split. A tie keeps the champion."""
    row = ab_scores(aliases, versions, profile, run_metrics, metric, path).filter(F.col("status") == "ACTIVE")
    wins = F.coalesce(F.col("challenger_metric") > F.col("champion_metric"), F.lit(False))

    def pick(name: str, winner: bool) -> Column:
        a, b = F.col(f"challenger_{name}"), F.col(f"champion_{name}")
        return F.when(wins, a if winner else b).otherwise(b if winner else a)

    return row.select(
        F.when(wins, "challenger").otherwise("champion").alias("winner"),
        pick("version", True).alias("winner_version"), pick("version", False).alias("loser_version"),
        pick("metric", True).alias("winner_metric"), pick("metric", False).alias("loser_metric"),
        archive_alias(F.lit(now).cast("timestamp")).alias("archive_alias"), "metric_source")


def traffic_split(df: DataFrame, key: str, routes: list[tuple[str, int]], seed: int = 0) -> DataFrame:
    """Route each key by its stable hash bucket in 0..99; the same key always goes the same way."""
    bucket = hash_word(F.col(key), seed) % 100
    out, upto = F.lit(None).cast("string"), 100
    for name, percent in reversed(routes):
        out = F.when(bucket < upto, F.lit(name)).otherwise(out)
        upto -= percent
    return df.withColumn("route", out)
