"""Alert queries over the published monitor tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.columns import any_below, recent

# Alert limits.
P_LIMIT = 0.05
PSI_LIMIT = 0.2
QUALITY_LIMITS = {"recall.weighted": 0.40, "precision.weighted": 0.50, "f1_score.weighted": 0.45}


def alert_feature_drift(drift: DataFrame, as_of: str | None, lookback: int = 1, p_limit: float = P_LIMIT) -> DataFrame:
    """Features whose KS or chi-squared p-value is below the limit; a NULL p-value never fires."""
    ks, chi = F.col("ks_test.pvalue"), F.col("chi_squared_test.pvalue")
    rows = drift.filter(
        (F.col("drift_type") == "BASELINE") & F.col("slice_key").isNull()
        & ~F.col("column_name").isin("prediction", ":table")
        & recent(F.col("window.start"), as_of, lookback)
        & ((ks < p_limit) | (chi < p_limit))
    )
    return rows.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "column_name", "granularity",
        F.col("ks_test.statistic").alias("ks_statistic"), ks.alias("ks_pvalue"),
        F.col("chi_squared_test.statistic").alias("chi2_statistic"), chi.alias("chi2_pvalue"),
        "wasserstein_distance", F.col("population_stability_index").alias("psi"),
    ).orderBy(F.coalesce("ks_pvalue", "chi2_pvalue"), "granularity", "window_start", "column_name")


def alert_model_quality(
    profile: DataFrame, as_of: str | None, lookback: int = 1, limits: dict[str, float] | None = None,
) -> DataFrame:
    """Whole-table windows whose weighted recall, precision or F1 is below its limit."""
    rows = profile.filter(
        (F.col("column_name") == ":table") & (F.col("log_type") == "INPUT") & F.col("slice_key").isNull()
        & recent(F.col("window.start"), as_of, lookback) & any_below(limits or QUALITY_LIMITS)
    )
    return rows.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "granularity", "model_version", "accuracy_score",
        F.col("precision.weighted").alias("precision_weighted"),
        F.col("recall.weighted").alias("recall_weighted"),
        F.col("f1_score.weighted").alias("f1_weighted"),
    )


def alert_prediction_psi(drift: DataFrame, as_of: str | None, lookback: int = 1, limit: float = PSI_LIMIT) -> DataFrame:
    """Windows whose prediction distribution moved away from the baseline."""
    rows = drift.filter(
        (F.col("drift_type") == "BASELINE") & (F.col("column_name") == "prediction") & F.col("slice_key").isNull()
        & recent(F.col("window.start"), as_of, lookback) & (F.col("population_stability_index") > limit)
    )
    return rows.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "granularity",
        F.col("population_stability_index").alias("psi"), "wasserstein_distance",
        F.col("avg_delta").alias("prediction_mean_delta"),
    )


def alert_evaluate(alerts: dict[str, DataFrame], rules: dict[str, tuple[str, str, float]]) -> DataFrame:
    """One row per alert: COUNT(column) compared with the rule's limit.

    ``rules`` maps an alert name to (column, operator, limit).
    """
    compare = {
        ">": lambda c, v: c > v, ">=": lambda c, v: c >= v, "<": lambda c, v: c < v,
        "<=": lambda c, v: c <= v, "=": lambda c, v: c == v, "!=": lambda c, v: c != v,
    }
    rows = []
    for name, df in alerts.items():
        column, op, limit = rules[name]
        count = F.count(column)
        rows.append(df.agg(count.alias("row_count")).select(
            F.lit(name).alias("alert"), "row_count",
            F.when(compare[op](F.col("row_count"), limit), "FIRED").otherwise("OK").alias("state")))
    return reduce(DataFrame.unionByName, rows)


def alert_demo(profile: DataFrame) -> DataFrame:
    """One row as soon as the profile table holds anything."""
    return profile.filter(F.col("column_name").isNotNull()).limit(1).select(
        F.lit("demo").alias("alert_reason"), F.current_timestamp().alias("ts"))
