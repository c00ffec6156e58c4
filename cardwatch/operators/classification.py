"""Classification reports, curves and losses as grouped aggregates.

``by`` names the grouping columns (a model version, a window, a slice) and may not be empty
for curves. Rows without a label or a prediction are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.columns import join_on, safe_div
from cardwatch.operators.ordered import running


def cells(df: DataFrame, label: str, pred: str, by: list[str]) -> DataFrame:
    """Rows per (label, prediction); everything below is derived from these few rows."""
    known = F.col(label).isNotNull() & F.col(pred).isNotNull()
    return (
        df.filter(known).groupBy(*by, F.col(label).cast("int").alias("label"), F.col(pred).cast("int").alias("prediction"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def confusion(df: DataFrame, label: str, pred: str, by: list[str], classes: tuple[int, ...] = (0, 1)) -> DataFrame:
    """Confusion cells with absent cells filled by 0."""
    found = cells(df, label, pred, by)
    grid = found.select(*by).distinct()
    for name in ("label", "prediction"):
        grid = grid.withColumn(name, F.explode(F.array(*[F.lit(c) for c in classes])))
    keys = [*by, "label", "prediction"]
    return join_on(grid, found, keys).select(*keys, F.coalesce("n", F.lit(0)).alias("n"))


def binary_metrics(df: DataFrame, label: str, pred: str, by: list[str]) -> DataFrame:
    """Precision, recall, F1 of class 1 and accuracy from conditional sums in one aggregate."""
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")

    def hits(cond: Column) -> Column:
        return F.count(F.when(cond, 1))

    counted = df.filter(y.isNotNull() & p.isNotNull()).groupBy(*by).agg(
        hits((y == 1) & (p == 1)).alias("tp"), hits((y == 0) & (p == 1)).alias("fp"),
        hits((y == 1) & (p == 0)).alias("fn"), hits((y == 0) & (p == 0)).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counted.withColumns({
        "precision": safe_div(tp, tp + fp),
        "recall": safe_div(tp, tp + fn),
        "f1_score": safe_div(2 * tp, 2 * tp + fp + fn),
        "accuracy": safe_div(tp + tn, tp + fp + fn + tn),
    })


def class_rows(found: DataFrame, by: list[str]) -> DataFrame:
    """Precision, recall, F1 and support per class from confusion cells."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    views = F.array(
        F.struct(F.col("label").alias("class"), hit.alias("tp"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("tp"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted")),
    )
    summed = (
        found.select(*by, F.explode(views).alias("v")).select(*by, "v.*")
        .groupBy(*by, "class").agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])
    )
    return summed.withColumns({
        "precision": safe_div(F.col("tp"), F.col("predicted")),
        "recall": safe_div(F.col("tp"), F.col("support")),
        "f1_score": safe_div(2 * F.col("tp"), F.col("predicted") + F.col("support")),
    })


def averages(per_class: DataFrame, by: list[str], *more: Column) -> DataFrame:
    """Accuracy with macro and support-weighted averages, one row per group; ``more`` are
    further aggregates of the same rows."""
    total = F.sum("support")
    out = [safe_div(F.sum("tp"), total).alias("accuracy"), total.alias("support")]
    for m in ("precision", "recall", "f1_score"):
        out += [
            F.avg(m).alias(f"{m}_macro"),
            safe_div(F.sum(F.col(m) * F.col("support")), total).alias(f"{m}_weighted"),
        ]
    return per_class.groupBy(*by).agg(*out, *more)


def class_report(df: DataFrame, label: str, pred: str, by: list[str]) -> DataFrame:
    """Report rows: one per class, then accuracy, macro avg and weighted avg."""
    per_class = class_rows(cells(df, label, pred, by), by)
    named = per_class.select(
        *by, F.col("class").cast("string").alias("row"), "precision", "recall", "f1_score", "support")
    acc = F.col("accuracy")
    rows = F.array(
        F.struct(F.lit("accuracy").alias("row"), acc.alias("precision"), acc.alias("recall"), acc.alias("f1_score"), "support"),
        *[F.struct(F.lit(f"{kind} avg").alias("row"), *[F.col(f"{m}_{kind}").alias(m) for m in ("precision", "recall", "f1_score")], "support")
          for kind in ("macro", "weighted")],
    )
    summary = averages(per_class, by).select(*by, F.explode(rows).alias("r")).select(*by, "r.*")
    return named.unionByName(summary)


def accuracy(df: DataFrame, label: str, pred: str, by: list[str]) -> DataFrame:
    same = (F.col(label).cast("int") == F.col(pred).cast("int")).cast("double")
    return df.groupBy(*by).agg(F.avg(same).alias("accuracy"))


def score_table(df: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    """Positives and negatives per distinct score; a repeated score is one row."""
    y = F.col(label).cast("int")
    return df.filter(y.isNotNull() & F.col(score).isNotNull()).groupBy(*by, F.col(score).alias("threshold")).agg(
        F.count(F.when(y == 1, 1)).alias("pos"), F.count(F.when(y == 0, 1)).alias("neg"))


def cumulative(table: DataFrame, by: list[str]) -> DataFrame:
    """True and false positives at or above each threshold, with the class totals."""
    pos, neg = F.col("pos"), F.col("neg")
    return running(
        table, by, ["threshold"], None,
        {"tp": ("sum", pos), "fp": ("sum", neg), "all_pos": ("total", pos), "all_neg": ("total", neg)},
        descending=True,
    )


def roc_auc(df: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    """Mann-Whitney area; tied scores count one half. NULL for a single class."""
    cum = cumulative(score_table(df, label, score, by), by)
    won = F.sum(F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return cum.groupBy(*by).agg(F.when(pairs > 0, won / pairs).alias("roc_auc"))


def roc_curve(df: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, a distributed table."""
    return cumulative(score_table(df, label, score, by), by).select(
        *by, "threshold", safe_div(F.col("fp"), F.col("all_neg")).alias("fpr"),
        safe_div(F.col("tp"), F.col("all_pos")).alias("tpr"))


def pr_curve(df: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    """(threshold, precision, recall) at every distinct score."""
    return cumulative(score_table(df, label, score, by), by).select(
        *by, "threshold", safe_div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        safe_div(F.col("tp"), F.col("all_pos")).alias("recall"))


def lift_chart(df: DataFrame, label: str, score: str, by: list[str], parts: int = 10) -> DataFrame:
    """Rows, positives and lift per score bin; bins are cut at the quantiles of the scores.

    A score lies in bin i if the scores below it hold at least i parts of the rows, which its
    own cumulative count tells; no edge table is joined.
    """
    sized = score_table(df, label, score, by).withColumn("n", F.col("pos") + F.col("neg"))
    n = F.col("n")
    cum = running(sized, by, ["threshold"], None, {
        "cum": ("sum", n), "all_n": ("total", n), "all_pos": ("total", F.col("pos"))})
    at = F.floor((F.col("cum") - n) * parts / F.col("all_n")).cast("int")
    binned = cum.groupBy(*by, at.alias("bin")).agg(
        F.sum("n").alias("n"), F.sum("pos").alias("positives"),
        (F.max("all_pos") / F.max("all_n")).alias("base"))
    return binned.select(
        *by, "bin", "n", "positives", safe_div(F.col("positives") / F.col("n"), F.col("base")).alias("lift"))


def log_loss(df: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    """Mean cross-entropy with scores held inside [1e-15, 1 - 1e-15]."""
    y = F.col(label).cast("int")
    p = F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), F.col(score)))
    loss = F.when(y == 1, -F.log(p)).when(y == 0, -F.log(1 - p))
    return df.filter(F.col(score).isNotNull()).groupBy(*by).agg(F.avg(loss).alias("log_loss"))


def long_metrics(wide: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """One row per metric: (by, metric, value)."""
    return wide.unpivot([F.col(c) for c in by], names, "metric", "value")
