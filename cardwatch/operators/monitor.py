"""Windowed and sliced profile, quality and drift tables.

Rows collapse first to counts per (finest time cell, slice columns, value) and only those
counts are spread over granularities and slices. The time cell and the map-side combine
keep a hot card, day or value from reaching one task as raw rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.functions.columns import join_on, value_bucket
from cardwatch.functions.timeparts import GRAINS, spans
from cardwatch.operators.classification import averages, cells, class_rows
from cardwatch.operators.ordered import bin_of, bucket_bits, group_totals, running
from cardwatch.session import materialize

WINDOW = ["granularity", "window_start", "window_end"]
SLICE = ["slice_key", "slice_value"]
CELL = ["part", "slice_value", "grain", "window_start"]
# Inside the module the whole table is the slice ("", ""), since running() wants no NULLs.
FLOOR = 1e-4
#: Lists in which the states of a group are merged before they are merged with each other.
CHUNKS = 64


def _cell_unit(granularities: tuple[str, ...]) -> str:
    return "hour" if "1 hour" in granularities else "day"


def _slice_cols(slices: list[str]) -> list[Column]:
    return [_told(s).alias(f"_slice_{s}") for s in slices]


def _told(name: str) -> Column:
    """A slice value behind an equals sign; NULL is the empty text, so it meets no value."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))


def _untold(value: Column) -> Column:
    return F.when(value != "", F.substring(value, 2, 2**31 - 1))


def _spread(fine: DataFrame, slices: list[str], granularities: tuple[str, ...], whole: bool = True) -> DataFrame:
    """Repeat cell rows per granularity and per slice; drops the cell's own columns."""
    entries = [F.struct(F.lit("").alias("slice_key"), F.lit("").alias("slice_value"))] if whole else []
    entries += [F.struct(F.lit(s).alias("slice_key"), F.col(f"_slice_{s}").alias("slice_value")) for s in slices]
    out = fine.withColumn("_s", F.explode(F.array(*entries))).select("*", "_s.*")
    out = out.drop("_s", *[f"_slice_{s}" for s in slices])
    if granularities:
        out = out.withColumn("_w", F.explode(spans(F.col("_cell"), granularities))).select("*", "_w.*").drop("_w", "_cell")
    return out


def _public(df: DataFrame) -> DataFrame:
    """Published slices: (NULL, NULL) is the whole table, (key, NULL) are the rows where the slice column is NULL."""
    blank = F.col("slice_key") == ""
    return df.withColumns({
        "slice_value": F.when(~blank, _untold(F.col("slice_value"))),
        "slice_key": F.when(~blank, F.col("slice_key")),
    })


def slice_grouping(df: DataFrame, by: list[Column], slices: list[str], aggs: list[Column]) -> DataFrame:
    """Overall and per-slice aggregates in one pass with grouping sets."""
    names = [f"_by{i}" for i in range(len(by))]
    rows = df.withColumns(dict(zip(names, by))).withColumns({s: _told(s) for s in slices})
    keys = [F.col(n) for n in names]
    sets = [keys] + [keys + [F.col(s)] for s in slices]
    grouped = rows.groupingSets(sets, *keys, *[F.col(s) for s in slices]).agg(*aggs)
    key = F.coalesce(*[F.when(F.col(s).isNotNull(), F.lit(s)) for s in slices])
    value = _untold(F.coalesce(*[F.col(s) for s in slices]))
    return grouped.withColumns({"slice_key": key, "slice_value": value}).drop(*slices)


# --- profile and quality -----------------------------------------------------------------

def value_counts(
    df: DataFrame, numeric: list[str], categorical: list[str], slices: list[str],
    ts: str | None = None, granularities: tuple[str, ...] = (), by: tuple[str, ...] = (),
) -> DataFrame:
    """Rows per (by, window, slice, column, value), NULL values kept as their own value.

    Numeric values stand in ``num``, categories in ``txt``. These are the widest tables of the
    monitor, so column and slice key travel as one number ``part``, the granularity as
    ``grain``; named() turns them back.
    """
    columns = numeric + categorical
    time = [F.date_trunc(_cell_unit(granularities), F.col(ts)).alias("_cell")] if granularities else []
    ids = [*by, *(["_cell"] if granularities else []), *[f"_slice_{s}" for s in slices]]
    none = {"num": F.lit(None).cast("double"), "txt": F.lit(None).cast("string")}

    def entry(i: int, **value: Column) -> Column:
        return F.struct(F.lit(i).alias("_col"), *[v.alias(k) for k, v in {**none, **value}.items()])

    entries = [entry(i, num=F.col(c).cast("double")) for i, c in enumerate(numeric)]
    entries += [entry(i, txt=F.col(c).cast("string")) for i, c in enumerate(categorical, len(numeric))]
    long = df.select(*by, *time, *_slice_cols(slices), F.explode(F.array(*entries)).alias("_e")).select(*ids, "_e.*")
    out = long.groupBy(*ids, "_col", "num", "txt").agg(F.count(F.lit(1)).alias("n"))

    parts = [F.struct(F.col("_col").alias("part"), F.lit("").alias("slice_value"))]
    parts += [
        F.struct((F.col("_col") + i * len(columns)).alias("part"), F.col(f"_slice_{s}").alias("slice_value"))
        for i, s in enumerate(slices, 1)
    ]
    out = out.withColumn("_s", F.explode(F.array(*parts))).select("*", "_s.*")
    keys = [*by, *CELL[:2], "num", "txt"]
    if granularities:
        starts = [
            F.struct(F.lit(i).alias("grain"), F.date_trunc(GRAINS[g][0], F.col("_cell")).alias("window_start"))
            for i, g in enumerate(granularities)
        ]
        out = out.withColumn("_w", F.explode(F.array(*starts))).select("*", "_w.*")
        keys += CELL[2:]
    return out.groupBy(*keys).agg(F.sum("n").alias("n"))


def named(df: DataFrame, columns: list[str], slices: list[str], granularities: tuple[str, ...]) -> DataFrame:
    """Names in place of part and grain, and the window end."""
    def pick(names: list[str], at: Column) -> Column:
        return F.element_at(F.array(*[F.lit(n) for n in names]), at + 1)

    out = df.withColumns({
        "column_name": pick(columns, F.col("part") % len(columns)),
        "slice_key": pick(["", *slices], F.floor(F.col("part") / len(columns)).cast("int")),
    }).drop("part")
    if not granularities:
        return out
    length = F.coalesce(*[
        F.when(F.col("grain") == i, F.col("window_start") + F.expr(GRAINS[g][1])) for i, g in enumerate(granularities)])
    return out.withColumns({"granularity": pick(list(granularities), F.col("grain")), "window_end": length}).drop("grain")


def _moments(states: Column) -> Column:
    """One (n, mean, m2) of many: each is merged around the mean of both, so no digits cancel."""
    def merge(one: Column, two: Column) -> Column:
        n, d = one["n"] + two["n"], two["mean"] - one["mean"]
        part = F.when(n > 0, two["n"] / n).otherwise(0.0)
        return F.struct(n.alias("n"), (one["mean"] + d * part).alias("mean"), (one["m2"] + two["m2"] + d * d * one["n"] * part).alias("m2"))

    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(states, start, merge)


def _merged(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row of ``keys`` with the cells' states merged, in two steps so that no list holds all cells of a hot group."""
    flat = [F.sum("_null").alias("_null"), F.sum("_odd").alias("_odd"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi")]
    state = _moments(F.collect_list("_state")).alias("_state")
    some = rows.withColumn("_chunk", F.pmod(F.xxhash64("_state", "_null", "_lo", "_hi"), F.lit(CHUNKS))).groupBy(*keys, "_chunk").agg(state, *flat)
    return some.groupBy(*keys).agg(state, *flat)


def profile(
    log: DataFrame, ts: str, columns: list[str], slices: list[str],
    granularities: tuple[str, ...] = ("1 day", "1 week"), by: tuple[str, ...] = ("model_version",),
    categorical: list[str] | None = None,
) -> DataFrame:
    """Count, NULLs, NaNs, mean, deviation, minimum, maximum and distinct values per group.

    States (n, mean, squares about the mean) are taken per cell with the built-in stable aggregates
    and merged from cell to window and slice. NaN and infinite values are counted in ``num_nan`` and
    count as missing otherwise. Text columns (``categorical``) have counts and distinct values only.
    Without granularities the groups are slices of the whole table. A NULL slice value is a slice of
    its own, apart from the text 'NULL'.
    """
    categorical = categorical or []
    time = [F.date_trunc(_cell_unit(granularities), F.col(ts)).alias("_cell")] if granularities else []
    ids = [*by, *(["_cell"] if granularities else []), *[f"_slice_{s}" for s in slices]]
    names = [f"_x{i}" for i in range(len(columns) + len(categorical))]
    flat = log.select(
        *by, *time, *_slice_cols(slices), *[F.col(c).cast("double").alias(x) for c, x in zip(columns, names)],
        *[F.col(c).cast("string").alias(x) for c, x in zip(categorical, names[len(columns):])])
    aggs = []
    for i, x in enumerate(names):
        aggs.append(F.count(F.when(F.col(x).isNull(), 1)).alias(f"_null{i}"))
        if i < len(columns):
            known = F.when(F.abs(x) < F.lit(float("inf")), F.col(x))
            aggs += [F.count(known).alias(f"_n{i}"), F.avg(known).alias(f"_m{i}"), F.var_pop(known).alias(f"_v{i}"),
                     F.min(known).alias(f"_lo{i}"), F.max(known).alias(f"_hi{i}"), F.count(x).alias(f"_all{i}")]
        else:
            aggs.append(F.count(x).alias(f"_n{i}"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("double")

    def entry(i: int, name: str) -> Column:
        n, number = F.col(f"_n{i}"), i < len(columns)
        mean = F.coalesce(F.col(f"_m{i}"), F.lit(0.0)) if number else F.lit(0.0)
        squares = F.coalesce(F.col(f"_v{i}") * n, F.lit(0.0)) if number else F.lit(0.0)
        return F.struct(
            F.lit(name).alias("column_name"), F.lit(number).alias("_number"), F.struct(n.alias("n"), mean.alias("mean"), squares.alias("m2")).alias("_state"),
            F.col(f"_null{i}").alias("_null"), (F.col(f"_all{i}") - n if number else zero).alias("_odd"),
            (F.col(f"_lo{i}") if number else none).alias("_lo"), (F.col(f"_hi{i}") if number else none).alias("_hi"))

    wide = flat.groupBy(*ids).agg(*aggs)
    fine = wide.select(*ids, F.explode(F.array(*[entry(i, c) for i, c in enumerate(columns + categorical)])).alias("_e")).select(*ids, "_e.*")
    keys = [*by, *(WINDOW if granularities else []), *SLICE, "column_name"]
    n = F.col("_state.n")
    merged = _merged(_spread(fine, slices, granularities), [*keys, "_number"]).select(
        *keys, n.alias("count"), F.col("_null").alias("num_nulls"), F.col("_odd").alias("num_nan"),
        F.when(F.col("_number") & (n > 0), F.col("_state.mean")).alias("avg"), F.col("_lo").alias("min"), F.col("_hi").alias("max"),
        F.when(F.col("_number") & (n > 1), F.sqrt(F.col("_state.m2") / (n - 1))).alias("stddev"))
    found = value_counts(log, columns, categorical, slices, ts, granularities, by)
    found = found.filter((F.abs("num") < F.lit(float("inf"))) | F.col("txt").isNotNull())
    distinct = found.groupBy(*by, *CELL[:2], *(CELL[2:] if granularities else [])).agg(F.count(F.lit(1)).alias("distinct_count"))
    distinct = named(distinct, columns + categorical, slices, granularities)
    joined = join_on(merged, distinct, keys).withColumn("distinct_count", F.coalesce("distinct_count", F.lit(0)))
    return _public(joined)


def profile_table(
    log: DataFrame, ts: str, numeric: list[str], categorical: list[str], slices: list[str], label: str | None = None, pred: str | None = None,
    baseline: DataFrame | None = None, granularities: tuple[str, ...] = ("1 day", "1 week"), by: tuple[str, ...] = ("model_version",),
) -> DataFrame:
    """The published profile table, written once: a row per window, slice and column.

    ``log_type`` INPUT are the windows of the log, BASELINE the slices of the whole baseline table (no
    window). With ``label`` and ``pred`` each window and slice has one more row, column ``:table``, with the
    quality metrics; the columns of the other kind are NULL.
    """
    def nested(df: DataFrame, log_type: str) -> DataFrame:
        span = F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end")) if "window_start" in df.columns else (
            F.lit(None).cast("struct<start:timestamp,end:timestamp>"))
        grain = F.col("granularity") if "granularity" in df.columns else F.lit(None).cast("string")
        return df.select(
            span.alias("window"), grain.alias("granularity"), *by, "column_name", F.lit(log_type).alias("log_type"), *SLICE,
            "count", "num_nulls", "num_nan", "avg", "stddev", "min", "max", "distinct_count")

    parts = []
    if numeric or categorical:
        parts.append(nested(profile(log, ts, numeric, slices, granularities, by, categorical), "INPUT"))
    if baseline is not None:
        parts.append(nested(profile(baseline, ts, numeric, slices, (), by, categorical), "BASELINE"))
    if label and pred:
        parts.append(quality(log, ts, label, pred, slices, granularities, by))
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part, allowMissingColumns=True)
    return materialize(table, "profile-metrics")


def quality(
    log: DataFrame, ts: str, label: str, pred: str, slices: list[str],
    granularities: tuple[str, ...] = ("1 day", "1 week"), by: tuple[str, ...] = ("model_version",),
    log_type: str = "INPUT",
) -> DataFrame:
    """Profile rows of the whole table (column ``:table``): accuracy, and precision, recall and
    F1 as struct(weighted, macro, one_vs_all)."""
    ids = [*by, "_cell", *[f"_slice_{s}" for s in slices]]
    flat = log.select(
        *by, F.date_trunc(_cell_unit(granularities), F.col(ts)).alias("_cell"), *_slice_cols(slices), label, pred)
    keys = [*by, *WINDOW, *SLICE]
    found = (
        _spread(cells(flat, label, pred, ids), slices, granularities)
        .groupBy(*keys, "label", "prediction").agg(F.sum("n").alias("n"))
    )
    per_class = class_rows(found, keys)
    # A group holds one row per class here.
    scored = averages(per_class, keys, *[
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("class").cast("string"), F.col(m))))).alias(f"_{m}")
        for m in ("precision", "recall", "f1_score")
    ])
    structs = [
        F.struct(F.col(f"{m}_weighted").alias("weighted"), F.col(f"{m}_macro").alias("macro"),
                 F.col(f"_{m}").alias("one_vs_all")).alias(m)
        for m in ("precision", "recall", "f1_score")
    ]
    return _public(scored).select(
        F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end")).alias("window"),
        "granularity", *by, F.lit(":table").alias("column_name"), F.lit(log_type).alias("log_type"),
        *SLICE, F.col("support").alias("count"), F.col("accuracy").alias("accuracy_score"), *structs,
    )


# --- drift -------------------------------------------------------------------------------

def ks_pvalue(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sample p-value; the series is 1 to double precision below 0.2."""
    lam = F.sqrt(n * m / (n + m)) * d
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(100)),
        lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam),
    )
    total = F.aggregate(terms, F.lit(0.0), lambda a, t: a + t) * 2.0
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))


#: Up to this product of the two sizes the KS p-value is counted, above it the series is used.
EXACT_KS = 10_000


def lattice_tail(n: int, m: int, h: int) -> float:
    """Share of the orders of n and m values whose shares differ somewhere by h / (n m) or more.

    An order is a path over the n x m lattice. Paths that have left the band are counted column by
    column, beside all paths: below the band every path counts, inside it those that left it earlier
    go on, above it every path counts again. Counts stay below 1e60 and nothing is subtracted.
    """
    n, m = min(n, m), max(n, m)
    at = np.arange(m + 1, dtype="int64") * n
    paths = np.ones(m + 1)
    left = (at >= h).astype("float64")
    for i in range(1, n + 1):
        left = np.cumsum(np.where(i * m - at >= h, paths, left))
        paths = np.cumsum(paths)
        left = np.where(at - i * m >= h, paths, left)
    return float(left[-1] / paths[-1])


@F.pandas_udf(T.DoubleType())
def ks_counted(distance: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    """Exact two-sample p-value; called on result rows only, NULL where an argument is."""
    out = [
        None if pd.isna(d) or pd.isna(a) or pd.isna(b) else lattice_tail(int(a), int(b), round(d * a * b))
        for d, a, b in zip(distance, n, m)]
    return pd.Series(out, dtype=object)


def _upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma: power series below a + 1, continued fraction above."""
    if x <= 0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1.0 - front * total)
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 100_000):
        an = -i * (i - a)
        b += 2
        d = 1 / ((an * d + b) or tiny)
        c = (b + an / c) or tiny
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return front * h


@F.pandas_udf(T.DoubleType())
def chi2_pvalue(statistic: pd.Series, df: pd.Series) -> pd.Series:
    """Upper tail of the chi-squared law; called on result rows only, one per group."""
    def tail(x, k):
        if pd.isna(x) or pd.isna(k):
            return np.nan
        return 1.0 if k < 1 else _upper_gamma(k / 2.0, x / 2.0)
    out = pd.Series([tail(x, k) for x, k in zip(statistic, df)], dtype="float64")
    return out.astype(object).where(out.notna(), None)


def numeric_drift(
    base: DataFrame, cur: DataFrame, keys: list[str], extra: list[str],
    stats: tuple[str, ...] = ("ks", "wasserstein", "psi", "avg_delta"),
) -> DataFrame:
    """KS, Wasserstein-1, PSI and mean difference of value tables (keys, [extra], value, n).

    ``keys`` pair a current group with its baseline, ``extra`` are further keys of the
    current side (its windows). The baseline is never repeated per window: its cumulative
    count C(x) and sum S(x) are looked up at the current values in one ordered pass.

    Sums are taken of x, the value's distance from the least one of its baseline group, so that
    values with a large offset keep their digits; order and bins follow the value itself. NaN and
    infinite values are left out, as NULL is.
    """
    group = keys + extra
    stats = set(stats)
    if not extra:
        return paired_drift(base, cur, keys, stats)
    finite = F.abs(F.col("value").cast("double")) < F.lit(float("inf"))
    base, rows = base.filter(finite), cur.filter(finite)
    n, value, mass = F.col("n"), F.col("value"), F.col("n") * F.col("x")
    tables = base, rows
    if stats & {"wasserstein", "avg_delta"}:
        # One row per baseline group, written, so that the planner joins it by its real size.
        least = materialize(base.groupBy(*keys).agg(F.min("value").alias("_least")), "drift-least")
        base, rows = (
            df.join(least, keys).withColumn("x", value.cast("double") - F.col("_least").cast("double")).drop("_least")
            for df in tables)
    else:
        base, rows = (df.withColumn("x", value.cast("double")) for df in tables)
    shapes = bool(stats & {"ks", "wasserstein"})
    bits = 10
    if shapes:
        bits = bucket_bits(sum(df.count() for df in tables))
        at_value = value_bucket(value, bits)
        cum = materialize(running(rows.select(*group, "value", "x", "n"), group, ["value"], at_value, {
            "cum": ("sum", n), "size": ("total", n), "next": ("next", F.col("x")),
        }), "drift-cum")
        both = cum.withColumns({"is_base": F.lit(False), "b": F.lit(0).cast("bigint"), "bv": F.lit(0.0)}).unionByName(
            base.select(*keys, "value", "x", F.lit(True).alias("is_base"), n.alias("b"), mass.alias("bv")),
            allowMissingColumns=True)
        b, bv = F.col("b"), F.col("bv")
        seen = materialize(running(both, keys, ["value"], at_value, {
            "c_le": ("sum", b), "s_le": ("sum", bv), "c_lt": ("sum", b, ["value", "is_base"]),
            "n_base": ("total", b), "mass_base": ("total", bv),
        }), "drift-seen")
        knots, rows = seen.filter("is_base"), seen.filter(~F.col("is_base"))
    elif "psi" in stats:
        knots = running(base, keys, ["value"], value_bucket(value), {
            "c_le": ("sum", n), "n_base": ("total", n), "mass_base": ("total", mass)})
    else:
        knots = base.groupBy(*keys).agg(F.sum("n").alias("n_base"), F.sum(mass).alias("mass_base"))

    # One small row per baseline group: size, sum and, for PSI, decile edges with bin counts.
    facts = [F.max("n_base").alias("n_base"), F.max("mass_base").alias("mass_base")]
    if "psi" in stats:
        facts += [
            F.min(F.when(F.col("c_le") * 10 >= F.col("n_base") * i, F.struct(value.alias("v"), F.col("c_le").alias("c")))).alias(f"_e{i}")
            for i in range(1, 10)
        ]
    info = knots.groupBy(*keys).agg(*facts)
    if "psi" in stats:
        upto = [F.lit(0).cast("bigint"), *[F.col(f"_e{i}.c") for i in range(1, 10)], F.col("n_base")]
        info = info.select(
            *keys, "n_base", "mass_base", F.array(*[F.col(f"_e{i}.v") for i in range(1, 10)]).alias("edges"),
            F.array(*[F.greatest(upto[i + 1] - upto[i], F.lit(0)) for i in range(10)]).alias("b_bins"))

    # Written, so that the planner joins it by its real size.
    rows = rows.drop("n_base", "mass_base").join(materialize(info, "drift-info"), keys)
    nb = F.col("n_base")
    if shapes:
        rows = rows.withColumns({
            "share": F.col("cum") / F.col("size"), "share_before": (F.col("cum") - n) / F.col("size"),
            "base_share": F.col("c_le") / nb, "base_share_before": F.col("c_lt") / nb,
        }).withColumn("gap", F.greatest(
            F.abs(F.col("share") - F.col("base_share")), F.abs(F.col("share_before") - F.col("base_share_before"))))
        rows = _add_area(rows, knots, keys, extra, bits) if "wasserstein" in stats else rows.withColumn("area", F.lit(0.0))

    sums = [F.sum(n).alias("n_cur"), F.sum(mass).alias("mass_cur"), F.max("n_base").alias("n_base"), F.max("mass_base").alias("mass_base")]
    if shapes:
        sums += [F.max("gap").alias("gap"), F.greatest(F.lit(0.0), F.sum("area")).alias("area")]
    if "psi" in stats:
        at = bin_of(value, F.col("edges"))
        sums += [F.max("b_bins").alias("b_bins"),
                 F.array(*[F.sum(F.when(at == i, n).otherwise(0)) for i in range(10)]).alias("c_bins")]
    found = rows.groupBy(*group).agg(*sums)

    return _statistics(found, group, stats, F.col("mass_cur") / F.col("n_cur") - F.col("mass_base") / nb)


def _statistics(found: DataFrame, group: list[str], stats: set[str], delta: Column) -> DataFrame:
    """The numeric statistics of groups from n_base, n_cur and, as far as they are asked for, gap, area and bin counts."""
    nb = F.col("n_base")
    enough = (F.col("n_cur") > 1) & (nb > 1)
    out = []
    if "ks" in stats:
        sizes = F.col("n_cur").cast("double"), nb.cast("double")
        few = enough & (sizes[0] * sizes[1] <= EXACT_KS)
        counted = ks_counted(F.when(few, F.col("gap")), F.when(few, F.col("n_cur")), F.when(few, nb))
        out += [F.when(enough, F.col("gap")).alias("ks_statistic"),
                F.when(few, counted).when(enough, ks_pvalue(F.col("gap"), *sizes)).alias("ks_pvalue")]
    if "wasserstein" in stats:
        out.append(F.when(enough, F.col("area")).alias("wasserstein_distance"))
    if "psi" in stats:
        index = F.aggregate(
            F.zip_with("b_bins", "c_bins", lambda b, c: _psi_term(c / F.col("n_cur"), b / nb)), F.lit(0.0), lambda s, t: s + t)
        out.append(F.when(enough, index).alias("population_stability_index"))
    if "avg_delta" in stats:
        out.append(delta.alias("avg_delta"))
    return found.select(*group, "n_base", "n_cur", *out)


def paired_drift(base: DataFrame, cur: DataFrame, keys: list[str], stats: set[str]) -> DataFrame:
    """numeric_drift where each baseline group has one current group, in a single ordered pass over both.

    With B and C the two cumulative shares after a value and d the way to the next value of either side, the distance
    is the sum of |B - C| d and the mean difference that of (B - C) d, so neither needs sums of values. Counts at or below
    the baseline's decile edges are the least cumulative counts where the baseline has reached i tenths.
    """
    value, n = F.col("value"), F.col("n")
    none = F.lit(0).cast("bigint")
    sides = base.select(*keys, "value", n.alias("b"), none.alias("c")).unionByName(cur.select(*keys, "value", none.alias("b"), n.alias("c")))
    sides = sides.filter(F.abs(value.cast("double")) < F.lit(float("inf")))
    seen = running(sides, keys, ["value"], value_bucket(value, bucket_bits(sides.count())), {
        "b_le": ("sum", F.col("b")), "c_le": ("sum", F.col("c")), "next": ("next", value),
        "n_base": ("total", F.col("b")), "n_cur": ("total", F.col("c")),
    }).filter("n_base > 0 and n_cur > 0")
    nb, nc, b_le, c_le = (F.col(c) for c in ("n_base", "n_cur", "b_le", "c_le"))
    # Whole numbers up to the division by both sizes at the end.
    step = F.coalesce((b_le.cast("double") * nc - c_le.cast("double") * nb) * (F.col("next").cast("double") - value.cast("double")), F.lit(0.0))
    sums = [F.max("n_base").alias("n_base"), F.max("n_cur").alias("n_cur"), F.max(F.abs(c_le / nc - b_le / nb)).alias("gap"),
            F.sum(F.abs(step)).alias("area"), F.sum(step).alias("shift")]
    if "psi" in stats:
        for i in range(1, 10):
            reached = b_le * 10 >= nb * i
            sums += [F.min(F.when(reached, b_le)).alias(f"_b{i}"), F.min(F.when(reached, c_le)).alias(f"_c{i}")]
    found = seen.groupBy(*keys).agg(*sums)
    sizes = nb.cast("double") * nc
    found = found.withColumns({"area": F.col("area") / sizes, "shift": F.col("shift") / sizes})
    if "psi" in stats:
        def bins(side: str, size: Column) -> Column:
            upto = [none, *[F.col(f"_{side}{i}") for i in range(1, 10)], size]
            return F.array(*[upto[i + 1] - upto[i] for i in range(10)])
        found = found.withColumns({"b_bins": bins("b", nb), "c_bins": bins("c", nc)})
    return _statistics(found, keys, stats, F.col("shift"))


#: Rank error of the first look at the baseline's deciles, as one in so many rows.
SKETCH = 10_000


def _long_numbers(df: DataFrame, numeric: list[str], slices: list[str], cell: list[Column]) -> DataFrame:
    """Finite values as rows (part, slice_value, [_cell], value), one per column and slice."""
    entries = [F.struct(F.lit(i).alias("_col"), F.col(c).cast("double").alias("value")) for i, c in enumerate(numeric)]
    long = df.select(*cell, *_slice_cols(slices), F.explode(F.array(*entries)).alias("_e")).filter(F.abs("_e.value") < F.lit(float("inf")))
    parts = [F.struct(F.col("_e._col").alias("part"), F.lit("").alias("slice_value"))]
    parts += [F.struct((F.col("_e._col") + i * len(numeric)).alias("part"), F.col(f"_slice_{s}").alias("slice_value")) for i, s in enumerate(slices, 1)]
    kept = ["_cell"] if cell else []
    return long.withColumn("_s", F.explode(F.array(*parts))).select("_s.*", *kept, F.col("_e.value").alias("value"))


def baseline_deciles(base: DataFrame, keys: list[str]) -> DataFrame:
    """Exact decile edges of each group of (keys, value) rows: keys, n_base, edges, b_bins.

    A sketch brackets each of the nine ranks, a second pass counts what lies below the brackets and the
    values inside them, which are few, and the edge is found among those. An edge is the least value
    with at least i tenths of the rows at or below it; b_bins are the rows of the ten bins. A bracket that
    misses its rank opens to the whole range.
    """
    i_s = range(1, 10)
    slack = 2.0 / SKETCH
    marks = [max(0.0, i / 10 - slack) for i in i_s] + [min(1.0, i / 10 + slack) for i in i_s]
    first = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_base"), F.percentile_approx("value", marks, SKETCH).alias("_q"))
    first = materialize(first, "psi-first")

    def brackets(known: DataFrame) -> DataFrame:
        rows = base.join(known, keys)
        sums = [F.count(F.when(F.col("value") < F.col("_q")[i - 1], 1)).alias(f"_below{i}") for i in i_s]
        below = rows.groupBy(*keys).agg(F.max("n_base").alias("n_base"), *sums)
        inside = F.filter(F.array(*[F.when((F.col("value") >= F.col("_q")[i - 1]) & (F.col("value") <= F.col("_q")[i + 8]), F.lit(i)) for i in i_s]),
                          lambda x: x.isNotNull())
        near = rows.select(*keys, "value", F.explode(inside).alias("_i")).groupBy(*keys, "_i", "value").agg(F.count(F.lit(1)).alias("_n"))
        below = below.select(*keys, "n_base", F.explode(F.array(*[
            F.struct(F.lit(i).alias("_i"), F.col(f"_below{i}").alias("_below")) for i in i_s])).alias("_b")).select(*keys, "n_base", "_b.*")
        ahead = Window.partitionBy(*keys, "_i").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
        near = near.withColumn("_cum", F.sum("_n").over(ahead)).join(below, [*keys, "_i"]).withColumn("_c", F.col("_below") + F.col("_cum"))
        reached = F.col("_c") * 10 >= F.col("n_base") * F.col("_i")
        return near.groupBy(*keys, "_i").agg(
            F.max("n_base").alias("n_base"), F.max("_below").alias("_below"), F.min(F.when(reached, F.struct(F.col("value").alias("v"), F.col("_c").alias("c")))).alias("_edge"))

    found = materialize(brackets(first), "psi-edges")
    right = F.col("_edge").isNotNull() & (F.col("_below") * 10 < F.col("n_base") * F.col("_i"))
    missed = found.filter(~F.coalesce(right, F.lit(False))).select(*keys).distinct()
    if not missed.isEmpty():
        lows = base.join(missed, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_base"), F.min("value").alias("_lo"), F.max("value").alias("_hi"))
        wide = lows.select(*keys, "n_base", F.concat(F.array_repeat("_lo", 9), F.array_repeat("_hi", 9)).alias("_q"))
        found = found.join(missed, keys, "left_anti").unionByName(brackets(wide))
    edges = found.groupBy(*keys).agg(F.max("n_base").alias("n_base"), *[F.max(F.when(F.col("_i") == i, F.col("_edge"))).alias(f"_e{i}") for i in i_s])
    upto = [F.lit(0).cast("bigint"), *[F.col(f"_e{i}.c") for i in i_s], F.col("n_base")]
    return edges.select(
        *keys, "n_base", F.array(*[F.col(f"_e{i}.v") for i in i_s]).alias("edges"),
        F.array(*[F.greatest(upto[i + 1] - upto[i], F.lit(0)) for i in range(10)]).alias("b_bins"))


def numeric_psi(base: DataFrame, cur: DataFrame, ts: str, numeric: list[str], slices: list[str], granularities: tuple[str, ...]) -> DataFrame:
    """PSI of numeric columns per window and slice: rows are binned by their slice's edges before they spread over windows."""
    keys = CELL[:2]
    edges = materialize(baseline_deciles(_long_numbers(base, numeric, slices, []), keys), "psi-info")
    cell = F.date_trunc(_cell_unit(granularities), F.col(ts)).alias("_cell")
    rows = _long_numbers(cur, numeric, slices, [cell]).join(edges.select(*keys, "edges"), keys)
    counted = rows.groupBy(*keys, "_cell", bin_of(F.col("value"), F.col("edges")).alias("_bin")).agg(F.count(F.lit(1)).alias("n"))
    starts = [F.struct(F.lit(i).alias("grain"), F.date_trunc(GRAINS[g][0], F.col("_cell")).alias("window_start")) for i, g in enumerate(granularities)]
    spread = counted.withColumn("_w", F.explode(F.array(*starts))).select(*keys, "_bin", "n", "_w.*")
    bins = F.array(*[F.sum(F.when(F.col("_bin") == i, F.col("n")).otherwise(0)) for i in range(10)]).alias("c_bins")
    found = spread.groupBy(*CELL).agg(F.sum("n").alias("n_cur"), bins).join(edges.drop("edges"), keys)
    index = F.aggregate(F.zip_with("b_bins", "c_bins", lambda b, c: _psi_term(c / F.col("n_cur"), b / F.col("n_base"))), F.lit(0.0), lambda s, t: s + t)
    enough = (F.col("n_cur") > 1) & (F.col("n_base") > 1)
    return found.select(*CELL, "n_base", "n_cur", F.when(enough, index).alias("population_stability_index"))


def _add_area(rows: DataFrame, knots: DataFrame, keys: list[str], extra: list[str], bits: int) -> DataFrame:
    """Add each row's part of the integral of |Fb - Fc| over the axis of x, the centred value.

    Fc is a constant a between a current value c and the next one, d, while Fb rises. With
    G(x) = (x C(x) - S(x)) / Nb, the integral of Fb up to x, and t the place in [c, d] where
    Fb passes a, the part is a (2t - c - d) - 2 G(t) + G(c) + G(d). G(d) is left to the next
    row, which also sees from the shares below it whether t was its own value. Only where Fb
    passes a strictly between c and d is t a baseline value; those few rows find it in a pass
    ordered by cumulative share.
    """
    nb, c, d = F.col("n_base"), F.col("x"), F.col("next")
    a, fb = F.col("share"), F.col("base_share")
    g = (c * F.col("c_le") - F.col("s_le")) / nb
    has_next, has_previous = d.isNotNull(), F.col("cum") > F.col("n")
    at_start = fb >= a
    right = F.when(~has_next, ((F.col("mass_base") - F.col("s_le")) - c * (nb - F.col("c_le"))) / nb).otherwise(
        F.when(at_start, a * (c - d) - 2 * g).otherwise(0.0) + g)
    left = g - F.when(has_previous & (F.col("share_before") > F.col("base_share_before")), 2 * g).otherwise(0.0)
    rows = rows.withColumn("area", left + right)

    # Rows whose right part depends on where Fb reaches a: at d or before.
    open_rows = rows.filter(has_next & ~at_start).select(
        *[k for k in rows.columns if k not in ("area", "gap", "n", "edges", "b_bins")])
    knot = F.struct(F.col("x").alias("v"), F.col("c_le").alias("c"), F.col("s_le").alias("s"))
    marks = knots.select(*keys, (F.col("c_le") / nb).alias("share"), knot.alias("knot"))
    ranked = running(
        open_rows.withColumn("is_probe", F.lit(True)).unionByName(marks, allowMissingColumns=True), keys, ["share"],
        F.floor(F.col("share") * 2**bits), {"reach": ("min", F.col("knot"))}, descending=True,
    ).filter("is_probe")
    t = F.col("reach")
    passed = a * (2 * t["v"] - c - d) - 2 * (t["v"] * t["c"] - t["s"]) / nb
    parts = ranked.withColumn("area", F.when(t["v"] >= d, a * (d - c)).otherwise(passed))
    return rows.unionByName(parts.select(*keys, *extra, "area"), allowMissingColumns=True)


def _psi_term(c: Column, b: Column) -> Column:
    c, b = F.greatest(c, F.lit(FLOOR)), F.greatest(b, F.lit(FLOOR))
    return (c - b) * F.log(c / b)


def categorical_drift(base: DataFrame, cur: DataFrame, keys: list[str], extra: list[str]) -> DataFrame:
    """Chi-squared homogeneity test and PSI of value tables; NULL is a category of its own.

    Baseline categories that a window lacks enter through totals over the whole baseline
    minus the matched part, so the baseline is not repeated per window. A group's totals reach its
    categories in parts, so a group of millions of categories is no single task.
    """
    group = keys + extra
    def tidy(df: DataFrame) -> DataFrame:
        return df.withColumns({"absent": F.col("value").isNull(), "value": F.coalesce("value", F.lit(""))})

    cell = ["value", "absent"]
    b, c = tidy(base).withColumnRenamed("n", "b"), tidy(cur).withColumnRenamed("n", "c")
    told = group_totals(b, keys, cell, {"n_base": F.sum("b"), "k_base": F.count(F.lit(1))})
    b_all = told.groupBy(*keys).agg(
        F.max("n_base").alias("n_base"), F.max("k_base").alias("k_base"),
        F.sum(_psi_term(F.lit(0.0), F.col("b") / F.col("n_base"))).alias("gone_all"))
    paired = (
        group_totals(c, group, cell, {"n_cur": F.sum("c")}, b_all, keys)
        .join(b.select(*keys, *cell, "b"), [*keys, *cell], "left")
        .withColumn("b", F.coalesce("b", F.lit(0)))
    )
    bb, cc = F.col("b").cast("double"), F.col("c").cast("double")
    nb, nc = F.col("n_base").cast("double"), F.col("n_cur").cast("double")
    skew = bb * nc - cc * nb
    found = paired.groupBy(*group).agg(
        F.max("n_base").alias("n_base"), F.max("n_cur").alias("n_cur"), F.max("k_base").alias("k_base"),
        F.max("gone_all").alias("gone_all"),
        F.sum(skew * skew / ((bb + cc) * nb * nc)).alias("chi2_met"),
        F.sum("b").alias("b_met"), F.count(F.when(F.col("b") == 0, 1)).alias("k_new"),
        F.sum(_psi_term(cc / nc, bb / nb)).alias("psi_met"),
        F.sum(F.when(F.col("b") > 0, _psi_term(F.lit(0.0), bb / nb)).otherwise(0.0)).alias("gone_met"),
    )
    enough = (F.col("n_cur") > 1) & (F.col("n_base") > 1)
    statistic = F.col("chi2_met") + (F.col("n_base") - F.col("b_met")) * F.col("n_cur") / F.col("n_base")
    freedom = (F.col("k_base") + F.col("k_new") - 1).cast("double")
    return found.withColumns({
        "chi2_statistic": F.when(enough, statistic), "chi2_df": F.when(enough, freedom),
        "population_stability_index": F.when(enough, F.col("psi_met") + F.col("gone_all") - F.col("gone_met")),
    }).withColumn("chi2_pvalue", chi2_pvalue("chi2_statistic", "chi2_df")).select(
        *group, "n_base", "n_cur", "chi2_statistic", "chi2_df", "chi2_pvalue", "population_stability_index")


def _assemble(parts: list[DataFrame], drift_type: str) -> DataFrame:
    flat = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    statistics = ("ks_statistic", "ks_pvalue", "chi2_statistic", "chi2_pvalue",
                  "wasserstein_distance", "population_stability_index", "avg_delta")
    flat = flat.withColumns({c: F.lit(None).cast("double") for c in statistics if c not in flat.columns})
    return _public(flat).select(
        F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end")).alias("window"),
        "granularity", "column_name", F.lit(drift_type).alias("drift_type"), *SLICE,
        F.col("n_cur").alias("count"), F.col("n_base").alias("baseline_count"),
        F.struct(F.col("ks_statistic").alias("statistic"), F.col("ks_pvalue").alias("pvalue")).alias("ks_test"),
        F.struct(F.col("chi2_statistic").alias("statistic"), F.col("chi2_pvalue").alias("pvalue")).alias("chi_squared_test"),
        "wasserstein_distance", "population_stability_index", "avg_delta",
    )


STATS = ("ks", "chi2", "wasserstein", "psi", "avg_delta")


def _compare(base: DataFrame, cur: DataFrame, numeric: list[str], categorical: list[str],
             keys: list[str], extra: list[str], stats: tuple[str, ...]) -> list[DataFrame]:
    column = F.col("part") % (len(numeric) + len(categorical))

    def side(df: DataFrame, cols: Column, value: str) -> DataFrame:
        rest = [c for c in df.columns if c not in ("num", "txt")]
        return df.filter(cols).select(*rest, F.col(value).alias("value"))

    numbers, categories = column < len(numeric), column >= len(numeric)
    parts = []
    if numeric and set(stats) - {"chi2"}:
        parts.append(numeric_drift(side(base, numbers, "num"), side(cur, numbers, "num"), keys, extra, stats))
    if categorical and {"chi2", "psi"} & set(stats):
        parts.append(categorical_drift(side(base, categories, "txt"), side(cur, categories, "txt"), keys, extra))
    return parts


def drift_metrics(
    base: DataFrame, cur: DataFrame, ts: str, numeric: list[str], categorical: list[str],
    granularities: tuple[str, ...] = ("1 day", "1 week"), slices: tuple[str, ...] = (),
    stats: tuple[str, ...] = STATS,
) -> DataFrame:
    """Every window and slice of the current table against the same slice of the baseline.

    The value tables of both sides are written by one job to the shared folder, and all
    statistics read them. ``stats`` limits the work to some statistics, the columns of the
    others stay NULL.
    """
    slices = list(slices)
    if set(stats) == {"psi"} and numeric:
        numbers = named(numeric_psi(base, cur, ts, numeric, slices, granularities), numeric, slices, granularities)
        if not categorical:
            return _assemble([numbers], "BASELINE")
        b, c = value_counts(base, [], categorical, slices), value_counts(cur, [], categorical, slices, ts, granularities)
        texts = _compare(b, c, [], categorical, CELL[:2], CELL[2:], stats)
        return _assemble([numbers, *[named(p, categorical, slices, granularities) for p in texts]], "BASELINE")
    sides = value_counts(cur, numeric, categorical, slices, ts, granularities).withColumn("side", F.lit("cur"))
    sides = sides.unionByName(
        value_counts(base, numeric, categorical, slices).withColumn("side", F.lit("base")), allowMissingColumns=True)
    sides = materialize(sides, "drift-values", partition_by=("side",))
    b = sides.filter(F.col("side") == "base").drop("side", *CELL[2:])
    c = sides.filter(F.col("side") == "cur").drop("side")
    parts = _compare(b, c, numeric, categorical, CELL[:2], CELL[2:], stats)
    return _assemble([named(p, numeric + categorical, slices, granularities) for p in parts], "BASELINE")


def drift_consecutive(
    cur: DataFrame, ts: str, numeric: list[str], categorical: list[str],
    granularities: tuple[str, ...] = ("1 day", "1 week"), slices: tuple[str, ...] = (),
    stats: tuple[str, ...] = STATS,
) -> DataFrame:
    """Every window against the window just before it; a window without one gives no row."""
    slices = list(slices)
    now = materialize(value_counts(cur, numeric, categorical, slices, ts, granularities), "drift-cur")
    following = F.coalesce(*[
        F.when(F.col("grain") == i, F.col("window_start") + F.expr(GRAINS[g][1])) for i, g in enumerate(granularities)])
    parts = _compare(now.withColumn("window_start", following), now, numeric, categorical, CELL, [], stats)
    return _assemble([named(p, numeric + categorical, slices, granularities) for p in parts], "CONSECUTIVE")


def align_baseline(table: DataFrame) -> DataFrame:
    """Profile rows of each window with the baseline row of the same column and slice, from the published table."""
    cur, base = table.filter("log_type = 'INPUT' and column_name <> ':table'"), table.filter("log_type = 'BASELINE'")
    kept = base.select(*[F.col(c).alias(f"_{c}") for c in ("column_name", *SLICE)], F.col("avg").alias("baseline_avg"),
                       F.col("count").alias("baseline_count"))
    cond = F.lit(True)
    for c in ("column_name", *SLICE):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return cur.join(kept, cond, "left").drop(*[f"_{c}" for c in ("column_name", *SLICE)])
