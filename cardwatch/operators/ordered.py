"""Running totals, ranks and quantiles over ordered groups of any size.

A window over one group sorts that group in one task. Here a group is cut into buckets
that follow the ordering, each task sorts one (group, bucket), and the totals of the
earlier buckets are added afterwards. The bucket totals are one small row per bucket.
Results are exact: the bucket only decides where the work is done.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.functions.columns import join_on
from cardwatch.session import materialize

#: Buckets that a group is cut into at its own quantiles.
SPLITS = 64
#: Parts by hash that a group's rows get its totals in.
HASHED = 256
_AGG = {"sum": F.sum, "min": F.min, "max": F.max, "next": F.min, "total": F.sum}


def running(
    df: DataFrame,
    by: list[str],
    order: list[str],
    bucket: Column | None,
    aggs: dict[str, tuple],
    *,
    descending: bool = False,
) -> DataFrame:
    """Add running aggregates of ``by`` groups in the given order.

    ``aggs`` maps an output name to (kind, column) or (kind, column, order override):

    * sum, min, max: over the rows up to this one; rows equal in the order count as one
      position, as in a RANGE frame;
    * next: the column's value in the following row (not NULL, one row per position);
    * total: the sum over the whole group.

    ``bucket`` must not decrease along the first order column. Without one the first order column, a
    number, is cut at quantiles of the group itself, so buckets are even wherever the values lie. NULL is
    a group like any other.
    """
    rows = split_by_value(df, by, order[0]) if bucket is None else df.withColumn("_bucket", bucket)
    totals = rows.groupBy(*by, "_bucket").agg(
        *[_AGG[kind](col).alias(f"_t_{name}") for name, (kind, col, *_) in aggs.items()]
    )
    step = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    whole = Window.partitionBy(*by)
    ordered = whole.orderBy(step)

    def elsewhere(name: str, kind: str) -> Column:
        total = F.col(f"_t_{name}")
        if kind == "total":
            return F.sum(total).over(whole)
        if kind == "next":
            return F.lead(total).over(ordered)
        return _AGG[kind](total).over(ordered.rowsBetween(Window.unboundedPreceding, -1))

    offsets = totals.select(
        *by, "_bucket", *[elsewhere(name, kind).alias(f"_o_{name}") for name, (kind, *_) in aggs.items()])

    def local(kind: str, col: Column, cols: list[str]) -> Column:
        keys = [F.col(c).desc() if descending else F.col(c).asc() for c in cols]
        frame = Window.partitionBy(*by, "_bucket").orderBy(*keys)
        if kind == "next":
            return F.lead(col).over(frame)
        return _AGG[kind](col).over(frame.rangeBetween(Window.unboundedPreceding, Window.currentRow))

    # Finer orders first: their sort also serves the coarser order.
    plain = {name: local(kind, col, order) for name, (kind, col, *other) in aggs.items() if kind != "total" and not other}
    finer = {name: local(kind, col, other[0]) for name, (kind, col, *other) in aggs.items() if other}
    for group in (finer, plain):
        if group:
            rows = rows.select("*", *[c.alias(f"_l_{name}") for name, c in group.items()])
    joined = join_on(rows, offsets, [*by, "_bucket"])

    def combine(name: str, kind: str) -> Column:
        here, other = F.col(f"_l_{name}"), F.col(f"_o_{name}")
        if kind == "total":
            return other
        if kind == "next":
            return F.coalesce(here, other)
        if kind == "sum":
            return F.coalesce(here + other, here, other)
        return F.least(here, other) if kind == "min" else F.greatest(here, other)

    return joined.select(
        *[F.col(c) for c in df.columns],
        *[combine(name, kind).alias(name) for name, (kind, *_) in aggs.items()],
    )


def group_totals(
    df: DataFrame, by: list[str], spread: list[str], sums: dict[str, Column],
    facts: DataFrame | None = None, on: list[str] | None = None,
) -> DataFrame:
    """Add sums over the whole ``by`` group to its rows; rows with a NULL in ``by`` are left out.

    Partial sums per (group, hash of ``spread``) are added up and come back to the rows by both, so
    no task gets a whole group. ``facts``, one row per ``on``, join the partial sums and come along.
    """
    rows = df.withColumn("_bucket", F.pmod(F.xxhash64(*spread), F.lit(HASHED)))
    whole = Window.partitionBy(*by)
    totals = rows.groupBy(*by, "_bucket").agg(*[c.alias(name) for name, c in sums.items()]).select(
        *by, "_bucket", *[F.sum(name).over(whole).alias(name) for name in sums])
    if facts is not None:
        totals = totals.join(facts, on)
    return rows.join(totals, [*by, "_bucket"]).drop("_bucket")


def split_by_value(df: DataFrame, by: list[str], value: str, parts: int = SPLITS) -> DataFrame:
    """Add _bucket, 0 to ``parts`` - 1, which follows ``value`` within each group and holds about as many rows each.

    ``df`` and the groups' splitters are written, so that every later branch sees the same buckets; the
    splitters are approximate quantiles, any of which give exact results. Equal values share a bucket.
    """
    table = materialize(df, "ordered-rows")
    shares = [i / parts for i in range(1, parts)]
    marks = table.groupBy(*by).agg(F.percentile_approx(F.col(value).cast("double"), shares, 20 * parts).alias("_marks"))
    marked = join_on(table, materialize(marks, "ordered-marks"), by)
    return marked.withColumn("_bucket", bin_of(F.col(value).cast("double"), F.array_distinct("_marks"))).drop("_marks")


def bucket_bits(rows: int, per_bucket: int = 250_000) -> int:
    """Bits for value_bucket that keep an evenly spread group near ``per_bucket`` rows."""
    return max(2, min(16, math.ceil(math.log2(max(1.0, rows / per_bucket)))))


def rank_by_hash(df: DataFrame, by: list[str], key: str, seed: int) -> DataFrame:
    """Add hash_rank, the 1-based position in the md5(key:seed) order of the group, and
    group_size; keys are unique."""
    hashed = df.withColumn("_hash", F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))))
    # 4096 even buckets: a group with a third of all rows is ranked by 4096 tasks.
    bucket = F.substring("_hash", 1, 3)
    one = F.lit(1)
    return running(
        hashed, by, ["_hash"], bucket, {"hash_rank": ("sum", one), "group_size": ("total", one)}).drop("_hash")


def hash_cuts(df: DataFrame, by: list[str], key: str, seed: int, share: float) -> DataFrame:
    """Per group the md5(key:seed) up to which the first round(share * n) keys lie; groups where that is none are left out.

    A histogram of 4,096 even ranges of hashes finds the range of the cut, and only the hashes in it are
    ordered; the rows themselves are not moved.
    """
    hashed = df.select(*by, F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))).alias("_hash"))
    ranges = hashed.groupBy(*by, F.substring("_hash", 1, 3).alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*by)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    need = F.round(F.sum("_n").over(whole) * F.lit(share)).cast("long")
    marked = ranges.select(*by, "_range", "_n", need.alias("_need"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    cuts = materialize(marked.filter((F.col("_need") > F.col("_before")) & (F.col("_need") <= F.col("_before") + F.col("_n"))), "hash-cuts")
    close = join_on(hashed, cuts, by, "inner").filter(F.substring("_hash", 1, 3) == F.col("_range"))
    place = F.row_number().over(Window.partitionBy(*by).orderBy("_hash"))
    last = close.withColumn("_place", place).filter(F.col("_place") == F.col("_need") - F.col("_before"))
    return materialize(last.select(*by, F.col("_hash").alias("hash_cut")), "hash-cut")


def value_table(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Rows per distinct non-NULL value; combined on the map side before the shuffle."""
    return df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))


def _cumulated(counts: DataFrame, by: list[str], value: str) -> DataFrame:
    n = F.col("n")
    return running(counts, by, [value], None, {"_cum": ("sum", n), "_size": ("total", n)})


def exact_quantiles(counts: DataFrame, by: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Interpolated quantiles per group from a value table, one output column per entry."""
    parts = []
    for name, p in probs.items():
        at = (F.col("_size") - 1) * F.lit(float(p))
        v = F.col(value).cast("double")
        parts += [
            F.min(F.when(F.col("_cum") > F.floor(at), v)).alias(f"_lo_{name}"),
            F.min(F.when(F.col("_cum") > F.ceil(at), v)).alias(f"_hi_{name}"),
            F.max(at - F.floor(at)).alias(f"_f_{name}"),
        ]
    found = _cumulated(counts, by, value).groupBy(*by).agg(*parts)
    return found.select(*by, *[
        (F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * F.col(f"_f_{name}")).alias(name)
        for name in probs
    ])


def bin_of(value: Column, edges: Column) -> Column:
    """Number of edges below the value: bins are closed on the right, the outer ones open."""
    return F.size(F.filter(edges, lambda e: e < value))


def heavy_keys(df: DataFrame, key: str, limit: int, max_keys: int = 1_000_000) -> DataFrame:
    """Keys with more than ``limit`` rows and more than a ``max_keys``-th part of all rows.

    The second condition bounds the list at ``max_keys`` keys whatever the table size, so it
    may be broadcast. It is a pure function of the counts, the same in every plan branch.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    return counts.filter((F.col("_rows") > limit) & (F.col("_rows") * max_keys > total)).select(key)
