"""Column helpers. All of them stay inside generated JVM code."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clip(value: Column, low: float, high: float) -> Column:
    """Clamp to [low, high]; greatest and least skip NULLs, so NULL is kept by hand."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def pct_change(new: Column, old: Column) -> Column:
    """(new - old) / old in percent; NULL where old is 0."""
    return F.try_divide((new - old) * F.lit(100.0), old)


def safe_div(part: Column, whole: Column) -> Column:
    """part / whole, 0.0 where the denominator is 0 (zero-division rule of the reports)."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def hash_word(key: Column, seed: int) -> Column:
    """First 32 bits of md5(key:seed) as bigint; depends on the key only, not on partitions."""
    text = F.concat(key.cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def uniform(key: Column, seed: int) -> Column:
    """Repeatable uniform number in [0, 1) per key."""
    return hash_word(key, seed) / F.lit(4294967296.0)


def noise(key: Column, width: float, seed: int) -> Column:
    """Uniform noise of the given width centred on 0."""
    return (uniform(key, seed) - F.lit(0.5)) * F.lit(width)


def archive_alias(at: Column) -> Column:
    return F.concat(F.lit("archive_"), F.date_format(at, "yyyyMMdd_HHmmss"))


def padded_id(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def last_part(name: Column) -> Column:
    """Last dotted part of a table name."""
    return F.element_at(F.split(name, r"\."), -1)


def model_uri(name: Column, alias: Column) -> Column:
    return F.concat(F.lit("models:/"), name, F.lit("@"), alias)


def uri_alias(uri: Column) -> Column:
    return F.substring_index(uri, "@", -1)


def clean_name(name: Column) -> Column:
    """Drop a numbered alert prefix; names may not hold a slash."""
    return F.translate(F.trim(F.regexp_replace(name, r"^-- Alert \d+:\s*", "")), "/", "-")


def has_prefix(name: Column, prefixes: list[str]) -> Column:
    return reduce(or_, [name.startswith(p) for p in prefixes])


def recent(at: Column, as_of: str | None, days: int = 1) -> Column:
    """at >= as_of - days; as_of defaults to the current date and folds to a literal."""
    day = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return at >= F.date_sub(day, days).cast("timestamp")


def any_below(limits: dict[str, float]) -> Column:
    """OR of column < limit; a NULL column never fires."""
    return reduce(or_, [F.col(path) < F.lit(limit) for path, limit in limits.items()])


def value_bucket(value: Column, bits: int = 10) -> Column:
    """Bucket number that never decreases as the value grows.

    Sign, binary exponent and the first ``bits`` mantissa bits of a double. It needs no
    look at the data, so every task, retry and plan branch computes the same bucket, and
    one group has a bounded number of buckets (2**bits per power of two).
    """
    v = value.cast("double")
    size = F.abs(v)
    exponent = F.floor(F.log2(size))
    mantissa = F.floor(size / F.pow(F.lit(2.0), exponent) * F.lit(float(2**bits)))
    code = (exponent + F.lit(1100)) * F.lit(2 ** (bits + 1)) + mantissa
    top = F.lit(2200 * 2 ** (bits + 1))
    return (
        F.when(v.isNull(), F.lit(None).cast("bigint"))
        .when(F.isnan(v), top + 1)
        .when(v == 0, F.lit(0).cast("bigint"))
        .when(size > 1.7e308, F.when(v > 0, top).otherwise(-top))
        .otherwise(F.when(v > 0, code).otherwise(-code))
        .cast("bigint")
    )


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL, as groups have it; the keys of ``left`` stay."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(other, same, how).drop(*[f"_right_{k}" for k in keys])
