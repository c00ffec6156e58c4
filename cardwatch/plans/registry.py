"""Register of queries: a Spark callable per key and, where SQL can say it, a SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.plans.data import SQL_VIEWS, Data
from cardwatch.session import pin

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def settle(value: Column | str, digits: int) -> Column:
    """Round for a comparison of two engines.

    A mean of amounts in cents often lies exactly between two rounded values, and the last
    bit, which depends on the order of summation, would decide. The value is moved by a
    thousandth of the last digit first; settle(x, n) in a SQL text means the same.
    """
    value = F.col(value) if isinstance(value, str) else value
    return F.round(value + F.lit(float(f"1e-{digits + 3}")), digits)


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: settle(c, n) for c, n in digits.items() if c in df.columns})


def expand_settle(sql: str) -> str:
    """Write settle(x, n) out as round((x) + 1e-(n+3), n)."""
    while (start := sql.rfind("settle(")) >= 0:
        depth, comma, at = 1, -1, start + len("settle(")
        first = at
        while depth:
            char = sql[at]
            depth += (char == "(") - (char == ")")
            if char == "," and depth == 1:
                comma = at
            at += 1
        digits = int(sql[comma + 1:at - 1])
        sql = f"{sql[:start]}round(({sql[first:comma]}) + 1e-{digits + 3}, {digits}){sql[at:]}"
    return sql


def with_views(views: tuple[str, ...], body: str) -> str:
    """Prefix a SQL text with the shared views it reads, in definition order."""
    wanted = set(views)
    for name in reversed(list(SQL_VIEWS)):
        if name in wanted:
            wanted |= set(SQL_VIEWS[name][0])
    ctes = [f"{name} as ({SQL_VIEWS[name][1].strip()})" for name in SQL_VIEWS if name in wanted]
    body = body.strip()
    if not ctes:
        return body
    head = "with " + ",\n".join(ctes)
    return f"{head},\n{body[5:]}" if body.startswith("with ") else f"{head}\n{body}"


def query(key: str, sql: str | None = None, views: tuple[str, ...] = ("txn",)):
    def register(fn: Callable[[Data], DataFrame]):
        QUERIES[key] = lambda spark, sf_dir: fn(Data(pin(spark), sf_dir))
        if sql is not None:
            ORACLES[key] = expand_settle(with_views(views, sql))
        return fn

    return register
