"""Run a query and its SQL twin on the same tables and compare names, types and values."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from functools import lru_cache

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


@lru_cache(maxsize=4)
def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (date, str, int, bool)) or v is None:
        return v
    return str(v)


def compare(spark, folder: str, key: str, run, sql: str) -> str:
    """Empty text if both agree, else what differs."""
    df = run(spark, folder)
    rel = connect(folder).sql(sql)
    names = sorted(df.columns)
    if names != sorted(rel.columns):
        return f"columns {names} vs {sorted(rel.columns)}"
    kinds = dict(zip(rel.columns, [str(t) for t in rel.types]))
    bad = [f"{f.name}: {f.dataType.simpleString()} vs {kinds[f.name]}" for f in df.schema.fields
           if KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) != kinds[f.name]]
    mine = Counter(tuple(norm(r[c]) for c in names) for r in df.collect())
    pos = [rel.columns.index(c) for c in names]
    theirs = Counter(tuple(norm(r[i]) for i in pos) for r in rel.fetchall())
    if mine != theirs:
        only, other = mine - theirs, theirs - mine
        bad.append(f"rows {sum(mine.values())} vs {sum(theirs.values())}; {sum(only.values())} differ; "
                   f"{names}: {sorted(map(str, only))[:3]} vs {sorted(map(str, other))[:3]}")
    return "; ".join(bad)
