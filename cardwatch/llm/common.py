"""Helpers shared by the operators: reading, batches, gapless numbers, connected components."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwatch.session import materialize

#: Rows in one Arrow batch; texts may be long, so a batch holds few of them.
BATCH_ROWS = 512


#: Bytes of the longest word that a worker remembers; longer ones are worked out anew.
LONGEST_WORD = 64


def trimmed() -> None:
    """Give freed memory back to the system, where the C library can."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def worker_memory(owner: str) -> dict:
    """What an operator keeps in a worker process from task to task; what others kept there goes when it starts."""
    kept = pa.__dict__.setdefault("_operator_memories", {})
    if any(name != owner for name in kept):
        kept.clear()
        trimmed()
    return kept.setdefault(owner, {})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a table of the given folder; sets the batch size that the text operators need."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: pa.Schema) -> DataFrame:
    """Rows of the driver as a table, by Arrow: plain lists start Python workers of another kind, which stay beside the others."""
    cols = list(zip(*rows)) or [[]] * len(schema)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema))


def veiled(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with numbered column names, which clash with none of an operator's own, and where each went."""
    names = {c: f"col{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _marked(wanted: DataFrame, name: str) -> DataFrame:
    """Write ``wanted`` so that an inner join with it filters the other side by a Bloom filter of its keys.

    The limits on table sizes that keep Spark from that are lifted; the mark makes the filter eligible.
    """
    conf = wanted.sparkSession.conf
    conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")
    conf.set("spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold", "1t")
    return materialize(wanted.withColumn("own_mark", F.lit(1)), name).filter("own_mark = 1").drop("own_mark")


def found_rows(docs: DataFrame, wanted: DataFrame, name: str) -> DataFrame:
    """Rows of ``docs`` joined with ``wanted`` on doc_id = own_id and h = own_h, NULLs alike.

    Texts are large and often few of them are wanted, so the others go before the shuffle.
    """
    same = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("h") == F.col("own_h"))
    return docs.join(_marked(wanted, name), same)


def found_keys(rows: DataFrame, wanted: DataFrame, key: str, name: str) -> DataFrame:
    """Rows joined with ``wanted`` on ``key``, most others filtered out before the shuffle."""
    return rows.join(_marked(wanted, name), key)


def buckets_for(rows: int, rows_per_bucket: int) -> int:
    return max(1, math.ceil(rows / rows_per_bucket))


def numbered(df: DataFrame, by: Sequence[str], spread: Sequence[str], out: str, rows_per_bucket: int = 50_000,
             weight: Column | None = None) -> DataFrame:
    """Number the rows of every group from 0 without gaps, whatever the group's size.

    Rows are dealt into buckets by a hash of ``spread``, each (group, bucket) is numbered in its
    own task, and the earlier buckets' totals are added. With ``weight`` the number is the running
    total of the weights before the row. ``by`` must not hold NULLs and ``df`` should be a written
    table, as it is read three times. Rows equal in ``spread`` are numbered in any order.
    """
    n = buckets_for(df.count(), rows_per_bucket)
    step = F.lit(1).cast("long") if weight is None else weight.cast("long")
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*spread), F.lit(n))).withColumn("_step", step)
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy(*by, "_bucket").agg(F.sum("_step").alias("_n"))
        .select(*by, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy(*by, "_bucket").orderBy(*spread).rowsBetween(Window.unboundedPreceding, -1)
    return (
        dealt.withColumn("_before", F.coalesce(F.sum("_step").over(within), F.lit(0)))
        .join(offsets, [*by, "_bucket"])
        .withColumn(out, F.col("_offset") + F.col("_before"))
        .drop("_bucket", "_step", "_before", "_offset")
    )


def _signature(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (node, root) with root the smallest node reachable.

    Alternates large-star and small-star steps until a pass changes nothing; every step is a
    written table, so a lost executor costs a re-read. Only nodes that have an edge are returned.
    """
    cols = [F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")]
    links = materialize(edges.filter("a <> b").select(*cols).distinct(), f"{name}-links")
    while True:
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), f"{name}-large")
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        step = materialize(small.union(root.select("u", F.col("m").alias("v"))).distinct(), f"{name}-small")
        same = _signature(step) == _signature(links)
        links = step
        if same:
            break
    named = links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(links.select("v", "v"))
    return named.groupBy("node").agg(F.min("root").alias("root"))
