"""Structured Streaming jobs: ingest, lookup, scoring and monitoring."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.functions.timeparts import GRAINS
from cardwatch.operators.features import lookup
from cardwatch.session import materialize
from cardwatch.sources.tables import landing_lines, read_features


def file_stream(spark: SparkSession, source: str, schema: T.StructType, pattern: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Files of a landing folder as a stream with a declared schema."""
    reader = spark.readStream.schema(schema).format(fmt)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(source)


def run_to_table(df: DataFrame, out: str, checkpoint: str, mode: str = "append", partition_by: tuple[str, ...] = ()) -> str:
    """Process what has arrived and stop. The file sink's log and the checkpoint make each
    input count exactly once over restarts."""
    writer = (
        df.writeStream.outputMode(mode).format("parquet").option("path", out)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start().awaitTermination()
    return out


def run_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process what has arrived in numbered micro-batches and stop; after a failure the same number comes again with the same rows."""
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def write_batch(rows: DataFrame, out: str, number: int) -> None:
    """A micro-batch's part of a table: its own folder, written over when the batch is repeated."""
    rows.write.mode("overwrite").parquet(f"{out}/batch={number}")


def read_batches(spark: SparkSession, out: str) -> DataFrame:
    """A table that ``write_batch`` has written, without the batch numbers."""
    return spark.read.parquet(out).drop("batch")


def ingest_stream(
    spark: SparkSession, source: str, schema: T.StructType, out: str, checkpoint: str, pattern: str | None = None,
    fmt: str = "parquet", rejects: str | None = None, files_per_batch: int | None = None,
) -> str:
    """Incremental ingest: a second run with the same checkpoint reads new files only.

    Lines of JSON or CSV files that cannot be read, or hold a value that is not of its declared type, go
    whole into ``rejects`` (by default ``out`` with the ending -rejects), as raw_line beside the columns that
    could be read. Both tables get their rows by micro-batch, so a batch that is repeated after a failure
    between the two writes loses and doubles nothing; read them with ``read_batches``.
    """
    if fmt not in ("json", "csv"):
        return run_to_table(file_stream(spark, source, schema, pattern), out, checkpoint)
    reader = landing_lines(spark.readStream, schema, fmt)
    options = {"pathGlobFilter": pattern, "maxFilesPerTrigger": files_per_batch}
    for name, value in options.items():
        if value:
            reader = reader.option(name, value)
    other, bad = rejects or f"{out.rstrip('/')}-rejects", F.col("raw_line").isNotNull()

    def land(lines: DataFrame, number: int) -> None:
        write_batch(lines.filter(bad), other, number)
        write_batch(lines.filter(~bad).drop("raw_line"), out, number)

    run_batches(reader.load(source), land, checkpoint)
    return out


def stream_lookup(stream: DataFrame, features: str, use: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, key: str = "card_id") -> str:
    """Left join of each micro-batch with the version of the feature table that is newest when the batch begins.

    ``features`` is the folder of ``publish_features``. The join is stateless; ``use`` turns its rows into
    those of the table ``out``, to be read with ``read_batches``.
    """
    def enrich(rows: DataFrame, number: int) -> None:
        write_batch(use(lookup(rows, read_features(rows.sparkSession, features), key, "left")), out, number)

    run_batches(stream, enrich, checkpoint)
    return out


def stream_score(
    stream: DataFrame, features: str, score: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, key: str = "card_id",
) -> str:
    """Enrich, score and append to the inference log; ``score`` may be a rule or ``score_model`` with a fitted model."""
    return stream_lookup(stream, features, score, out, checkpoint, key)


def stream_monitor(
    stream: DataFrame, ts: str, label: str, pred: str, delay: str = "1 day", granularity: str = "1 day",
    by: tuple[str, ...] = ("model_version",),
) -> DataFrame:
    """Rows and confusion cells per tumbling window; a window is final once the watermark has
    passed its end, later rows are dropped. State is one small row per open window."""
    length = {"1 hour": "1 hour", "1 day": "1 day", "1 week": "7 days"}[granularity]
    # Epoch day 0 is a Thursday: weeks are moved to start on Monday.
    frame = F.window(ts, length, startTime="4 days") if granularity == "1 week" else F.window(ts, length)
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")

    def hits(a: int, b: int):
        return F.count(F.when((y == a) & (p == b), 1))

    return (
        stream.withWatermark(ts, delay).groupBy(frame.alias("window"), *by)
        .agg(F.count(F.lit(1)).alias("n"), hits(1, 1).alias("tp"), hits(0, 1).alias("fp"),
             hits(1, 0).alias("fn"), hits(0, 0).alias("tn"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                F.lit(granularity).alias("granularity"), *by, "n", "tp", "fp", "fn", "tn")
    )


def refresh(log: DataFrame, new_rows: DataFrame, ts: str, build: Callable[[DataFrame], DataFrame], path: str,
            granularities: tuple[str, ...] = ("1 day", "1 week")) -> str:
    """Recompute only the windows that new rows touch and replace just those partitions.

    ``build`` turns log rows into metric rows with granularity and window_start. Per
    granularity the log is cut to the touched windows by a semi join on the window start,
    a list with one row per touched window. First and last touched window are read as one
    row, so that a plain time range reaches the scan. A touched window that has no rows any
    more loses its partition.
    """
    for name in granularities:
        unit, length = GRAINS[name]
        touched = new_rows.select(F.date_trunc(unit, F.col(ts)).alias("_start")).distinct()
        span = touched.agg(F.min("_start").alias("low"), (F.max("_start") + F.expr(length)).alias("high")).first()
        if span["low"] is None:
            continue
        inside = (F.col(ts) >= F.lit(span["low"])) & (F.col(ts) < F.lit(span["high"]))
        rows = log.filter(inside).withColumn("_start", F.date_trunc(unit, F.col(ts))).join(touched, "_start", "left_semi")
        built = materialize(build(rows.drop("_start")).filter(F.col("granularity") == name), "refresh")
        (
            built.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("granularity", "window_start").parquet(path)
        )
        emptied = touched.select(F.col("_start").alias("window_start")).join(built, "window_start", "left_anti")
        table = log.sparkSession.read.schema(built.schema).parquet(path)
        drop_windows(table.filter(F.col("granularity") == name), emptied)
    return path


def drop_windows(table: DataFrame, starts: DataFrame) -> None:
    """Remove the partitions of some windows; the driver sees one folder name per window."""
    spark = table.sparkSession
    stale = table.select("window_start", "_metadata.file_path").join(starts, "window_start", "left_semi")
    folders = stale.select(F.regexp_replace("file_path", "/[^/]*$", "").alias("folder")).distinct()
    for row in folders.toLocalIterator():
        folder = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(row["folder"]))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
