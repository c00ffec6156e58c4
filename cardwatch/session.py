"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "cardwatch", master: str | None = None, **conf: str) -> SparkSession:
    """Session for jobs and tests; cluster sizes come from spark-submit, not from here."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # A call site per column expression costs more than planning a wide query.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def pin(spark: SparkSession) -> SparkSession:
    """Calendar functions follow the session zone, so every job runs in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder named by spark.checkpoint.dir; every executor must reach it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="cardwatch-")
    raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")


def fresh_path(spark: SparkSession, name: str) -> str:
    """New path in the shared folder; a job never writes over what it reads."""
    return f"{shared_dir(spark)}/cardwatch/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once as a Parquet table and read it back.

    Cuts lineage: later branches scan the written table in place of repeating the
    upstream shuffles, and a lost executor costs a re-read only.
    """
    path = fresh_path(df.sparkSession, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
