"""Table reads and writes over Parquet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.operators.features import key_check
from cardwatch.session import fresh_path


def scan(spark: SparkSession, path: str, schema: T.StructType | None = None, columns: list[str] | None = None) -> DataFrame:
    """Read a table; the column list reaches the Parquet reader. No row count is taken."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def scan_count(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table in one job; counts come from the Parquet footers."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """First n rows in a stated order; plans as a top-k, not as a full sort."""
    return df.orderBy(*order_by).limit(n)


def describe_schema(df: DataFrame) -> DataFrame:
    """Column names and types, as DESCRIBE TABLE gives them."""
    view = "described_table"
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(f"DESCRIBE TABLE {view}").select("col_name", "data_type")


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: tuple[str, ...] = (),
) -> str:
    """Append to or replace a table. Row counts belong to the reader of the result."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Read a table whose later appends added columns; older rows get NULL there."""
    return spark.read.option("mergeSchema", True).parquet(path)


def replace_schema(df: DataFrame, name: str) -> str:
    """Overwrite with another schema: a new version directory, so readers of the old one go on."""
    return write_table(df, fresh_path(df.sparkSession, name), mode="overwrite")


def replace_partition(df: DataFrame, path: str, key: str = "model_version") -> str:
    """Replace only the partitions that ``df`` holds; running it again changes nothing."""
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(key).parquet(path)
    )
    return path


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that a DELETE with this condition keeps; an unknown condition deletes nothing."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def ingest_batch(
    spark: SparkSession, source: str, schema: T.StructType, path: str, fmt: str = "json", rejects: str | None = None,
) -> str:
    """Load landing files with a declared schema into a raw table.

    Lines of JSON or CSV files that are malformed, or hold a value that is not of its declared
    type, go whole into the table ``rejects`` (by default ``path`` with the ending -rejects), as
    raw_line beside the columns that could be read. The landing files are parsed once for each
    of the two tables.
    """
    if fmt not in ("json", "csv"):
        return write_table(spark.read.schema(schema).format(fmt).load(source), path, mode="append")
    raw = "raw_line"
    lines = landing_lines(spark.read, schema, fmt, raw).load(source)
    bad = F.col(raw).isNotNull()
    write_table(lines.filter(bad), rejects or f"{path.rstrip('/')}-rejects", mode="append")
    return write_table(lines.filter(~bad).drop(raw), path, mode="append")


def typed_from_text(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast an all-text table to its declared types; text that is no value of the type, or beyond its width, becomes NULL."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def _folder(spark: SparkSession, path: str):
    """Hadoop path and its file system; works for any store that Spark reads."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def newest_version(spark: SparkSession, base: str) -> int:
    """Highest version below ``base`` that was written to its end, 0 where there is none."""
    folder, store = _folder(spark, base)
    if not store.exists(folder):
        return 0
    names = [status.getPath().getName() for status in store.listStatus(folder)]
    numbers = sorted((int(n.removeprefix("version=")) for n in names if n.startswith("version=")), reverse=True)
    return next((n for n in numbers if store.exists(_folder(spark, f"{base}/version={n}/_SUCCESS")[0])), 0)


def publish_features(df: DataFrame, base: str, key: str = "card_id") -> int:
    """Write a feature table as the next numbered version; readers find it once it is whole and its keys are checked.

    A version whose keys fail is left without its mark, so no reader takes it. One publisher at a time.
    """
    spark = df.sparkSession
    number = newest_version(spark, base) + 1
    path = f"{base}/version={number}"
    spark_marks = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    df.write.mode("overwrite").option(spark_marks, "false").parquet(path)
    verdict = key_check(spark.read.schema(df.schema).parquet(path), key).first()
    if verdict["status"] != "PASS":
        raise ValueError(f"{key}: {verdict['null_keys']} NULL and {verdict['duplicate_keys']} repeated keys")
    mark, store = _folder(spark, f"{path}/_SUCCESS")
    store.create(mark, True).close()
    return number


def read_features(spark: SparkSession, base: str) -> DataFrame:
    """The newest whole version of a feature table, a plain scan."""
    number = newest_version(spark, base)
    if not number:
        raise FileNotFoundError(f"no version of a feature table in {base}")
    return spark.read.parquet(f"{base}/version={number}")


def landing_lines(reader, schema: T.StructType, fmt: str, raw: str = "raw_line"):
    """``reader``, of a batch or a stream, that keeps lines which cannot be read as they are in a column of their own."""
    reader = reader.schema(T.StructType([*schema.fields, T.StructField(raw, T.StringType())])).format(fmt)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", raw)
    return reader.option("header", True) if fmt == "csv" else reader


def feature_table_write(df: DataFrame, path: str, key: str = "card_id", partition_by: tuple[str, ...] = ()) -> str:
    """Persist a feature table after its key check; the check looks at one result row only."""
    write_table(df, path, mode="overwrite", partition_by=partition_by)
    verdict = key_check(df.sparkSession.read.schema(df.schema).parquet(path), key).first()
    if verdict["status"] != "PASS":
        raise ValueError(f"{key}: {verdict['null_keys']} NULL and {verdict['duplicate_keys']} repeated keys")
    return path
