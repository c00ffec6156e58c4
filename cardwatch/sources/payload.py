"""Scoring requests and responses kept as JSON text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.functions.columns import join_on
from cardwatch.operators.ordered import exact_quantiles, value_table
from cardwatch.sources.tables import typed_from_text, write_table


def payload_records(df: DataFrame, body_col: str, schema: T.StructType) -> DataFrame:
    """One row per object of ``dataframe_records``; row_no keeps the order inside the request.

    Fields are read as text first, so that a bad scalar is seen by the type check and does
    not make the whole body NULL. An empty list gives no row. A body without a readable list
    gives one row whose row_no and fields are NULL, which ``check_signature`` rejects.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    body = T.StructType([T.StructField("dataframe_records", T.ArrayType(text))])
    return (
        df.withColumn("_body", F.from_json(body_col, body))
        .select(*[c for c in df.columns if c != body_col], *_entries(F.col("_body.dataframe_records"), text))
        .withColumn("row_no", _number())
        .select("*", "_row.*").drop("_row", "_read")
    )


def _entries(found: Column, kind: T.DataType) -> list[Column]:
    """The entries of a list with their places; one NULL entry in place of a list that is not there."""
    return [found.isNotNull().alias("_read"),
            F.posexplode(F.coalesce(found, F.array(F.lit(None).cast(kind)))).alias("row_no", "_row")]


def _number() -> Column:
    return F.when(F.col("_read"), F.col("row_no"))


def payload_split(df: DataFrame, body_col: str, schema: T.StructType) -> DataFrame:
    """One row per entry of ``dataframe_split.data``, matched to fields by column name.

    A cell that a short row lacks is NULL; of a repeated name the first column counts. A body
    without readable names and rows gives one row of NULLs, as in ``payload_records``.
    """
    body = T.StructType([T.StructField("dataframe_split", T.StructType([
        T.StructField("columns", T.ArrayType(T.StringType())),
        T.StructField("data", T.ArrayType(T.ArrayType(T.StringType()))),
    ]))])
    keep = [c for c in df.columns if c != body_col]
    part = F.col("_body.dataframe_split")
    readable = F.when(part["columns"].isNotNull(), part["data"])
    rows = (
        df.withColumn("_body", F.from_json(body_col, body))
        .select(*keep, part["columns"].alias("_names"), *_entries(readable, T.ArrayType(T.StringType())))
        .withColumn("row_no", _number())
    )

    def cell(name: str) -> Column:
        place = F.array_position("_names", F.lit(name)).cast("int")
        return F.try_element_at("_row", F.when(place > 0, place)).alias(name)

    return rows.select(*keep, "row_no", *[cell(f.name) for f in schema.fields])


def _type_fault(field: T.StructField) -> Column:
    """True where text is present but is not of the declared type."""
    col = F.col(field.name)
    if isinstance(field.dataType, (T.LongType, T.IntegerType)):
        return col.isNotNull() & col.try_cast("bigint").isNull()
    if isinstance(field.dataType, T.DoubleType):
        return col.isNotNull() & col.try_cast("double").isNull()
    return F.lit(False)


def check_signature(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add reject_reason: the first column that is missing or of another type, else NULL.

    A parsed body without a row_no could not be read at all.
    """
    reason = F.coalesce(*[
        F.when(F.col(f.name).isNull(), F.lit(f"missing {f.name}"))
        .when(_type_fault(f), F.lit(f"bad {f.name}"))
        for f in schema.fields
    ])
    if "row_no" in df.columns:
        reason = F.when(F.col("row_no").isNull(), F.lit("unreadable body")).otherwise(reason)
    return df.withColumn("reject_reason", reason)


def enforce_signature(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Split request rows into typed accepted rows and rejected rows with the reason."""
    checked = check_signature(df, schema)
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    wide = T.StructType([f for f in df.schema.fields if f.name in extra] + schema.fields)
    accepted = typed_from_text(checked.filter(F.col("reject_reason").isNull()), wide)
    return accepted, checked.filter(F.col("reject_reason").isNotNull())


def prediction_response(scored: DataFrame, request_id: str, row_no: str, prediction: str = "prediction") -> DataFrame:
    """One response body per request, predictions in request order.

    A group is the rows of a single request body, so its size is that of one message.
    """
    rows = F.sort_array(F.collect_list(F.struct(row_no, prediction)))
    return (
        scored.groupBy(request_id).agg(F.transform(rows, lambda r: r[prediction]).alias("predictions"))
        .select(request_id, F.to_json(F.struct("predictions")).alias("response"))
    )


def payload_log(
    requests: DataFrame, responses: DataFrame, path: str, request_id: str = "request_id", at: str = "request_time",
) -> str:
    """Append requests with their responses, partitioned by date for the monitor's pruning."""
    log = requests.join(responses, request_id, "left").withColumn("request_date", F.to_date(at))
    return write_table(log, path, mode="append", partition_by=("request_date",))


def usage_by_day(log: DataFrame, at: str, latency: str) -> DataFrame:
    """Requests, mean and 95th percentile latency per day, endpoint and requester."""
    by = ["usage_date", "endpoint", "requester"]
    rows = log.withColumn("usage_date", F.to_date(at))
    totals = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("requests"), F.avg(latency).alias("avg_latency"))
    p95 = exact_quantiles(value_table(rows, by, latency), by, latency, {"p95_latency": 0.95})
    return join_on(totals, p95, by)


def latest_per(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Newest row per key as one partial aggregate: no sort of the group is needed."""
    newest = F.max(F.struct(*order, *[c for c in df.columns if c not in order and c not in key])).alias("_top")
    return df.groupBy(*key).agg(newest).select(*key, "_top.*")


def latest_n(df: DataFrame, key: list[str], order: str, n: int = 2) -> DataFrame:
    """The n newest rows per key of a small version table, with their rank."""
    frame = Window.partitionBy(*key).orderBy(F.col(order).desc())
    return df.withColumn("recency", F.row_number().over(frame)).filter(F.col("recency") <= n)
