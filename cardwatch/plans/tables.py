"""Write paths with read-back, ingest, and request/response payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.functions.columns import padded_id
from cardwatch.plans.data import CHALLENGER, CHAMPION, Data
from cardwatch.plans.features import ALL_CARD_COLS, ROUND, _cards_sql
from cardwatch.plans.registry import query, rounded, settle
from cardwatch.schemas import EVENTS, REQUEST
from cardwatch.session import fresh_path
from cardwatch.sources import payload as pay
from cardwatch.sources import tables as src

EVENT_COLS = ["event_id", "user_id", "event_type", "value"]


def rows(d: Data) -> DataFrame:
    return d.table("events").select(*EVENT_COLS)


@query("write_append", "select event_id, user_id, event_type, value from events", ())
def write_append(d: Data):
    path = fresh_path(d.spark, "append")
    src.write_table(rows(d).filter(F.col("event_type") != "error"), path)
    src.write_table(rows(d).filter(F.col("event_type") == "error"), path, mode="append")
    return src.scan(d.spark, path, rows(d).schema)


@query("write_overwrite", "select event_id, user_id, event_type, settle(value * 2e0, 4) as value from events", ())
def write_overwrite(d: Data):
    path = fresh_path(d.spark, "overwrite")
    src.write_table(rows(d), path, mode="overwrite")
    src.write_table(rows(d).withColumn("value", settle(F.col("value") * 2, 4)), path, mode="overwrite")
    return src.scan(d.spark, path, rows(d).schema)


@query("write_partitioned", "select event_id, user_id, value, event_type from events where event_type in ('purchase', 'view')", ())
def write_partitioned(d: Data):
    path = src.write_table(rows(d), fresh_path(d.spark, "partitioned"), mode="overwrite", partition_by=("event_type",))
    return src.scan(d.spark, path, rows(d).schema).filter(F.col("event_type").isin("purchase", "view"))


@query("write_merge_schema", """
  select event_id, value, case when event_type = 'purchase' then user_id end as buyer,
         case when event_type not in ('purchase', 'view') then event_type end as kind from events""", ())
def write_merge_schema(d: Data):
    path = fresh_path(d.spark, "merged")
    src.write_table(rows(d).filter("event_type = 'view'").select("event_id", "value"), path)
    src.write_table(rows(d).filter("event_type = 'purchase'").select("event_id", "value", F.col("user_id").alias("buyer")), path)
    others = rows(d).filter("event_type not in ('purchase', 'view')").select("event_id", F.col("event_type").alias("kind"), "value")
    src.write_table(others, path)
    return src.read_merged(d.spark, path)


@query("write_replace_schema", "select event_id, settle(value * 100e0, 4) as cents from events", ())
def write_replace_schema(d: Data):
    src.replace_schema(rows(d), "versioned")
    path = src.replace_schema(rows(d).select("event_id", settle(F.col("value") * 100, 4).alias("cents")), "versioned")
    return d.spark.read.parquet(path)


@query("replace_partition", f"""
  select transaction_id, model_version, case when model_version = '{CHALLENGER}' then 1 - prediction else prediction end as prediction from log""", ("log",))
def replace_partition(d: Data):
    """The challenger's rows are replaced twice; the champion's partition stays as it is."""
    log = d.log.select("transaction_id", "prediction", "model_version")
    path = src.replace_partition(log, fresh_path(d.spark, "by-model"))
    again = log.filter(F.col("model_version") == CHALLENGER).withColumn("prediction", 1 - F.col("prediction"))
    for _ in range(2):
        src.replace_partition(again, path)
    return src.scan(d.spark, path, log.schema)


@query("delete_where", f"""
  select transaction_id, transaction_amount from log where not coalesce(model_version = '{CHAMPION}' and nullif(transaction_state, 'N/A') = 'ASIA', false)""", ("log",))
def delete_where(d: Data):
    state = F.when(F.col("transaction_state") != "N/A", F.col("transaction_state"))
    kept = src.delete_where(d.log, (F.col("model_version") == CHAMPION) & (state == "ASIA"))
    return kept.select("transaction_id", "transaction_amount")


@query("ingest_batch", """
  select event_id, ts, user_id, event_type, value, cast(null as varchar) as raw_line from events
  union all select null, null, null, null, null, concat('{"event_id": ', cast(event_id as varchar), ', "value"') from events where event_id % 50 = 0
  union all select null, null, null, null, null, concat('{"event_id":', cast(event_id as varchar), ',"value":"abc"}') from events where event_id % 50 = 1""", ())
def ingest_batch(d: Data):
    """Some events also arrive as a cut line, others as a line with a text in place of a number."""
    landing = fresh_path(d.spark, "landing")
    raw = d.table("events").select("event_id", "ts", "user_id", "event_type", "value")
    raw.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(landing)
    number = F.col("event_id").cast("string")
    cut = raw.filter("event_id % 50 = 0").select(F.concat(F.lit('{"event_id": '), number, F.lit(', "value"')))
    text = raw.filter("event_id % 50 = 1").select(F.concat(F.lit('{"event_id":'), number, F.lit(',"value":"abc"}')))
    cut.union(text).write.mode("append").text(landing)
    schema = T.StructType([f for f in EVENTS.fields if f.name != "props"])
    path, rejects = fresh_path(d.spark, "raw"), fresh_path(d.spark, "rejects")
    good = src.scan(d.spark, src.ingest_batch(d.spark, landing, schema, path, rejects=rejects), schema)
    return good.unionByName(d.spark.read.parquet(rejects).select("raw_line"), allowMissingColumns=True)


@query("feature_table_write", f"select card_id, {_cards_sql(ALL_CARD_COLS)} from cards", ("cards",))
def feature_table_write(d: Data):
    path = src.feature_table_write(d.cards, fresh_path(d.spark, "features"), partition_by=("home_state",))
    return rounded(src.scan(d.spark, path, d.cards.schema), ROUND)


@query("typed_from_text", """
  select event_id, case when event_id % 10 = 3 then null else value end as value,
         case when event_id % 10 = 4 then null else user_id end as user_id, event_type from events""", ())
def typed_from_text(d: Data):
    text = rows(d).select(
        F.col("event_id").cast("string"),
        F.when(F.col("event_id") % 10 == 3, "abc").otherwise(F.col("value").cast("string")).alias("value"),
        F.when(F.col("event_id") % 10 == 4, "1.x").otherwise(F.col("user_id").cast("string")).alias("user_id"), "event_type")
    schema = T.StructType([EVENTS["event_id"], EVENTS["value"], EVENTS["user_id"], EVENTS["event_type"]])
    return src.typed_from_text(text, schema)


# --- payloads ----------------------------------------------------------------------------
# A request holds the transactions whose number gives the same quotient by 4. Every tenth
# transaction has a bad amount, every tenth from 5 on a boolean flag.

FIELDS = [f.name for f in REQUEST.fields]
NUMBER = "cast(substr(transaction_id, 5) as bigint)"
REQ = f"""
  select concat('REQ_', lpad(cast({NUMBER} // 4 as varchar), 7, '0')) as request_id,
         cast({NUMBER} % 4 as int) as row_no, {NUMBER} % 10 as digit, card_id,
         strftime(date_trunc('second', transaction_timestamp), '%Y-%m-%d %H:%M:%S') as transaction_timestamp,
         transaction_amount, transaction_country, transaction_state, merchant_category, transaction_status,
         cast(is_vpn_used as bigint) as is_vpn_used, transaction_timestamp as event_at, prediction_champion as prediction from txn"""


def numbered(d: Data) -> DataFrame:
    number = F.substring("transaction_id", 5, 20).cast("bigint")
    return d.txn.withColumns({
        "number": number, "request_id": padded_id("REQ_", F.floor(number / 4), 7),
        "request_time": F.col("transaction_timestamp"),
        "transaction_timestamp": F.date_format("transaction_timestamp", "yyyy-MM-dd HH:mm:ss"),
        "is_vpn_used": F.col("is_vpn_used").cast("bigint"),
    })


def requests(d: Data, spoil: bool = False) -> DataFrame:
    """Request bodies of up to four rows in the records form."""
    amount, flag = F.col("transaction_amount").cast("string"), F.col("is_vpn_used").cast("string")
    if spoil:
        digit = F.col("number") % 10
        amount = F.when(digit == 0, "12,5").otherwise(amount)
        flag = F.when(digit == 5, "true").otherwise(flag)
    # Numbers and booleans stand unquoted in the body, as a caller writes them.
    item = F.concat(
        F.lit('{"card_id":"'), "card_id", F.lit('","transaction_timestamp":"'), "transaction_timestamp",
        F.lit('","transaction_amount":'), F.when(amount == "12,5", '"12,5"').otherwise(amount),
        F.lit(',"transaction_country":"'), "transaction_country", F.lit('","transaction_state":"'), "transaction_state",
        F.lit('","merchant_category":"'), "merchant_category", F.lit('","transaction_status":"'), "transaction_status",
        F.lit('","is_vpn_used":'), flag, F.lit("}"))
    parts = numbered(d).select("request_id", "number", "request_time", item.alias("item"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("number", "item"))), lambda x: x["item"]), ",")
    return parts.groupBy("request_id").agg(F.min("request_time").alias("request_time"), body.alias("items")).select(
        "request_id", "request_time", F.concat(F.lit('{"dataframe_records":['), "items", F.lit("]}")).alias("body"))


@query("payload_records", f"select request_id, row_no, {', '.join(FIELDS)} from ({REQ})")
def payload_records(d: Data):
    parsed = pay.payload_records(requests(d).drop("request_time"), "body", REQUEST)
    return src.typed_from_text(parsed, T.StructType([parsed.schema["request_id"], parsed.schema["row_no"]] + REQUEST.fields)).withColumn(
        "row_no", F.col("row_no").cast("int"))


@query("payload_split", f"select request_id, row_no, card_id, transaction_amount, merchant_category, is_vpn_used, cast(null as varchar) as transaction_country from ({REQ})")
def payload_split(d: Data):
    """Bodies name four of the fields, in another order."""
    cell = F.array(F.col("is_vpn_used").cast("string"), F.concat(F.lit('"'), "card_id", F.lit('"')),
                   F.col("transaction_amount").cast("string"), F.concat(F.lit('"'), "merchant_category", F.lit('"')))
    parts = numbered(d).select("request_id", "number", F.concat(F.lit("["), F.array_join(cell, ","), F.lit("]")).alias("item"))
    items = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("number", "item"))), lambda x: x["item"]), ",")
    head = '{"dataframe_split":{"columns":["is_vpn_used","card_id","transaction_amount","merchant_category"],"data":['
    bodies = parts.groupBy("request_id").agg(F.concat(F.lit(head), items, F.lit("]}}")).alias("body"))
    parsed = pay.payload_split(bodies, "body", REQUEST)
    return parsed.select(
        "request_id", "row_no", "card_id", F.col("transaction_amount").try_cast("double").alias("transaction_amount"),
        "merchant_category", F.col("is_vpn_used").try_cast("bigint").alias("is_vpn_used"), "transaction_country")


@query("enforce_signature", f"""
  select request_id, row_no, card_id, case when digit in (0, 5) then null else transaction_amount end as transaction_amount,
         case digit when 0 then 'bad transaction_amount' when 5 then 'bad is_vpn_used' end as reject_reason from ({REQ})
  union all select replace(request_id, 'REQ', 'BAD'), null, null, null, 'unreadable body' from ({REQ}) where row_no = 0 and digit = 0""")
def enforce_signature(d: Data):
    """Besides the spoiled rows some requests have a body that is cut or no JSON at all."""
    unreadable = numbered(d).filter("number % 20 = 0").select(
        F.replace("request_id", F.lit("REQ"), F.lit("BAD")).alias("request_id"),
        F.when(F.col("number") % 40 == 0, "not json").otherwise('{"dataframe_records":[{"card_id":').alias("body"))
    bodies = requests(d, spoil=True).drop("request_time").unionByName(unreadable)
    accepted, rejected = pay.enforce_signature(pay.payload_records(bodies, "body", REQUEST), REQUEST)
    good = accepted.select("request_id", F.col("row_no").cast("int").alias("row_no"), "card_id", "transaction_amount", F.lit(None).cast("string").alias("reject_reason"))
    bad = rejected.select("request_id", "row_no", "card_id", F.lit(None).cast("double").alias("transaction_amount"), "reject_reason")
    return good.unionByName(bad)


def responses(d: Data) -> DataFrame:
    scored = numbered(d).withColumn("row_no", (F.col("number") % 4).cast("int"))
    return pay.prediction_response(scored, "request_id", "row_no", "prediction_champion")


RESPONSE = f"select request_id, concat('{{\"predictions\":[', string_agg(cast(prediction as varchar), ',' order by row_no), ']}}') as response from ({REQ}) group by 1"


@query("prediction_response", RESPONSE)
def prediction_response(d: Data):
    return responses(d)


@query("payload_log", f"""
  with r as ({RESPONSE})
  select q.request_id, q.request_time, cast(q.request_time as date) as request_date, q.n as n_rows, r.response
  from (select request_id, min(event_at) as request_time, cast(count(*) as int) as n from ({REQ}) group by 1) q left join r using (request_id)""")
def payload_log(d: Data):
    path = pay.payload_log(requests(d), responses(d), fresh_path(d.spark, "payload"))
    log = d.spark.read.parquet(path)
    n = F.size(F.from_json("body", "dataframe_records array<struct<card_id string>>")["dataframe_records"])
    return log.select("request_id", "request_time", "request_date", n.alias("n_rows"), "response")


@query("usage_tracking", """
  select cast(ts as date) as usage_date, concat('fraud-', event_type) as endpoint, concat('team-', cast(user_id % 5 as varchar)) as requester,
         count(*) as requests, settle(avg(value), 8) as avg_latency, settle(quantile_cont(value, 0.95), 6) as p95_latency
  from events group by 1, 2, 3""", ())
def usage_tracking(d: Data):
    log = d.events.select(
        F.col("ts").alias("request_time"), F.concat(F.lit("fraud-"), "event_type").alias("endpoint"),
        F.concat(F.lit("team-"), (F.col("user_id") % 5).cast("string")).alias("requester"), F.col("value").alias("latency"))
    return rounded(pay.usage_by_day(log, "request_time", "latency"), {"avg_latency": 8, "p95_latency": 6})
