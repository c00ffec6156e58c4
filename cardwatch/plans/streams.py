"""Streaming jobs run over the given files and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardwatch.functions.timeparts import windows, with_time_features
from cardwatch.operators import classification as cl
from cardwatch.operators.features import rule_points
from cardwatch.operators.scoring import score_model
from cardwatch.plans.data import CHAMPION, CUT, Data, model_log
from cardwatch.plans.features import CARD_COLS, ROUND, _cards_sql
from cardwatch.plans.models import ONE_SPLIT_SQL, one_split_model
from cardwatch.plans.registry import query, rounded
from cardwatch.schemas import EVENTS
from cardwatch.session import fresh_path
from cardwatch.sources.tables import publish_features
from cardwatch.streaming import jobs


def stream(d: Data):
    return jobs.file_stream(d.spark, d.folder, EVENTS, "events*.parquet")


def paths(d: Data, name: str) -> tuple[str, str]:
    base = fresh_path(d.spark, name)
    return f"{base}/table", f"{base}/checkpoint"


@query("ingest_stream", """
  select event_id, ts, user_id, event_type, value, props, cast(null as varchar) as raw_line from events
  union all select null, null, null, null, null, null, concat('{"event_id": ', cast(event_id as varchar), ', "value"') from events where event_id % 50 = 0
  union all select null, null, null, null, null, null, concat('{"event_id":', cast(event_id as varchar), ',"value":"abc"}') from events where event_id % 50 = 1""", ())
def ingest_stream(d: Data):
    """JSON lines land in two waves, some of them cut or with a text for a number; a third run finds nothing new."""
    landing, rejects = fresh_path(d.spark, "stream-landing"), fresh_path(d.spark, "stream-rejects")
    out, checkpoint = paths(d, "ingest-stream")
    number = F.col("event_id").cast("string")
    for wave in (0, 1, None):
        if wave is not None:
            raw = d.table("events").filter(F.col("event_id") % 2 == wave)
            raw.write.mode("append").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(landing)
            ending = ', "value"' if wave == 0 else ',"value":"abc"}'
            start = '{"event_id": ' if wave == 0 else '{"event_id":'
            raw.filter(F.col("event_id") % 50 == wave).select(F.concat(F.lit(start), number, F.lit(ending))).write.mode("append").text(landing)
        jobs.ingest_stream(d.spark, landing, EVENTS, out, checkpoint, fmt="json", rejects=rejects)
    good, bad = jobs.read_batches(d.spark, out), jobs.read_batches(d.spark, rejects)
    return good.unionByName(bad.select("raw_line"), allowMissingColumns=True)


def published_cards(d: Data, cols: list[str]) -> str:
    """The feature table as the serving side finds it: a numbered version that was written before."""
    base = fresh_path(d.spark, "card-features")
    publish_features(d.some_cards.select("card_id", *cols), base)
    return base


@query("stream_static_lookup", f"""
  select t.transaction_id, t.card_id, {_cards_sql(CARD_COLS, 'c.')} from txn t left join some_cards c on c.card_id = t.card_id""", ("txn", "some_cards"))
def stream_static_lookup(d: Data):
    out, checkpoint = paths(d, "stream-lookup")
    txn = d.as_txn(stream(d)).select("transaction_id", "card_id")
    jobs.stream_lookup(txn, published_cards(d, CARD_COLS), lambda rows: rows, out, checkpoint)
    return rounded(jobs.read_batches(d.spark, out), ROUND)


@query("stream_score", """
  select transaction_id, card_id, cast(hour(transaction_timestamp) as int) as hour_of_day, score, cast(score >= 25 as int) as prediction
  from (select t.*, case when t.transaction_amount > 2 * c.avg_transaction_amount_90d then 15 else 0 end
             + case when is_vpn_used then 20 else 0 end + case when t.transaction_country <> t.home_country then 10 else 0 end as score
        from txn t left join some_cards c on c.card_id = t.card_id)""", ("txn", "some_cards"))
def stream_score(d: Data):
    out, checkpoint = paths(d, "stream-score")

    def score(rows):
        points = rule_points([
            (F.col("transaction_amount") > 2 * F.col("avg_transaction_amount_90d"), 15),
            (F.col("is_vpn_used"), 20), (F.col("transaction_country") != F.col("home_country"), 10)])
        rows = with_time_features(rows, "transaction_timestamp").withColumn("score", points)
        return rows.select("transaction_id", "card_id", "hour_of_day", "score", (F.col("score") >= 25).cast("int").alias("prediction"))

    jobs.stream_score(d.as_txn(stream(d)), published_cards(d, ["avg_transaction_amount_90d"]), score, out, checkpoint)
    return jobs.read_batches(d.spark, out)


@query("stream_score_model", f"""{ONE_SPLIT_SQL}
  select transaction_id, card_id, settle(score, 6) as score, cast(score >= 0.3e0 as int) as prediction, '{CHAMPION}' as model_version from scored""")
def stream_score_model(d: Data):
    """A fitted model scores the stream, next to looked-up features."""
    out, checkpoint = paths(d, "stream-model")
    model = one_split_model(d)

    def score(rows):
        scored = score_model(rows, model, CHAMPION, 0.3, "2024-01-31")
        return rounded(scored.select("transaction_id", "card_id", "score", "prediction", "model_version"), {"score": 6})

    jobs.stream_score(d.as_txn(stream(d)), published_cards(d, ["avg_transaction_amount_90d"]), score, out, checkpoint)
    return jobs.read_batches(d.spark, out)


@query("stream_monitor", """
  with w as (select date_trunc('day', transaction_timestamp) as window_start, * from log)
  select window_start, window_start + interval 1 day as window_end, '1 day' as granularity, model_version, count(*) as n,
         count(*) filter (is_fraud = 1 and prediction = 1) as tp, count(*) filter (is_fraud = 0 and prediction = 1) as fp,
         count(*) filter (is_fraud = 1 and prediction = 0) as fn, count(*) filter (is_fraud = 0 and prediction = 0) as tn
  from w where window_start + interval 1 day <= (select max(transaction_timestamp) from txn) - interval 1 day group by all""", ("log",))
def stream_monitor(d: Data):
    out, checkpoint = paths(d, "stream-monitor")
    log = model_log(d.as_txn(stream(d)))
    jobs.run_to_table(jobs.stream_monitor(log, "transaction_timestamp", "is_fraud", "prediction"), out, checkpoint)
    return d.spark.read.parquet(out)


@query("incremental_refresh", """
  with w as (select g.granularity, date_trunc(g.unit, transaction_timestamp) as window_start, * from log
             cross join (values ('1 day', 'day'), ('1 week', 'week')) g(granularity, unit))
  select granularity, window_start, model_version, count(*) filter (is_fraud = 1 and prediction = 1) as tp,
         count(*) filter (is_fraud = 0 and prediction = 1) as fp, count(*) filter (is_fraud = 1 and prediction = 0) as fn,
         count(*) filter (is_fraud = 0 and prediction = 0) as tn from w group by all""", ("log",))
def incremental_refresh(d: Data):
    """Metrics of the first half, then a refresh of the windows the second half touches."""
    path = fresh_path(d.spark, "refresh")
    ts = "transaction_timestamp"

    def build(rows):
        return cl.binary_metrics(windows(rows, ts), "is_fraud", "prediction", ["granularity", "window_start", "model_version"]).select(
            "granularity", "window_start", "model_version", "tp", "fp", "fn", "tn")

    cut = F.lit(f"{CUT} 12:00:00").cast("timestamp")
    old, new = d.log.filter(F.col(ts) < cut), d.log.filter(F.col(ts) >= cut)
    jobs.refresh(old, old, ts, build, path)
    jobs.refresh(d.log, new, ts, build, path)
    schema = "model_version string, tp bigint, fp bigint, fn bigint, tn bigint, granularity string, window_start timestamp"
    return d.spark.read.schema(schema).parquet(path)
