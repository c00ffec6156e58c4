from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.operators import classification as cl
from cardwatch.schemas import REQUEST
from cardwatch.session import fresh_path
from cardwatch.sources import payload as pay
from cardwatch.sources import tables as src
from cardwatch.streaming import jobs

ROW = ('{"card_id":"CC_1","transaction_timestamp":"2026-09-30 03:15:00","transaction_amount":%s,"transaction_country":"US",'
       '"transaction_state":"CA","merchant_category":"gas","transaction_status":"approved","is_vpn_used":%s}')


def bodies(spark, *rows):
    return spark.createDataFrame([(i, '{"dataframe_records":[%s]}' % ",".join(r)) for i, r in enumerate(rows)], "request_id int, body string")


def test_records_keep_order_and_types(spark):
    df = bodies(spark, [ROW % ("2500.0", "1"), ROW % ("42.75", "0")], [ROW % ("1", "1")])
    parsed = pay.payload_records(df, "body", REQUEST)
    accepted, rejected = pay.enforce_signature(parsed, REQUEST)
    assert rejected.count() == 0
    got = [(r["request_id"], r["row_no"], r["transaction_amount"], r["is_vpn_used"]) for r in accepted.orderBy("request_id", "row_no").collect()]
    assert got == [(0, 0, 2500.0, 1), (0, 1, 42.75, 0), (1, 0, 1.0, 1)]
    out = pay.prediction_response(accepted.withColumn("prediction", F.col("is_vpn_used")), "request_id", "row_no").orderBy("request_id").collect()
    assert [r["response"] for r in out] == ['{"predictions":[1,0]}', '{"predictions":[1]}']


def test_signature_rejects_booleans_bad_numbers_and_gaps(spark):
    gap = '{"card_id":"CC_1","transaction_timestamp":"2026-09-30 03:15:00"}'
    df = bodies(spark, [ROW % ("1.5", "true"), ROW % ('"12,5"', "1"), gap, ROW % ("1.5", "1")])
    accepted, rejected = pay.enforce_signature(pay.payload_records(df, "body", REQUEST), REQUEST)
    assert accepted.count() == 1
    assert {r["row_no"]: r["reject_reason"] for r in rejected.collect()} == {
        0: "bad is_vpn_used", 1: "bad transaction_amount", 2: "missing transaction_amount"}


def test_split_matches_fields_by_name(spark):
    body = '{"dataframe_split":{"columns":["is_vpn_used","card_id"],"data":[[1,"CC_1"],[0,"CC_2"]]}}'
    df = spark.createDataFrame([(1, body)], "request_id int, body string")
    got = pay.payload_split(df, "body", REQUEST).orderBy("row_no").collect()
    assert [(r["row_no"], r["card_id"], r["is_vpn_used"], r["transaction_amount"]) for r in got] == [(0, "CC_1", "1", None), (1, "CC_2", "0", None)]


def test_unreadable_bodies_are_rejected_not_lost(spark):
    texts = ["not json", None, '{"dataframe_split":{"columns":["card_id"],"data":[["CC_1"]]}}', '{"dataframe_records":[]}',
             '{"dataframe_records":[{"card_id":"CC', '{"dataframe_records":[%s]}' % (ROW % ("1.5", "1"))]
    df = spark.createDataFrame(list(enumerate(texts)), "request_id int, body string")
    accepted, rejected = pay.enforce_signature(pay.payload_records(df, "body", REQUEST), REQUEST)
    assert [(r["request_id"], r["row_no"]) for r in accepted.collect()] == [(5, 0)]
    assert {(r["request_id"], r["row_no"], r["reject_reason"]) for r in rejected.collect()} == {(i, None, "unreadable body") for i in (0, 1, 2, 4)}


def test_unreadable_split_bodies_are_rejected_not_lost(spark):
    texts = ["not json", None, '{"dataframe_split":{"data":[["CC_1"]]}}', '{"dataframe_split":{"columns":["card_id"],"data":[]}}',
             '{"dataframe_split":{"columns":["card_id"],"data":[["CC_1"],[]]}}']
    df = spark.createDataFrame(list(enumerate(texts)), "request_id int, body string")
    checked = pay.check_signature(pay.payload_split(df, "body", REQUEST), REQUEST).collect()
    got = {(r["request_id"], r["row_no"], r["card_id"], r["reject_reason"]) for r in checked}
    assert got == {(i, None, None, "unreadable body") for i in (0, 1, 2)} | {
        (4, 0, "CC_1", "missing transaction_timestamp"), (4, 1, None, "missing card_id")}


@pytest.mark.parametrize("fmt,lines,good", [
    ("json", ['{"n": 1, "v": 0.5}', '{"n": 2, "v"', '{"n": 3, "v": "abc"}', "nothing", '{"n": 4}', ""], {(1, 0.5), (4, None)}),
    ("csv", ["n,v", "1,0.5", "2,abc", "x,1.0", "4,"], {(1, 0.5), (4, None)}),
])
def test_ingest_keeps_bad_lines_apart(spark, fmt, lines, good):
    landing, path = fresh_path(spark, "landing"), fresh_path(spark, "raw")
    spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1).write.text(landing)
    for times in (1, 2):
        src.ingest_batch(spark, landing, T.StructType.fromDDL("n int, v double"), path, fmt)
        rows = [tuple(r) for r in spark.read.parquet(path).collect()]
        bad = [r["raw_line"] for r in spark.read.parquet(f"{path}-rejects").collect()]
        assert set(rows) == good and len(rows) == times * len(good)
        assert len(bad) == times * len(set(bad)) and set(bad) == set(lines) - {"", "n,v"} - {lines[1] if fmt == "csv" else lines[0], lines[4]}


def test_replace_partition_twice_changes_nothing_else(spark):
    path = fresh_path(spark, "t")
    both = spark.createDataFrame([(1, "a"), (2, "b")], "n int, model_version string")
    src.replace_partition(both, path)
    for _ in range(2):
        src.replace_partition(spark.createDataFrame([(3, "b")], "n int, model_version string"), path)
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(1, "a"), (3, "b")}


def test_delete_keeps_rows_with_an_unknown_condition(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "n int")
    assert {r["n"] for r in src.delete_where(df, F.col("n") == 1).collect()} == {2, None}


def test_feature_table_refuses_repeated_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "card_id string, f int")
    with pytest.raises(ValueError, match="1 repeated"):
        src.feature_table_write(df, fresh_path(spark, "t"))


def test_typed_from_text(spark):
    df = spark.createDataFrame([("CC_1", "1e3", "7"), ("CC_2", "x", "7.5"), (None, None, None)], "card_id string, transaction_amount string, is_vpn_used string")
    schema = type(REQUEST)([REQUEST["card_id"], REQUEST["transaction_amount"], REQUEST["is_vpn_used"]])
    assert [tuple(r) for r in src.typed_from_text(df, schema).collect()] == [("CC_1", 1000.0, 7), ("CC_2", None, None), (None, None, None)]


# --- streams -----------------------------------------------------------------------------

LOG = "ts timestamp, y int, p int, model_version string"


def land(spark, folder, rows):
    spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(folder)


def test_ingest_reads_each_file_once(spark):
    folder, out, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "check"))
    land(spark, folder, [(datetime(2024, 1, 1), 1, 1, "m")])
    schema = spark.read.parquet(folder).schema
    for _ in range(2):
        jobs.ingest_stream(spark, folder, schema, out, checkpoint)
    assert spark.read.parquet(out).count() == 1
    land(spark, folder, [(datetime(2024, 1, 2), 0, 1, "m")])
    jobs.ingest_stream(spark, folder, schema, out, checkpoint)
    assert spark.read.parquet(out).count() == 2


def test_monitor_drops_late_rows_and_weeks_start_on_monday(spark):
    folder, out, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "check"))
    schema = spark.createDataFrame([], LOG).schema

    def run():
        stream = jobs.stream_monitor(jobs.file_stream(spark, folder, schema), "ts", "y", "p", granularity="1 week")
        jobs.run_to_table(stream, out, checkpoint)

    # Sunday and the following Monday lie in different weeks.
    land(spark, folder, [(datetime(2024, 1, 7, 23), 1, 1, "m"), (datetime(2024, 1, 8, 1), 0, 1, "m"), (datetime(2024, 1, 20), 0, 0, "m")])
    run()
    land(spark, folder, [(datetime(2024, 1, 7, 22), 1, 0, "m"), (datetime(2024, 2, 20), 1, 1, "m")])
    run()
    got = {r["window_start"].day: (r["n"], r["tp"], r["fp"]) for r in spark.read.parquet(out).collect()}
    assert got == {1: (1, 1, 0), 8: (1, 0, 1), 15: (1, 0, 0)}


def test_refresh_touches_only_new_windows(spark):
    path = fresh_path(spark, "refresh")
    old = spark.createDataFrame([(datetime(2024, 1, 1, 5), 1, 1, "m"), (datetime(2024, 1, 2, 5), 1, 1, "m")], LOG)
    new = spark.createDataFrame([(datetime(2024, 1, 2, 6), 1, 0, "m")], LOG)

    def build(rows):
        from cardwatch.functions.timeparts import windows
        return cl.binary_metrics(windows(rows, "ts"), "y", "p", ["granularity", "window_start", "model_version"])

    jobs.refresh(old, old, "ts", build, path)
    first = {f.path: f.modificationTime for f in spark.read.format("binaryFile").load(f"{path}/granularity=1 day/window_start=2024-01-01*").collect()}
    jobs.refresh(old.unionByName(new), new, "ts", build, path)
    again = {f.path: f.modificationTime for f in spark.read.format("binaryFile").load(f"{path}/granularity=1 day/window_start=2024-01-01*").collect()}
    assert first == again
    got = {(r["granularity"], str(r["window_start"])[:10]): (r["tp"], r["fn"]) for r in spark.read.parquet(path).collect()}
    assert got == {("1 day", "2024-01-01"): (1, 0), ("1 day", "2024-01-02"): (1, 1), ("1 week", "2024-01-01"): (2, 1)}


def test_refresh_drops_windows_left_without_rows(spark):
    from cardwatch.functions.timeparts import windows

    def build(rows):
        return cl.binary_metrics(windows(rows, "ts"), "y", "p", ["granularity", "window_start", "model_version"])

    def days():
        return {(r["granularity"], str(r["window_start"])[:10]): r["tp"] for r in spark.read.parquet(path).collect()}

    path = fresh_path(spark, "refresh")
    one = spark.createDataFrame([(datetime(2024, 1, 1, 5), 1, 1, "m")], LOG)
    two = spark.createDataFrame([(datetime(2024, 1, 2, 5), 1, 1, "m")], LOG)
    jobs.refresh(one.unionByName(two), one.unionByName(two), "ts", build, path)
    for _ in range(2):  # a second run changes nothing
        jobs.refresh(one, two, "ts", build, path)
        assert days() == {("1 day", "2024-01-01"): 1, ("1 week", "2024-01-01"): 1}
    empty = fresh_path(spark, "refresh")
    jobs.refresh(one.limit(0), one, "ts", build, empty)
    assert spark.read.schema("n int").parquet(empty).count() == 0


def test_text_landing_keeps_every_line_once_over_restarts(spark, monkeypatch):
    folder, out, rejects, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "rejects", "check"))
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    for k in range(4):
        lines = [f'{{"a": {k}, "b": "x"}}', f'{{"a": {10 + k}}}', f'{{"a": {k}, "b', f'{{"a": "t{k}", "b": "y"}}']
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(folder)
    write, calls = jobs.write_batch, []

    def failing(rows, path, number):
        calls.append(number)
        if len(calls) == 4:  # the second batch has its rejects, not its rows
            raise RuntimeError("lost")
        write(rows, path, number)

    run = lambda: jobs.ingest_stream(spark, folder, schema, out, checkpoint, fmt="json", rejects=rejects, files_per_batch=1)
    monkeypatch.setattr(jobs, "write_batch", failing)
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.setattr(jobs, "write_batch", write)
    run()
    run()
    good = sorted((r["a"], r["b"] or "") for r in jobs.read_batches(spark, out).collect())
    assert good == sorted([(k, "x") for k in range(4)] + [(10 + k, "") for k in range(4)])
    bad = sorted(r["raw_line"] for r in jobs.read_batches(spark, rejects).collect())
    assert bad == sorted([f'{{"a": {k}, "b' for k in range(4)] + [f'{{"a": "t{k}", "b": "y"}}' for k in range(4)])


def test_a_version_published_between_two_batches_serves_the_second(spark):
    base, folder, out, checkpoint = (fresh_path(spark, n) for n in ("features", "in", "out", "check"))
    cards = lambda v: spark.createDataFrame([("c1", v), ("c2", v)], "card_id string, limit int")
    with pytest.raises(FileNotFoundError):
        src.read_features(spark, base)
    assert src.publish_features(cards(1), base) == 1
    with pytest.raises(ValueError):
        src.publish_features(cards(7).union(cards(8)), base)
    assert src.read_features(spark, base).first()["limit"] == 1  # a version with repeated keys is not taken
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], "card_id string").coalesce(1).write.mode("append").parquet(folder)
    rows("c1", "none")
    schema, plans = spark.read.parquet(folder).schema, []

    def use(joined):
        plans.append(joined._jdf.queryExecution().executedPlan().toString())
        return joined

    run = lambda: jobs.stream_lookup(jobs.file_stream(spark, folder, schema), base, use, out, checkpoint)
    run()
    src.publish_features(cards(2), base)
    rows("c2")
    run()
    got = sorted((r["card_id"], r["limit"]) for r in jobs.read_batches(spark, out).collect() if r["limit"])
    assert got == [("c1", 1), ("c2", 2)] and jobs.read_batches(spark, out).count() == 3
    assert all("FileScan parquet [card_id" in p and "Aggregate" not in p and "Window" not in p for p in plans) and len(plans) == 2


def test_declared_widths_are_kept(spark):
    schema = T.StructType([T.StructField("a", T.ByteType()), T.StructField("b", T.IntegerType()), T.StructField("c", T.FloatType()),
                           T.StructField("d", T.DecimalType(5, 2))])
    df = spark.createDataFrame([("7", "70000", "1.5", "2.25"), ("300", "x", "1e40", "12345")], "a string, b string, c string, d string")
    got = src.typed_from_text(df, schema)
    assert got.schema.simpleString() == schema.simpleString()
    assert [r["a"] for r in got.collect()] == [7, None] and [r["b"] for r in got.collect()] == [70000, None] and got.collect()[1]["d"] is None
