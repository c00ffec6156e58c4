import random

import pytest
from pyspark.sql import functions as F

from cardwatch.operators import classification as cl
from cardwatch.operators import lifecycle as lc
from cardwatch.operators import relational as rel

LOG = "m string, y int, p int, s double"


def log(spark, rows):
    return spark.createDataFrame(rows, LOG)


def test_auc_with_ties_and_reversed_scores(spark):
    rng = random.Random(3)
    rows = [("m", rng.randint(0, 1), 0, rng.choice([-1.0, 0.0, 0.2, 0.2, 0.7, 1.0])) for _ in range(200)]
    df = log(spark, rows)
    auc = cl.roc_auc(df, "y", "s", ["m"]).first()["roc_auc"]
    back = cl.roc_auc(df.withColumn("s", -F.col("s")), "y", "s", ["m"]).first()["roc_auc"]
    pos, neg = [r[3] for r in rows if r[1]], [r[3] for r in rows if not r[1]]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert auc == pytest.approx(want) and auc + back == pytest.approx(1.0)
    last = cl.roc_curve(df, "y", "s", ["m"]).orderBy("threshold").first()
    assert (last["fpr"], last["tpr"]) == (1.0, 1.0)


def test_single_class_has_no_auc(spark):
    assert cl.roc_auc(log(spark, [("m", 1, 1, 0.5), ("m", 1, 0, 0.1)]), "y", "s", ["m"]).first()["roc_auc"] is None


def test_no_predicted_positives_gives_zero(spark):
    r = cl.binary_metrics(log(spark, [("m", 1, 0, 0.1), ("m", 0, 0, 0.1), ("m", None, 1, 0.1), ("m", 1, None, 0.1)]), "y", "p", ["m"]).first()
    assert (r["precision"], r["recall"], r["f1_score"], r["accuracy"]) == (0.0, 0.0, 0.0, 0.5)
    assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (0, 0, 1, 1)


def test_confusion_fills_cells_and_sums_to_the_rows(spark):
    df = log(spark, [("m", 1, 1, 0.0)] * 3 + [("m", 0, 0, 0.0)] * 2)
    cells = {(r["label"], r["prediction"]): r["n"] for r in cl.confusion(df, "y", "p", ["m"]).collect()}
    assert cells == {(1, 1): 3, (0, 0): 2, (0, 1): 0, (1, 0): 0}


def test_report_averages(spark):
    df = log(spark, [("m", 0, 0, 0.0)] * 6 + [("m", 0, 1, 0.0)] * 2 + [("m", 1, 1, 0.0)] * 1 + [("m", 1, 0, 0.0)])
    got = {r["row"]: r for r in cl.class_report(df, "y", "p", ["m"]).collect()}
    assert set(got) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert got["accuracy"]["precision"] == 0.7 and got["weighted avg"]["recall"] == pytest.approx(0.7)
    assert got["macro avg"]["recall"] == pytest.approx((0.75 + 0.5) / 2) and got["1"]["precision"] == pytest.approx(1 / 3)


def test_log_loss_is_finite_at_the_ends(spark):
    got = cl.log_loss(log(spark, [("m", 1, 1, 0.0), ("m", 0, 0, 0.0)]), "y", "s", ["m"]).first()["log_loss"]
    assert got == pytest.approx(34.538776394910684 / 2)


def test_lift_bins_cover_all_rows(spark):
    df = log(spark, [("m", int(i > 80), 0, float(i % 97)) for i in range(200)])
    rows = cl.lift_chart(df, "y", "s", ["m"]).collect()
    assert sum(r["n"] for r in rows) == 200 and {r["bin"] for r in rows} == set(range(10))


def test_compare_takes_missing_as_zero(spark):
    a = spark.createDataFrame([("recall", 0.12345), ("x", 1.0)], "metric string, value double")
    b = spark.createDataFrame([("recall", 0.5)], "metric string, value double")
    assert [tuple(r) for r in rel.metric_compare(a, b).collect()] == [("recall", 0.1235, 0.5), ("x", 1.0, 0.0)]


# --- gate and champion/challenger --------------------------------------------------------

PROFILE = ("model_version string, granularity string, window struct<start: timestamp, end: timestamp>, column_name string, "
           "slice_key string, recall struct<weighted: double>")


def tables(spark, champion, challenger, same=False):
    from datetime import datetime
    aliases = spark.createDataFrame(
        [("champion", 3, "c")] + ([] if challenger == "none" else [("challenger", 3 if same else 4, "d")]),
        "alias string, version int, model_version string")
    versions = spark.createDataFrame([("m", 3, "r3"), ("m", 4, "r4")], "model string, version int, run_id string")
    runs = spark.createDataFrame([("r3", "recall", 0.9), ("r4", "recall", 0.2)], "run_id string, metric string, value double")
    weeks = [(datetime(2024, 1, d), datetime(2024, 1, d + 7)) for d in (1, 8)]
    rows = []
    for model, scores in (("c", champion), ("d", challenger if challenger != "none" else None)):
        for window, score in zip(weeks, scores or []):
            rows.append((model, "1 week", window, ":table", None, (score,)))
            rows.append((model, "1 day", window, ":table", None, (0.0,)))
            rows.append((model, "1 week", window, ":table", "home_state", (0.0,)))
    return aliases, versions, spark.createDataFrame(rows, PROFILE), runs


def decide(spark, *args, **kw):
    aliases, versions, profile, runs = tables(spark, *args, **kw)
    return lc.ab_resolve(aliases, versions, profile, runs, "2024-02-01 03:04:05").collect()


def test_newest_week_decides_and_a_tie_keeps_the_champion(spark):
    won = decide(spark, [0.9, 0.5], [0.1, 0.6])[0]
    assert (won["winner"], won["winner_version"], won["loser_version"], won["metric_source"]) == ("challenger", 4, 3, "monitoring_1week")
    assert won["archive_alias"] == "archive_20240201_030405" and (won["winner_metric"], won["loser_metric"]) == (0.6, 0.5)
    assert decide(spark, [0.1, 0.5], [0.9, 0.5])[0]["winner"] == "champion"


def test_one_unmonitored_model_falls_back_for_both(spark):
    row = decide(spark, [0.1, 0.1], None)[0]
    assert (row["winner"], row["winner_metric"], row["loser_metric"], row["metric_source"]) == ("champion", 0.9, 0.2, "training")


def test_nothing_to_resolve(spark):
    assert decide(spark, [0.1, 0.1], "none") == []
    assert decide(spark, [0.1, 0.1], [0.2, 0.2], same=True) == []
    aliases, *_ = tables(spark, [0.1, 0.1], "none")
    assert lc.active_split(aliases).first()["status"] == "NO_CHALLENGER"


def test_gate(spark):
    rows = spark.createDataFrame([("good", 0.5, 0.5, 0.5), ("low", 0.1, 0.5, 0.2), ("gap", None, 0.5, 0.5)],
                                 "m string, recall double, precision double, f1_score double")
    got = {r["m"]: (r["verdict"], r["failures"]) for r in lc.quality_gate(rows, ["m"]).collect()}
    assert got["good"] == ("PASSED", "") and got["gap"] == ("REJECTED", "recall missing")
    assert got["low"] == ("REJECTED", "f1_score 0.2000 < 0.35; recall 0.1000 < 0.3")


def test_traffic_follows_the_percentages(spark):
    routed = lc.traffic_split(spark.range(5000), "id", [("a", 90), ("b", 10)])
    shares = {r["route"]: r["count"] for r in routed.groupBy("route").count().collect()}
    assert set(shares) == {"a", "b"} and 400 < shares["b"] < 600
    whole = lc.traffic_split(spark.range(100), "id", [("a", 100), ("b", 0)])
    assert whole.filter("route = 'a'").count() == 100
