import math
import random
from datetime import datetime, timedelta
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwatch.operators import features as ft
from cardwatch.operators import relational as rel
from cardwatch.operators import scoring as sc

T0 = datetime(2024, 1, 1)
TXN = "id int, card_id string, ts timestamp, amount double, country string"


def transactions(seed=1, n=300):
    """One card holds most rows; ties in time, NULL amounts, equal amounts."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        card = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", "c"])
        at = T0 + timedelta(minutes=rng.randint(0, 15 * 24 * 6) * 10)
        amount = None if rng.random() < 0.05 else rng.choice([10.0, 10.0, 12.34, round(rng.uniform(0, 99), 2)])
        rows.append((i, card, at, amount, rng.choice(["x", "y", "z", None])))
    # Exactly one and seven days apart, one microsecond beyond, and the same second.
    for k, gap in enumerate([timedelta(0), timedelta(0), timedelta(days=1), timedelta(days=7), timedelta(days=7, microseconds=1)]):
        rows.append((1000 + k, "edge", T0 + gap, 5.0, "x"))
    return rows


def frame_values(rows, row, days):
    return [a for _, c, t, a, _ in rows if c == row["card_id"] and row["ts"] - timedelta(days=days) <= t <= row["ts"]]


@pytest.mark.parametrize("hot_rows", [0, 100, 10**9])
def test_rolling_stats_equal_brute_force(spark, hot_rows):
    rows = transactions()
    df = spark.createDataFrame(rows, TXN)
    got = ft.rolling_stats(df, "card_id", "ts", "amount", hot_rows=hot_rows, bucket_seconds=3600).collect()
    assert len(got) == len(rows)
    for r in got:
        for d in (1, 7):
            inside = frame_values(rows, r, d)
            known = [a for a in inside if a is not None]
            assert r[f"txn_count_{d}d"] == len(inside)
            if known:
                assert r[f"txn_amount_avg_{d}d"] == pytest.approx(np.mean(known), abs=1e-9)
            else:
                assert r[f"txn_amount_avg_{d}d"] is None
            if len(known) > 1:
                assert r[f"txn_amount_std_{d}d"] == pytest.approx(np.std(known, ddof=1), abs=1e-7)
            else:
                assert r[f"txn_amount_std_{d}d"] is None


@pytest.mark.parametrize("hot_rows", [0, 10**9])
def test_rolling_stats_take_nan_and_infinity_as_missing(spark, hot_rows):
    amounts = [1.0, float("nan"), float("inf"), 3.0, None, float("-inf")]
    df = spark.createDataFrame([(i, "k", T0 + timedelta(hours=i), a, "x") for i, a in enumerate(amounts)], TXN)
    last = ft.rolling_stats(df, "card_id", "ts", "amount", hot_rows=hot_rows).filter("id = 5").first()
    assert (last["txn_count_7d"], last["txn_amount_avg_7d"]) == (6, 2.0) and last["txn_amount_std_7d"] == pytest.approx(2**0.5)


@pytest.mark.parametrize("hot_rows", [0, 10**9])
def test_rolling_stats_hold_for_amounts_of_any_size(spark, hot_rows):
    sizes = {"fine": [1e-9, 2e-9, 4e-9, 3e-7], "large": [1e13, 2e13, 1e13 + 1, 3e15], "mixed": [1e20, 1e-9, 3e-9, 5.0],
             "far": [1e12 + i for i in range(40)], "near": [1e9 + i % 7 for i in range(40)]}
    rows = [(i, k, T0 + timedelta(hours=13 * i), a, "x") for k, amounts in sizes.items() for i, a in enumerate(amounts)]
    rows += [(100 + i, k, T0 + timedelta(days=60, hours=i), a, "x") for k in sizes for i, a in enumerate([1e-9, 3e-9, 7e-9])]
    got = ft.rolling_stats(spark.createDataFrame(rows, TXN), "card_id", "ts", "amount", hot_rows=hot_rows).collect()
    assert len(got) == len(rows)
    for r in got:
        for d in (1, 7):
            known = [Fraction(a) for a in frame_values(rows, r, d)]
            mean = sum(known) / len(known)
            assert r[f"txn_count_{d}d"] == len(known) and r[f"txn_amount_avg_{d}d"] == pytest.approx(float(mean), rel=1e-12)
            if len(known) > 1:
                want = math.sqrt(sum((a - mean) ** 2 for a in known) / (len(known) - 1))
                # within the last digit of the greatest amount in the frame
                assert r[f"txn_amount_std_{d}d"] == pytest.approx(want, rel=1e-9, abs=1e-16 * float(max(known)))


@pytest.mark.parametrize("hot_rows", [0, 10**9])
def test_zscore_is_null_without_spread(spark, hot_rows):
    df = spark.createDataFrame([(i, "k", T0 + timedelta(hours=i), 12.34, "x") for i in range(4)], TXN)
    got = ft.rolling_features(df, "card_id", "ts", "amount", hot_rows=hot_rows).collect()
    assert [r["amount_zscore"] for r in got] == [None] * 4
    assert all(r["txn_amount_std_7d"] in (None, 0.0) for r in got)


def test_rolling_distinct_equals_brute_force(spark):
    rows = transactions(2)
    df = spark.createDataFrame(rows, TXN)
    got = ft.rolling_distinct(df, "card_id", "ts", ["country"], days=7).collect()
    assert len(got) == len(rows)
    for r in got:
        seen = {c for _, k, t, _, c in rows if k == r["card_id"] and r["ts"] - timedelta(days=7) <= t <= r["ts"]} - {None}
        assert r["distinct_country"] == len(seen)


def test_lookup_keeps_unknown_cards_on_the_left_only(spark):
    df = spark.createDataFrame([("a", 1), ("zz", 2)], "card_id string, n int")
    cards = spark.createDataFrame([("a", 0.5)], "card_id string, f double")
    assert ft.lookup(df, cards).count() == 1
    assert {(r["card_id"], r["f"]) for r in ft.lookup(df, cards, how="left").collect()} == {("a", 0.5), ("zz", None)}
    assert ft.orphan_check(df, cards, "card_id").first().asDict() == {"orphans": 1, "status": "FAIL"}
    assert ft.orphan_check(cards, df, "card_id").first()["status"] == "PASS"


def test_key_check_counts_nulls_and_repeats(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    assert ft.key_check(df, "k").first().asDict() == {"row_count": 5, "null_keys": 2, "duplicate_keys": 1, "status": "FAIL"}
    assert ft.key_check(df.filter("k = 'b'"), "k").first()["status"] == "PASS"
    assert ft.key_check(df.filter("k = 'zz'"), "k").first().asDict() == {"row_count": 0, "null_keys": 0, "duplicate_keys": 0, "status": "PASS"}


def test_card_profile_window_and_month_edges(spark):
    schema = ("card_id string, transaction_timestamp timestamp, transaction_amount double, transaction_country string, "
              "transaction_state string, merchant_category string, transaction_status string")
    rows = [
        ("a", datetime(2024, 1, 31, 23), 100.0, "US", "CA", "online_retail", "approved"),
        ("a", datetime(2024, 2, 1, 1), 60.0, "US", "NY", "grocery", "declined"),
        ("a", datetime(2024, 2, 20), 50.0, "DE", "N/A", "grocery", "declined"),
        ("a", datetime(2024, 3, 1), 999.0, "US", "CA", "grocery", "approved"),
        ("a", datetime(2023, 12, 1), 999.0, "US", "CA", "grocery", "approved"),
        ("b", datetime(2023, 12, 2), 7.0, "US", "CA", "online_retail", "declined"),
    ]
    txn = spark.createDataFrame(rows, schema)
    dim = spark.createDataFrame([("a", "US", "CA")], "card_id string, home_country string, home_state string")
    logins = spark.createDataFrame([("a", "web_login", datetime(2024, 2, 28, 12))], "card_id string, login_type string, login_at timestamp")
    got = {r["card_id"]: r for r in ft.card_profile(txn, dim, logins, "2024-03-01").collect()}
    a, b = got["a"], got["b"]
    assert (a["total_transactions_90d"], a["max_single_transaction_90d"], a["max_monthly_spend_statement"]) == (3, 100.0, 110.0)
    assert (a["distinct_countries_90d"], a["distinct_states_90d"], a["declined_transactions_30d"]) == (2, 2, 2)
    assert a["hours_since_last_transaction"] == 240.0 and a["pct_online_transactions_90d"] == pytest.approx(1 / 3)
    assert (a["days_since_last_web_login"], a["days_since_last_password_reset"]) == (1, None)
    assert (b["total_transactions_90d"], b["declined_transactions_30d"], b["home_country"]) == (1, 0, None)


def test_codes_follow_value_order_and_unknown_is_minus_one(spark):
    train = spark.createDataFrame([("pear", "u"), ("apple", "v"), ("apple", None)], "a string, b string")
    codes = ft.fit_codes(train, ["a", "b"])
    assert {(r["column_name"], r["value"], r["code"]) for r in codes.collect()} == {("a", "apple", 0), ("a", "pear", 1), ("b", "u", 0), ("b", "v", 1)}
    new = spark.createDataFrame([(1, "pear", "v"), (2, "plum", None)], "i int, a string, b string")
    assert {(r["i"], r["a"], r["b"]) for r in ft.apply_codes(new, codes, ["a", "b"]).collect()} == {(1, 1, 1), (2, -1, -1)}


def test_split_holds_the_share_per_label_and_repeats(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 950, 0).otherwise(1).alias("y"))
    one = {r["id"] for r in ft.split(df, "id", "y").filter("is_test").collect()}
    two = {r["id"] for r in ft.split(df.repartition(13), "id", "y").filter("is_test").collect()}
    assert one == two and len(one) == 200 and len([i for i in one if i >= 950]) == 10
    by_hash = ft.split(df, "id", "y", exact=False).filter("is_test").count()
    assert 150 < by_hash < 250
    sizes = ft.folds(df, "id", "y").groupBy("y", "fold").count().collect()
    assert len(sizes) == 6 and max(r["count"] for r in sizes if r["y"] == 0) - min(r["count"] for r in sizes if r["y"] == 0) <= 1


def test_drift_inject_bounds_and_nulls(spark):
    df = spark.createDataFrame([(str(i), 10.0, 0.9, 7) for i in range(50)] + [("n", None, None, None)], "k string, a double, p double, c int")
    got = ft.drift_inject(df, {"a": ("scale", 1.2, 1.4), "p": ("add", 0.1, 0.3, (0.1, 0.98)), "c": ("steps", [0, 1, 2], (1, 8))}, "k").collect()
    known = [r for r in got if r["k"] != "n"]
    assert all(12 <= r["a"] <= 14 and r["p"] == 0.98 and r["c"] in (7, 8) for r in known)
    assert [(r["a"], r["p"], r["c"]) for r in got if r["k"] == "n"] == [(None, None, None)]


def test_mean_shift_and_correlation(spark):
    base = spark.createDataFrame([(1.0, 2.0), (3.0, None), (5.0, 4.0)], "a double, b double")
    cur = spark.createDataFrame([(6.0, 0.0)], "a double, b double")
    shift = {r["column_name"]: r["shift_pct"] for r in rel.mean_shift(base, cur, ["a", "b"]).collect()}
    assert shift == {"a": 100.0, "b": -100.0}
    r = {(x["column_a"], x["column_b"]): x["r"] for x in rel.correlation(base, ["a", "b"]).collect()}
    assert r["a", "a"] == 1.0 and r["a", "b"] == pytest.approx(1.0) and r["a", "b"] == r["b", "a"]


def test_rule_score_and_perturbation(spark):
    df = spark.createDataFrame(
        [("1", 2000.0, True, "DE", "electronics"), ("2", 10.0, False, "US", "grocery"), ("3", None, None, "US", "grocery")],
        "k string, transaction_amount double, is_vpn_used boolean, transaction_country string, merchant_category string")
    scored = sc.rule_score(df, sc.RULE_BASE, 0.3)
    got = {r["k"]: (round(r["rule_score"], 6), r["rule_flag"]) for r in scored.collect()}
    assert got == {"1": (0.53, 1), "2": (0.0, 0), "3": (0.0, 0)}
    moved = sc.perturb(scored.withColumn("score", F.col("rule_score")), "k", "m").collect()
    assert all(0 <= r["score"] <= 1 and abs(r["score"] - r["rule_score"]) <= 0.08 for r in moved)


def test_codes_of_values_with_a_shared_beginning(spark):
    df = spark.range(20_000).select(F.concat(F.lit("shared beginning "), F.lpad((F.col("id") % 7919).cast("string"), 6, "0")).alias("c"))
    codes = ft.fit_codes(df.repartition(8), ["c"])
    got = [(r["value"], r["code"]) for r in codes.orderBy("value").collect()]
    assert [c for _, c in got] == list(range(7919)) and [v for v, _ in got] == sorted(v for v, _ in got)


def test_split_moves_no_whole_rows(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("y"), F.lit("wide").alias("wide"))
    plan = ft.split(df, "id", "y")._jdf.queryExecution().executedPlan().toString()
    assert "Sort [" not in plan and "Window" not in plan
