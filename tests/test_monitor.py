import itertools
import math
import random
from collections import Counter
from datetime import datetime, timedelta
from fractions import Fraction

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from cardwatch.operators import alerts as al
from cardwatch.operators import monitor as mon

T0 = datetime(2024, 1, 29)
SCHEMA = "transaction_timestamp timestamp, x double, c string, home string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def sample(seed, n, shift=0.0, values=None):
    rng = random.Random(seed)
    pick = (lambda: rng.choice(values)) if values else (lambda: round(rng.gauss(5 + shift, 3), 2))
    return [(T0 + timedelta(hours=rng.randint(0, 47)), pick(), rng.choice("abc" if shift else "abd"), rng.choice(["u", "v", None])) for _ in range(n)]


def brute(base, cur):
    points = np.unique(np.concatenate([base, cur]))
    fb = np.searchsorted(np.sort(base), points, side="right") / len(base)
    fc = np.searchsorted(np.sort(cur), points, side="right") / len(cur)
    return np.abs(fb - fc).max(), float((np.abs(fb - fc)[:-1] * np.diff(points)).sum())


@pytest.mark.parametrize("seed,values", [(1, None), (2, None), (3, [1.0, 2.0, 3.0]), (4, [-5.0, 0.0, 0.0, 1e6]), (5, [-1.5, 2.25, 40.0])])
def test_distances_equal_brute_force(spark, seed, values):
    base, cur = sample(seed, 150, 0.0, values), sample(seed + 50, 90, 1.0, values)
    drift = mon.drift_metrics(frame(spark, base), frame(spark, cur), "transaction_timestamp", ["x"], [], slices=("home",))
    rows = drift.collect()
    assert len(rows) == 3 * 4  # two days and a week, whole table and three slices
    for r in rows:
        inside = [x for t, x, _, h in cur if r["window"]["start"] <= t < r["window"]["end"] and (r["slice_key"] is None or h == r["slice_value"])]
        ref = [x for _, x, _, h in base if r["slice_key"] is None or h == r["slice_value"]]
        ks, w1 = brute(np.array(ref), np.array(inside))
        assert math.isclose(r["ks_test"]["statistic"], ks, abs_tol=1e-12)
        assert math.isclose(r["wasserstein_distance"], w1, rel_tol=1e-9, abs_tol=1e-9)
        assert r["population_stability_index"] >= 0
        assert math.isclose(r["avg_delta"], np.mean(inside) - np.mean(ref), rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("offset", [0.0, 1.7e9, 1e12, -1e12])
def test_distances_keep_their_digits_at_an_offset(spark, offset):
    rng = random.Random(9)
    base = [offset + rng.gauss(0, 1) for _ in range(400)]
    cur = [offset + rng.gauss(0.5, 1) for _ in range(300)]
    frames = [frame(spark, [(T0, v, "a", None) for v in values]) for values in (base, cur)]
    drift = mon.drift_metrics(*frames, "transaction_timestamp", ["x"], []).filter("granularity = '1 day'").first()
    ks, w1 = brute(np.array(base) - offset, np.array(cur) - offset)
    delta = math.fsum(x - offset for x in cur) / len(cur) - math.fsum(x - offset for x in base) / len(base)
    spread = max(base + cur) - min(base + cur)
    assert drift["ks_test"]["statistic"] == pytest.approx(ks, abs=1e-12)
    assert abs(drift["wasserstein_distance"] - w1) < 1e-9 * spread and abs(drift["avg_delta"] - delta) < 1e-9 * spread


@pytest.mark.parametrize("sketch", [10_000, 12])
@pytest.mark.parametrize("values", [None, [1.0, 1.0, 2.0, 7.5], [-0.5, 1e300, -1e300, 3.0, float("nan")]])
def test_psi_of_narrowed_deciles_is_that_of_cumulated_values(spark, monkeypatch, sketch, values):
    monkeypatch.setattr(mon, "SKETCH", sketch)
    base, cur = frame(spark, sample(21, 300, 0.0, values)), frame(spark, sample(22, 150, 1.0, values))
    key = lambda r: (r["granularity"], r["window"]["start"], r["column_name"], r["slice_key"] or "", r["slice_value"] or "")
    one, two = (
        {key(r): (r["population_stability_index"], r["count"], r["baseline_count"])
         for r in mon.drift_metrics(base, cur, "transaction_timestamp", ["x"], ["c"], slices=("home",), stats=stats).collect()}
        for stats in (("psi",), ("psi", "avg_delta")))
    assert one.keys() == two.keys() and len(one) == 3 * 4 * 2
    for k in one:
        assert one[k][1:] == two[k][1:] and one[k][0] == pytest.approx(two[k][0], abs=1e-12)


def test_nan_and_infinity_count_as_missing(spark):
    base, cur = sample(1, 80), sample(2, 60, 1.0)
    odd = [(T0, v, "a", "u") for v in (float("nan"), float("inf"), float("-inf"), None)]
    plain, mixed = (
        {(r["granularity"], str(r["window"]["start"])): (r["ks_test"]["statistic"], r["wasserstein_distance"], r["avg_delta"], r["population_stability_index"])
         for r in mon.drift_metrics(frame(spark, base + extra), frame(spark, cur + extra), "transaction_timestamp", ["x"], []).collect()}
        for extra in ([], odd))
    assert plain.keys() == mixed.keys()
    for k in plain:
        assert plain[k] == pytest.approx(mixed[k], abs=1e-12)


def test_identical_tables_do_not_drift(spark):
    df = frame(spark, sample(7, 200))
    rows = mon.drift_metrics(df, df, "transaction_timestamp", ["x"], ["c"], granularities=("1 week",)).collect()
    by = {r["column_name"]: r for r in rows}
    assert by["x"]["ks_test"]["statistic"] == 0 and by["x"]["ks_test"]["pvalue"] == 1
    assert abs(by["x"]["wasserstein_distance"]) < 1e-9 and abs(by["x"]["population_stability_index"]) < 1e-12
    assert by["c"]["chi_squared_test"]["statistic"] == 0 and by["c"]["chi_squared_test"]["pvalue"] == 1


def test_one_row_and_null_windows(spark):
    base = frame(spark, sample(8, 50))
    cur = frame(spark, [(T0, 1.0, None, "u"), (T0 + timedelta(days=1), None, "a", "u"), (T0 + timedelta(days=1), None, "zz", "u")])
    rows = mon.drift_metrics(base, cur, "transaction_timestamp", ["x"], ["c"], granularities=("1 day",)).collect()
    got = {(r["column_name"], r["window"]["start"].day): r for r in rows}
    assert got["x", 29]["ks_test"]["statistic"] is None and got["x", 29]["wasserstein_distance"] is None
    assert ("x", 30) not in got
    assert got["c", 29]["chi_squared_test"]["pvalue"] is None
    assert got["c", 30]["chi_squared_test"]["statistic"] > 0


def test_chi2_equals_spark_ml(spark):
    base, cur = sample(9, 300), sample(10, 200, 1.0)
    df, cf = frame(spark, base), frame(spark, cur)
    r = mon.drift_metrics(df, cf, "transaction_timestamp", [], ["c"], granularities=("1 week",)).first()
    both = df.withColumn("side", F.lit(0.0)).unionByName(cf.withColumn("side", F.lit(1.0)))
    both = StringIndexer(inputCol="c", outputCol="i").fit(both).transform(both)
    both = VectorAssembler(inputCols=["i"], outputCol="f").transform(both)
    test = ChiSquareTest.test(both, "f", "side", True).first()
    assert math.isclose(r["chi_squared_test"]["statistic"], test["statistic"], rel_tol=1e-9)
    assert math.isclose(r["chi_squared_test"]["pvalue"], test["pValue"], rel_tol=1e-6, abs_tol=1e-12)


def test_chi2_and_psi_of_many_categories_equal_brute_force(spark):
    rng = np.random.default_rng(41)
    draws = [[f"c{v}" if v % 97 else None for v in rng.geometric(p, n)] for p, n in ((0.0008, 9000), (0.001, 7000))]
    base, cur = (frame(spark, [(T0, 0.0, v, "u") for v in values]) for values in draws)
    r = mon.drift_metrics(base, cur, "transaction_timestamp", [], ["c"], granularities=("1 day",)).first()
    names = sorted(set(draws[0]) | set(draws[1]), key=str)
    b, c = (np.array([counts[v] for v in names], dtype=float) for counts in map(Counter, draws))
    nb, nc = b.sum(), c.sum()
    chi2 = ((b * nc - c * nb) ** 2 / ((b + c) * nb * nc)).sum()
    pb, pc = np.maximum(b / nb, 1e-4), np.maximum(c / nc, 1e-4)
    assert len(names) > 3000 and r["chi_squared_test"]["statistic"] == pytest.approx(chi2, rel=1e-10)
    assert r["population_stability_index"] == pytest.approx(((pc - pb) * np.log(pc / pb)).sum(), rel=1e-9)
    assert (r["count"], r["baseline_count"]) == (7000, 9000)


@pytest.mark.parametrize("n,m", [(1, 1), (1, 4), (2, 3), (3, 3), (4, 6), (5, 5)])
def test_counted_ks_equals_all_orders(n, m):
    farthest = []
    for ones in itertools.combinations(range(n + m), n):
        a = b = far = 0
        for place in range(n + m):
            a, b = (a + 1, b) if place in ones else (a, b + 1)
            far = max(far, abs(a * m - b * n))
        farthest.append(far)
    for h in range(n * m + 2):
        assert mon.lattice_tail(n, m, h) == mon.lattice_tail(m, n, h)
        assert mon.lattice_tail(n, m, h) == pytest.approx(sum(f >= h for f in farthest) / len(farthest), rel=1e-12)


@pytest.mark.parametrize("n,m", [(7, 30), (30, 30), (12, 29), (2, 5000)])
def test_counted_ks_equals_whole_number_paths(n, m):
    for h in {1, n, m, n * m // 3, n * m // 2, n * m}:
        inside = [0] * (m + 1)
        for i in range(n + 1):
            for j in range(m + 1):
                ways = 1 if i == j == 0 else (inside[j] if i else 0) + (inside[j - 1] if j else 0)
                inside[j] = ways if abs(i * m - j * n) < h else 0
        assert mon.lattice_tail(n, m, h) == pytest.approx(1 - Fraction(inside[m], math.comb(n + m, n)), rel=1e-9)


def test_few_rows_have_a_counted_p_value_and_many_the_series(spark):
    rng = random.Random(31)
    base = [(T0, rng.gauss(0, 1), "a", None) for _ in range(40)]
    cur = [(T0 + timedelta(days=d), rng.gauss(0.7, 1), "a", None) for d, n in ((0, 6), (1, 250), (2, 251), (3, 1)) for _ in range(n)]
    rows = mon.drift_metrics(frame(spark, base), frame(spark, cur), "transaction_timestamp", ["x"], [], granularities=("1 day",)).collect()
    got = {r["count"]: r["ks_test"] for r in rows}
    assert set(got) == {1, 6, 250, 251} and got[1]["pvalue"] is None
    for n in (6, 250):
        assert got[n]["pvalue"] == mon.lattice_tail(n, 40, round(got[n]["statistic"] * n * 40))
    lam = math.sqrt(251 * 40 / 291) * got[251]["statistic"]
    assert got[251]["pvalue"] == pytest.approx(2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101)), abs=1e-12)


def test_upper_gamma_known_values():
    # Chi-squared tail at the usual 5 percent limits.
    for k, x in ((1, 3.841458820694124), (2, 5.991464547107979), (10, 18.307038053275146), (100, 124.34211340400407)):
        assert math.isclose(mon._upper_gamma(k / 2, x / 2), 0.05, rel_tol=1e-9)
    assert mon._upper_gamma(1.0, 3.0) == pytest.approx(math.exp(-3.0))


def test_consecutive_needs_the_window_before(spark):
    rows = [(T0 + timedelta(days=d, hours=h), float(h + d), "a", "u") for d in (0, 1, 3) for h in range(5)]
    got = mon.drift_consecutive(frame(spark, rows), "transaction_timestamp", ["x"], [], granularities=("1 day",)).collect()
    assert [(r["window"]["start"].day, r["drift_type"]) for r in got] == [(30, "CONSECUTIVE")]
    assert got[0]["avg_delta"] == 1.0 and got[0]["wasserstein_distance"] == pytest.approx(1.0)


def test_profile_merges_moments(spark):
    rows = sample(11, 300) + [(T0, None, "a", "u")]
    df = frame(spark, rows).withColumn("model_version", F.lit("m"))
    for r in mon.profile(df, "transaction_timestamp", ["x"], ["home"]).collect():
        inside = [(x, h) for t, x, _, h in rows if r["window_start"] <= t < r["window_end"]]
        inside = [x for x, h in inside if r["slice_key"] is None or h == r["slice_value"]]
        known = [x for x in inside if x is not None]
        assert (r["count"], r["num_nulls"], r["distinct_count"]) == (len(known), len(inside) - len(known), len(set(known)))
        assert r["avg"] == pytest.approx(np.mean(known)) and r["stddev"] == pytest.approx(np.std(known, ddof=1))


def test_null_slices_text_columns_and_odd_numbers(spark):
    odd = [float("nan"), float("inf"), None, 2.0, 1e12 + 1, 1e12 + 2]
    rows = [(T0, v, c, h) for v, c, h in zip(odd, ["a", None, "a", "b", "NULL", "a"], [None, "NULL", None, "NULL", None, "x"])]
    df = frame(spark, rows).withColumn("model_version", F.lit("m"))
    table = mon.profile_table(df, "transaction_timestamp", ["x"], ["c"], ["home"], baseline=df, granularities=("1 day",))
    got = {(r["log_type"], r["column_name"], r["slice_key"], r["slice_value"]):
           (r["count"], r["num_nulls"], r["num_nan"], r["min"], r["max"], r["distinct_count"]) for r in table.collect()}
    for kind in ("INPUT", "BASELINE"):
        assert got[kind, "x", None, None] == (3, 1, 2, 2.0, 1e12 + 2, 3)
        assert got[kind, "x", "home", None] == (1, 1, 1, 1e12 + 1, 1e12 + 1, 1)
        assert got[kind, "x", "home", "NULL"] == (1, 0, 1, 2.0, 2.0, 1)
        assert got[kind, "c", None, None] == (5, 1, 0, None, None, 3)
        assert got[kind, "c", "home", "NULL"] == (1, 1, 0, None, None, 1)
    assert len(got) == 2 * 2 * 4
    grouped = mon.slice_grouping(df, [F.lit(1)], ["home"], [F.count("*").alias("n")]).collect()
    assert {(r["slice_key"], r["slice_value"], r["n"]) for r in grouped} == {(None, None, 6), ("home", None, 3), ("home", "NULL", 2), ("home", "x", 1)}


def test_states_keep_their_digits(spark):
    rng = random.Random(4)
    rows = [(T0 + timedelta(days=i % 7), 1e9 + (i % 7) + rng.gauss(0, 1e-3), "a", f"h{i % 50}") for i in range(2000)]
    df = frame(spark, rows).withColumn("model_version", F.lit("m"))
    for r in mon.profile(df, "transaction_timestamp", ["x"], ["home"]).filter("slice_key is null").collect():
        inside = [x - 1e9 for t, x, _, _ in rows if r["window_start"] <= t < r["window_end"]]
        assert r["stddev"] == pytest.approx(np.std(inside, ddof=1), rel=1e-4)


def quality_log(spark, hits):
    rows = [(T0, y, p, "m", "u") for y, p in hits]
    return spark.createDataFrame(rows, "ts timestamp, y int, p int, model_version string, home string")


def test_quality_of_a_single_class_window(spark):
    r = mon.quality(quality_log(spark, [(0, 0)] * 5), "ts", "y", "p", ["home"], granularities=("1 day",)).filter("slice_key is null").first()
    assert r["accuracy_score"] == 1 and r["recall"]["weighted"] == 1 and r["recall"]["one_vs_all"] == {"0": 1.0}


def test_alerts_fire_on_drift_only(spark):
    base = sample(12, 400)
    df = frame(spark, base)
    same = frame(spark, sample(12, 400))
    moved = frame(spark, [(t, x * 1.6, "q" if i % 2 else c, h) for i, (t, x, c, h) in enumerate(base)])
    def fired(cur):
        drift = mon.drift_metrics(df, cur, "transaction_timestamp", ["x"], ["c"])
        return {r["column_name"] for r in al.alert_feature_drift(drift, "2024-01-30").collect()}
    assert fired(same) == set() and fired(moved) == {"x", "c"}


def test_quality_alert_and_evaluation(spark):
    good = mon.quality(quality_log(spark, [(1, 1), (0, 0)] * 10), "ts", "y", "p", ["home"])
    bad = mon.quality(quality_log(spark, [(1, 0), (0, 1)] * 10), "ts", "y", "p", ["home"])
    calm, loud = al.alert_model_quality(good, "2024-01-30"), al.alert_model_quality(bad, "2024-01-30")
    assert calm.count() == 0 and loud.count() == 2
    late = al.alert_model_quality(bad, "2024-02-15")
    assert late.count() == 0
    states = al.alert_evaluate({"a": calm, "b": loud}, {"a": ("window_start", ">", 0), "b": ("window_start", ">", 0)})
    assert {r["alert"]: r["state"] for r in states.collect()} == {"a": "OK", "b": "FIRED"}


@pytest.mark.parametrize("offset", [0.0, 1.7e9])
def test_consecutive_windows_take_one_pass_over_both_sides(spark, monkeypatch, offset):
    names, write = [], mon.materialize
    monkeypatch.setattr(mon, "materialize", lambda df, name, *a, **k: names.append(name) or write(df, name, *a, **k))
    rng = random.Random(8)
    days = {d: [offset + round(rng.gauss(0.3 * d, 1 + d / 4), 1) for _ in range(n)] for d, n in ((0, 40), (1, 150), (2, 1), (3, 90), (4, 200))}
    rows = [(T0 + timedelta(days=d), x, "a", "u") for d, values in days.items() for x in values]
    rows += [(T0 + timedelta(days=1), x, "a", "u") for x in (float("nan"), float("inf"), None)]
    got = mon.drift_consecutive(frame(spark, rows), "transaction_timestamp", ["x"], [], granularities=("1 day",)).collect()
    assert len(got) == 4 and not {"drift-cum", "drift-seen", "drift-least", "drift-info"} & set(names)
    for r in got:
        d = (r["window"]["start"] - T0.replace(hour=0, minute=0, second=0, microsecond=0)).days
        base, cur = np.sort(days[d - 1]), np.sort(days[d])
        assert (r["baseline_count"], r["count"]) == (len(base), len(cur))
        assert r["avg_delta"] == pytest.approx((cur - offset).mean() - (base - offset).mean(), abs=1e-6 if offset else 1e-12)
        if min(len(base), len(cur)) < 2:
            assert r["wasserstein_distance"] is None and r["ks_test"]["statistic"] is None and r["population_stability_index"] is None
            continue
        at = np.unique(np.r_[base, cur])
        b, c = (np.searchsorted(side, at, "right") / len(side) for side in (base, cur))
        assert r["ks_test"]["statistic"] == pytest.approx(np.abs(b - c).max(), abs=1e-12)
        assert r["wasserstein_distance"] == pytest.approx((np.abs(b - c)[:-1] * np.diff(at)).sum(), abs=1e-6 if offset else 1e-12)
        edges = [base[-(-len(base) * i // 10) - 1] for i in range(1, 10)]
        shares = [np.maximum(np.bincount(np.searchsorted(edges, side), minlength=10) / len(side), mon.FLOOR) for side in (base, cur)]
        assert r["population_stability_index"] == pytest.approx(((shares[1] - shares[0]) * np.log(shares[1] / shares[0])).sum(), abs=1e-9)
