import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardwatch.functions.columns import value_bucket
from cardwatch.operators import ordered as od


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(allow_nan=False), min_size=2, max_size=200))
def test_bucket_never_decreases(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for bits in (2, 10):
        rows = df.select("v", value_bucket(F.col("v"), bits).alias("b")).orderBy("v").collect()
        buckets = [r["b"] for r in rows]
        assert buckets == sorted(buckets)


def test_bucket_of_special_values(spark):
    values = [-math.inf, -1e308, -5e-324, -0.0, 0.0, 5e-324, 1.0, 1e308, math.inf, math.nan]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(99, None)], "i int, v double")
    got = {r["i"]: r["b"] for r in df.select("i", value_bucket(F.col("v")).alias("b")).collect()}
    assert got.pop(99) is None
    assert [got[i] for i in range(len(values))] == sorted(got.values())


def rows_of(seed, n=400):
    rng = random.Random(seed)
    # One group holds most rows; many ties, negative values and zeros.
    return [("hot" if rng.random() < 0.7 else rng.choice("ab"), float(rng.choice([-3, -1, 0, 0.5, 2, 7, 7.25, 100]) * rng.choice([1, 1, 3])), rng.randint(0, 5))
            for _ in range(n)]


@pytest.mark.parametrize("descending", [False, True])
def test_running_equals_brute_force(spark, descending):
    data = rows_of(1)
    df = spark.createDataFrame(data, "g string, v double, n int")
    got = od.running(df, ["g"], ["v"], value_bucket(F.col("v"), 2), {
        "s": ("sum", F.col("n")), "lo": ("min", F.col("n")), "hi": ("max", F.col("n")), "t": ("total", F.col("n"))},
        descending=descending).collect()
    assert len(got) == len(data)
    for r in got:
        upto = [n for g, v, n in data if g == r["g"] and (v >= r["v"] if descending else v <= r["v"])]
        assert (r["s"], r["lo"], r["hi"]) == (sum(upto), min(upto), max(upto))
        assert r["t"] == sum(n for g, _, n in data if g == r["g"])


def test_next_crosses_buckets(spark):
    values = [-8.0, -1.0, 0.0, 0.25, 3.0, 1000.0]
    df = spark.createDataFrame([("x", v) for v in values], "g string, v double")
    got = od.running(df, ["g"], ["v"], value_bucket(F.col("v")), {"d": ("next", F.col("v"))}).orderBy("v").collect()
    assert [r["d"] for r in got] == values[1:] + [None]


def test_quantiles_equal_numpy(spark):
    data = rows_of(2)
    df = spark.createDataFrame(data + [("hot", None, 1)], "g string, v double, n int")
    probs = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    for r in od.exact_quantiles(od.value_table(df, ["g"], "v"), ["g"], "v", probs).collect():
        values = [v for g, v, _ in data if g == r["g"]]
        assert np.allclose([r[k] for k in probs], np.quantile(values, list(probs.values())))


def test_buckets_follow_the_values_of_each_group(spark):
    rng = np.random.default_rng(8)
    rows = [("close", float(v)) for v in 0.999 + rng.random(20_000) / 1000] + [("wide", float(v)) for v in rng.lognormal(0, 9, 5_000)]
    rows += [("one", 3.0)] * 500 + [(None, 1.0), (None, -2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    cut = od.split_by_value(df, ["g"], "v")
    sizes = {}
    for r in cut.groupBy("g", "_bucket").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("g", "_bucket").collect():
        sizes.setdefault(r["g"], []).append((r["n"], r["lo"], r["hi"]))
    for g in ("close", "wide"):
        assert len(sizes[g]) >= 32 and max(n for n, *_ in sizes[g]) < 3 * sum(n for n, *_ in sizes[g]) / 64
        assert all(a[2] < b[1] for a, b in zip(sizes[g], sizes[g][1:]))
    assert len(sizes["one"]) == 1
    got = od.running(df, ["g"], ["v"], None, {"n": ("sum", F.lit(1))}).filter("g is null").orderBy("v").collect()
    assert [r["n"] for r in got] == [1, 2]


def test_the_cut_of_a_split_is_that_of_the_whole_order(spark):
    df = spark.range(6000).select("id", F.when(F.col("id") % 10 == 0, 1).when(F.col("id") > 5, 0).alias("y"))
    cuts = od.hash_cuts(df, ["y"], "id", 42, 0.2)
    ranked = od.rank_by_hash(df, ["y"], "id", 42).withColumn("h", F.md5(F.concat(F.col("id").cast("string"), F.lit(":42"))))
    wanted = {r["y"]: r["h"] for r in ranked.filter("hash_rank = round(group_size * 0.2)").collect()}
    assert {r["y"]: r["hash_cut"] for r in cuts.collect()} == wanted and len(wanted) == 3


def test_hash_rank_is_a_permutation_per_group(spark):
    df = spark.range(500).select("id", F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("y"))
    got = od.rank_by_hash(df, ["y"], "id", 42).collect()
    for y, size in ((0, 450), (1, 50)):
        assert sorted(r["hash_rank"] for r in got if r["y"] == y) == list(range(1, size + 1))
        assert {r["group_size"] for r in got if r["y"] == y} == {size}


def test_heavy_keys_are_bounded(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 600, 0).otherwise(F.col("id")).alias("k"))
    assert [r["k"] for r in od.heavy_keys(df, "k", 10).collect()] == [0]
    assert od.heavy_keys(df, "k", 600).count() == 0
    assert od.heavy_keys(df, "k", 0, max_keys=2).count() == 1


def test_totals_of_a_hot_group_reach_its_rows_in_even_tasks(spark):
    hot = spark.range(1_000_000).select(F.lit("hot").alias("g"), F.col("id").alias("v"), F.lit(2).alias("n"))
    df = hot.union(spark.range(300).select(F.concat(F.lit("g"), F.col("id") % 30), F.col("id"), F.lit(1)))
    df = df.union(spark.createDataFrame([(None, 1, 1)], "g string, v long, n int"))
    facts = spark.createDataFrame([("hot", 7), *[(f"g{i}", i) for i in range(20)]], "g string, fact int")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = od.group_totals(df, ["g"], ["v"], {"size": F.sum("n"), "kinds": F.count(F.lit(1))}, facts, ["g"])
        tasks = sorted(r["count"] for r in got.groupBy(F.spark_partition_id().alias("task")).count().collect())
        found = {r["g"]: r for r in got.groupBy("g").agg(
            F.count("*").alias("rows"), *[F.collect_set(c).alias(c) for c in ("size", "kinds", "fact")]).collect()}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len(tasks) == 8 and tasks[-1] < 3 * tasks[4]
    assert set(found) == {"hot", *[f"g{i}" for i in range(20)]}
    for g, r in found.items():
        n = 1_000_000 if g == "hot" else 10
        assert (r["rows"], r["kinds"]) == (n, [n]) and r["size"] == [2 * n if g == "hot" else n]
        assert r["fact"] == [7 if g == "hot" else int(g[1:])]
