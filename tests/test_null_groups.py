"""Rows of a NULL group give the numbers that the same rows give under a name."""

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.operators.classification import confusion, roc_auc
from cardwatch.operators.ordered import exact_quantiles, value_table
from cardwatch.sources.payload import payload_split, usage_by_day


def both(spark):
    rnd = random.Random(2)
    rows = [(rnd.random(), int(rnd.random() < 0.4)) for _ in range(400)]
    return spark.createDataFrame([(m, s, y, int(s > 0.5)) for m in (None, "named") for s, y in rows],
                                 "model string, score double, label int, pred int")


def halves(rows, key="model"):
    rows = [r.asDict() for r in rows]
    split = [sorted(str({k: v for k, v in r.items() if k != key}) for r in rows if (r[key] is None) == none) for none in (True, False)]
    assert split[0]
    return split


def test_null_groups_count_like_named_ones(spark):
    df = both(spark)
    for out in (confusion(df, "label", "pred", ["model"]), roc_auc(df, "label", "score", ["model"]),
                exact_quantiles(value_table(df, ["model"], "score"), ["model"], "score", {"p95": 0.95})):
        none, named = halves(out.collect())
        assert none == named


def test_usage_of_a_null_requester(spark):
    rows = [(w, "e", f"2024-01-0{1 + i % 2} 10:00:00", float(i)) for w in (None, "x") for i in range(40)]
    df = spark.createDataFrame(rows, "requester string, endpoint string, at string, ms double").withColumn("at", F.to_timestamp("at"))
    none, named = halves(usage_by_day(df, "at", "ms").collect(), "requester")
    assert none == named and "None" not in none[0]


def test_split_bodies_may_be_short_or_repeat_a_name(spark):
    body = '{"dataframe_split": {"columns": ["a", "a", "b"], "data": [["1", "2", "3"], ["4"]]}}'
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("z", T.LongType())])
    out = payload_split(spark.createDataFrame([(1, body)], "id long, body string"), "body", schema)
    assert sorted(tuple(map(str, r)) for r in out.select("row_no", "a", "b", "z").collect()) == [
        ("0", "1", "3", "None"), ("1", "4", "None", "None")]
