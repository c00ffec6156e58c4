"""Each stage's decisions take effect on what the stage before kept."""

import re

import corpus_pipeline
from pyspark.sql import functions as F

from cardwatch.llm import common, mixing, ngram_join, packing, suffix_dedup

FOLDER = "/root/testdata/sf0.001"


def test_stages_in_order(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    seen, columns = [docs], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, seen[-1], FOLDER).write.parquet(str(tmp_path / name))
        seen.append(spark.read.parquet(str(tmp_path / name)))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "suffix_dedup", "mixing", "packing"]
    assert all(s.columns == columns for s in seen[:5])
    _, clean, single, cut, mix, packed = seen
    assert {r[0] for r in single.select("doc_id").collect()} <= {r[0] for r in clean.select("doc_id").collect()}
    sets = [frozenset(zip(*(w[i:] for i in range(5)))) for (t,) in single.select("text").collect() if len(w := re.findall(r"\S+", t.lower())) > 4]
    assert not any(100 * len(a & b) >= 80 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    texts, seen_strings = [t.encode() for (t,) in cut.orderBy("doc_id").select("text").collect()], set()
    for t in texts:
        own = {t[i:i + 200] for i in range(len(t) - 199)}
        assert not own & seen_strings
        seen_strings |= own
    words = sum(len(t.split()) for t in texts)
    taken = sum(len(t.encode().split()) for (t,) in mix.select("text").collect())
    assert abs(taken - 1.5 * words) <= 20
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0
    assert packed.filter("start = 0").count() == mix.count()


def test_a_task_holds_one_python_worker(spark, tmp_path, monkeypatch):
    # Two Python steps in a row, or rows that the driver sends as a list, took more workers, which stayed for the stages after them.
    plans, materialize = [], common.materialize

    def noted(df, *args, **named):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df, *args, **named)

    for module in (common, mixing, ngram_join, packing, suffix_dedup):
        monkeypatch.setattr(module, "materialize", noted)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    python = re.compile(r"MapInArrow|MapInPandas|FlatMapGroups\w+|\w*EvalPython")
    assert sum(bool(python.search(p)) for p in plans) > 10
    for plan in plans:
        assert "ExistingRDD" not in plan
        above = []  # (depth, Python steps since the last exchange) of the nodes on the way down
        for line in plan.splitlines():
            depth = re.match(r"[ :|+-]*", line).end()
            above = [a for a in above if a[0] < depth]
            n = 0 if "Exchange" in line.split("(")[0] else (above[-1][1] if above else 0) + bool(python.search(line.split("(")[0].split("[")[0]))
            assert n < 2, plan
            above.append((depth, n))
