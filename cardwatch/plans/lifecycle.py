"""Aliases, gate, champion/challenger decision, traffic routes and tuning tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardwatch.functions.columns import uniform
from cardwatch.operators import classification as cl
from cardwatch.operators import lifecycle as lc
from cardwatch.operators import monitor as mon
from cardwatch.operators import trees
from cardwatch.operators.features import hash_folds
from cardwatch.plans.data import AS_OF, CHALLENGER, Data
from cardwatch.plans.monitoring import QUALITY, SLICES, TS
from cardwatch.plans.quality import BINARY
from cardwatch.plans.registry import query, rounded
from cardwatch.session import materialize
from cardwatch.sources.payload import latest_n

NOW = f"{AS_OF} 10:20:30"


def profile(d: Data, log=None):
    """The published quality table."""
    return materialize(mon.quality(d.log if log is None else log, TS, "is_fraud", "prediction", SLICES), "quality")


@query("alias_resolve", """
  select a.alias, a.version, v.run_id, m.metric, settle(m.value, 6) as value
  from aliases a left join versions v using (version) left join run_metrics m using (run_id)""", ("aliases", "versions", "run_metrics"))
def alias_resolve(d: Data):
    found = lc.alias_resolve(d.aliases.select("alias", "version"), d.versions.select("version", "run_id"), d.run_metrics)
    return rounded(found, {"value": 6})


@query("latest_and_previous", """
  select model, version, run_id, cast(recency as int) as recency
  from (select *, row_number() over (order by version desc) as recency from versions) where recency <= 2""", ("versions",))
def latest_and_previous(d: Data):
    return latest_n(d.versions, ["model"], "version", 2)


LATEST = f"""{QUALITY},
  latest as (select model_version, window_end, recall_weighted as score from quality q where slice_key is null and granularity = '1 week'
    and window_end = (select max(window_end) from quality p where p.model_version = q.model_version and p.granularity = '1 week'))"""


@query("latest_per_model", f"with {LATEST} select model_version, window_end, settle(score, 6) as score from latest", ("log",))
def latest_per_model(d: Data):
    return rounded(lc.latest_per_model(profile(d), F.col("recall.weighted")), {"score": 6})


@query("champion_challenger_pair", f"""with {LATEST}
  select settle(max(score) filter (model_version like '%@champion'), 6) as champion_score,
         settle(max(score) filter (model_version like '%@challenger'), 6) as challenger_score from latest""", ("log",))
def champion_challenger_pair(d: Data):
    pair = lc.pair_scores(lc.latest_per_model(profile(d), F.col("recall.weighted")), d.aliases)
    return rounded(pair, {"champion_score": 6, "challenger_score": 6})


@query("ab_active_split", """
  select (select version from aliases where alias = 'champion') as champion_version,
         (select version from aliases where alias = 'challenger') as challenger_version, 'ACTIVE' as status""", ("aliases",))
def ab_active_split(d: Data):
    return lc.active_split(d.aliases)


TRAINED = """
  select max(value) filter (alias = 'champion') as champion, max(value) filter (alias = 'challenger') as challenger
  from aliases join versions using (version) join run_metrics using (run_id) where metric = 'recall'"""


@query("ab_score_source", f"""with {LATEST},
  watched as (select max(score) filter (model_version like '%@champion') as champion, max(score) filter (model_version like '%@challenger') as challenger from latest),
  trained as ({TRAINED})
  select 'both' as case_name, settle(champion, 6) as champion_metric, settle(challenger, 6) as challenger_metric, 'monitoring_1week' as metric_source from watched
  union all select 'one', settle(champion, 6), settle(challenger, 6), 'training' from trained""", ("log", "aliases", "versions", "run_metrics"))
def ab_score_source(d: Data):
    """Both models monitored, and only one of them: the second case falls back as a pair."""
    one = d.log.filter(F.col("model_version") != CHALLENGER)
    cases = [("both", profile(d)), ("one", profile(d, one))]
    rows = [lc.ab_scores(d.aliases, d.versions, p, d.run_metrics).withColumn("case_name", F.lit(name)) for name, p in cases]
    both = rows[0].unionByName(rows[1]).drop("champion_version", "challenger_version", "status")
    return rounded(both, {"champion_metric": 6, "challenger_metric": 6})


@query("ab_resolve", f"""with {LATEST},
  s as (select max(score) filter (model_version like '%@champion') as a, max(score) filter (model_version like '%@challenger') as b from latest),
  v as (select max(version) filter (alias = 'champion') as va, max(version) filter (alias = 'challenger') as vb from aliases)
  select case when b > a then 'challenger' else 'champion' end as winner, case when b > a then vb else va end as winner_version,
         case when b > a then va else vb end as loser_version, settle(greatest(a, b), 6) as winner_metric, settle(least(a, b), 6) as loser_metric,
         'archive_' || strftime(timestamp '{NOW}', '%Y%m%d_%H%M%S') as archive_alias, 'monitoring_1week' as metric_source
  from s, v""", ("log", "aliases"))
def ab_resolve(d: Data):
    decided = lc.ab_resolve(d.aliases, d.versions, profile(d), d.run_metrics, NOW)
    return rounded(decided, {"winner_metric": 6, "loser_metric": 6})


@query("quality_gate", f"""
  with b as ({BINARY}),
  c as (select *, case when f1_score < 0.9 then printf('f1_score %.4f < 0.9', f1_score) end as c1,
    case when "precision" < 0.95 then printf('precision %.4f < 0.95', "precision") end as c2,
    case when recall < 0.3 then printf('recall %.4f < 0.3', recall) end as c3 from b)
  select model_version, case when coalesce(c1, c2, c3) is null then 'PASSED' else 'REJECTED' end as verdict,
         concat_ws('; ', c1, c2, c3) as failures from c
  union all select model_version, 'REJECTED', 'f1_score missing' from b""", ("log",))
def quality_gate(d: Data):
    """Strict limits that the champion misses, and a metric table without F1."""
    metrics = cl.binary_metrics(d.log, "is_fraud", "prediction", ["model_version"])
    strict = lc.quality_gate(metrics, ["model_version"], {"recall": 0.3, "precision": 0.95, "f1_score": 0.9})
    return strict.unionByName(lc.quality_gate(metrics.drop("f1_score"), ["model_version"]))


@query("traffic_split", """
  select card_id, case when b < 50 then 'champion' when b < 80 then 'challenger' else 'shadow' end as route
  from (select distinct card_id, cast('0x' || substr(md5(concat(card_id, ':0')), 1, 8) as bigint) % 100 as b from txn)""")
def traffic_split(d: Data):
    return lc.traffic_split(d.txn.select("card_id").distinct(), "card_id", [("champion", 50), ("challenger", 30), ("shadow", 20)])


# --- tuning tables: each trial flags transactions from another number of points ----------

TRIALS = """
  trial_folds as (
    select t.trial, f.fold, count(*) filter (is_fraud and points + u * 10 >= 8 + 2 * t.trial) / count(*) filter (is_fraud) as recall
    from (select *, cast('0x' || substr(md5(concat(transaction_id, ':42')), 1, 8) as bigint) % 3 as fold,
                 cast('0x' || substr(md5(concat(transaction_id, ':9')), 1, 8) as bigint) / 4294967296e0 as u from txn) f, range(0, 12) t(trial)
    group by 1, 2),
  trials as (select cast(trial as int) as trial, avg(recall) as mean_metric, stddev_pop(recall) as std_metric, count(*) as folds from trial_folds group by 1)"""


def trial_folds(d: Data):
    """Recall per trial and fold of the rule with 12 cut-offs: (trial, fold, recall)."""
    level = F.col("points") + uniform(F.col("transaction_id"), 9) * 10
    rows = hash_folds(d.txn, "transaction_id").filter("is_fraud").select("fold", level.alias("level"))
    hits = [F.count(F.when(F.col("level") >= 8 + 2 * t, 1)).alias(f"h{t}") for t in range(12)]
    wide = rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), *hits)
    entries = F.array(*[F.struct(F.lit(t).alias("trial"), (F.col(f"h{t}") / F.col("n")).alias("recall")) for t in range(12)])
    return wide.select("fold", F.explode(entries).alias("e")).select("fold", "e.*")


@query("cv_summary", f"with {TRIALS} select trial, settle(mean_metric, 6) as mean_metric, settle(std_metric, 6) as std_metric from trials")
def cv_summary(d: Data):
    return rounded(trees.cv_summary(trial_folds(d)), {"mean_metric": 6, "std_metric": 6})


@query("trial_log", f"""with {TRIALS}
  select trial, concat('cutoff=', cast(8 + 2 * trial as varchar)) as params, settle(mean_metric, 6) as mean_metric, settle(std_metric, 6) as std_metric from trials""")
def trial_log(d: Data):
    log = trees.cv_summary(trial_folds(d)).withColumn("params", F.concat(F.lit("cutoff="), (8 + 2 * F.col("trial")).cast("string")))
    return rounded(log, {"mean_metric": 6, "std_metric": 6})


@query("top_trials", f"""with {TRIALS}
  select trial, settle(mean_metric, 6) as mean_metric from trials order by mean_metric desc, trial limit 10""")
def top_trials(d: Data):
    best = trees.top_trials(trees.cv_summary(trial_folds(d)), "mean_metric", 10)
    return rounded(best.select("trial", "mean_metric"), {"mean_metric": 6})


@query("best_trial", f"""with {TRIALS}
  select trial, settle(mean_metric, 6) as mean_metric, settle(std_metric, 6) as std_metric from trials order by mean_metric desc, trial limit 1""")
def best_trial(d: Data):
    return rounded(trees.best_trial(trees.cv_summary(trial_folds(d)), "mean_metric"), {"mean_metric": 6, "std_metric": 6})
