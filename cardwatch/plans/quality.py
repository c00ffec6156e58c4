"""Classification metrics, curves and comparisons of the logged models."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardwatch.functions.columns import clip, noise
from cardwatch.operators import classification as cl
from cardwatch.operators import relational as rel
from cardwatch.plans.data import CHALLENGER, CHAMPION, Data
from cardwatch.plans.registry import query, rounded

BY = ["model_version"]

COUNTS = """
  select model_version, count(*) filter (is_fraud = 1 and prediction = 1) as tp, count(*) filter (is_fraud = 0 and prediction = 1) as fp,
         count(*) filter (is_fraud = 1 and prediction = 0) as fn, count(*) filter (is_fraud = 0 and prediction = 0) as tn
  from log group by 1"""
BINARY = f"""
  select *, coalesce(tp / nullif(tp + fp, 0), 0) as "precision", coalesce(tp / nullif(tp + fn, 0), 0) as recall,
         coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) as f1_score, (tp + tn) / (tp + fp + fn + tn) as accuracy
  from ({COUNTS})"""
CLASSES = f"""
  select model_version, '1' as "row", tp / (tp + fp) as "precision", tp / (tp + fn) as recall, 2 * tp / (2 * tp + fp + fn) as f1_score, tp + fn as support from ({COUNTS})
  union all
  select model_version, '0', tn / (tn + fn), tn / (tn + fp), 2 * tn / (2 * tn + fp + fn), tn + fp from ({COUNTS})"""
CUM = """
  select model_version, threshold, pos, neg, sum(pos) over w as tp, sum(neg) over w as fp,
         sum(pos) over (partition by model_version) as all_pos, sum(neg) over (partition by model_version) as all_neg
  from (select model_version, score as threshold, count(*) filter (is_fraud = 1) as pos, count(*) filter (is_fraud = 0) as neg
        from slog group by 1, 2)
  window w as (partition by model_version order by threshold desc)"""
# A score with many distinct values: the rule points moved by a per-row draw.
SLOG = """
  select *, round(greatest(0e0, least(1e0, points / 53e0
    + (cast('0x' || substr(md5(concat(transaction_id, ':5')), 1, 8) as bigint) / 4294967296e0 - 0.5e0) * 0.5e0)), 4) as noisy
  from log"""


def scored(d: Data):
    moved = clip(F.col("score") + noise(F.col("transaction_id"), 0.5, 5), 0.0, 1.0)
    return d.log.withColumn("score", F.round(moved, 4))


SLOG_VIEW = f"with slog as (select * replace (noisy as score) from ({SLOG}))"


@query("confusion_matrix", """
  select m.model_version, a.c as label, b.c as prediction,
         (select count(*) from log l where l.model_version = m.model_version and l.is_fraud = a.c and l.prediction = b.c) as n
  from (select distinct model_version from log) m, (values (0), (1), (2)) a(c), (values (0), (1), (2)) b(c)""", ("log",))
def confusion_matrix(d: Data):
    return cl.confusion(d.log, "is_fraud", "prediction", BY, classes=(0, 1, 2))


@query("binary_metrics", f"""
  select model_version, tp, fp, fn, tn, settle("precision", 6) as "precision", settle(recall, 6) as recall, settle(f1_score, 6) as f1_score,
         settle(accuracy, 6) as accuracy from ({BINARY})""", ("log",))
def binary_metrics(d: Data):
    return rounded(cl.binary_metrics(d.log, "is_fraud", "prediction", BY), dict.fromkeys(("precision", "recall", "f1_score", "accuracy"), 6))


@query("class_report", f"""
  with c as ({CLASSES}), b as ({BINARY})
  select model_version, "row", settle("precision", 6) as "precision", settle(recall, 6) as recall, settle(f1_score, 6) as f1_score, support from c
  union all select model_version, 'accuracy', settle(accuracy, 6), settle(accuracy, 6), settle(accuracy, 6), tp + fp + fn + tn from b
  union all select model_version, 'macro avg', settle(avg("precision"), 6), settle(avg(recall), 6), settle(avg(f1_score), 6), cast(sum(support) as bigint) from c group by 1
  union all select model_version, 'weighted avg', settle(sum("precision" * support) / sum(support), 6), settle(sum(recall * support) / sum(support), 6),
                   settle(sum(f1_score * support) / sum(support), 6), cast(sum(support) as bigint) from c group by 1""", ("log",))
def class_report(d: Data):
    return rounded(cl.class_report(d.log, "is_fraud", "prediction", BY), dict.fromkeys(("precision", "recall", "f1_score"), 6))


@query("accuracy", "select model_version, settle(avg(cast(is_fraud = prediction as int)), 6) as accuracy from log group by 1", ("log",))
def accuracy(d: Data):
    return rounded(cl.accuracy(d.log, "is_fraud", "prediction", BY), {"accuracy": 6})


@query("roc_auc", f"""{SLOG_VIEW}, cum as ({CUM})
  select model_version, settle(sum(neg * (tp - pos / 2e0)) / (sum(pos) * sum(neg)), 6) as roc_auc from cum group by 1""", ("log",))
def roc_auc(d: Data):
    return rounded(cl.roc_auc(scored(d), "is_fraud", "score", BY), {"roc_auc": 6})


@query("roc_curve", f"""{SLOG_VIEW}, cum as ({CUM})
  select model_version, threshold, settle(fp / all_neg, 6) as fpr, settle(tp / all_pos, 6) as tpr from cum""", ("log",))
def roc_curve(d: Data):
    return rounded(cl.roc_curve(scored(d), "is_fraud", "score", BY), {"fpr": 6, "tpr": 6})


@query("pr_curve", f"""{SLOG_VIEW}, cum as ({CUM})
  select model_version, threshold, settle(tp / (tp + fp), 6) as "precision", settle(tp / all_pos, 6) as recall from cum""", ("log",))
def pr_curve(d: Data):
    return rounded(cl.pr_curve(scored(d), "is_fraud", "score", BY), {"precision": 6, "recall": 6})


@query("lift_chart", f"""{SLOG_VIEW},
  v as (select model_version, score, count(*) as n, count(*) filter (is_fraud = 1) as pos from slog group by 1, 2),
  r as (select *, sum(n) over (partition by model_version order by score) as cum, sum(n) over (partition by model_version) as size,
               sum(pos) over (partition by model_version) as all_pos from v),
  e as (select model_version, i, min(score) filter (cum * 10 >= size * i) as edge from r, range(1, 10) g(i) group by 1, 2),
  b as (select r.model_version, r.n, r.pos, r.size, r.all_pos,
               (select count(*) from e where e.model_version = r.model_version and e.edge < r.score) as bin from r)
  select model_version, cast(bin as int) as bin, cast(sum(n) as bigint) as n, cast(sum(pos) as bigint) as positives,
         settle((sum(pos) / sum(n)) / (max(all_pos) / max(size)), 6) as lift from b group by 1, 2""", ("log",))
def lift_chart(d: Data):
    return rounded(cl.lift_chart(scored(d), "is_fraud", "score", BY), {"lift": 6})


@query("log_loss", f"""{SLOG_VIEW},
  p as (select model_version, is_fraud, greatest(1e-15, least(1 - 1e-15, score)) as p from slog)
  select model_version, settle(avg(case when is_fraud = 1 then -ln(p) else -ln(1 - p) end), 6) as log_loss from p group by 1""", ("log",))
def log_loss(d: Data):
    return rounded(cl.log_loss(scored(d), "is_fraud", "score", BY), {"log_loss": 6})


@query("metric_compare", f"""
  with b as ({BINARY}),
  champ as (unpivot (select "precision", recall, f1_score, accuracy from b where model_version = '{CHAMPION}') on "precision", recall, f1_score, accuracy into name metric value v),
  chal as (unpivot (select "precision", recall, f1_score, cast(tp as double) as tp from b where model_version = '{CHALLENGER}') on "precision", recall, f1_score, tp into name metric value v)
  select metric, round(coalesce(champ.v, 0e0), 4) as champion, round(coalesce(chal.v, 0e0), 4) as challenger
  from champ full join chal using (metric) order by metric""", ("log",))
def metric_compare(d: Data):
    wide = cl.binary_metrics(d.log, "is_fraud", "prediction", BY).withColumn("tp", F.col("tp").cast("double"))
    champion = cl.long_metrics(wide.filter(F.col("model_version") == CHAMPION), BY, ["precision", "recall", "f1_score", "accuracy"])
    challenger = cl.long_metrics(wide.filter(F.col("model_version") == CHALLENGER), BY, ["precision", "recall", "f1_score", "tp"])
    return rel.metric_compare(champion, challenger)
