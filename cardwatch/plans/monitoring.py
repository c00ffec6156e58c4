"""Profile, quality and drift tables of the model log, and the alerts over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.timeparts import windows
from cardwatch.operators import alerts as al
from cardwatch.operators import monitor as mon
from cardwatch.plans.data import AS_OF, CATEGORICAL, CUT, NUMERIC, SLICES, Data
from cardwatch.plans.registry import query, rounded
from cardwatch.session import materialize

TS = "transaction_timestamp"
LOOKBACK = 3

# --- SQL text shared by the twins --------------------------------------------------------

GRAINS = "(values ('1 day', 'day', interval 1 day), ('1 week', 'week', interval 7 day)) g(granularity, unit, len)"
SPREAD = f"""
  select {{cols}}, g.granularity, date_trunc(g.unit, {TS}) as window_start, date_trunc(g.unit, {TS}) + g.len as window_end,
         s.k as slice_key, case s.k when 'home_country' then home_country when 'home_state' then home_state end as slice_value
  from {{source}} cross join {GRAINS} cross join (values (null), ('home_country'), ('home_state')) s(k)"""
KEY = "column_name, sk, sv"
WIN = "granularity, window_start, window_end"


def _long(source: str, cols: list[str], kind: str, windowed: bool) -> str:
    """Value counts per column, slice ('' for the whole table) and, if asked, window."""
    parts = []
    for c in cols:
        expr = f"cast(hour({TS}) as int)" if c == "hour_of_day" else c
        parts.append(f"select '{c}' as column_name, cast({expr} as {kind}) as v, home_country, home_state, {TS} from {source}")
    flat = " union all ".join(parts)
    slices = "cross join (values (''), ('home_country'), ('home_state')) s(k)"
    sv = "case s.k when 'home_country' then home_country when 'home_state' then home_state else '' end"
    if not windowed:
        return f"select column_name, s.k as sk, {sv} as sv, v, count(*) as n from ({flat}) {slices} group by all"
    return (f"select column_name, s.k as sk, {sv} as sv, g.granularity, date_trunc(g.unit, {TS}) as window_start, "
            f"date_trunc(g.unit, {TS}) + g.len as window_end, v, count(*) as n from ({flat}) {slices} cross join {GRAINS} group by all")


def _ctes_num(grp: str, shared: str, base: str, cur: str) -> str:
    """CTE list from value tables: grp are the group columns, shared the ones the baseline has."""
    joined = " and ".join(f"a.{c.strip()} = b.{c.strip()}" for c in shared.split(","))
    return f"""
  nbase as ({base}), ncur as ({cur}),
  bsize as (select {shared}, cast(sum(n) as bigint) as n_base, sum(n * v) / sum(n) as mean_base from nbase where v is not null group by all),
  csize as (select {grp}, cast(sum(n) as bigint) as n_cur, sum(n * v) / sum(n) as mean_cur from ncur where v is not null group by all),
  size as (select a.*, b.n_base, b.mean_base from csize a join bsize b on {joined}),
  merged as (select {grp}, v, sum(b) as b, sum(c) as c from (
      select {', '.join('a.' + c.strip() for c in grp.split(','))}, b.v, b.n as b, 0 as c from size a join nbase b on {joined} where b.v is not null
      union all select {grp}, v, 0, n from ncur where v is not null) group by all),
  steps as (select {grp}, v, lead(v) over w - v as gap, sum(b) over w as cb, sum(c) over w as cc from merged window w as (partition by {grp} order by v)),
  dist as (select {grp}, max(abs(cb / n_base - cc / n_cur)) as ks, coalesce(sum(abs(cb / n_base - cc / n_cur) * gap), 0) as w1
           from steps join size using ({grp}) group by all),
  bcum as (select *, sum(n) over (partition by {shared} order by v) as cum, sum(n) over (partition by {shared}) as size from nbase where v is not null),
  edges as (select {shared}, i, min(v) filter (cum * 10 >= size * i) as edge from bcum, range(1, 10) g(i) group by all),
  bbin as (select {shared}, bin, sum(n) as n from (select a.*, (select count(*) from edges b where {joined} and b.edge < a.v) as bin from nbase a where v is not null) group by all),
  cbin as (select {grp}, bin, sum(n) as n from (select a.*, (select count(*) from edges b where {joined} and b.edge < a.v) as bin from ncur a where v is not null) group by all),
  grid as (select size.*, bin from size, range(0, 10) g(bin)),
  shares as (select grid.*, greatest(coalesce(b.n, 0) / n_base, 1e-4) as pb, greatest(coalesce(c.n, 0) / n_cur, 1e-4) as pc
             from grid left join bbin b using ({shared}, bin) left join cbin c using ({grp}, bin)),
  psi as (select {grp}, sum((pc - pb) * ln(pc / pb)) as psi from shares group by all),
  few as (select distinct least(n_base, n_cur) as p, greatest(n_base, n_cur) as q, cast(round(ks * n_base * n_cur) as bigint) as h
          from size join dist using ({grp}) where n_base > 1 and n_cur > 1 and n_base * n_cur <= 10000),
  counted as (with recursive walk as (
      select p, q, h, 0::bigint as i, j, 1e0 as paths, case when j * p >= h then 1e0 else 0e0 end as away
      from (select *, unnest(range(0, q + 1)) as j from few)
      union all
      select p, q, h, i + 1, j, sum(paths) over w,
             case when j * p - (i + 1) * q >= h then sum(paths) over w else sum(case when (i + 1) * q - j * p >= h then paths else away end) over w end
      from walk where i < p window w as (partition by p, q, h order by j))
    select p, q, h, away / paths as exact from walk where i = p and j = q),
  num as (select {grp}, n_base, n_cur,
      case when n_base > 1 and n_cur > 1 then ks end as ks_statistic,
      case when n_base > 1 and n_cur > 1 then case when n_base * n_cur <= 10000 then exact when lam < 0.2 then 1e0 else greatest(0e0, least(1e0, 2 * list_sum(list_transform(range(1, 101),
           lambda k: (case when k % 2 = 1 then 1e0 else -1e0 end) * exp(-2e0 * k * k * lam * lam))))) end end as ks_pvalue,
      case when n_base > 1 and n_cur > 1 then w1 end as wasserstein_distance,
      case when n_base > 1 and n_cur > 1 then psi end as population_stability_index, mean_cur - mean_base as avg_delta
    from (select *, sqrt(n_cur * n_base / (n_cur + n_base)) * ks as lam from size join dist using ({grp}) join psi using ({grp}))
    left join counted on p = least(n_base, n_cur) and q = greatest(n_base, n_cur) and h = cast(round(ks * n_base * n_cur) as bigint))"""


def _ctes_cat(grp: str, shared: str, base: str, cur: str) -> str:
    joined = " and ".join(f"a.{c.strip()} = b.{c.strip()}" for c in shared.split(","))
    return f"""
  xbase as (select * replace (coalesce(v, '<null>') as v) from ({base})), xcur as (select * replace (coalesce(v, '<null>') as v) from ({cur})),
  xsize as (select a.*, b.n_base from (select {grp}, cast(sum(n) as bigint) as n_cur from xcur group by all) a
            join (select {shared}, cast(sum(n) as bigint) as n_base from xbase group by all) b on {joined}),
  xtable as (select {grp}, v, sum(b) as b, sum(c) as c from (
      select {', '.join('a.' + c.strip() for c in grp.split(','))}, b.v, b.n as b, 0 as c from xsize a join xbase b on {joined}
      union all select {grp}, v, 0, n from xcur) group by all),
  xsum as (select {grp}, n_base, n_cur, count(*) - 1 as df,
             sum(power(b - eb, 2) / eb + power(c - ec, 2) / ec) as chi2,
             sum((greatest(c / n_cur, 1e-4) - greatest(b / n_base, 1e-4)) * ln(greatest(c / n_cur, 1e-4) / greatest(b / n_base, 1e-4))) as psi
           from (select *, (b + c) * n_base / (n_base + n_cur) as eb, (b + c) * n_cur / (n_base + n_cur) as ec from xtable join xsize using ({grp})) group by all),
  cat as (select {grp}, n_base, n_cur,
      case when n_base > 1 and n_cur > 1 then chi2 end as chi2_statistic,
      case when n_base > 1 and n_cur > 1 then case when df < 1 or chi2 <= 0 then 1e0 else greatest(0e0, 1e0 - list_sum(list_transform(range(0, 2000),
           lambda i: exp(-chi2 / 2 + (df / 2 + i) * ln(chi2 / 2) - lgamma(df / 2 + i + 1))))) end end as chi2_pvalue,
      case when n_base > 1 and n_cur > 1 then psi end as population_stability_index
    from xsum)"""


SLICE_OUT = "nullif(sk, '') as slice_key, case when sk <> '' then sv end as slice_value"
GROUP = f"{KEY}, {WIN}"


def _num(cur: str = "drifted_m") -> str:
    return _ctes_num(GROUP, KEY, _long("base_m", NUMERIC, "double", False), _long(cur, NUMERIC, "double", True))


def _cat(cur: str = "drifted_m") -> str:
    return _ctes_cat(GROUP, KEY, _long("base_m", CATEGORICAL, "varchar", False), _long(cur, CATEGORICAL, "varchar", True))


M = """base_m as (select *, prediction_champion as prediction from base),
  drifted_m as (select * from drifted)"""
FLAT = f"""
  flat as (
    select column_name, sk, sv, {WIN}, n_base, n_cur, ks_statistic, ks_pvalue, cast(null as double) as chi2_statistic, cast(null as double) as chi2_pvalue,
           wasserstein_distance, population_stability_index, avg_delta from num
    union all
    select column_name, sk, sv, {WIN}, n_base, n_cur, null, null, chi2_statistic, chi2_pvalue, null, population_stability_index, null from cat)"""
VIEWS = ("base", "drifted")
DIGITS = {"ks_statistic": 6, "ks_pvalue": 6, "chi2_statistic": 4, "chi2_pvalue": 6, "wasserstein_distance": 6,
          "population_stability_index": 6, "avg_delta": 6, "psi": 6, "prediction_mean_delta": 6}


def _r(*names: str) -> str:
    return ", ".join(f"settle({n}, {DIGITS[n]}) as {n}" for n in names)


# --- Spark side --------------------------------------------------------------------------


def drift_table(d: Data, *stats: str, numeric: list[str] = NUMERIC, categorical: list[str] = CATEGORICAL) -> DataFrame:
    return mon.drift_metrics(
        d.monitored(d.base), d.monitored(d.drifted), TS, numeric, categorical, slices=tuple(SLICES), stats=stats or mon.STATS)


def published(d: Data, *stats: str, **cols: list[str]) -> DataFrame:
    """The drift table as the alerts find it: written once, read by all of them."""
    return materialize(drift_table(d, *stats, **cols), "drift-metrics")


def flat(drift: DataFrame, *names: str) -> DataFrame:
    """Nested drift rows as plain columns, rounded."""
    out = drift.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "granularity", "column_name",
        "slice_key", "slice_value", F.col("ks_test.statistic").alias("ks_statistic"), F.col("ks_test.pvalue").alias("ks_pvalue"),
        F.col("chi_squared_test.statistic").alias("chi2_statistic"), F.col("chi_squared_test.pvalue").alias("chi2_pvalue"),
        "wasserstein_distance", "population_stability_index", "avg_delta", "count", "baseline_count")
    keep = ["window_start", "window_end", "granularity", "column_name", "slice_key", "slice_value"]
    return rounded(out.select(*keep, *names), DIGITS)


HEAD = f"{WIN}, column_name, {SLICE_OUT}"


@query("drift_ks", f"with {M}, {_num()} select {HEAD}, {_r('ks_statistic', 'ks_pvalue')} from num", VIEWS)
def drift_ks(d: Data):
    return flat(drift_table(d, "ks", categorical=[]), "ks_statistic", "ks_pvalue")


@query("drift_wasserstein", f"with {M}, {_num()} select {HEAD}, {_r('wasserstein_distance')} from num", VIEWS)
def drift_wasserstein(d: Data):
    return flat(drift_table(d, "wasserstein", categorical=[]), "wasserstein_distance")


@query("drift_chi2", f"with {M}, {_cat()} select {HEAD}, {_r('chi2_statistic', 'chi2_pvalue')} from cat", VIEWS)
def drift_chi2(d: Data):
    return flat(drift_table(d, "chi2", numeric=[]), "chi2_statistic", "chi2_pvalue")


@query("drift_psi", f"with {M}, {_num()}, {_cat()}, {FLAT} select {HEAD}, {_r('population_stability_index')} from flat", VIEWS)
def drift_psi(d: Data):
    return flat(drift_table(d, "psi"), "population_stability_index")


@query("drift_avg_delta", f"with {M}, {_num()} select {HEAD}, {_r('avg_delta')} from num", VIEWS)
def drift_avg_delta(d: Data):
    return flat(drift_table(d, "avg_delta", categorical=[]), "avg_delta")


@query("drift_metrics", f"""with {M}, {_num()}, {_cat()}, {FLAT}
  select {HEAD}, {_r('ks_statistic', 'ks_pvalue', 'chi2_statistic', 'chi2_pvalue', 'wasserstein_distance', 'population_stability_index', 'avg_delta')},
         n_cur as "count", n_base as baseline_count from flat""", VIEWS)
def drift_metrics(d: Data):
    return flat(
        drift_table(d), "ks_statistic", "ks_pvalue", "chi2_statistic", "chi2_pvalue", "wasserstein_distance",
        "population_stability_index", "avg_delta", "count", "baseline_count")


_NOW = "select * from ({})"
_PREV = "select column_name, sk, sv, granularity, window_end as window_start, window_end + (window_end - window_start) as window_end, v, n from ({})"


@query("drift_consecutive", f"""
  with txn_m as (select *, prediction_champion as prediction from txn),
  {_ctes_num(GROUP, GROUP, _PREV.format(_long('txn_m', NUMERIC, 'double', True)), _NOW.format(_long('txn_m', NUMERIC, 'double', True)))},
  {_ctes_cat(GROUP, GROUP, _PREV.format(_long('txn_m', CATEGORICAL, 'varchar', True)), _NOW.format(_long('txn_m', CATEGORICAL, 'varchar', True)))}, {FLAT}
  select {HEAD}, {_r('ks_statistic', 'ks_pvalue', 'chi2_statistic', 'chi2_pvalue', 'wasserstein_distance', 'population_stability_index', 'avg_delta')} from flat""")
def drift_consecutive(d: Data):
    found = mon.drift_consecutive(d.monitored(d.txn), TS, NUMERIC, CATEGORICAL, slices=tuple(SLICES))
    return flat(found, "ks_statistic", "ks_pvalue", "chi2_statistic", "chi2_pvalue", "wasserstein_distance", "population_stability_index", "avg_delta")


# --- windows, profile, quality -----------------------------------------------------------


@query("tumbling_windows", f"""
  select transaction_id, g.granularity, date_trunc(g.unit, {TS}) as window_start, date_trunc(g.unit, {TS}) + g.len as window_end
  from txn cross join {GRAINS}""")
def tumbling_windows(d: Data):
    return windows(d.txn.select("transaction_id", TS), TS).drop(TS)


@query("slice_grouping", f"""
  with s as (select date_trunc('day', {TS}) as window_start, home_country, home_state, transaction_amount, is_fraud from txn)
  select window_start, case when home_country is not null then 'home_country' when home_state is not null then 'home_state' end as slice_key,
         coalesce(home_country, home_state) as slice_value, n, frauds, settle(amount, 2) as amount
  from (select window_start, home_country, home_state, count(*) as n, count(*) filter (is_fraud) as frauds, sum(transaction_amount) as amount
        from s group by grouping sets ((window_start), (window_start, home_country), (window_start, home_state)))""")
def slice_grouping(d: Data):
    grouped = mon.slice_grouping(
        d.txn, [F.date_trunc("day", TS)], SLICES,
        [F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("is_fraud"), 1)).alias("frauds"), F.sum("transaction_amount").alias("amount")])
    return rounded(grouped.withColumnRenamed("_by0", "window_start"), {"amount": 2})


PROFILE_COLS = ["transaction_amount", "points", "prediction", "risk"]
TEXT_COLS = ["merchant_category", "transaction_status"]
RISK = "case when points = 0 then 'nan'::double when points = 8 then 'inf'::double when points = 10 then null else points / 7e0 end"
_spread_log = SPREAD.format(cols="l.*", source="log l")


def with_risk(log: DataFrame) -> DataFrame:
    """The log with a column that has NULL, NaN and infinite values."""
    points = F.col("points")
    return log.withColumn("risk", F.when(points == 0, float("nan")).when(points == 8, float("inf")).when(points != 10, points / 7.0))


def profile_table(d: Data) -> DataFrame:
    """The published profile table: windows of the log, its baseline, and quality rows."""
    log, base = with_risk(d.log), with_risk(d.log.filter(F.col(TS) < F.lit(CUT).cast("timestamp")))
    return mon.profile_table(log, TS, PROFILE_COLS, TEXT_COLS, SLICES, "is_fraud", "prediction", base)


def _profiled(spread: str, window: str, kind: str) -> str:
    number = " union all ".join(f"select model_version, {window}, slice_key, slice_value, '{c}' as column_name, cast({c} as double) as v from {spread}" for c in PROFILE_COLS)
    text = " union all ".join(f"select model_version, {window}, slice_key, slice_value, '{c}' as column_name, cast({c} as varchar) as t from {spread}" for c in TEXT_COLS)
    out = [c.rsplit(" as ", 1)[-1].strip() for c in window.split(", ")]
    keys = f"model_version, {', '.join(out)}, slice_key, slice_value, column_name"
    return f"""
      select {keys}, '{kind}' as log_type, count(x) as "count", count(*) filter (v is null) as num_nulls, count(v) - count(x) as num_nan, settle(avg(x), 8) as "avg",
        min(x) as "min", max(x) as "max", settle(stddev_samp(x), 6) as stddev, count(distinct x) as distinct_count
      from (select *, case when isfinite(v) then v end as x from ({number})) group by all
      union all select {keys}, '{kind}', count(t), count(*) - count(t), 0, null, null, null, null, count(distinct t) from ({text}) group by all"""


_none = "null::varchar as granularity, null::timestamp as window_start, null::timestamp as window_end"


@query("monitor_profile", f"""
  with noted as (select *, {RISK} as risk from log),
  spread as ({SPREAD.format(cols="l.*", source="noted l")}),
  base_spread as (select l.*, s.k as slice_key, case s.k when 'home_country' then home_country when 'home_state' then home_state end as slice_value
    from noted l cross join (values (null), ('home_country'), ('home_state')) s(k) where {TS} < timestamp '{CUT}')
  {_profiled("spread", WIN, "INPUT")} union all {_profiled("base_spread", _none, "BASELINE")}""", ("log",))
def monitor_profile(d: Data):
    rows = profile_table(d).filter("column_name <> ':table'").select(
        "model_version", "granularity", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "slice_key",
        "slice_value", "column_name", "log_type", "count", "num_nulls", "num_nan", "avg", "min", "max", "stddev", "distinct_count")
    return rounded(rows, {"avg": 8, "stddev": 6})


QUALITY = f"""
  spread as ({_spread_log}),
  cell as (select model_version, {WIN}, slice_key, slice_value, count(*) filter (is_fraud = 1 and prediction = 1) as tp,
      count(*) filter (is_fraud = 0 and prediction = 1) as fp, count(*) filter (is_fraud = 1 and prediction = 0) as fn,
      count(*) filter (is_fraud = 0 and prediction = 0) as tn from spread group by all),
  cls as (select * exclude (tp, fp, fn, tn), '1' as c, tp as hit, tp + fn as support, tp + fp as predicted, tp + fp + fn + tn as n, tp + tn as ok from cell
    union all select * exclude (tp, fp, fn, tn), '0', tn, tn + fp, tn + fn, tp + fp + fn + tn, tp + tn from cell),
  rate as (select *, coalesce(hit / nullif(predicted, 0), 0) as pr, coalesce(hit / nullif(support, 0), 0) as re,
      coalesce(2 * hit / nullif(predicted + support, 0), 0) as f1 from cls where support + predicted > 0),
  quality as (select model_version, {WIN}, slice_key, slice_value, max(n) as n, max(ok) / max(n) as accuracy_score,
      sum(pr * support) / max(n) as precision_weighted, sum(re * support) / max(n) as recall_weighted, sum(f1 * support) / max(n) as f1_weighted,
      avg(pr) as precision_macro, avg(re) as recall_macro, max(case when c = '1' then re end) as recall_of_1
    from rate group by all)"""
QCOLS = ["accuracy_score", "precision_weighted", "recall_weighted", "f1_weighted", "precision_macro", "recall_macro", "recall_of_1"]


@query("monitor_quality", f"""with {QUALITY}
  select model_version, {WIN}, slice_key, slice_value, 'INPUT' as log_type, n as "count", {', '.join(f'settle({c}, 6) as {c}' for c in QCOLS)} from quality""", ("log",))
def monitor_quality(d: Data):
    table = mon.profile_table(d.log, TS, [], [], SLICES, "is_fraud", "prediction")
    rows = table.filter("column_name = ':table'").select(
        "model_version", "granularity", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "slice_key", "slice_value", "log_type", "count", "accuracy_score",
        *[F.col(f"{m}.weighted").alias(f"{n}_weighted") for m, n in (("precision", "precision"), ("recall", "recall"), ("f1_score", "f1"))],
        F.col("precision.macro").alias("precision_macro"), F.col("recall.macro").alias("recall_macro"),
        F.try_element_at("recall.one_vs_all", F.lit("1")).alias("recall_of_1"))
    return rounded(rows, dict.fromkeys(QCOLS, 6))


def _means(source: str, window: str, avg: str) -> str:
    return " union all ".join(
        f"select {window}slice_key, slice_value, '{c}' as column_name, count({c}) as n, avg({'hour(' + TS + ')' if c == 'hour_of_day' else c}) as {avg} from {source} group by all"
        .replace(f"count({c})", f"count({TS})" if c == "hour_of_day" else f"count({c})") for c in NUMERIC)


@query("baseline_align", f"""
  with {M}, spread_b as (select l.*, s.k as slice_key, case s.k when 'home_country' then home_country when 'home_state' then home_state end as slice_value
      from base_m l cross join (values (null), ('home_country'), ('home_state')) s(k)),
  spread_c as ({SPREAD.format(cols="l.*", source="drifted_m l")}),
  bg as ({_means("spread_b", "", "baseline_avg")}), cg as ({_means("spread_c", WIN + ", ", '"avg"')})
  select {WIN}, cg.slice_key, cg.slice_value, cg.column_name, cg.n as "count", settle(cg."avg", 6) as "avg", settle(baseline_avg, 6) as baseline_avg, bg.n as baseline_count
  from cg left join bg on cg.column_name = bg.column_name and cg.slice_key is not distinct from bg.slice_key and cg.slice_value is not distinct from bg.slice_value""", VIEWS)
def baseline_align(d: Data):
    table = mon.profile_table(d.monitored(d.drifted), TS, NUMERIC, [], SLICES, baseline=d.monitored(d.base), by=())
    paired = mon.align_baseline(table).select(
        "granularity", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *mon.SLICE, "column_name",
        "count", "avg", "baseline_avg", "baseline_count")
    return rounded(paired, {"avg": 6, "baseline_avg": 6})


# --- alerts ------------------------------------------------------------------------------

SINCE = f"window_start >= date '{AS_OF}' - interval {LOOKBACK} day"
FEATURE_ALERT = f"""
  select window_start, window_end, column_name, granularity, {_r('ks_statistic', 'ks_pvalue', 'chi2_statistic', 'chi2_pvalue', 'wasserstein_distance')},
         settle(population_stability_index, 6) as psi from flat
  where sk = '' and column_name not in ('prediction', ':table') and {SINCE} and (ks_pvalue < 0.05 or chi2_pvalue < 0.05)"""


@query("alert_feature_drift", f"with {M}, {_num()}, {_cat()}, {FLAT} {FEATURE_ALERT}", VIEWS)
def alert_feature_drift(d: Data):
    return rounded(al.alert_feature_drift(published(d), AS_OF, LOOKBACK), DIGITS)


@query("sort_coalesce", f"""with {M}, {_num()}, {_cat()}, {FLAT}
  select column_name, granularity, window_start, settle(coalesce(ks_pvalue, chi2_pvalue), 6) as pvalue from flat where sk = '' and n_cur > 1
  order by coalesce(ks_pvalue, chi2_pvalue), granularity, window_start, column_name""", VIEWS)
def sort_coalesce(d: Data):
    rows = flat(drift_table(d, "ks", "chi2"), "ks_pvalue", "chi2_pvalue").filter(F.col("slice_key").isNull())
    rows = rows.select("column_name", "granularity", "window_start", F.coalesce("ks_pvalue", "chi2_pvalue").alias("pvalue"))
    return rows.orderBy(F.col("pvalue").asc_nulls_last(), "granularity", "window_start", "column_name")


@query("limit_one", f"""with {M}, {_cat()}
  select column_name, granularity, window_start, settle(chi2_statistic, 4) as chi2_statistic from cat where sk = ''
  order by chi2_statistic desc nulls last, granularity, window_start, column_name limit 1""", VIEWS)
def limit_one(d: Data):
    rows = flat(drift_table(d, "chi2", numeric=[]), "chi2_statistic").filter(F.col("slice_key").isNull())
    order = [F.col("chi2_statistic").desc_nulls_last(), "granularity", "window_start", "column_name"]
    return rows.select("column_name", "granularity", "window_start", "chi2_statistic").orderBy(*order).limit(1)


def failing_log(d: Data) -> DataFrame:
    """The log with the prediction turned round for three of the five categories."""
    wrong = F.col("merchant_category").isin("click", "view", "error")
    return d.log.withColumn("prediction", F.when(wrong, 1 - F.col("prediction")).otherwise(F.col("prediction")))


QUALITY_BAD = QUALITY.replace("from log l", "from (select * replace (case when merchant_category in ('click', 'view', 'error') then 1 - prediction else prediction end as prediction) from log) l")
QUALITY_ALERT = f"""
  select window_start, window_end, granularity, model_version, settle(accuracy_score, 6) as accuracy_score, settle(precision_weighted, 6) as precision_weighted,
         settle(recall_weighted, 6) as recall_weighted, settle(f1_weighted, 6) as f1_weighted from quality
  where slice_key is null and {SINCE} and (recall_weighted < 0.40 or precision_weighted < 0.50 or f1_weighted < 0.45)"""


def quality_alert(d: Data) -> DataFrame:
    return al.alert_model_quality(mon.quality(failing_log(d), TS, "is_fraud", "prediction", SLICES), AS_OF, LOOKBACK)


@query("alert_model_quality", f"with {QUALITY_BAD} {QUALITY_ALERT}", ("log",))
def alert_model_quality(d: Data):
    return rounded(quality_alert(d), dict.fromkeys(("accuracy_score", "precision_weighted", "recall_weighted", "f1_weighted"), 6))


PSI_ALERT = f"""
  select window_start, window_end, granularity, settle(population_stability_index, 6) as psi, {_r('wasserstein_distance')},
         settle(avg_delta, 6) as prediction_mean_delta from flat
  where sk = '' and column_name = 'prediction' and {SINCE} and population_stability_index > 0.2"""


@query("alert_prediction_psi", f"with {M}, {_num()}, {_cat()}, {FLAT} {PSI_ALERT}", VIEWS)
def alert_prediction_psi(d: Data):
    return rounded(al.alert_prediction_psi(
        published(d, "psi", "wasserstein", "avg_delta", numeric=["prediction"], categorical=[]), AS_OF, LOOKBACK), DIGITS)


@query("alert_evaluate", f"""with {M}, {_num()}, {_cat()}, {FLAT}, {QUALITY_BAD},
  n as (select 'feature_drift' as alert, count(*) as row_count from ({FEATURE_ALERT})
    union all select 'model_quality', count(*) from ({QUALITY_ALERT})
    union all select 'prediction_psi', count(*) from ({PSI_ALERT})
    union all select 'prediction_psi_future', 0)
  select alert, cast(row_count as bigint) as row_count, case when row_count > 0 then 'FIRED' else 'OK' end as state from n""", ("base", "drifted", "log"))
def alert_evaluate(d: Data):
    drift = published(d)
    found = {
        "feature_drift": al.alert_feature_drift(drift, AS_OF, LOOKBACK),
        "model_quality": quality_alert(d),
        "prediction_psi": al.alert_prediction_psi(drift, AS_OF, LOOKBACK),
        "prediction_psi_future": al.alert_prediction_psi(drift, "2030-01-01", LOOKBACK),
    }
    return al.alert_evaluate(found, {name: ("window_start", ">", 0) for name in found})


@query("alert_demo", "select 'demo' as alert_reason, count(*) > 0 as fired from txn")
def alert_demo(d: Data):
    table = mon.quality(d.log, TS, "is_fraud", "prediction", SLICES)
    return al.alert_demo(table).select("alert_reason", F.col("ts").isNotNull().alias("fired"))
