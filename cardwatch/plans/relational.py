"""Scans, projections, predicates, aggregates, sorts, set operations and scalar functions."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import functions as F

from cardwatch.functions.columns import (
    archive_alias, clean_name, clip, has_prefix, last_part, model_uri, noise, padded_id, pct_change,
    recent, uniform, uri_alias,
)
from cardwatch.functions.timeparts import apply_functions, register_time_functions, with_time_features
from cardwatch.operators import features as ft
from cardwatch.operators import relational as rel
from cardwatch.plans.data import AS_OF, CHAMPION, Data
from cardwatch.plans.registry import query, settle
from cardwatch.schemas import LINEITEM
from cardwatch.sources import tables as src

# --- scans -------------------------------------------------------------------------------


@query("scan_project", "select l_orderkey, l_linenumber, l_quantity, l_returnflag from lineitem", ())
def scan_project(d: Data):
    return src.scan(d.spark, f"{d.folder}/lineitem.parquet", LINEITEM, columns=["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"])


@query("scan_count", """
  select 'events' as table_name, count(*) as row_count from events
  union all select 'customer', count(*) from customer
  union all select 'orders', count(*) from orders
  union all select 'lineitem', count(*) from lineitem""", ())
def scan_count(d: Data):
    return src.scan_count({t: d.table(t) for t in ("events", "customer", "orders", "lineitem")})


@query("preview_rows", "select event_id, user_id, event_type, value from events order by value desc, event_id limit 5", ())
def preview_rows(d: Data):
    rows = d.events.select("event_id", "user_id", "event_type", "value")
    return src.preview(rows, [F.col("value").desc(), "event_id"], 5)


@query("describe_schema", """
  with one as (select typeof(columns(*)) from (select * from txn limit 1))
  select col_name, case data_type when 'VARCHAR' then 'string' when 'INTEGER' then 'int' else lower(data_type) end as data_type
  from (unpivot one on columns(*) into name col_name value data_type)""")
def describe_schema(d: Data):
    return src.describe_schema(d.txn)


# --- projections and predicates ----------------------------------------------------------


@query("project_columns", """
  select card_id, transaction_timestamp, transaction_amount, transaction_country, transaction_state,
         merchant_category, transaction_status, cast(is_vpn_used as int) as is_vpn_used, is_fraud from txn""")
def project_columns(d: Data):
    return d.txn.withColumn("is_vpn_used", F.col("is_vpn_used").cast("int")).select(
        "card_id", "transaction_timestamp", "transaction_amount", "transaction_country", "transaction_state",
        "merchant_category", "transaction_status", "is_vpn_used", "is_fraud")


@query("drop_columns", "select * exclude (card_id, transaction_id, transaction_timestamp) from txn")
def drop_columns(d: Data):
    return d.txn.drop("card_id", "transaction_id", "transaction_timestamp")


@query("feature_select", "select * exclude (transaction_id, card_id, transaction_timestamp, is_fraud, points) from txn")
def feature_select(d: Data):
    return ft.feature_select(d.txn, exclude=("transaction_id", "card_id", "transaction_timestamp", "is_fraud", "points"))


@query("constant_column", f"select transaction_id, '{CHAMPION}' as model_version from txn")
def constant_column(d: Data):
    return ft.tag(d.txn.select("transaction_id"), "model_version", CHAMPION)


@query("struct_pack", """
  select transaction_id, transaction_amount as f_amount, merchant_category as f_category, is_vpn_used as f_vpn from txn""")
def struct_pack(d: Data):
    packed = ft.pack(d.txn, ["transaction_amount", "merchant_category", "is_vpn_used"])
    return packed.select(
        "transaction_id", F.col("features.transaction_amount").alias("f_amount"),
        F.col("features.merchant_category").alias("f_category"), F.col("features.is_vpn_used").alias("f_vpn"))


@query("struct_access", """
  select date_trunc('day', transaction_timestamp) as window_start,
         date_trunc('day', transaction_timestamp) + interval 1 day as window_end,
         settle(avg(transaction_amount), 6) as avg_amount, max(transaction_amount) as max_amount
  from txn group by 1, 2""")
def struct_access(d: Data):
    nested = d.txn.groupBy(F.window("transaction_timestamp", "1 day").alias("window")).agg(
        F.struct(F.avg("transaction_amount").alias("avg"), F.max("transaction_amount").alias("max")).alias("amount"))
    return nested.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        settle("amount.avg", 6).alias("avg_amount"), F.col("amount.max").alias("max_amount"))


@query("filter_equals", f"select transaction_id, prediction from log where model_version = '{CHAMPION}'", ("log",))
def filter_equals(d: Data):
    return d.log.filter(F.col("model_version") == CHAMPION).select("transaction_id", "prediction")


@query("filter_null_aware", """
  select transaction_id, case when transaction_state <> 'N/A' then transaction_state end as state,
         case when transaction_state = 'N/A' then 'abroad' else 'home' end as place from txn
  where transaction_state is not null""")
def filter_null_aware(d: Data):
    state = F.when(F.col("transaction_state") != "N/A", F.col("transaction_state"))
    rows = d.txn.select("transaction_id", state.alias("state"))
    abroad = rows.filter(F.col("state").isNull()).withColumn("place", F.lit("abroad"))
    home = rows.filter(F.col("state").isNotNull()).withColumn("place", F.lit("home"))
    return abroad.unionByName(home)


@query("filter_not_in", "select transaction_id, merchant_category from txn where merchant_category not in ('view', 'click')")
def filter_not_in(d: Data):
    return d.txn.filter(~F.col("merchant_category").isin("view", "click")).select("transaction_id", "merchant_category")


@query("filter_disjunction", """
  select transaction_id, transaction_amount, points from txn
  where transaction_status = 'approved' and (transaction_amount > 150 or points >= 30
        or case when transaction_state <> 'N/A' then length(transaction_state) end < 5)""")
def filter_disjunction(d: Data):
    known = F.when(F.col("transaction_state") != "N/A", F.length("transaction_state"))
    hit = (F.col("transaction_amount") > 150) | (F.col("points") >= 30) | (known < 5)
    return d.txn.filter((F.col("transaction_status") == "approved") & hit).select("transaction_id", "transaction_amount", "points")


@query("filter_recent", f"""
  select transaction_id, transaction_timestamp from txn
  where transaction_timestamp >= date '{AS_OF}' - interval 2 day""")
def filter_recent(d: Data):
    return d.txn.filter(recent(F.col("transaction_timestamp"), AS_OF, 2)).select("transaction_id", "transaction_timestamp")


@query("case_when", """
  select event_id, case when value > 100 then 'high' when value > 20 then 'mid' else 'low' end as band,
         case when event_type = 'error' then 'declined' else 'approved' end as status from events""", ())
def case_when(d: Data):
    band = F.when(F.col("value") > 100, "high").when(F.col("value") > 20, "mid").otherwise("low")
    status = F.when(F.col("event_type") == "error", "declined").otherwise("approved")
    return d.events.select("event_id", band.alias("band"), status.alias("status"))


@query("is_in_set", "select transaction_id, merchant_category in ('purchase', 'signup') as risky from txn")
def is_in_set(d: Data):
    return d.txn.select("transaction_id", F.col("merchant_category").isin("purchase", "signup").alias("risky"))


@query("bool_logic", "select transaction_id, is_vpn_used or (is_fraud and transaction_amount > 100) as boosted from txn")
def bool_logic(d: Data):
    boosted = F.col("is_vpn_used") | (F.col("is_fraud") & (F.col("transaction_amount") > 100))
    return d.txn.select("transaction_id", boosted.alias("boosted"))


@query("prefix_filter", """
  select p_partkey, p_type from part where starts_with(p_type, 'PROMO') or starts_with(p_type, 'STANDARD')""", ())
def prefix_filter(d: Data):
    return d.table("part").filter(has_prefix(F.col("p_type"), ["PROMO", "STANDARD"])).select("p_partkey", "p_type")


@query("rename_columns", "select merchant_category as category, count(*) as cv_rows from txn group by 1")
def rename_columns(d: Data):
    return d.txn.groupBy("merchant_category").count().withColumnsRenamed({"merchant_category": "category", "count": "cv_rows"})


# --- aggregates --------------------------------------------------------------------------


@query("class_balance", """
  select is_fraud, count(*) as n, round(count(*) * 100e0 / sum(count(*)) over (), 2) as pct from txn group by is_fraud""")
def class_balance(d: Data):
    return rel.class_balance(d.txn, "is_fraud")


@query("percent_of_total", """
  select o_orderpriority, n, round(n * 100e0 / sum(n) over (), 2) as pct
  from (select o_orderpriority, count(*) as n from orders group by 1)""", ())
def percent_of_total(d: Data):
    return rel.class_balance(d.table("orders"), "o_orderpriority")


@query("hourly_fraud_rate", """
  select cast(hour(transaction_timestamp) as int) as hour_of_day, count(*) as transactions,
         cast(sum(cast(is_fraud as int)) as bigint) as frauds, round(avg(cast(is_fraud as int)), 4) as fraud_rate
  from txn group by 1 order by 1""")
def hourly_fraud_rate(d: Data):
    return rel.hourly_rate(d.txn, "transaction_timestamp", "is_fraud")


@query("amount_by_label", """
  select is_fraud, floor(transaction_amount / 25e0) * 25e0 as bin_low, count(*) as n from txn group by 1, 2""")
def amount_by_label(d: Data):
    return rel.amount_hist(d.txn, "transaction_amount", "is_fraud", 25.0)


@query("amount_quantiles", """
  select is_fraud, settle(quantile_cont(transaction_amount, 0.25), 6) as q25,
         settle(quantile_cont(transaction_amount, 0.5), 6) as q50,
         settle(quantile_cont(transaction_amount, 0.99), 6) as q99 from txn group by 1""")
def amount_quantiles(d: Data):
    found = rel.amount_quantiles(d.txn, "transaction_amount", "is_fraud", {"q25": 0.25, "q50": 0.5, "q99": 0.99})
    return found.select("is_fraud", *[settle(c, 6).alias(c) for c in ("q25", "q50", "q99")])


CORR = {
    "transaction_amount": "transaction_amount", "points": "points", "is_vpn_used": "cast(is_vpn_used as int)",
    "hour_of_day": "hour(transaction_timestamp)", "day_of_week": "isodow(transaction_timestamp) - 1",
    "prediction_champion": "prediction_champion", "is_fraud": "cast(is_fraud as int)",
}


def _corr_sql() -> str:
    cells = []
    for a, b in combinations_with_replacement(CORR, 2):
        r = "1e0" if a == b else f"settle(corr({CORR[a]}, {CORR[b]}), 6)"
        cells.append((a, b, r))
        if a != b:
            cells.append((b, a, r))
    return " union all ".join(f"select '{a}' as column_a, '{b}' as column_b, {r} as r from txn" for a, b, r in cells if r != "1e0") + "".join(
        f" union all select '{a}', '{a}', 1e0" for a in CORR)


@query("correlation_matrix", _corr_sql())
def correlation_matrix(d: Data):
    rows = with_time_features(d.txn, "transaction_timestamp").select(*[F.col(c).cast("double").alias(c) for c in CORR])
    return rel.correlation(rows, list(CORR)).withColumn("r", settle("r", 6))


@query("model_row_counts", "select model_version, count(*) as n from log group by rollup(model_version)", ("log",))
def model_row_counts(d: Data):
    return rel.counts_with_total(d.log, "model_version")


@query("distinct_keys", "select distinct card_id from txn")
def distinct_keys(d: Data):
    return ft.distinct_keys(d.txn, "card_id")


@query("column_means", """
  select 'l_quantity' as column_name, settle(avg(l_quantity), 6) as mean from lineitem
  union all select 'l_discount', settle(avg(l_discount), 6) from lineitem
  union all select 'l_tax', settle(avg(l_tax), 6) from lineitem""", ())
def column_means(d: Data):
    return rel.means(d.table("lineitem"), ["l_quantity", "l_discount", "l_tax"]).withColumn("mean", settle("mean", 6))


@query("fraud_rate", """
  select settle(avg(cast(is_fraud as int)), 6) as rate, settle(avg(cast(is_fraud as int)) * 100, 4) as rate_pct from txn""")
def fraud_rate(d: Data):
    rate = F.avg(F.col("is_fraud").cast("double"))
    return d.txn.agg(settle(rate, 6).alias("rate"), settle(rate * 100, 4).alias("rate_pct"))


# --- sorts, limits, set operations -------------------------------------------------------


@query("sort_by_key", "select o_orderkey, o_totalprice from orders order by o_totalprice, o_orderkey", ())
def sort_by_key(d: Data):
    return d.table("orders").select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey")


@query("union_models", "select transaction_id, model_version, prediction from log", ("log",))
def union_models(d: Data):
    champion = d.log.filter(F.col("model_version") == CHAMPION).select("transaction_id", "model_version", "prediction")
    challenger = d.log.filter(F.col("model_version") != CHAMPION).select("prediction", "model_version", "transaction_id")
    return champion.unionByName(challenger)


@query("key_difference", """
  select distinct concat('CC_', lpad(cast(c_custkey as varchar), 6, '0')) as card_id from customer
  except select card_id from txn""")
def key_difference(d: Data):
    return rel.key_difference(d.dim, d.txn, "card_id")


@query("metric_name_union", """
  select distinct metric from run_metrics where value < 0.8
  union select distinct metric from run_metrics where value >= 0.8""", ("run_metrics",))
def metric_name_union(d: Data):
    low, high = d.run_metrics.filter(F.col("value") < 0.8), d.run_metrics.filter(F.col("value") >= 0.8)
    return rel.name_union(low, high, "metric")


# --- scalar functions --------------------------------------------------------------------


@query("time_features", """
  select transaction_id, cast(hour(transaction_timestamp) as int) as hour_of_day,
         cast(isodow(transaction_timestamp) - 1 as int) as day_of_week from txn""")
def time_features(d: Data):
    return with_time_features(d.txn, "transaction_timestamp").select("transaction_id", "hour_of_day", "day_of_week")


@query("parse_timestamp", """
  select event_id, case when event_id % 7 = 0 then null else date_trunc('second', ts) end as parsed from events""", ())
def parse_timestamp(d: Data):
    text = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("bad "), F.date_format("ts", "HH:mm"))).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return d.events.select("event_id", text.alias("text")).select(
        "event_id", F.try_to_timestamp("text", F.lit("yyyy-MM-dd HH:mm:ss")).alias("parsed"))


@query("bool_to_number", """
  select transaction_id, cast(is_vpn_used as int) as as_int, cast(cast(is_vpn_used as int) as bigint) as as_long,
         cast(cast(is_vpn_used as int) as double) as as_double from txn""")
def bool_to_number(d: Data):
    flag = F.col("is_vpn_used")
    return d.txn.select(
        "transaction_id", flag.cast("int").alias("as_int"), flag.cast("long").alias("as_long"), flag.cast("double").alias("as_double"))


@query("number_or_null", """
  select event_id, case when event_id % 5 = 0 then null else value end as amount,
         case when event_id % 5 = 0 then null else user_id end as number from events""", ())
def number_or_null(d: Data):
    def spoilt(c: str):
        return F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("n/a "), F.col(c).cast("string"))).otherwise(F.col(c).cast("string"))
    return d.events.select("event_id", spoilt("value").try_cast("double").alias("amount"), spoilt("user_id").try_cast("bigint").alias("number"))


@query("round_digits", """
  select l_orderkey, l_linenumber, round(sqrt(l_extendedprice), 1) as r1, round(sqrt(l_extendedprice), 2) as r2,
         round(sqrt(l_extendedprice), 3) as r3, round(sqrt(l_extendedprice), 4) as r4 from lineitem""", ())
def round_digits(d: Data):
    root = F.sqrt("l_extendedprice")
    return d.table("lineitem").select("l_orderkey", "l_linenumber", *[F.round(root, n).alias(f"r{n}") for n in (1, 2, 3, 4)])


@query("clip_range", """
  select event_id, case when event_type = 'error' then null else greatest(1e0, least(80e0, value)) end as clipped from events""", ())
def clip_range(d: Data):
    value = F.when(F.col("event_type") != "error", F.col("value"))
    return d.events.select("event_id", clip(value, 1.0, 80.0).alias("clipped"))


@query("percent_change", """
  select l_orderkey, l_linenumber, case when l_discount = 0 then null
         else settle((l_tax - l_discount) * 100e0 / l_discount, 6) end as change_pct from lineitem""", ())
def percent_change(d: Data):
    change = settle(pct_change(F.col("l_tax"), F.col("l_discount")), 6)
    return d.table("lineitem").select("l_orderkey", "l_linenumber", change.alias("change_pct"))


@query("coalesce_values", """
  select transaction_id, coalesce(case when is_vpn_used then transaction_amount end,
         case when points > 10 then cast(points as double) end, 0e0) as first_known from txn""")
def coalesce_values(d: Data):
    first = F.coalesce(
        F.when(F.col("is_vpn_used"), F.col("transaction_amount")), F.when(F.col("points") > 10, F.col("points").cast("double")), F.lit(0.0))
    return d.txn.select("transaction_id", first.alias("first_known"))


@query("date_shift", """
  select event_id, ts - interval 1 day as day_before, ts - interval 90 minute as earlier,
         cast(ts as date) - 1 as date_before from events""", ())
def date_shift(d: Data):
    return d.events.select(
        "event_id", (F.col("ts") - F.expr("INTERVAL 1 DAY")).alias("day_before"),
        (F.col("ts") - F.expr("INTERVAL 90 MINUTES")).alias("earlier"), F.date_sub("ts", 1).alias("date_before"))


@query("stamp_time")
def stamp_time(d: Data):
    return d.txn.select("transaction_id", F.current_timestamp().alias("scored_at"))


@query("format_id", """
  select user_id, concat('CC_', lpad(cast(user_id as varchar), 4, '0')) as card_id,
         concat('DTXN_', lpad(cast(event_id as varchar), 5, '0')) as transaction_id from events""", ())
def format_id(d: Data):
    return d.events.select(
        "user_id", padded_id("CC_", F.col("user_id"), 4).alias("card_id"), padded_id("DTXN_", F.col("event_id"), 5).alias("transaction_id"))


@query("format_time_alias", "select event_id, concat('archive_', strftime(ts, '%Y%m%d_%H%M%S')) as alias from events", ())
def format_time_alias(d: Data):
    return d.events.select("event_id", archive_alias(F.col("ts")).alias("alias"))


@query("name_part", """
  select c_custkey, c_name as table_part, concat('models:/bank.', c_mktsegment, '.', c_name, '@champion') as uri,
         'champion' as alias from customer""", ())
def name_part(d: Data):
    full = F.concat_ws(".", F.lit("bank"), "c_mktsegment", "c_name")
    uri = model_uri(full, F.lit("champion"))
    return d.table("customer").select(
        "c_custkey", last_part(full).alias("table_part"), uri.alias("uri"), uri_alias(uri).alias("alias"))


@query("clean_alert_name", """
  select event_id, concat(event_type, ' drift (KS - chi ', cast(user_id as varchar), ')') as name from events""", ())
def clean_alert_name(d: Data):
    raw = F.concat(F.lit("-- Alert "), (F.col("event_id") % 40).cast("string"), F.lit(":  "), "event_type",
                   F.lit(" drift (KS / chi "), F.col("user_id").cast("string"), F.lit(")"))
    return d.events.select("event_id", clean_name(raw).alias("name"))


@query("random_noise", """
  select transaction_id, settle(u, 9) as uniform, settle((u - 0.5e0) * 0.16e0, 9) as noise
  from (select transaction_id,
               cast('0x' || substr(md5(concat(transaction_id, ':77')), 1, 8) as bigint) / 4294967296e0 as u from txn)""")
def random_noise(d: Data):
    key = F.col("transaction_id")
    return d.txn.select(
        "transaction_id", settle(uniform(key, 77), 9).alias("uniform"), settle(noise(key, 0.16, 77), 9).alias("noise"))


# --- named functions ---------------------------------------------------------------------

FUNCTIONS_SQL = """
  select transaction_id, cast(hour(transaction_timestamp) as int) as hour_of_day,
         cast(isodow(transaction_timestamp) - 1 as int) as day_of_week from txn"""


@query("sql_time_functions", FUNCTIONS_SQL)
def sql_time_functions(d: Data):
    register_time_functions(d.spark)
    return d.txn.selectExpr(
        "transaction_id", "extract_hour_of_day(transaction_timestamp) AS hour_of_day",
        "extract_day_of_week(transaction_timestamp) AS day_of_week")


@query("feature_function_binding", FUNCTIONS_SQL)
def feature_function_binding(d: Data):
    register_time_functions(d.spark)
    bound = apply_functions(d.txn, [
        ("extract_hour_of_day", "transaction_timestamp", "hour_of_day"),
        ("extract_day_of_week", "transaction_timestamp", "day_of_week")])
    return bound.select("transaction_id", "hour_of_day", "day_of_week")
