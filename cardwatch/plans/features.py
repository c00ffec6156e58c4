"""Lookups, checks, rolling features, card profile, encodings and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardwatch.operators import features as ft
from cardwatch.operators import relational as rel
from cardwatch.plans.data import Data
from cardwatch.plans.registry import query, rounded, settle
from cardwatch.schemas import FEATURE_COLS

CARD_COLS = ["avg_transaction_amount_90d", "max_monthly_spend_statement", "total_transactions_90d", "hours_since_last_transaction"]
ROUND = {"avg_transaction_amount_90d": 8, "max_monthly_spend_statement": 2, "avg_transactions_per_day_90d": 6,
         "pct_online_transactions_90d": 6, "hours_since_last_transaction": 6}


def _cards_sql(cols: list[str], prefix: str = "") -> str:
    return ", ".join(f"settle({prefix}{c}, {ROUND[c]}) as {c}" if c in ROUND else f"{prefix}{c}" for c in cols)


ALL_CARD_COLS = [
    "avg_transaction_amount_90d", "max_monthly_spend_statement", "total_transactions_90d", "avg_transactions_per_day_90d",
    "max_single_transaction_90d", "pct_online_transactions_90d", "home_country", "home_state", "distinct_countries_90d",
    "distinct_states_90d", "days_since_last_password_reset", "days_since_last_web_login", "hours_since_last_transaction",
    "declined_transactions_30d"]


@query("card_profile_90d", f"select card_id, {_cards_sql(ALL_CARD_COLS)} from cards", ("cards",))
def card_profile_90d(d: Data):
    return rounded(d.cards, ROUND)


@query("join_inner_features", f"""
  select t.transaction_id, t.card_id, t.transaction_amount, {_cards_sql(CARD_COLS, 'c.')}
  from txn t join some_cards c on c.card_id = t.card_id""", ("txn", "some_cards"))
def join_inner_features(d: Data):
    joined = ft.lookup(d.txn.select("transaction_id", "card_id", "transaction_amount"), d.some_cards.select("card_id", *CARD_COLS))
    return rounded(joined, ROUND)


@query("lookup_left", f"""
  select t.transaction_id, t.card_id, {_cards_sql(CARD_COLS, 'c.')}
  from txn t left join some_cards c on c.card_id = t.card_id""", ("txn", "some_cards"))
def lookup_left(d: Data):
    joined = ft.lookup(d.txn.select("transaction_id", "card_id"), d.some_cards.select("card_id", *CARD_COLS), how="left")
    return rounded(joined, ROUND)


@query("training_set", f"""
  select t.transaction_amount, t.transaction_country, t.transaction_state, t.merchant_category, t.transaction_status,
         cast(t.is_vpn_used as int) as is_vpn_used, {_cards_sql(ALL_CARD_COLS, 'c.')},
         cast(hour(transaction_timestamp) as int) as hour_of_day, cast(isodow(transaction_timestamp) - 1 as int) as day_of_week, t.is_fraud
  from txn t left join cards c on c.card_id = t.card_id""", ("txn", "cards"))
def training_set(d: Data):
    return rounded(_built(d), ROUND)


def _built(d: Data):
    labels = d.txn.select(
        "card_id", "transaction_timestamp", "transaction_amount", "transaction_country", "transaction_state",
        "merchant_category", "transaction_status", F.col("is_vpn_used").cast("int").alias("is_vpn_used"), "is_fraud")
    return ft.training_set(
        labels, [(d.cards, "card_id")], "transaction_timestamp", "is_fraud", exclude=("card_id", "transaction_timestamp"))


def _feature_sql(name: str) -> str:
    own = {"is_vpn_used": "cast(t.is_vpn_used as int)", "hour_of_day": "cast(hour(transaction_timestamp) as int)",
           "day_of_week": "cast(isodow(transaction_timestamp) - 1 as int)"}
    return f"{own[name]} as {name}" if name in own else _cards_sql([name], "c.") if name in ALL_CARD_COLS else f"t.{name}"


@query("ordered_features", f"select {', '.join(map(_feature_sql, FEATURE_COLS))} from txn t left join cards c on c.card_id = t.card_id", ("txn", "cards"))
def ordered_features(d: Data):
    """All model inputs in the order that the model declares."""
    return rounded(ft.feature_select(_built(d), order=FEATURE_COLS), ROUND)


@query("orphan_check", """
  select count(*) as orphans, case when count(*) = 0 then 'PASS' else 'FAIL' end as status
  from (select distinct card_id from txn) t where card_id not in (select card_id from some_cards)""", ("txn", "some_cards"))
def orphan_check(d: Data):
    return ft.orphan_check(d.txn, d.some_cards, "card_id")


@query("key_constraint_check", """
  select 'cards' as table_name, count(*) as row_count, count(*) - count(card_id) as null_keys,
         cast(0 as bigint) as duplicate_keys, 'PASS' as status from cards
  union all
  select 'txn', (select count(*) from txn), cast(0 as bigint), count(*), 'FAIL'
  from (select card_id from txn group by card_id having count(*) > 1)""", ("txn", "cards"))
def key_constraint_check(d: Data):
    good = ft.key_check(d.cards, "card_id").withColumn("table_name", F.lit("cards"))
    bad = ft.key_check(d.txn, "card_id").withColumn("table_name", F.lit("txn"))
    return good.unionByName(bad)


@query("mean_shift_compare", """
  select column_name, settle(b, 6) as baseline_mean, settle(c, 6) as drift_mean, round((c - b) * 100e0 / b, 1) as shift_pct from (
    select 'transaction_amount' as column_name, (select avg(transaction_amount) from base) as b, (select avg(transaction_amount) from drifted) as c
    union all select 'points', (select avg(points) from base), (select avg(points) from drifted)
    union all select 'is_vpn_used', (select avg(cast(is_vpn_used as int)) from base), (select avg(cast(is_vpn_used as int)) from drifted))""",
       ("base", "drifted"))
def mean_shift_compare(d: Data):
    shift = rel.mean_shift(d.base, d.drifted, ["transaction_amount", "points", "is_vpn_used"])
    return rounded(shift, {"baseline_mean": 6, "drift_mean": 6})


# --- rolling -----------------------------------------------------------------------------

ROLLING_SQL = """
  select transaction_id, card_id, transaction_timestamp, transaction_amount,
    count(*) over d1 as txn_count_1d, count(*) over d7 as txn_count_7d,
    avg(transaction_amount) over d1 as txn_amount_avg_1d, avg(transaction_amount) over d7 as txn_amount_avg_7d,
    stddev_samp(transaction_amount) over d7 as txn_amount_std_7d
  from txn
  window d1 as (partition by card_id order by transaction_timestamp range between interval 1 day preceding and current row),
         d7 as (partition by card_id order by transaction_timestamp range between interval 7 day preceding and current row)"""


def _stats(d: Data):
    rows = d.txn.select("transaction_id", "card_id", "transaction_timestamp", "transaction_amount")
    return ft.rolling_stats(rows, "card_id", "transaction_timestamp", "transaction_amount")


@query("rolling_counts", f"with r as ({ROLLING_SQL}) select transaction_id, txn_count_1d, txn_count_7d from r")
def rolling_counts(d: Data):
    return _stats(d).select("transaction_id", "txn_count_1d", "txn_count_7d")


@query("rolling_amounts", f"""with r as ({ROLLING_SQL}) select transaction_id, settle(txn_amount_avg_1d, 8) as txn_amount_avg_1d,
  settle(txn_amount_avg_7d, 8) as txn_amount_avg_7d, settle(txn_amount_std_7d, 5) as txn_amount_std_7d from r""")
def rolling_amounts(d: Data):
    return _stats(d).select(
        "transaction_id", settle("txn_amount_avg_1d", 8).alias("txn_amount_avg_1d"),
        settle("txn_amount_avg_7d", 8).alias("txn_amount_avg_7d"), settle("txn_amount_std_7d", 5).alias("txn_amount_std_7d"))


@query("amount_zscore", f"""with r as ({ROLLING_SQL})
  select transaction_id, settle(case when txn_amount_std_7d > 0 then (transaction_amount - txn_amount_avg_7d) / txn_amount_std_7d end, 5) as amount_zscore from r""")
def amount_zscore(d: Data):
    built = ft.rolling_features(d.txn, "card_id", "transaction_timestamp", "transaction_amount")
    return built.select("transaction_id", settle("amount_zscore", 5).alias("amount_zscore"))


@query("rolling_features", f"""with r as ({ROLLING_SQL})
  select transaction_id, txn_count_1d, txn_count_7d, settle(txn_amount_avg_1d, 8) as txn_amount_avg_1d,
    settle(txn_amount_avg_7d, 8) as txn_amount_avg_7d, settle(txn_amount_std_7d, 5) as txn_amount_std_7d,
    settle(case when txn_amount_std_7d > 0 then (transaction_amount - txn_amount_avg_7d) / txn_amount_std_7d end, 5) as amount_zscore,
    cast(hour(transaction_timestamp) as int) as hour_of_day, cast(isodow(transaction_timestamp) - 1 as int) as day_of_week,
    transaction_amount as amount from r""")
def rolling_features(d: Data):
    built = ft.rolling_features(d.txn, "card_id", "transaction_timestamp", "transaction_amount")
    built = rounded(built, {"txn_amount_avg_1d": 8, "txn_amount_avg_7d": 8, "txn_amount_std_7d": 5, "amount_zscore": 5})
    return built.select(
        "transaction_id", "txn_count_1d", "txn_count_7d", "txn_amount_avg_1d", "txn_amount_avg_7d", "txn_amount_std_7d",
        "amount_zscore", "hour_of_day", "day_of_week", "amount")


@query("rolling_hot_cards", f"""with r as ({ROLLING_SQL}) select transaction_id, txn_count_1d, txn_count_7d,
  settle(txn_amount_avg_7d, 8) as txn_amount_avg_7d, settle(txn_amount_std_7d, 5) as txn_amount_std_7d from r""")
def rolling_hot_cards(d: Data):
    """The same features with a low hot-card limit, so that part of the cards is spread over time buckets."""
    rows = d.txn.select("transaction_id", "card_id", "transaction_timestamp", "transaction_amount")
    built = ft.rolling_stats(rows, "card_id", "transaction_timestamp", "transaction_amount", hot_rows=60)
    return built.select(
        "transaction_id", "txn_count_1d", "txn_count_7d", settle("txn_amount_avg_7d", 8).alias("txn_amount_avg_7d"),
        settle("txn_amount_std_7d", 5).alias("txn_amount_std_7d"))


@query("rolling_distinct", """
  select t.transaction_id,
    (select count(distinct u.transaction_country) from txn u where u.card_id = t.card_id
       and u.transaction_timestamp between t.transaction_timestamp - interval 5 day and t.transaction_timestamp) as distinct_transaction_country,
    (select count(distinct u.transaction_state) from txn u where u.card_id = t.card_id
       and u.transaction_timestamp between t.transaction_timestamp - interval 5 day and t.transaction_timestamp) as distinct_transaction_state
  from txn t""")
def rolling_distinct(d: Data):
    rows = d.txn.select("transaction_id", "card_id", "transaction_timestamp", "transaction_country", "transaction_state")
    built = ft.rolling_distinct(rows, "card_id", "transaction_timestamp", ["transaction_country", "transaction_state"], days=5)
    return built.select("transaction_id", "distinct_transaction_country", "distinct_transaction_state")


# --- encoding, split, drift --------------------------------------------------------------


@query("ordinal_encode", """
  with known as (select distinct merchant_category, transaction_country from base where transaction_country <> 'NATION_7'),
  cat as (select merchant_category as v, row_number() over (order by merchant_category) - 1 as code from (select distinct merchant_category from known)),
  cty as (select transaction_country as v, row_number() over (order by transaction_country) - 1 as code from (select distinct transaction_country from known))
  select t.transaction_id, cast(coalesce(cat.code, -1) as int) as merchant_category, cast(coalesce(cty.code, -1) as int) as transaction_country
  from txn t left join cat on cat.v = t.merchant_category left join cty on cty.v = t.transaction_country""", ("txn", "base"))
def ordinal_encode(d: Data):
    cols = ["merchant_category", "transaction_country"]
    codes = ft.fit_codes(d.base.filter(F.col("transaction_country") != "NATION_7"), cols)
    return ft.apply_codes(d.txn.select("transaction_id", *cols), codes, cols)


@query("stratified_split", """
  select transaction_id, is_fraud, row_number() over (partition by is_fraud order by md5(concat(transaction_id, ':42')))
         <= round(count(*) over (partition by is_fraud) * 0.2e0) as is_test from txn""")
def stratified_split(d: Data):
    return ft.split(d.txn.select("transaction_id", "is_fraud"), "transaction_id", "is_fraud")


@query("stratified_split_by_hash", """
  select transaction_id, cast('0x' || substr(md5(concat(transaction_id, ':42')), 1, 8) as bigint) / 4294967296e0 < 0.2e0 as is_test from txn""")
def stratified_split_by_hash(d: Data):
    return ft.split(d.txn.select("transaction_id"), "transaction_id", "is_fraud", exact=False)


@query("stratified_folds", """
  select transaction_id, is_fraud, cast((row_number() over (partition by is_fraud order by md5(concat(transaction_id, ':42'))) - 1) % 3 as int) as fold from txn""")
def stratified_folds(d: Data):
    return ft.folds(d.txn.select("transaction_id", "is_fraud"), "transaction_id", "is_fraud")


def _u(seed: int) -> str:
    return f"cast('0x' || substr(md5(concat(card_id, ':{seed}')), 1, 8) as bigint) / 4294967296e0"


@query("drift_inject", f"""
  select card_id, settle(max_monthly_spend_statement * (1.2e0 + {_u(99)} * 0.2e0), 4) as max_monthly_spend_statement,
         settle(greatest(0.1e0, least(0.98e0, pct_online_transactions_90d + 0.1e0 + {_u(100)} * 0.2e0)), 6) as pct_online_transactions_90d,
         greatest(1, least(8, distinct_countries_90d + cast(floor({_u(101)} * 3) as int))) as distinct_countries_90d,
         cast(total_transactions_90d % 8 as bigint) as declined_transactions_30d
  from cards""", ("cards",))
def drift_inject(d: Data):
    spec = {
        "max_monthly_spend_statement": ("scale", 1.2, 1.4),
        "pct_online_transactions_90d": ("add", 0.1, 0.3, (0.1, 0.98)),
        "distinct_countries_90d": ("steps", [0, 1, 2], (1, 8)),
        "declined_transactions_30d": ("replace", F.col("total_transactions_90d") % 8),
    }
    shifted = ft.drift_inject(d.cards, spec, "card_id")
    return rounded(shifted.select("card_id", *spec), {"max_monthly_spend_statement": 4, "pct_online_transactions_90d": 6})
