"""Explicit schemas and column lists; nothing is inferred on read."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and order of the 22 model inputs.
CATEGORICAL_COLS = [
    "transaction_country", "transaction_state", "merchant_category",
    "transaction_status", "home_country", "home_state",
]
NUMERIC_COLS = [
    "transaction_amount", "avg_transaction_amount_90d", "max_monthly_spend_statement",
    "total_transactions_90d", "avg_transactions_per_day_90d", "max_single_transaction_90d",
    "pct_online_transactions_90d", "distinct_countries_90d", "distinct_states_90d",
    "days_since_last_password_reset", "days_since_last_web_login",
    "hours_since_last_transaction", "declined_transactions_30d",
    "is_vpn_used", "hour_of_day", "day_of_week",
]
FEATURE_COLS = CATEGORICAL_COLS + NUMERIC_COLS


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


EVENTS = _struct(
    event_id=T.LongType(), ts=T.TimestampNTZType(), user_id=T.LongType(),
    event_type=T.StringType(), value=T.DoubleType(), props=T.StringType(),
)

CUSTOMER = _struct(
    c_custkey=T.LongType(), c_name=T.StringType(), c_nationkey=T.IntegerType(),
    c_acctbal=T.DoubleType(), c_mktsegment=T.StringType(),
)
NATION = _struct(n_nationkey=T.IntegerType(), n_name=T.StringType(), n_regionkey=T.IntegerType())
REGION = _struct(r_regionkey=T.IntegerType(), r_name=T.StringType())
ORDERS = _struct(
    o_orderkey=T.LongType(), o_custkey=T.LongType(), o_orderstatus=T.StringType(),
    o_totalprice=T.DoubleType(), o_orderdate=T.TimestampNTZType(), o_orderpriority=T.StringType(),
)
LINEITEM = _struct(
    l_orderkey=T.LongType(), l_partkey=T.LongType(), l_suppkey=T.LongType(), l_linenumber=T.IntegerType(),
    l_quantity=T.DoubleType(), l_extendedprice=T.DoubleType(), l_discount=T.DoubleType(), l_tax=T.DoubleType(),
    l_returnflag=T.StringType(), l_linestatus=T.StringType(), l_shipdate=T.TimestampNTZType(),
)
PART = _struct(
    p_partkey=T.LongType(), p_name=T.StringType(), p_brand=T.StringType(), p_type=T.StringType(),
    p_size=T.IntegerType(), p_retailprice=T.DoubleType(),
)

# Given tables by name.
TABLES = {
    "events": EVENTS, "customer": CUSTOMER, "nation": NATION, "region": REGION,
    "orders": ORDERS, "lineitem": LINEITEM, "part": PART,
}

# The eight typed request columns a caller may send.
REQUEST = _struct(
    card_id=T.StringType(), transaction_timestamp=T.StringType(),
    transaction_amount=T.DoubleType(), transaction_country=T.StringType(),
    transaction_state=T.StringType(), merchant_category=T.StringType(),
    transaction_status=T.StringType(), is_vpn_used=T.LongType(),
)
