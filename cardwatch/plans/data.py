"""Views of the given tables in the shape of a card-transaction store.

Spark builds them with DataFrames (class Data); SQL_VIEWS states the same views for the SQL
twins. Every row comes from the given tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.functions.columns import padded_id
from cardwatch.operators.classification import binary_metrics, long_metrics
from cardwatch.operators.features import card_profile
from cardwatch.schemas import TABLES
from cardwatch.sources.payload import latest_n

AS_OF = "2024-01-31"
CUT = "2024-01-16"
CHAMPION = "models:/bank.cards.fraud_model@champion"
CHALLENGER = "models:/bank.cards.fraud_model@challenger"
SLICES = ["home_country", "home_state"]
NUMERIC = ["transaction_amount", "points", "hour_of_day", "prediction"]
CATEGORICAL = ["merchant_category", "transaction_country", "transaction_status"]


def txn_view(events: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Card transactions from events of customers; works on a batch or a stream of events.

    Points are whole numbers, so rule limits have no rounding.
    """
    home = (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("home_nation"),
                F.col("n_name").alias("home_country"), F.col("r_name").alias("home_state"))
    )
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    rows = events.select(
        "event_id", F.col("ts").cast("timestamp").alias("transaction_timestamp"), "user_id", "event_type", "value", k.alias("k"),
    ).join(home, "user_id")
    abroad = F.col("txn_nation") != F.col("home_nation")
    rows = rows.withColumn("txn_nation", F.when(F.col("k") % 4 == 0, F.col("k") % 25).otherwise(F.col("home_nation")))

    def worth(cond: Column, weight: int) -> Column:
        return F.when(cond, weight).otherwise(0)

    rows = rows.withColumn("points", (
        worth(F.col("value") > 100, 15) + worth(F.col("k") % 10 == 0, 20) + worth(abroad, 10)
        + worth(F.col("event_type").isin("purchase", "signup"), 8)))
    points = F.col("points")
    return rows.select(
        padded_id("TXN_", F.col("event_id"), 7).alias("transaction_id"),
        padded_id("CC_", F.col("user_id"), 6).alias("card_id"),
        F.col("value").alias("transaction_amount"),
        F.concat(F.lit("NATION_"), F.col("txn_nation").cast("string")).alias("transaction_country"),
        F.when(~abroad, F.col("home_state")).otherwise("N/A").alias("transaction_state"),
        (F.col("k") % 10 == 0).alias("is_vpn_used"),
        F.col("event_type").alias("merchant_category"),
        F.when(F.col("event_type") == "error", "declined").otherwise("approved").alias("transaction_status"),
        "transaction_timestamp", "home_country", "home_state", "points",
        (points > 22).alias("is_fraud"),
        worth((points >= 20) & (F.col("k") % 7 != 0), 1).alias("prediction_champion"),
        worth((points >= 23) & (F.col("k") % 11 != 0), 1).alias("prediction_challenger"),
    )


def model_log(txn: DataFrame) -> DataFrame:
    """The inference log: each transaction once per model, from one scan."""
    entries = F.array(
        F.struct(F.lit(CHAMPION).alias("model_version"), F.col("prediction_champion").alias("prediction")),
        F.struct(F.lit(CHALLENGER).alias("model_version"), F.col("prediction_challenger").alias("prediction")),
    )
    return (
        txn.withColumn("_m", F.explode(entries)).select("*", "_m.*")
        .drop("_m", "prediction_champion", "prediction_challenger")
        .withColumns({"score": F.col("points") / F.lit(53.0), "is_fraud": F.col("is_fraud").cast("int")})
    )


class Data:
    """The views over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events").withColumn("ts", F.col("ts").cast("timestamp"))

    def as_txn(self, events: DataFrame) -> DataFrame:
        return txn_view(events, self.table("customer"), self.table("nation"), self.table("region"))

    @cached_property
    def txn(self) -> DataFrame:
        return self.as_txn(self.table("events"))

    @cached_property
    def base(self) -> DataFrame:
        return self.txn.filter(F.col("transaction_timestamp") < F.lit(CUT).cast("timestamp"))

    @cached_property
    def cur(self) -> DataFrame:
        return self.txn.filter(F.col("transaction_timestamp") >= F.lit(CUT).cast("timestamp"))

    @cached_property
    def drifted(self) -> DataFrame:
        """Current rows with amounts up by 30 percent, more VPN use and a rescored prediction."""
        shifted = self.cur.withColumns({
            "transaction_amount": F.col("transaction_amount") * 1.3,
            "points": F.col("points") + F.when(F.col("transaction_amount") > 30, 15).otherwise(0),
        })
        return shifted.withColumn("prediction", (F.col("points") >= 20).cast("int"))

    @cached_property
    def log(self) -> DataFrame:
        return model_log(self.txn)

    @cached_property
    def dim(self) -> DataFrame:
        """Home country and state per card."""
        return (
            self.table("customer").join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(padded_id("CC_", F.col("c_custkey"), 6).alias("card_id"),
                    F.col("n_name").alias("home_country"), F.col("r_name").alias("home_state"))
        )

    @cached_property
    def logins(self) -> DataFrame:
        kind = F.when(F.col("event_type") == "signup", "password_reset").when(F.col("event_type") == "view", "web_login")
        return self.events.select(
            padded_id("CC_", F.col("user_id"), 6).alias("card_id"), kind.alias("login_type"), F.col("ts").alias("login_at"),
        ).filter(F.col("login_type").isNotNull())

    @cached_property
    def cards(self) -> DataFrame:
        return card_profile(self.txn, self.dim, self.logins, AS_OF, online="purchase")

    @cached_property
    def some_cards(self) -> DataFrame:
        """Card features without the customers whose number ends in 3, so lookups can miss."""
        return self.cards.filter(F.substring("card_id", -1, 1) != "3")

    def monitored(self, df: DataFrame) -> DataFrame:
        """Columns the drift tables watch, champion prediction."""
        ts = F.col("transaction_timestamp")
        pred = F.col("prediction" if "prediction" in df.columns else "prediction_champion")
        return df.withColumns({"hour_of_day": F.hour(ts), "prediction": pred})

    # Model bookkeeping, derived from the transactions: one retraining per week.
    @cached_property
    def weekly(self) -> DataFrame:
        start = F.date_trunc("week", "transaction_timestamp")
        version = (F.datediff(start, F.lit("2024-01-01").cast("date")) / 7 + 1).cast("int")
        return self.txn.withColumn("version", version)

    @cached_property
    def versions(self) -> DataFrame:
        """Registered versions of the model: (model, version, run_id)."""
        return self.weekly.select("version").distinct().select(
            F.lit("fraud_model").alias("model"), "version",
            F.concat(F.lit("run_"), F.col("version").cast("string")).alias("run_id"))

    @cached_property
    def run_metrics(self) -> DataFrame:
        """Training metrics of each run as (run_id, metric, value)."""
        wide = binary_metrics(self.weekly, "is_fraud", "prediction_champion", ["version"])
        wide = wide.withColumn("run_id", F.concat(F.lit("run_"), F.col("version").cast("string")))
        return long_metrics(wide, ["run_id"], ["precision", "recall", "f1_score", "accuracy"])

    @cached_property
    def aliases(self) -> DataFrame:
        """The newest version is the challenger, the one before it the champion."""
        newest = F.col("recency") == 1
        return latest_n(self.versions, ["model"], "version").select(
            F.when(newest, "challenger").otherwise("champion").alias("alias"), "version",
            F.when(newest, CHALLENGER).otherwise(CHAMPION).alias("model_version"))


TXN = """
  select concat('TXN_', lpad(cast(event_id as varchar), 7, '0')) as transaction_id,
         concat('CC_', lpad(cast(user_id as varchar), 6, '0')) as card_id,
         value as transaction_amount,
         concat('NATION_', cast(txn_nation as varchar)) as transaction_country,
         case when txn_nation = home_nation then home_state else 'N/A' end as transaction_state,
         k % 10 = 0 as is_vpn_used,
         event_type as merchant_category,
         case when event_type = 'error' then 'declined' else 'approved' end as transaction_status,
         ts as transaction_timestamp, home_country, home_state, points,
         points > 22 as is_fraud,
         case when points >= 20 and k % 7 <> 0 then 1 else 0 end as prediction_champion,
         case when points >= 23 and k % 11 <> 0 then 1 else 0 end as prediction_challenger
  from (
    select j.*,
           case when value > 100 then 15 else 0 end
         + case when k % 10 = 0 then 20 else 0 end
         + case when txn_nation <> home_nation then 10 else 0 end
         + case when event_type in ('purchase', 'signup') then 8 else 0 end as points
    from (
      select e.*, c.c_nationkey as home_nation, n.n_name as home_country, r.r_name as home_state,
             case when e.k % 4 = 0 then e.k % 25 else c.c_nationkey end as txn_nation
      from (select event_id, ts, user_id, event_type, value,
                   cast(regexp_extract(props, '([0-9]+)', 1) as int) as k from events) e
      join customer c on c.c_custkey = e.user_id
      join nation n on n.n_nationkey = c.c_nationkey
      join region r on r.r_regionkey = n.n_regionkey) j)
"""

LOG = f"""
  select t.* exclude (prediction_champion, prediction_challenger, is_fraud),
         cast(is_fraud as int) as is_fraud, m.model_version, points / 53e0 as score,
         case when m.model_version like '%champion' then prediction_champion else prediction_challenger end as prediction
  from txn t cross join (values ('{CHAMPION}'), ('{CHALLENGER}')) m(model_version)
"""

CARDS = f"""
  select p.card_id, avg_transaction_amount_90d, max_monthly_spend_statement, total_transactions_90d,
         total_transactions_90d / 90e0 as avg_transactions_per_day_90d, max_single_transaction_90d,
         pct_online_transactions_90d, n.n_name as home_country, r.r_name as home_state,
         distinct_countries_90d, distinct_states_90d, days_since_last_password_reset,
         days_since_last_web_login, hours_since_last_transaction, declined_transactions_30d
  from (
    select card_id, avg(transaction_amount) as avg_transaction_amount_90d,
           count(*) as total_transactions_90d, max(transaction_amount) as max_single_transaction_90d,
           avg(case when merchant_category = 'purchase' then 1e0 else 0e0 end) as pct_online_transactions_90d,
           count(distinct transaction_country) as distinct_countries_90d,
           count(distinct case when transaction_state <> 'N/A' then transaction_state end) as distinct_states_90d,
           (epoch_us(timestamp '{AS_OF}') - epoch_us(max(transaction_timestamp))) / 3.6e9 as hours_since_last_transaction,
           count(case when transaction_status = 'declined'
                       and transaction_timestamp >= timestamp '{AS_OF}' - interval 30 day then 1 end) as declined_transactions_30d
    from txn
    where transaction_timestamp >= timestamp '{AS_OF}' - interval 90 day and transaction_timestamp < timestamp '{AS_OF}'
    group by card_id) p
  join (select card_id, max(spend) as max_monthly_spend_statement
        from (select card_id, date_trunc('month', transaction_timestamp) as m, sum(transaction_amount) as spend
              from txn
              where transaction_timestamp >= timestamp '{AS_OF}' - interval 90 day and transaction_timestamp < timestamp '{AS_OF}'
              group by 1, 2) group by card_id) s on s.card_id = p.card_id
  left join (select concat('CC_', lpad(cast(user_id as varchar), 6, '0')) as card_id,
               cast(floor((epoch_us(timestamp '{AS_OF}') - epoch_us(max(case when event_type = 'signup' then ts end))) / 8.64e10) as bigint) as days_since_last_password_reset,
               cast(floor((epoch_us(timestamp '{AS_OF}') - epoch_us(max(case when event_type = 'view' then ts end))) / 8.64e10) as bigint) as days_since_last_web_login
             from events where event_type in ('signup', 'view') and ts < timestamp '{AS_OF}' group by 1) l on l.card_id = p.card_id
  left join customer c on c.c_custkey = cast(substr(p.card_id, 4) as bigint)
  left join nation n on n.n_nationkey = c.c_nationkey
  left join region r on r.r_regionkey = n.n_regionkey
"""

# name -> (views it reads, text), in definition order
SQL_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "txn": ((), TXN),
    "base": (("txn",), f"select * from txn where transaction_timestamp < timestamp '{CUT}'"),
    "cur": (("txn",), f"select * from txn where transaction_timestamp >= timestamp '{CUT}'"),
    "drifted": (("cur",), """
      select * replace (transaction_amount * 1.3e0 as transaction_amount,
                        points + case when transaction_amount > 30 then 15 else 0 end as points),
             case when points + case when transaction_amount > 30 then 15 else 0 end >= 20 then 1 else 0 end as prediction
      from cur"""),
    "log": (("txn",), LOG),
    "cards": (("txn",), CARDS),
    "some_cards": (("cards",), "select * from cards where right(card_id, 1) <> '3'"),
    "weekly": (("txn",), """
      select *, cast(date_diff('day', date '2024-01-01', cast(date_trunc('week', transaction_timestamp) as date)) / 7 + 1 as int) as version
      from txn"""),
    "versions": (("weekly",), """
      select distinct 'fraud_model' as model, version, concat('run_', cast(version as varchar)) as run_id from weekly"""),
    "run_wide": (("weekly",), """
      select concat('run_', cast(version as varchar)) as run_id,
             coalesce(tp / nullif(tp + fp, 0), 0) as "precision", coalesce(tp / nullif(tp + fn, 0), 0) as recall,
             coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) as f1_score, (tp + tn) / (tp + fp + fn + tn) as accuracy
      from (select version,
              count(*) filter (is_fraud and prediction_champion = 1) as tp,
              count(*) filter (not is_fraud and prediction_champion = 1) as fp,
              count(*) filter (is_fraud and prediction_champion = 0) as fn,
              count(*) filter (not is_fraud and prediction_champion = 0) as tn
            from weekly group by version)"""),
    "run_metrics": (("run_wide",), """
      select run_id, 'precision' as metric, "precision" as value from run_wide
      union all select run_id, 'recall', recall from run_wide
      union all select run_id, 'f1_score', f1_score from run_wide
      union all select run_id, 'accuracy', accuracy from run_wide"""),
    "aliases": (("versions",), f"""
      select case when recency = 1 then 'challenger' else 'champion' end as alias, version,
             case when recency = 1 then '{CHALLENGER}' else '{CHAMPION}' end as model_version
      from (select *, row_number() over (order by version desc) as recency from versions) where recency <= 2"""),
}
