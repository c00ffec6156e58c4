"""Joins, checks and features keyed by card."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.functions.columns import hash_word, join_on, uniform
from cardwatch.functions.timeparts import with_time_features
from cardwatch.operators.ordered import hash_cuts, heavy_keys, rank_by_hash, running
from cardwatch.session import materialize

DAY_US = 86_400_000_000


# --- projections -------------------------------------------------------------------------

def feature_select(df: DataFrame, exclude: tuple[str, ...] = (), order: list[str] | None = None) -> DataFrame:
    """All columns but the excluded ones, or a stated order of columns."""
    return df.select(*(order if order else [c for c in df.columns if c not in exclude]))


def tag(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def pack(df: DataFrame, cols: list[str], name: str = "features") -> DataFrame:
    return df.withColumn(name, F.struct(*cols))


# --- lookups and key checks --------------------------------------------------------------

def lookup(df: DataFrame, features: DataFrame, key: str = "card_id", how: str = "inner") -> DataFrame:
    """Join rows with their card features.

    No broadcast is forced: the feature table grows with the customers, so its measured
    size decides (autoBroadcastJoinThreshold). Beyond it the join sorts and merges on the
    key, and the adaptive skew join splits the partition of a hot card.
    """
    return df.join(features, key, how)


def training_set(
    labels: DataFrame, lookups: list[tuple[DataFrame, str]], ts: str, label: str, exclude: tuple[str, ...],
) -> DataFrame:
    """Label rows with looked-up and computed features, label last, consumed columns dropped."""
    wide = reduce(lambda d, item: lookup(d, item[0], item[1], "left"), lookups, labels)
    wide = with_time_features(wide, ts)
    return wide.select(*[c for c in wide.columns if c not in exclude and c != label], label)


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def orphan_check(df: DataFrame, ref: DataFrame, key: str) -> DataFrame:
    """Keys without a reference row, and the verdict."""
    orphans = distinct_keys(df, key).join(ref.select(key), key, "left_anti")
    count = F.count(F.lit(1))
    return orphans.agg(count.alias("orphans"), F.when(count == 0, "PASS").otherwise("FAIL").alias("status"))


def key_check(df: DataFrame, key: str) -> DataFrame:
    """NOT NULL and unique test of a key as one row."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    nulls = F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0))
    repeated = F.count(F.when(F.col(key).isNotNull() & (F.col("n") > 1), 1))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        nulls.alias("null_keys"), repeated.alias("duplicate_keys"),
        F.when((nulls == 0) & (repeated == 0), "PASS").otherwise("FAIL").alias("status"),
    )


# --- card profile ------------------------------------------------------------------------

def card_profile(
    txn: DataFrame, dim: DataFrame, logins: DataFrame, as_of: str, days: int = 90, online: str = "online_retail",
) -> DataFrame:
    """The 14 card features over the trailing ``days`` (declines: 30 days) before ``as_of``.

    Rows collapse to (card, month, country, state) before the first shuffle, so a card with
    a large share of all rows arrives as a handful of partial rows.
    """
    at = F.lit(as_of).cast("timestamp")
    ts = F.col("transaction_timestamp")
    inside = txn.filter((ts >= at - F.expr(f"INTERVAL {days} DAYS")) & (ts < at))
    declined = (F.col("transaction_status") == "declined") & (ts >= at - F.expr("INTERVAL 30 DAYS"))
    parts = inside.groupBy(
        "card_id", F.trunc(ts, "month").alias("month"), "transaction_country", "transaction_state",
    ).agg(
        F.count(F.lit(1)).alias("n"), F.sum("transaction_amount").alias("spend"),
        F.count("transaction_amount").alias("n_amount"),
        F.max("transaction_amount").alias("top"), F.max(ts).alias("last_at"),
        F.count(F.when(F.col("merchant_category") == online, 1)).alias("n_online"),
        F.count(F.when(declined, 1)).alias("n_declined"),
    )
    # One exchange by card serves the month sums, the distinct counts and the profile.
    of_month = Window.partitionBy("card_id", "month")
    parts = parts.repartition("card_id").withColumn("month_spend", F.sum("spend").over(of_month))
    state = F.when(F.col("transaction_state") != "N/A", F.col("transaction_state"))
    profile = parts.groupBy("card_id").agg(
        (F.sum("spend") / F.sum("n_amount")).alias("avg_transaction_amount_90d"),
        F.max("month_spend").alias("max_monthly_spend_statement"),
        F.sum("n").alias("total_transactions_90d"),
        (F.sum("n") / F.lit(float(days))).alias("avg_transactions_per_day_90d"),
        F.max("top").alias("max_single_transaction_90d"),
        (F.sum("n_online") / F.sum("n")).alias("pct_online_transactions_90d"),
        F.count_distinct("transaction_country").alias("distinct_countries_90d"),
        F.count_distinct(state).alias("distinct_states_90d"),
        ((F.unix_micros(at) - F.unix_micros(F.max("last_at"))) / F.lit(3.6e9)).alias("hours_since_last_transaction"),
        F.sum("n_declined").alias("declined_transactions_30d"),
    )

    def days_since(kind: str) -> Column:
        last = F.max(F.when(F.col("login_type") == kind, F.col("login_at")))
        return F.floor((F.unix_micros(at) - F.unix_micros(last)) / F.lit(float(DAY_US)))

    access = logins.filter(F.col("login_at") < at).groupBy("card_id").agg(
        days_since("password_reset").alias("days_since_last_password_reset"),
        days_since("web_login").alias("days_since_last_web_login"),
    )
    joined = profile.join(access, "card_id", "left")
    joined = joined.join(dim.select("card_id", "home_country", "home_state"), "card_id", "left")
    return joined.select(
        "card_id", "avg_transaction_amount_90d", "max_monthly_spend_statement", "total_transactions_90d",
        "avg_transactions_per_day_90d", "max_single_transaction_90d", "pct_online_transactions_90d",
        "home_country", "home_state", "distinct_countries_90d", "distinct_states_90d",
        "days_since_last_password_reset", "days_since_last_web_login",
        "hours_since_last_transaction", "declined_transactions_30d",
    )


# --- rolling features --------------------------------------------------------------------

def _moments(here: Column) -> dict[str, Column]:
    """Rows, known amounts and their mean, variance, least and greatest, over the rows where ``here`` holds."""
    x = F.when(here, F.col("_x"))
    return {"n": F.count(F.when(here, 1)), "k": F.count(x), "m": F.avg(x), "v": F.var_pop(x), "lo": F.min(x), "hi": F.max(x)}


def _moves(rows: DataFrame, key: str, width: int, bucket_seconds: int, *cols: str) -> DataFrame:
    """Each row entering at its time and leaving ``width`` later, with its block of that width and its bucket."""
    move = F.explode(F.array(
        F.struct(F.col("_at").alias("_t"), F.lit(True).alias("_in")),
        F.struct((F.col("_at") + F.lit(width)).alias("_t"), F.lit(False).alias("_in"))))
    # A row without a time has no exit: its frame is the rows without a time.
    events = rows.select(key, *cols, "_x", "_hot", move.alias("_m")).select(
        key, *[F.when(F.col("_m._in"), F.col(c)).alias(c) for c in cols], "_x", "_hot", "_m.*").filter("_in or _t is not null")
    return events.withColumns({
        "_block": F.col("_t") - F.pmod(F.col("_t"), F.lit(width)),
        "_bucket": F.when(F.col("_hot"), F.floor(F.col("_t") / F.lit(bucket_seconds * 1_000_000))).otherwise(F.lit(0)),
    })


def _elsewhere(events: DataFrame, by: list[str]) -> DataFrame:
    """Moments of the entries in the earlier buckets of a block and of the exits in the later ones."""
    parts = {"a": (F.col("_in"), F.col("_bucket").asc()), "b": (~F.col("_in"), F.col("_bucket").desc())}
    totals = events.groupBy(*by, "_bucket").agg(
        *[col.alias(f"_{p}_{name}") for p, (here, _) in parts.items() for name, col in _moments(here).items()])
    for p, (_, step) in parts.items():
        n, k, m, v, lo, hi = (F.col(f"_{p}_{name}") for name in ("n", "k", "m", "v", "lo", "hi"))
        before = Window.partitionBy(*by).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
        totals = totals.withColumns({"_K": F.sum(k).over(before), "_S": F.sum(k * m).over(before)})
        apart = m - F.col("_S") / F.col("_K")
        # Squares about the mean grow by a bucket's own and by the distance of the two means: only sums of positive terms.
        grown = F.when(k > 0, k * v + F.when(F.col("_K") > 0, apart * apart * k * (F.col("_K") / (F.col("_K") + k))).otherwise(0.0))
        totals = totals.withColumn("_Q", grown).select(
            *[c for c in totals.columns if not c.startswith((f"_{p}_", "_K", "_S"))],
            F.sum(n).over(before).alias(f"_{p}_n"), F.col("_K").alias(f"_{p}_k"),
            F.when(F.col("_K") > 0, F.col("_S") / F.col("_K")).alias(f"_{p}_m"),
            F.sum("_Q").over(before).alias(f"_{p}_q"),
            F.min(lo).over(before).alias(f"_{p}_lo"), F.max(hi).over(before).alias(f"_{p}_hi"))
    return totals


def rolling_stats(
    df: DataFrame, key: str, ts: str, amount: str, days: tuple[int, ...] = (1, 7),
    hot_rows: int = 200_000, bucket_seconds: int = 60,
) -> DataFrame:
    """Count, mean and sample deviation of the amount over trailing frames per card.

    A sliding window frame is summed anew for every row. Here time is cut into blocks as long as
    the frame, which then is the beginning of the row's block up to the row and the end of the
    block before: two running totals, at a cost that does not depend on the frame's length. Every
    row enters its block at its time and leaves, one block later, one microsecond after the frame
    has passed it, so the end is what has yet to leave. Nothing is ever subtracted: count, mean and
    squares about the mean are merged, in doubles, whatever the size of the amounts. A card
    of more than ``hot_rows`` rows is spread over its time buckets. A NaN or infinite amount counts
    as a NULL one: the row is counted, its amount is not.
    """
    value = F.col(amount).cast("double")
    hot = heavy_keys(df, key, hot_rows).withColumn("_hot", F.lit(True))
    # At most a million keys, see heavy_keys; no row moves for this join.
    rows = df.withColumns({
        "_row": F.struct(*df.columns), "_at": F.unix_micros(ts), "_x": F.when(F.abs(value) < F.lit(float("inf")), value),
    }).join(F.broadcast(hot), key, "left")
    plain, out, found = rows, [], []
    by = [key, "_block"]
    for d in days:
        width = d * DAY_US + 1
        carried = ["_row", "_at", *found]
        events = _moves(rows, key, width, bucket_seconds, *carried)
        # Exits of a row's own time have left: in the order they come before the entries.
        events = events.withColumn("_o", F.col("_t") * 2 + F.col("_in").cast("int"))
        whole = Window.partitionBy(*by, "_bucket")
        sides = {"p": (F.col("_in"), F.col("_o").asc()), "s": (~F.col("_in"), F.col("_o").desc())}
        for p, (here, order) in sides.items():
            frame = whole.orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
            events = events.select("*", *[col.over(frame).alias(f"_{p}_{name}") for name, col in _moments(here).items()])
        done = events.filter("_in").withColumns({f"_{p}_q": F.col(f"_{p}_k") * F.col(f"_{p}_v") for p in sides})
        done = join_on(done, _elsewhere(_moves(plain, key, width, bucket_seconds), by), [*by, "_bucket"])

        def added(name: str, term) -> Column:
            return reduce(add, [F.coalesce(term(p), F.lit(0)) for p in "apsb"]).alias(name)

        def among(pick, name: str) -> Column:
            return pick(*[F.col(f"_{p}_{name}") for p in "apsb"])

        done = done.select(key, "_hot", "_x", *carried, *[F.col(f"_{p}_{c}") for p in "apsb" for c in ("k", "m", "q")],
                           added(f"_n{d}", lambda p: F.col(f"_{p}_n")), added("_k", lambda p: F.col(f"_{p}_k")),
                           added("_sum", lambda p: F.col(f"_{p}_k") * F.col(f"_{p}_m")),
                           among(F.least, "lo").alias("_lo"), among(F.greatest, "hi").alias("_hi"))
        k, lo, even = F.col("_k"), F.col("_lo"), F.col("_lo") == F.col("_hi")
        done = done.withColumn(f"_m{d}", F.when(k > 0, F.when(even, lo).otherwise(F.col("_sum") / k)))

        def squares(p: str) -> Column:
            apart = F.col(f"_{p}_m") - F.col(f"_m{d}")
            return F.col(f"_{p}_q") + apart * apart * F.col(f"_{p}_k")

        done = done.withColumn("_q", added("_q", squares))
        found += [f"_n{d}", f"_m{d}", f"_d{d}"]
        rows = done.withColumn(f"_d{d}", F.when(k > 1, F.when(even, 0.0).otherwise(F.sqrt(F.col("_q") / (k - 1))))).select(
            key, "_hot", "_x", "_row", "_at", *found)
        out += [F.col(f"_n{d}").alias(f"txn_count_{d}d"), F.col(f"_m{d}").alias(f"txn_amount_avg_{d}d"),
                F.col(f"_d{d}").alias(f"txn_amount_std_{d}d")]
    return rows.select("_row.*", *out)


def rolling_features(df: DataFrame, key: str, ts: str, amount: str, days: tuple[int, int] = (1, 7), **limits) -> DataFrame:
    """The nine rolling inputs: counts, means, deviation, z-score, amount, hour and weekday."""
    short, long = days
    stats = rolling_stats(df, key, ts, amount, days, **limits)
    std, mean = F.col(f"txn_amount_std_{long}d"), F.col(f"txn_amount_avg_{long}d")
    zscore = F.when(std > 0, (F.col(amount) - mean) / std)
    return with_time_features(
        stats.withColumn("amount_zscore", zscore).withColumn("amount", F.col(amount)), ts,
    ).drop(f"txn_amount_std_{short}d")


def rolling_distinct(
    df: DataFrame, key: str, ts: str, cols: list[str], days: int = 90, bucket: str = "hour",
) -> DataFrame:
    """Distinct values per card in the trailing frame that ends at each row.

    A value is counted from its first sight until ``days`` after its last one. Sightings
    collapse to one row per (card, value, day) before any ordering, runs of sightings become
    +1 and -1 steps, and a running total of the steps gives the number at each row.
    """
    width = days * DAY_US
    rows = df.withColumn("_at", F.unix_micros(ts))
    seen = (
        rows.select(key, "_at", F.explode(F.array(*[
            F.struct(F.lit(c).alias("_c"), F.col(c).cast("string").alias("_v")) for c in cols
        ])).alias("_s")).select(key, "_at", "_s.*").filter(F.col("_v").isNotNull())
        .groupBy(key, "_c", "_v", F.floor(F.col("_at") / F.lit(DAY_US)).alias("_day"))
        .agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"))
    )
    order = Window.partitionBy(key, "_c", "_v").orderBy("_day")
    runs = seen.withColumns({"_before": F.lag("_last").over(order), "_after": F.lead("_first").over(order)})
    opens = F.col("_before").isNull() | (F.col("_first") - F.col("_before") > width)
    closes = F.col("_after").isNull() | (F.col("_after") - F.col("_last") > width)
    steps = runs.select(key, "_c", F.explode(F.array(
        F.when(opens, F.struct(F.col("_first").alias("_t"), F.lit(1).alias("_d"))),
        F.when(closes, F.struct((F.col("_last") + F.lit(width + 1)).alias("_t"), F.lit(-1).alias("_d"))),
    )).alias("_m")).filter(F.col("_m").isNotNull()).select(key, "_c", "_m.*")
    steps = steps.groupBy(key, "_t").agg(*[
        F.sum(F.when(F.col("_c") == c, F.col("_d")).otherwise(0)).alias(f"_d_{c}") for c in cols
    ])
    body = rows.select(key, F.col("_at").alias("_t"), F.struct(*df.columns).alias("_row"))
    events = body.unionByName(steps, allowMissingColumns=True)
    unit = {"hour": 3_600_000_000, "minute": 60_000_000, "day": DAY_US}[bucket]
    counted = running(
        events, [key], ["_t"], F.floor(F.col("_t") / F.lit(unit)),
        {f"distinct_{c}": ("sum", F.coalesce(F.col(f"_d_{c}"), F.lit(0))) for c in cols},
    )
    return counted.filter(F.col("_row").isNotNull()).select("_row.*", *[f"distinct_{c}" for c in cols])


# --- encoding and sampling ---------------------------------------------------------------

def fit_codes(df: DataFrame, cols: list[str]) -> DataFrame:
    """Dictionary (column_name, value, code): codes 0..k-1 in value order per column."""
    values = (
        df.select(*[F.col(c).cast("string").alias(c) for c in cols])
        .unpivot([], cols, "column_name", "value").filter(F.col("value").isNotNull()).distinct()
    )
    # Ranges are cut from a sample of the values, so a shared beginning does not gather them in one task.
    ranges = materialize(values.repartitionByRange("column_name", "value").withColumn("_part", F.spark_partition_id()), "code-ranges")
    ranked = running(ranges, ["column_name"], ["value"], F.col("_part"), {"_rank": ("sum", F.lit(1))})
    # A fitted dictionary is kept as a table, whose size then decides how it is joined.
    return materialize(ranked.select("column_name", "value", (F.col("_rank") - 1).cast("int").alias("code")), "codes")


def apply_codes(df: DataFrame, codes: DataFrame, cols: list[str]) -> DataFrame:
    """Replace categories by their codes; a value the dictionary lacks becomes -1.

    The dictionary is joined per column. It is small in practice and then broadcast by its
    measured size; a large one falls back to a merge join.
    """
    for c in cols:
        part = codes.filter(F.col("column_name") == c).select(
            F.col("value").alias(c), F.col("code").alias(f"_{c}"))
        df = df.join(part, c, "left").withColumn(c, F.coalesce(F.col(f"_{c}"), F.lit(-1))).drop(f"_{c}")
    return df


def split(df: DataFrame, key: str, label: str, share: float = 0.2, seed: int = 42, exact: bool = True) -> DataFrame:
    """Add is_test with the share held per label.

    Exact mode takes the first round(share * n) rows of each label in the order of the key's hash: the hash
    at the cut is found from a histogram, then each row is decided by its own. Otherwise each row is decided by its own hash: no shuffle, share held in expectation.
    """
    if not exact:
        return df.withColumn("is_test", uniform(F.col(key), seed) < F.lit(share))
    cuts = hash_cuts(df, [label], key, seed, share)
    own = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return join_on(df, cuts, [label]).select(*df.columns, F.coalesce(own <= F.col("hash_cut"), F.lit(False)).alias("is_test"))


def folds(df: DataFrame, key: str, label: str, n: int = 3, seed: int = 42) -> DataFrame:
    """Add fold 0..n-1, shuffled by key hash and even within each label."""
    ranked = rank_by_hash(df, [label], key, seed)
    return ranked.select(*df.columns, ((F.col("hash_rank") - 1) % n).cast("int").alias("fold"))


def hash_folds(df: DataFrame, key: str, n: int = 3, seed: int = 42) -> DataFrame:
    """Folds from the key hash alone: no shuffle, even in expectation."""
    return df.withColumn("fold", (hash_word(F.col(key), seed) % n).cast("int"))


def drift_inject(df: DataFrame, spec: dict[str, tuple], key: str, seed: int = 99) -> DataFrame:
    """Shift columns to test monitors; spec maps a column to one of

    ("scale", low, high), ("add", low, high), ("steps", [values]), ("replace", Column),
    each with an optional trailing (min, max) clamp.
    """
    out = {}
    for position, (name, (kind, *args)) in enumerate(spec.items()):
        draw = uniform(F.col(key), seed + position)
        bounds = args.pop() if args and isinstance(args[-1], tuple) else None
        col = F.col(name)
        if kind == "scale":
            col = col * (F.lit(args[0]) + draw * F.lit(args[1] - args[0]))
        elif kind == "add":
            col = col + F.lit(args[0]) + draw * F.lit(args[1] - args[0])
        elif kind == "steps":
            steps = args[0]
            pick = F.floor(draw * len(steps)).cast("int") + 1
            col = col + F.element_at(F.array(*[F.lit(s) for s in steps]), pick)
        else:
            col = args[0]
        if bounds:
            low, high = bounds
            col = F.when(col.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), col)))
        out[name] = col
    return df.withColumns(out)


def rule_points(terms: list[tuple[Column, float]]) -> Column:
    """Sum of the weights whose condition holds; an unknown condition adds nothing."""
    return reduce(add, [F.when(cond, F.lit(weight)).otherwise(F.lit(type(weight)(0))) for cond, weight in terms])
