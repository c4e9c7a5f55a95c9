"""Fraud signal derivation (R3): explainable rule flags and a score for each
card authorization, from login activity in a look-back window before it and
from the customer's core-banking status.

The look-back is a range join (logins of the same customer with
``card_ts - lookback <= login_ts <= card_ts``). It is computed without
pairing rows, as running sums of login enter/leave events at each card's
time, in two levels over buckets of time (``login_counts_before``), so a hot
customer does not end up in one task.

The thresholds and weights are parameters of ours: the documented fraud
scenarios name the signals but no numbers.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.functions.exprs import iso_to_ts


@dataclass(frozen=True)
class SignalParams:
    lookback_seconds: int = 86400
    high_value_amount: str = "50000.00"
    min_failed_logins: int = 2
    new_account_days: int = 30
    home_countries: tuple = ("US",)
    high_risk_categories: tuple = ("4829", "5944", "6051", "7995")
    weights: dict = field(default_factory=lambda: {
        "high_value_transaction": 20,
        "card_not_present": 10,
        "manual_keyed": 15,
        "multiple_failed_logins": 25,
        "password_reset": 15,
        "new_device_registered": 15,
        "restricted_customer": 20,
        "restricted_account": 15,
        "high_kyc_risk": 10,
        "fraud_watchlist": 20,
        "cross_border": 10,
        "high_risk_category": 10,
        "new_account": 10,
        "foreign_login": 10,
    })
    levels: tuple = ((70, "high"), (50, "medium_high"), (30, "medium"))


COUNTED_TYPES = {"failed_logins": "login_failed", "password_resets": "password_reset",
                 "new_devices": "new_device_registered"}
COUNTED = [*COUNTED_TYPES, "foreign_logins"]

#: What ``fraud_signals`` reads of a card.
CARD_COLUMNS = ["process_date", "event_id", "customer_id", "event_time", "transaction_id", "account_id", "amount", "card_present",
                "entry_mode", "merchant_country", "merchant_category_code"]
#: And of a login.
LOGIN_COLUMNS = ["customer_id", "event_time", "event_type", "country"]

# Sort tags at one instant: a bucket's start row comes first; a login enters its
# window (+1) before the cards at that instant and leaves it (-1 at login_ts +
# lookback) after them, so both ends of ``card_ts - lookback <= login_ts <=
# card_ts`` are inclusive.
_START, _ENTER, _CARD, _LEAVE = -1, 0, 1, 2

#: Cards and logins of one customer that a task may sort in one group.
HOT_ROWS = 50_000


def login_counts_before(cards: DataFrame, logins: DataFrame, lookback_seconds: int,
                        bucket_seconds: int = 300, carry: list[str] | tuple = (),
                        home_countries: tuple = ("US",), facts: DataFrame | None = None,
                          hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per card: failed logins, password resets, new devices and logins from
    other than the home countries, of the same customer with ``card_ts - lookback <= login_ts <= card_ts``.

    Exact distributed running sums, no pairs: every login adds +1 when it
    happens and -1 once the look-back has passed, so the count for a card is
    the running sum of the customer's events at the card's time. The rows of a
    customer are summed in order in one group, unless there are more than
    ``hot_rows``: then the sums have two levels. Totals of (customer, time
    bucket), aggregated before the shuffle, are summed over the customer's
    earlier buckets; a start row takes that sum into each bucket, where the
    rows are summed in order. A customer of any share of the rows is thus
    dealt over as many tasks as there are buckets with activity of theirs,
    whatever the number of shuffle partitions, and the others, of whom most
    buckets would hold a single row, move no start rows. The cards are shuffled once.

    ``facts`` (one row per customer) ride on the start rows, or come as one row
    before the customer's others, and reach the cards without a join of the cards.
    Every card comes out once, with the ``carry`` columns it brought along. A card
    without a parseable time counts nothing; logins without a time or customer
    take part in no window. Pass the logins of the days before the cards' as well.
    """
    width, span = lookback_seconds * 1_000_000, bucket_seconds * 1_000_000
    micros = F.unix_micros(iso_to_ts(F.col("event_time")))
    names = COUNTED
    known = [] if facts is None else [c for c in facts.columns if c != "customer_id"]

    # business dates do not part the stream: a look-back runs over midnight
    carry = ["process_date", "event_id", *carry]
    queries = cards.select("customer_id", micros.alias("_us"), F.lit(_CARD).alias("_tag"),
                           *[F.lit(0).cast("bigint").alias(c) for c in names], *carry)
    is_type = lambda t: F.when(F.col("event_type") == t, 1).otherwise(0)
    abroad = F.when(~F.col("country").isin(*home_countries), 1).otherwise(0) if "country" in logins.columns else F.lit(0)
    edges = F.array(F.struct(F.col("_s").alias("_us"), F.lit(_ENTER).alias("_tag"), F.lit(1).alias("_d")),
                    F.struct((F.col("_s") + width).alias("_us"), F.lit(_LEAVE).alias("_tag"), F.lit(-1).alias("_d")))
    events = logins.select("customer_id", micros.alias("_s"),
                           *[is_type(t).alias("_is_" + c) for c, t in COUNTED_TYPES.items()],
                           abroad.alias("_is_foreign_logins")) \
        .where(F.col("_s").isNotNull() & F.col("customer_id").isNotNull()
               & reduce(lambda a, b: a | b, [F.col("_is_" + c) == 1 for c in names])) \
        .select("customer_id", *["_is_" + c for c in names], F.inline(edges)) \
        .select("customer_id", "_us", "_tag", *[(F.col("_d") * F.col("_is_" + c)).cast("bigint").alias(c) for c in names])
    # at most a row for every ``hot_rows`` of the input
    hot = F.broadcast(cards.select("customer_id").unionAll(logins.select("customer_id")).groupBy("customer_id").count()
                      .where(F.col("count") > hot_rows).select(F.col("customer_id").alias("_customer"), F.lit(True).alias("_hot")))
    is_hot = F.col("customer_id").eqNullSafe(F.col("_customer"))
    bucket = F.when(F.col("_hot"), F.floor(F.col("_us") / span).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    stream = queries.unionByName(events, allowMissingColumns=True).join(hot, is_hot, "left").withColumn("_bucket", bucket)

    earlier = Window.partitionBy("customer_id").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = stream.where(F.col("_hot")).groupBy("customer_id", "_bucket").agg(*[F.sum(c).alias(c) for c in names]).select(
        "customer_id", "_bucket", (F.col("_bucket") * span).alias("_us"), F.lit(_START).alias("_tag"),
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in names])
    if facts is not None:
        starts = starts.join(facts, "customer_id", "left")
        # of the other customers, before all their rows as it has no time
        alone = facts.join(hot, is_hot, "left_anti").withColumns(
            {"_bucket": F.lit(0).cast("bigint"), "_tag": F.lit(_START), **{c: F.lit(0).cast("bigint") for c in names}})
        starts = starts.unionByName(alone, allowMissingColumns=True)
    stream = stream.drop("_customer", "_hot")

    so_far = Window.partitionBy("customer_id", "_bucket").orderBy("_us", "_tag") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return stream.unionByName(starts, allowMissingColumns=True).select(
        "customer_id", "_tag", *carry, *[F.sum(c).over(so_far).alias(c) for c in names],
        *[F.first(c).over(so_far).alias(c) for c in known]) \
        .where(F.col("_tag") == _CARD).drop("_tag")


def fraud_signals(cards: DataFrame, logins: DataFrame, customers: DataFrame, accounts: DataFrame | None = None,
                  profiles: DataFrame | None = None, params: SignalParams = SignalParams()) -> DataFrame:
    """Flags, score (at most 100) and level for every card authorization.

    Without ``accounts`` or ``profiles`` the flags that need them stay unset.
    An account counts only for the customer that holds it."""
    # One row per customer id even if the reference tables repeat a key (a
    # primary-key violation the constraint report flags), so card rows are
    # never multiplied.
    said = customers.select("customer_id", (F.col("customer_status") == "restricted").alias("_restricted"))
    if profiles is not None:
        said = said.unionByName(profiles.select("customer_id", (F.col("kyc_risk_rating") == "high").alias("_high_kyc"),
                                                F.col("fraud_watchlist_flag").alias("_watchlist")), allowMissingColumns=True)
    else:
        said = said.withColumns({"_high_kyc": F.lit(False), "_watchlist": F.lit(False)})
    facts = said.groupBy("customer_id").agg(*[F.bool_or(c).alias(c) for c in ("_restricted", "_high_kyc", "_watchlist")])
    # what a card says by itself is decided before the shuffles, which carry the answers instead of the card's columns
    own = {"high_value_transaction": F.col("amount") >= F.lit(params.high_value_amount).cast("decimal(28,2)"),
           "card_not_present": F.col("card_present") == F.lit(False),
           "manual_keyed": F.col("entry_mode") == "manual_keyed",
           "cross_border": ~F.col("merchant_country").isin(*params.home_countries),
           "high_risk_category": F.col("merchant_category_code").isin(*params.high_risk_categories)}
    cards = cards.withColumns({"_day": iso_to_ts(F.col("event_time")).cast("date"), **{"_" + n: c for n, c in own.items()}})
    j = login_counts_before(cards, logins, params.lookback_seconds, home_countries=params.home_countries, facts=facts,
                            carry=["transaction_id", "account_id", "_day", *["_" + n for n in own]])
    if accounts is not None:
        held = accounts.groupBy("account_id", "customer_id").agg(
            F.bool_or(F.col("account_status").isin("restricted", "frozen")).alias("_held"),
            F.max("opened_at").alias("_opened"))
        j = j.join(held, ["account_id", "customer_id"], "left")
    else:
        j = j.withColumns({"_held": F.lit(False), "_opened": F.lit(None).cast("date")})
    age = F.datediff(F.col("_day"), F.col("_opened"))
    flags: list[tuple[str, Column]] = [
        ("high_value_transaction", F.col("_high_value_transaction")),
        ("card_not_present", F.col("_card_not_present")),
        ("manual_keyed", F.col("_manual_keyed")),
        ("multiple_failed_logins", F.col("failed_logins") >= params.min_failed_logins),
        ("password_reset", F.col("password_resets") >= 1),
        ("new_device_registered", F.col("new_devices") >= 1),
        ("restricted_customer", F.col("_restricted")),
        ("restricted_account", F.col("_held")),
        ("high_kyc_risk", F.col("_high_kyc")),
        ("fraud_watchlist", F.col("_watchlist")),
        ("cross_border", F.col("_cross_border")),
        ("high_risk_category", F.col("_high_risk_category")),
        ("new_account", (age >= 0) & (age <= params.new_account_days)),
        ("foreign_login", F.col("foreign_logins") >= 1),
    ]
    hits = [F.coalesce(cond, F.lit(False)) for _, cond in flags]
    names = F.array_compact(F.array(*[F.when(h, F.lit(n)) for (n, _), h in zip(flags, hits)]))
    score = F.least(sum((F.when(h, params.weights[n]).otherwise(0) for (n, _), h in zip(flags, hits)),
                        F.lit(0)), F.lit(100))
    level = F.lit("low")
    for threshold, name in reversed(params.levels):
        level = F.when(F.col("signal_score") >= threshold, name).otherwise(level)
    out = j.select("process_date", "event_id", "transaction_id", "customer_id",
                   *[F.coalesce(F.col(x), F.lit(0)).cast("bigint").alias(x)
                     for x in COUNTED],
                   names.alias("rule_flags"), score.cast("int").alias("signal_score"))
    return out.withColumn("risk_level", level)
