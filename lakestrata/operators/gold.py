"""Gold layer: transaction monitoring aggregate and fraud investigation cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.functions.exprs import half_even_average, iso_utc, parse_object

RISK_FIELDS = ["risk_event_id", "event_time", "source_transaction_id", "customer_id", "account_id", "card_id", "risk_score",
               "risk_level", "recommended_action", "rule_flags", "explanation", "source_events", "source_system", "schema_version"]
RISK_TYPES = {"risk_score": "bigint", "rule_flags": "array<string>", "source_events": "array<string>"}
TX_KEYS = ["authorization_status", "channel", "merchant_country", "merchant_category_code"]
#: What the transaction aggregate and the fraud cases read of a Silver card, and the login summary of a login.
CARD_COLUMNS = ["process_date", "event_id", "transaction_id", "amount", "merchant_name", *TX_KEYS]
LOGIN_COLUMNS = ["process_date", "customer_id", "event_type"]


def transaction_monitoring(silver_cards: DataFrame) -> DataFrame:
    """Per process date and (status, channel, country, MCC): count, exact sum,
    half-even average, approved and declined counts.

    Hash aggregate with a partial (map-side) step: one shuffle of one row per
    group per task, whatever the skew of the keys.
    """
    status = F.col("authorization_status")
    g = silver_cards.groupBy("process_date", *TX_KEYS).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("amount").alias("total_amount"),
        F.count_if(status == "approved").alias("approved_count"),
        F.count_if(status == "declined").alias("declined_count"),
    )
    return g.select(
        *TX_KEYS, "transaction_count", "total_amount",
        half_even_average(F.col("total_amount"), F.col("transaction_count")).alias("average_amount"),
        "approved_count", "declined_count",
        iso_utc(F.current_timestamp()).alias("gold_processed_time"),
        "process_date",
    )


def risk_events(bronze_risk: DataFrame, process_date: str | Column | None = None) -> DataFrame:
    """Risk events straight from Bronze: only JSON-object bodies are kept
    (others are skipped, not counted); no validation or de-duplication.

    ``process_date`` maps the risk ingest date onto the business date; by
    default it is the ingest date itself.
    """
    pd_col = F.col("ingest_date") if process_date is None else (
        process_date if isinstance(process_date, Column) else F.lit(process_date))
    # an integral JSON number is the only text that a bigint is read from; any
    # other score is NULL and fails Gold validation
    p = parse_object(bronze_risk, F.col("raw_value"), "raw_value", RISK_FIELDS, [],
                     [F.col("raw_value"), pd_col.alias("process_date")], RISK_TYPES)
    none = F.array().cast("array<string>")
    return p.where(F.col("_keys").isNotNull()).select(
        *[(F.coalesce(F.col("_f.source_events"), none) if f == "source_events" else F.col("_f." + f)).alias(f) for f in RISK_FIELDS],
        "process_date")


def login_summary(silver_logins: DataFrame) -> DataFrame:
    """Per (process date, customer): login, failed, new-device and
    password-reset counts (D2). Partial aggregation absorbs hot customers."""
    et = F.col("event_type")
    return silver_logins.groupBy("process_date", "customer_id").agg(
        F.count(F.lit(1)).alias("login_event_count"),
        F.count_if(et == "login_failed").alias("failed_login_count"),
        F.count_if(et == "new_device_registered").alias("new_device_count"),
        F.count_if(et == "password_reset").alias("password_reset_count"),
    )


def latest_card_per_transaction(silver_cards: DataFrame) -> DataFrame:
    """One card per (process date, transaction): the largest event_id wins, as
    a later write over the same key would in a lookup table."""
    w = Window.partitionBy("process_date", "transaction_id").orderBy(F.col("event_id").desc())
    return (silver_cards
            .select("process_date", "transaction_id", "event_id", F.col("amount").alias("transaction_amount"),
                    "merchant_name", "merchant_country", "merchant_category_code", "authorization_status")
            .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn", "event_id"))


def fraud_cases(silver_cards: DataFrame, silver_logins: DataFrame, risks: DataFrame) -> DataFrame:
    """Risk event ⟕ login summary by customer ⟕ latest card by transaction id.

    Both right sides are reduced to one row per join key before the join, so
    the left outer joins never multiply risk rows. A risk without logins gets
    zero counts. The four counts are joined first, so that the card's columns do
    not move a second time, by customer.
    """
    cards = latest_card_per_transaction(silver_cards).withColumnRenamed("transaction_id", "source_transaction_id")
    logins = login_summary(silver_logins)
    j = (risks.join(logins, ["process_date", "customer_id"], "left")
         .join(cards, ["process_date", "source_transaction_id"], "left"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return j.select(
        "risk_event_id", "customer_id", "account_id", "card_id", "source_transaction_id",
        "risk_score", "risk_level", "recommended_action", "rule_flags", "explanation",
        "transaction_amount", "merchant_name", "merchant_country", "merchant_category_code",
        "authorization_status",
        zero("login_event_count"), zero("failed_login_count"), zero("new_device_count"),
        zero("password_reset_count"),
        "source_events",
        iso_utc(F.current_timestamp()).alias("gold_processed_time"),
        "process_date",
    )


def unmatched_cases(cases: DataFrame) -> DataFrame:
    """Cases whose transaction found no card (null or empty merchant)."""
    m = F.col("merchant_name")
    return cases.where(m.isNull() | (m == ""))
