"""Registered queries: each maps the given tables onto the pipeline's inputs
and runs the operators over all of it. ``(spark, sf_dir) -> DataFrame``.

Processing and emission times (``*_processed_time``, ``failed_at``) are left
out of the returned frames because they come from the clock; arrays are
rendered with ``array_join`` so they compare as text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions import rules
from lakestrata.operators import change_events, core, gold, health, marts, monitoring, signals, silver, validation
from lakestrata.sources import fixtures
from lakestrata.session import materialize
from lakestrata.sources.bronze import envelope, flatten_cards

Query = Callable[[SparkSession, str], DataFrame]

EVENT_TABLES = ("customer", "supplier", "part", "orders", "lineitem", "events")

# Intermediate frames are built once per session and state of the input folder
# (a query that uses, say, the metrics twice then has one subtree in its plan).
# The layers that a query reads more than once (Silver cards, Gold transactions,
# the latest runs, the per-date monitoring rows) are stored once as Parquet, with
# the columns that are read.
# A folder whose files have changed is read anew, and what was kept is dropped.
_FRAMES: dict = {}


def input_state(spark: SparkSession, d: str) -> tuple:
    """Path, size and time of every input file, by the listing alone."""
    p = spark._jvm.org.apache.hadoop.fs.Path(d)
    files = p.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(p, True)
    out = []
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def shared(fn):
    def wrapper(spark, d):
        app, state = spark.sparkContext.applicationId, input_state(spark, d)
        held = _FRAMES.get(d)
        if held is None or held[0] != (app, state):
            held = _FRAMES[d] = ((app, state), {})
        if fn.__name__ not in held[1]:
            held[1][fn.__name__] = fn(spark, d)
        return held[1][fn.__name__]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


#: Input bytes for each partition of a shuffle before adaptive execution joins small ones, and the bytes it joins them to. A card of
#: 18 bytes in Parquet moves as 48 to the join with its order and is sorted as a message of some 1,000 behind it, so a task sorts
#: 100 to 250 MB and need not spill, whatever the size of the input.
BYTES_PER_PARTITION = 4 << 20
PARTITION_TARGET = "8m"


def fit_partitions(spark: SparkSession, d: str) -> None:
    """Let the number of shuffle partitions grow with the input: the session's, or more if the tables are large."""
    size = sum(n for path, n, _ in input_state(spark, d) if any(f"/{t}.parquet" in path for t in EVENT_TABLES))
    wanted, name = -(-size // BYTES_PER_PARTITION), "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(name, str(wanted))
    else:
        spark.conf.unset(name)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", PARTITION_TARGET)


def fitted(query: Query) -> Query:
    def run(spark, d):
        fit_partitions(spark, d)
        return query(spark, d)
    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


def input_held(spark: SparkSession, d: str, name: str) -> bool:
    """Whether this frame is kept for the folder's present state."""
    held = _FRAMES.get(d)
    return held is not None and held[0] == (spark.sparkContext.applicationId, input_state(spark, d)) and name in held[1]


def forget_frames() -> None:
    """Drop everything kept, so that the next query computes its own layers."""
    _FRAMES.clear()


# --- inputs -------------------------------------------------------------------

@shared
def bronze_cards(spark, d) -> DataFrame:
    m = fixtures.card_messages(spark, d)
    return envelope(m, fixtures.FIXTURE_DATE, F.col("timestamp"))


@shared
def bronze_logins(spark, d) -> DataFrame:
    m = fixtures.login_messages(spark, d)
    return envelope(m, fixtures.FIXTURE_DATE, F.col("timestamp"))


@shared
def bronze_risks(spark, d) -> DataFrame:
    m = fixtures.risk_messages(spark, d)
    return envelope(m, fixtures.FIXTURE_DATE, F.col("timestamp"))


# The checked rows (typed fields and the rejection reason) of the quarantine,
# the run counters and the quarantine listing. Each query reads them once, so
# storing them would only add their bytes.
@shared
def checked_card_table(spark, d) -> DataFrame:
    return silver.check_cards(bronze_cards(spark, d))


@shared
def checked_login_table(spark, d) -> DataFrame:
    return silver.check_logins(bronze_logins(spark, d))


# Silver as rows for a query that reads it once; Gold's columns of the cards are stored for those
# that read them more often.
@shared
def silver_cards(spark, d) -> DataFrame:
    return silver.silver_cards(bronze_cards(spark, d))


@shared
def silver_login_rows(spark, d) -> DataFrame:
    return silver.silver_logins(bronze_logins(spark, d))


@shared
def gold_card_rows(spark, d) -> DataFrame:
    return silver.silver_cards(bronze_cards(spark, d), columns=gold.CARD_COLUMNS)


@shared
def gold_login_rows(spark, d) -> DataFrame:
    return silver.silver_logins(bronze_logins(spark, d), columns=gold.LOGIN_COLUMNS)


@shared
def gold_card_table(spark, d) -> DataFrame:
    return materialize(gold_card_rows(spark, d))


def gold_cards(spark, d) -> DataFrame:
    """The stored layer if an earlier query of the session has made it, else the rows it is made of."""
    return (gold_card_table if input_held(spark, d, "gold_card_table") else gold_card_rows)(spark, d)


@shared
def risk_table(spark, d) -> DataFrame:
    return gold.risk_events(bronze_risks(spark, d))


def fraud_cases(spark, d) -> DataFrame:
    return gold.fraud_cases(gold_cards(spark, d), gold_login_rows(spark, d), risk_table(spark, d))


@shared
def tx_table(spark, d) -> DataFrame:
    return materialize(gold.transaction_monitoring(gold_cards(spark, d)))


@shared
def health_table(spark, d) -> DataFrame:
    return health.pipeline_health(fixtures.audit_runs(spark, d))


@shared
def latest_health_table(spark, d) -> DataFrame:
    # A few rows per date that metrics, findings and validation all read:
    # stored once instead of re-ranking every audit run for each of them. The
    # order of the history is that of its listing; ranking needs none.
    return materialize(health.latest_per_job(health.health_rows(fixtures.audit_runs(spark, d))))


def _drop_clock(df: DataFrame) -> DataFrame:
    return df.drop("silver_processed_time", "gold_processed_time", "failed_at", "emitted_at", "generated_at")


# --- Bronze / Silver ------------------------------------------------------------

def q_bronze_envelope(spark, d):
    return bronze_cards(spark, d).unionByName(bronze_logins(spark, d)).unionByName(bronze_risks(spark, d))


def q_silver_card(spark, d):
    return _drop_clock(silver_cards(spark, d))


def q_silver_card_quarantine(spark, d):
    return _drop_clock(silver.quarantine(checked_card_table(spark, d), rules.JOB_SILVER_CARD))


def q_silver_card_counts(spark, d):
    return silver.run_counts(checked_card_table(spark, d))


def q_silver_login(spark, d):
    return _drop_clock(silver_login_rows(spark, d))


def q_silver_login_quarantine(spark, d):
    return _drop_clock(silver.quarantine(checked_login_table(spark, d), rules.JOB_SILVER_LOGIN))


def q_silver_login_counts(spark, d):
    return silver.run_counts(checked_login_table(spark, d))


# --- Gold -------------------------------------------------------------------------

def q_gold_tx_monitoring(spark, d):
    return _drop_clock(tx_table(spark, d))


def q_login_summary(spark, d):
    return gold.login_summary(gold_login_rows(spark, d))


def _cases_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("rule_flags", F.array_join("rule_flags", ",")) \
             .withColumn("source_events", F.array_join("source_events", ","))


def q_gold_fraud_cases(spark, d):
    return _cases_as_text(_drop_clock(fraud_cases(spark, d)))


def q_unmatched_fraud_cases(spark, d):
    return gold.unmatched_cases(fraud_cases(spark, d)).select(
        "process_date", "risk_event_id", "customer_id", "source_transaction_id", "risk_score")


def q_pipeline_health(spark, d):
    return _drop_clock(health_table(spark, d))


def q_pipeline_health_latest(spark, d):
    return _drop_clock(latest_health_table(spark, d)).select(
        "process_date", "job_name", "run_id", "status", "records_read", "records_written",
        "records_rejected", "duration_seconds", "finished_at")


def q_audit_runs(spark, d):
    return health.run_listing(fixtures.audit_runs(spark, d))


def q_health_listing(spark, d):
    return health.latest_listing(latest_health_table(spark, d), fixtures.FIXTURE_DATE)


# --- monitoring ------------------------------------------------------------------

def metrics_rows(spark, d, dates: DataFrame | None = None) -> DataFrame:
    gold_card_table(spark, d)  # stored, as transactions and fraud cases both read it
    return monitoring.metrics(latest_health_table(spark, d), tx_table(spark, d), fraud_cases(spark, d), dates)


@shared
def metrics_table(spark, d) -> DataFrame:
    return materialize(metrics_rows(spark, d))


@shared
def findings_table(spark, d) -> DataFrame:
    return materialize(monitoring.findings(metrics_table(spark, d), latest_health_table(spark, d)))


@shared
def status_table(spark, d) -> DataFrame:
    return materialize(monitoring.status(metrics_table(spark, d), findings_table(spark, d)))


@shared
def alerts_table(spark, d) -> DataFrame:
    return monitoring.alerts(findings_table(spark, d), status_table(spark, d))


@shared
def summary_table(spark, d) -> DataFrame:
    return monitoring.alert_summary(alerts_table(spark, d), status_table(spark, d))


def q_fraud_cases_dedup(spark, d):
    return _cases_as_text(_drop_clock(monitoring.dedupe_cases(fraud_cases(spark, d))))


def q_monitoring_metrics(spark, d):
    return metrics_table(spark, d)


def q_monitoring_findings(spark, d):
    return findings_table(spark, d)


def q_monitoring_status(spark, d):
    return status_table(spark, d)


EMPTY_DATE = "2024-02-01"


def q_monitoring_findings_empty_date(spark, d):
    """The findings of two requested dates, one of them without any rows."""
    dates = spark.createDataFrame([(fixtures.FIXTURE_DATE,), (EMPTY_DATE,)], "process_date string")
    m = metrics_rows(spark, d, dates)
    return monitoring.findings(m, latest_health_table(spark, d))


def q_dash_alerts(spark, d):
    return monitoring.first_alerts(summary_table(spark, d))


def q_alerts(spark, d):
    return _drop_clock(alerts_table(spark, d))


def q_alert_summary(spark, d):
    s = _drop_clock(summary_table(spark, d))
    return s.withColumn("alert_ids", F.array_join(F.transform("alerts", lambda a: a["alert_id"]), ",")).drop("alerts")


# --- dashboard marts --------------------------------------------------------------

def q_dash_channel_amount(spark, d):
    return marts.channel_amount(tx_table(spark, d))


def q_dash_risk_levels(spark, d):
    return marts.risk_levels(fraud_cases(spark, d))


def q_dash_approval_mix(spark, d):
    return marts.approval_mix(tx_table(spark, d))


def q_dash_top_tx(spark, d):
    return marts.top_transaction_groups(tx_table(spark, d))


def q_dash_top_fraud(spark, d):
    return marts.top_fraud_cases(fraud_cases(spark, d))


def q_dash_kpis(spark, d):
    return marts.kpis(metrics_table(spark, d), status_table(spark, d), summary_table(spark, d))


def q_dash_ops_messages(spark, d):
    return marts.operations_summary(metrics_table(spark, d))


# --- validation -------------------------------------------------------------------

@shared
def checked_bronze(spark, d) -> list:
    """(topic, G1 errors per Bronze object) for the three topics. The summary and the failure
    report read them once each, so they are not stored."""
    return [(topic, validation.check_bronze(b(spark, d), prefix))
            for b, prefix, topic in ((bronze_cards, rules.BRONZE_CARD_PREFIX, rules.CARD_TOPIC),
                                     (bronze_logins, rules.BRONZE_LOGIN_PREFIX, rules.LOGIN_TOPIC),
                                     (bronze_risks, rules.BRONZE_RISK_PREFIX, rules.RISK_TOPIC))]


def q_validate_bronze_failures(spark, d):
    parts = [validation.failures(c, ["source_object_key"]) for _, c in checked_bronze(spark, d)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_validate_bronze(spark, d):
    parts = [validation.summary(c, dataset=topic) for topic, c in checked_bronze(spark, d)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_validate_bronze_documents(spark, d):
    """Every failing login document with all its errors."""
    docs = fixtures.login_documents(bronze_logins(spark, d))
    return validation.failures(validation.check_bronze_documents(docs), ["source_object_key"])


@shared
def checked_silver_cards(spark, d):
    # stored with what the reports read: they read it twice, for the errors and for the duplicate keys
    return materialize(validation.check_silver_cards(silver_cards(spark, d)).select("process_date", "event_id", "_errors"))


def q_validate_silver_card(spark, d):
    return validation.silver_summary(checked_silver_cards(spark, d))


def q_validate_silver_card_failures(spark, d):
    return validation.silver_failures(checked_silver_cards(spark, d))


def q_validate_silver_login(spark, d):
    return validation.silver_summary(materialize(
        validation.check_silver_logins(silver_login_rows(spark, d)).select("process_date", "event_id", "_errors")))


TX_KEYS = ["authorization_status", "channel", "merchant_country", "merchant_category_code"]


def q_validate_gold_tx(spark, d):
    return validation.summary(validation.check_gold_tx(tx_table(spark, d)))


def q_validate_gold_tx_failures(spark, d):
    return validation.failures(validation.check_gold_tx(tx_table(spark, d)), TX_KEYS)


def q_validate_gold_fraud(spark, d):
    return validation.summary(validation.check_gold_fraud(fraud_cases(spark, d)))


def q_validate_gold_fraud_failures(spark, d):
    return validation.failures(validation.check_gold_fraud(fraud_cases(spark, d)), monitoring.CASE_KEY)


def q_validate_gold_health(spark, d):
    hist = validation.summary(validation.check_gold_health(health_table(spark, d)), dataset="pipeline_health")
    latest = validation.summary(validation.check_gold_health(latest_health_table(spark, d)),
                                dataset="pipeline_health_latest")
    return hist.unionByName(latest)


def q_validate_gold_health_failures(spark, d):
    return validation.failures(validation.check_gold_health(health_table(spark, d)), ["run_id"])


def q_bronze_sample(spark, d):
    """The first hundred card objects in key order."""
    return validation.sample_objects(bronze_cards(spark, d), 100, rules.BRONZE_CARD_PREFIX).select(
        "kafka_topic", "kafka_partition", "kafka_offset", "raw_value")


def _quarantined(spark, d) -> DataFrame:
    parts = []
    for checked, job in ((checked_card_table, rules.JOB_SILVER_CARD), (checked_login_table, rules.JOB_SILVER_LOGIN)):
        parts.append(_drop_clock(silver.quarantine(checked(spark, d), job)))
    return parts[0].unionByName(parts[1])


def q_quarantine_listing(spark, d):
    return silver.quarantine_listing(_quarantined(spark, d))


def q_quarantine_listing_login(spark, d):
    """The listing below one job's quarantine prefix, for one date."""
    return silver.quarantine_listing(_quarantined(spark, d), rules.QUARANTINE_LOGIN_PREFIX, fixtures.FIXTURE_DATE)


def q_bronze_flatten(spark, d):
    return flatten_cards(bronze_cards(spark, d))


# --- core banking -----------------------------------------------------------------

@shared
def core_tables(spark, d):
    return {"customers": fixtures.core_customers(spark, d), "accounts": fixtures.core_accounts(spark, d),
            "account_balances": fixtures.core_balances(spark, d),
            "customer_risk_profiles": fixtures.core_risk_profiles(spark, d)}


def q_core_table_counts(spark, d):
    return core.table_counts(core_tables(spark, d))


def q_core_constraint_violations(spark, d):
    t = core_tables(spark, d)
    return core.constraint_report(t["customers"], t["accounts"], t["account_balances"], t["customer_risk_profiles"])


def q_cdc_current_state(spark, d):
    return core.fold_changes(fixtures.order_changes(spark, d), "order_id")


#: Of each core table: its key, and the column and value that its feed's updates set.
CORE_FEEDS = {"customers": ("customer_id", "customer_status", "inactive"),
              "accounts": ("account_id", "account_status", "closed"),
              "account_balances": ("balance_id", "currency", "GBP"),
              "customer_risk_profiles": ("risk_profile_id", "kyc_status", "expired")}


def q_cdc_events_decoded(spark, d):
    decoded = change_events.decode_events(fixtures.order_events(spark, d), T.StructType.fromDDL(fixtures.ORDER_ROW))
    row = F.coalesce("after", "before")
    good = F.col("problem").isNull()
    return decoded.select("event_no", "problem", *[F.when(good, F.col(c)).alias(c) for c in ("op", "lsn", "snapshot", "event_ms")],
                          *[F.when(good, row[c]).alias(c) for c in ("order_id", "customer_id", "status", "total", "order_date", "gift")],
                          F.when(good, F.unix_micros(row["changed_at"])).alias("changed_micros"),
                          F.when(good, F.col("before.status")).alias("status_before"))


def q_cdc_core_state(spark, d):
    """The current state of the four core tables from their change feeds: each
    row's key, the column that updates touch, and the change that won."""
    parts = []
    for name, (key, column, value) in CORE_FEEDS.items():
        feed = fixtures.core_changes(core_tables(spark, d)[name], key, column, value)
        parts.append(core.fold_changes(feed, key).select(
            F.lit(name).alias("table_name"), F.col(key).alias("row_key"), F.col(column).alias("updated_value"),
            "source_lsn", "last_op"))
    return reduce(DataFrame.unionByName, parts)


def q_fraud_signals(spark, d):
    t = core_tables(spark, d)
    # the tables have country names and brands where the events have codes
    params = signals.SignalParams(home_countries=("US", "UNITED STATES"), high_risk_categories=("Brand#11", "Brand#55"))
    # read twice, so stored, with the columns that are read
    cards = materialize(silver.silver_cards(bronze_cards(spark, d), columns=signals.CARD_COLUMNS))
    logins = materialize(silver.silver_logins(bronze_logins(spark, d), columns=signals.LOGIN_COLUMNS))
    s = signals.fraud_signals(cards, logins, t["customers"], t["accounts"], t["customer_risk_profiles"], params)
    return s.withColumn("rule_flags", F.array_join("rule_flags", ","))


QUERIES: dict[str, Query] = {
    "bronze_envelope": q_bronze_envelope,
    "silver_card": q_silver_card,
    "silver_card_quarantine": q_silver_card_quarantine,
    "silver_card_counts": q_silver_card_counts,
    "silver_login": q_silver_login,
    "silver_login_quarantine": q_silver_login_quarantine,
    "silver_login_counts": q_silver_login_counts,
    "gold_tx_monitoring": q_gold_tx_monitoring,
    "login_summary": q_login_summary,
    "gold_fraud_cases": q_gold_fraud_cases,
    "unmatched_fraud_cases": q_unmatched_fraud_cases,
    "pipeline_health": q_pipeline_health,
    "pipeline_health_latest": q_pipeline_health_latest,
    "audit_runs": q_audit_runs,
    "health_listing": q_health_listing,
    "fraud_cases_dedup": q_fraud_cases_dedup,
    "monitoring_metrics": q_monitoring_metrics,
    "monitoring_findings": q_monitoring_findings,
    "monitoring_status": q_monitoring_status,
    "monitoring_findings_empty_date": q_monitoring_findings_empty_date,
    "dash_alerts": q_dash_alerts,
    "alerts": q_alerts,
    "alert_summary": q_alert_summary,
    "dash_channel_amount": q_dash_channel_amount,
    "dash_risk_levels": q_dash_risk_levels,
    "dash_approval_mix": q_dash_approval_mix,
    "dash_top_tx": q_dash_top_tx,
    "dash_top_fraud": q_dash_top_fraud,
    "dash_kpis": q_dash_kpis,
    "dash_ops_messages": q_dash_ops_messages,
    "validate_bronze": q_validate_bronze,
    "validate_bronze_failures": q_validate_bronze_failures,
    "validate_bronze_documents": q_validate_bronze_documents,
    "validate_silver_card": q_validate_silver_card,
    "validate_silver_card_failures": q_validate_silver_card_failures,
    "validate_silver_login": q_validate_silver_login,
    "validate_gold_tx": q_validate_gold_tx,
    "validate_gold_tx_failures": q_validate_gold_tx_failures,
    "validate_gold_fraud": q_validate_gold_fraud,
    "validate_gold_fraud_failures": q_validate_gold_fraud_failures,
    "validate_gold_health": q_validate_gold_health,
    "validate_gold_health_failures": q_validate_gold_health_failures,
    "bronze_sample": q_bronze_sample,
    "quarantine_listing": q_quarantine_listing,
    "quarantine_listing_login": q_quarantine_listing_login,
    "bronze_flatten": q_bronze_flatten,
    "core_table_counts": q_core_table_counts,
    "core_constraint_violations": q_core_constraint_violations,
    "cdc_current_state": q_cdc_current_state,
    "cdc_core_state": q_cdc_core_state,
    "cdc_events_decoded": q_cdc_events_decoded,
    "fraud_signals": q_fraud_signals,
}
QUERIES = {name: fitted(query) for name, query in QUERIES.items()}
