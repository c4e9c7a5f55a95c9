"""Monitoring: fraud-case de-dup, per-date metrics, rule findings, overall
status, alerts and the alert summary.

Everything after the metrics works on one row per business date (plus one
row per non-successful job), so its cost does not grow with the data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.functions import rules
from lakestrata.functions.exprs import alert_id, iso_utc, percent, thousands

CASE_KEY = ["risk_event_id", "customer_id", "source_transaction_id"]
# Full order for equal score and time, so a retried task keeps the same case.
CASE_TIEBREAK = ["account_id", "card_id", "risk_level", "recommended_action", "explanation"]


def ranked_cases(cases: DataFrame) -> DataFrame:
    """The cases with their rank ``_rn`` among those of the same (date, risk event, customer, transaction)."""
    w = Window.partitionBy("process_date", *CASE_KEY).orderBy(
        F.coalesce(F.col("risk_score"), F.lit(0)).desc(),
        F.coalesce(F.col("gold_processed_time"), F.lit("")).desc(),
        *[F.col(c).asc_nulls_first() for c in CASE_TIEBREAK if c in cases.columns])
    return cases.withColumn("_rn", F.row_number().over(w))


def dedupe_cases(cases: DataFrame) -> DataFrame:
    """One case per (date, risk event, customer, transaction): highest score,
    then newest processing time (E3); remaining ties break on the case's
    attributes so the winner does not depend on read order."""
    return ranked_cases(cases).where(F.col("_rn") == 1).drop("_rn")


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)


def metrics(latest_health: DataFrame, tx: DataFrame, cases: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """One row per process date with health (D5), transaction (D6) and fraud
    (D7) metrics; dates of ``dates`` (``process_date``) without any rows are
    counted as empty, so that their absence is found. Each input is read once and aggregated to one row per date first; the
    three small results are combined with a union and a second aggregate,
    not a join. Cases are ranked (E3) rather than filtered, so that one reading counts them raw and
    without duplicates, and cases that a join has just dealt out by their transaction stay where they are."""
    st = F.coalesce(F.col("status"), F.lit("unknown"))
    h = latest_health.groupBy("process_date").agg(
        F.count(F.lit(1)).alias("jobs"),
        F.count_if(st == "success").alias("success"),
        F.count_if(st != "success").alias("failed"),
        F.sum(F.coalesce("records_read", F.lit(0))).alias("records_read"),
        F.sum(F.coalesce("records_written", F.lit(0))).alias("records_written"),
        F.sum(F.coalesce("records_rejected", F.lit(0))).alias("records_rejected"))
    t = tx.groupBy("process_date").agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum(F.coalesce("transaction_count", F.lit(0))).alias("transactions"),
        F.sum(F.coalesce("approved_count", F.lit(0))).alias("approved"),
        F.sum(F.coalesce("declined_count", F.lit(0))).alias("declined"),
        F.sum(F.coalesce("total_amount", F.lit(0).cast("decimal(28,2)"))).alias("amount"))
    m, kept = F.col("merchant_name"), F.col("_rn") == 1
    u = ranked_cases(cases).groupBy("process_date").agg(
        F.count(F.lit(1)).alias("raw_cases"),
        F.count_if(kept).alias("cases"),
        F.max(F.when(kept, F.coalesce(F.col("risk_score"), F.lit(0)))).alias("max_score"),
        F.count_if(kept & (m.isNull() | (m == ""))).alias("unmatched_merchants"),
        F.count_if(kept & F.col("risk_level").isin(*rules.HIGH_RISK_LEVELS)).alias("high_risk"),
        F.sum(F.when(kept, F.coalesce("failed_login_count", F.lit(0)))).alias("failed_logins"))
    parts = [h, t, u] + ([dates.select("process_date")] if dates is not None else [])
    cols = [c for p in parts for c in p.columns if c != "process_date"]
    allc = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    g = allc.groupBy("process_date").agg(*[F.max(c).alias(c) for c in cols])
    out = g.select(
        "process_date",
        *[_zero(c) for c in ["jobs", "success", "failed", "records_read", "records_written", "records_rejected",
                             "groups", "transactions", "approved", "declined"]],
        F.coalesce(F.col("amount"), F.lit(0)).cast("decimal(38,2)").alias("amount"),
        *[_zero(c) for c in ["cases", "raw_cases"]],
        *[_zero(c) for c in ["max_score", "unmatched_merchants", "high_risk", "failed_logins"]])
    return out.withColumn("decline_rate", percent(F.col("declined"), F.col("transactions"))) \
              .withColumn("duplicates", F.greatest(F.col("raw_cases") - F.col("cases"), F.lit(0)))


def _finding(order: int, cond: Column, severity: str, rule_id: str, message: Column,
             value: Column | None = None, threshold: str | None = None) -> Column:
    return F.when(cond, F.struct(
        F.lit(order).alias("finding_order"), F.lit("").alias("job_name"),
        F.lit(severity).alias("severity"), F.lit(rule_id).alias("rule_id"), message.alias("message"),
        (value.cast("string") if value is not None else F.lit(None).cast("string")).alias("value"),
        F.lit(threshold).cast("string").alias("threshold")))


def findings(metric_rows: DataFrame, latest_health: DataFrame) -> DataFrame:
    """Rule findings H1-H9 per date, in rule order (H4 once per job that is
    not successful, by job name)."""
    c = F.col
    rate = c("decline_rate").cast("string")
    metric_findings = [
        _finding(1, c("jobs") == 0, "critical", "missing_pipeline_health",
                 F.lit("No latest pipeline health records were found.")),
        _finding(2, c("groups") == 0, "critical", "missing_transaction_monitoring",
                 F.lit("No Gold transaction monitoring records were found.")),
        _finding(3, c("raw_cases") == 0, "warning", "missing_fraud_cases",
                 F.lit("No Gold fraud case records were found.")),
        _finding(5, c("records_rejected") > 0, "warning", "rejected_records_present",
                 F.concat(thousands(c("records_rejected")), F.lit(" records were rejected in latest pipeline health.")),
                 c("records_rejected"), "0"),
        _finding(6, c("decline_rate") > F.lit(rules.DECLINE_RATE_THRESHOLD).cast("decimal(21,1)"), "warning",
                 "decline_rate_high", F.concat(F.lit("Decline rate is "), rate, F.lit("% for this process date.")),
                 rate, rules.DECLINE_RATE_THRESHOLD),
        _finding(7, c("max_score") >= rules.HIGH_RISK_SCORE_THRESHOLD, "warning", "high_fraud_risk_score",
                 F.concat(F.lit("Maximum fraud risk score is "), c("max_score").cast("string"), F.lit(".")),
                 c("max_score"), str(rules.HIGH_RISK_SCORE_THRESHOLD)),
        _finding(8, c("duplicates") > 0, "warning", "duplicate_fraud_cases",
                 F.concat(thousands(c("duplicates")),
                          F.lit(" duplicate fraud case rows were detected across repeated runs.")),
                 c("duplicates"), "0"),
        _finding(9, c("unmatched_merchants") > 0, "warning", "unmatched_fraud_merchants",
                 F.concat(thousands(c("unmatched_merchants")), F.lit(" fraud cases have no matched merchant.")),
                 c("unmatched_merchants"), "0"),
    ]
    from_metrics = metric_rows.select("process_date", F.explode(F.array_compact(F.array(*metric_findings))).alias("f")) \
        .select("process_date", "f.*")
    st = F.coalesce(c("status"), F.lit("unknown"))
    job_findings = latest_health.where(st != "success").select(
        "process_date", F.lit(4).alias("finding_order"), F.coalesce(c("job_name"), F.lit("")).alias("job_name"),
        F.lit("critical").alias("severity"), F.lit("pipeline_job_not_successful").alias("rule_id"),
        F.concat(F.coalesce(c("job_name"), F.lit("unknown job")), F.lit(" finished with status "), st,
                 F.lit(".")).alias("message"),
        st.alias("value"), F.lit("success").alias("threshold"))
    return from_metrics.unionByName(job_findings)


def status(metric_rows: DataFrame, finding_rows: DataFrame) -> DataFrame:
    """Overall status per date: the worst finding severity (D11); dates
    without findings are healthy. ``fail_on_critical`` is the H10 gate."""
    rank = F.when(F.col("severity") == "critical", 2).when(F.col("severity") == "warning", 1).otherwise(0)
    worst = finding_rows.groupBy("process_date").agg(
        F.max(rank).alias("_rank"),
        F.count(F.lit(1)).alias("finding_count"),
        F.count_if(F.col("severity") == "critical").alias("critical_count"),
        F.count_if(F.col("severity") == "warning").alias("warning_count"))
    j = metric_rows.select("process_date").join(worst, "process_date", "left")
    r = F.coalesce(F.col("_rank"), F.lit(0))
    return j.select(
        "process_date",
        F.when(r == 2, "critical").when(r == 1, "warning").otherwise("healthy").alias("status"),
        *[F.coalesce(F.col(x), F.lit(0)).cast("bigint").alias(x)
          for x in ["finding_count", "critical_count", "warning_count"]],
        (r == 2).alias("fail_on_critical"))


def alerts(finding_rows: DataFrame, status_rows: DataFrame, channel: str = rules.DEFAULT_ALERT_CHANNEL) -> DataFrame:
    """One alert per finding with a stable id."""
    j = finding_rows.join(status_rows.select("process_date", F.col("status").alias("monitoring_status")),
                          "process_date", "left")
    return j.select(
        alert_id(F.col("process_date"), F.col("severity"), F.col("rule_id"), F.col("message")).alias("alert_id"),
        "process_date",
        iso_utc(F.current_timestamp()).alias("emitted_at"),
        F.lit(channel).alias("channel"),
        "monitoring_status", "severity", "rule_id", "message", "value", "threshold",
        "finding_order", "job_name")


def first_alerts(summary_rows: DataFrame, lines: int = rules.DASHBOARD_ALERT_LINES) -> DataFrame:
    """The first alerts of each date in rule order, a row each, as the dashboard
    shows them (F6)."""
    return summary_rows.select("process_date", F.posexplode(F.slice("alerts", 1, lines)).alias("position", "a")).select(
        "process_date", (F.col("position") + 1).alias("position"), "a.alert_id", "a.severity", "a.rule_id", "a.message")


def alert_summary(alert_rows: DataFrame, status_rows: DataFrame,
                  channel: str = rules.DEFAULT_ALERT_CHANNEL) -> DataFrame:
    """Per date: alert counts and the alert list in rule order.
    The list holds one entry per rule plus one per failing job, so it is
    bounded by the rule set and the job catalogue, not by the data."""
    agg = alert_rows.groupBy("process_date").agg(
        F.count(F.lit(1)).alias("alert_count"),
        F.count_if(F.col("severity") == "critical").alias("critical_count_a"),
        F.count_if(F.col("severity") == "warning").alias("warning_count_a"),
        F.array_sort(F.collect_list(F.struct("finding_order", "job_name", "alert_id", "severity",
                                             "rule_id", "message", "value", "threshold"))).alias("alerts"))
    j = status_rows.select("process_date", F.col("status").alias("monitoring_status")).join(agg, "process_date", "left")
    return j.select(
        "process_date",
        iso_utc(F.current_timestamp()).alias("generated_at"),
        F.lit(channel).alias("channel"),
        "monitoring_status",
        F.coalesce(F.col("alert_count"), F.lit(0)).cast("bigint").alias("alert_count"),
        F.coalesce(F.col("critical_count_a"), F.lit(0)).cast("bigint").alias("critical_count"),
        F.coalesce(F.col("warning_count_a"), F.lit(0)).cast("bigint").alias("warning_count"),
        F.coalesce(F.col("alerts"), F.array()).alias("alerts"))
