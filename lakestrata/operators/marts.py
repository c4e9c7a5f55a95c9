"""Dashboard datasets: approval mix, amount by channel, risk levels, top
transaction groups, top fraud cases, KPI strip and operations summary.

Only the data behind the dashboard is built; HTML rendering is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.functions import rules
from lakestrata.functions.exprs import money, percent, thousands
from lakestrata.operators.gold import TX_KEYS
from lakestrata.operators.monitoring import dedupe_cases


def _share(value: Column, total: Column) -> Column:
    return percent(value, total)


def channel_amount(tx: DataFrame) -> DataFrame:
    """Total amount per channel and its share of all (D8); the share uses
    whole dollars, as the chart does."""
    g = tx.groupBy("process_date", F.coalesce(F.col("channel"), F.lit("unknown")).alias("channel")) \
        .agg(F.sum(F.coalesce("total_amount", F.lit(0).cast("decimal(28,2)"))).alias("amount"))
    total = F.sum("amount").over(Window.partitionBy("process_date"))
    return g.select("process_date", "channel", g["amount"].cast("decimal(38,2)").alias("amount"),
                    _share(F.floor(F.col("amount")), F.floor(total)).alias("share_pct"))


def risk_levels(cases: DataFrame) -> DataFrame:
    """De-duplicated cases per risk level with share."""
    g = dedupe_cases(cases).groupBy("process_date",
                                    F.coalesce(F.col("risk_level"), F.lit("unknown")).alias("risk_level")) \
        .agg(F.count(F.lit(1)).alias("case_count"))
    total = F.sum("case_count").over(Window.partitionBy("process_date"))
    return g.select("process_date", "risk_level", "case_count", _share(F.col("case_count"), total).alias("share_pct"))


def approval_mix(tx: DataFrame) -> DataFrame:
    """Approved and declined transactions with their share of all."""
    g = tx.groupBy("process_date").agg(
        F.sum(F.coalesce("transaction_count", F.lit(0))).alias("transactions"),
        F.sum(F.coalesce("approved_count", F.lit(0))).alias("approved"),
        F.sum(F.coalesce("declined_count", F.lit(0))).alias("declined"))
    s = g.select("process_date", "transactions",
                 F.explode(F.array(
                     F.struct(F.lit("Approved").alias("label"), F.col("approved").alias("count")),
                     F.struct(F.lit("Declined").alias("label"), F.col("declined").alias("count")))).alias("r"))
    return s.select("process_date", "r.label", F.col("r.count").cast("bigint").alias("count"),
                    _share(F.col("r.count"), F.col("transactions")).alias("share_pct"))


def top_transaction_groups(tx: DataFrame, n: int = rules.DASHBOARD_TOP_N) -> DataFrame:
    """Top ``n`` groups by transaction count per date, ties in key order.
    ``rank <= n`` is limited on the map side before the shuffle."""
    w = Window.partitionBy("process_date").orderBy(F.col("transaction_count").desc(), *[F.col(k).asc() for k in TX_KEYS])
    r = tx.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    return r.select("process_date", "rank", *TX_KEYS, "transaction_count", "total_amount", "average_amount",
                    thousands(F.col("transaction_count")).alias("count_display"),
                    money(F.col("total_amount")).alias("total_display"),
                    money(F.col("average_amount")).alias("average_display"))


def top_fraud_cases(cases: DataFrame, n: int = rules.DASHBOARD_TOP_N) -> DataFrame:
    """Top ``n`` de-duplicated cases by score per date (F4); an unmatched
    merchant shows as 'Not matched' (B20)."""
    u = dedupe_cases(cases)
    w = Window.partitionBy("process_date").orderBy(
        F.coalesce(F.col("risk_score"), F.lit(0)).desc(), *[F.col(k).asc() for k in
                                                            ["risk_event_id", "customer_id", "source_transaction_id"]])
    r = u.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    m = F.col("merchant_name")
    return r.select("process_date", "rank", "risk_event_id", "customer_id", "risk_score", "risk_level",
                    "recommended_action", "failed_login_count",
                    F.when(m.isNull() | (m == ""), F.lit(rules.UNMATCHED_LABEL)).otherwise(m).alias("merchant_display"))


def _tone_of(status: Column) -> Column:
    return F.when(status == "healthy", "good").when(status == "critical", "bad").otherwise("warn")


def kpis(metric_rows: DataFrame, status_rows: DataFrame | None = None,
         summary_rows: DataFrame | None = None) -> DataFrame:
    """The ten KPI tiles per date (H13): label, value, note and tone. Status
    and alert summary may be absent, as their files may be."""
    m = metric_rows
    if status_rows is not None:
        m = m.join(status_rows.select("process_date", F.col("status").alias("_mstatus"),
                                      F.col("finding_count").alias("_findings")), "process_date", "left")
    else:
        m = m.withColumn("_mstatus", F.lit(None).cast("string")).withColumn("_findings", F.lit(None).cast("bigint"))
    if summary_rows is not None:
        m = m.join(summary_rows.select("process_date", F.col("alert_count").alias("_alerts"),
                                       F.col("monitoring_status").alias("_astatus")), "process_date", "left")
    else:
        m = m.withColumn("_alerts", F.lit(None).cast("bigint")).withColumn("_astatus", F.lit(None).cast("string"))
    c = F.col
    n = lambda x: thousands(c(x))
    tiles = [
        ("Pipeline Jobs", c("jobs").cast("string"),
         F.concat(c("success").cast("string"), F.lit(" success / "), c("failed").cast("string"), F.lit(" failing")),
         F.when((c("failed") == 0) & (c("jobs") > 0), "good").otherwise("warn")),
        ("Records Moved", n("records_written"), F.concat(n("records_read"), F.lit(" read")), F.lit("good")),
        ("Rejected Records", n("records_rejected"), F.lit("latest job health"),
         F.when(c("records_rejected") > 0, "bad").otherwise("good")),
        ("Transactions", n("transactions"), F.concat(money(c("amount")), F.lit(" total amount")), F.lit("violet")),
        ("Declines", n("declined"), F.concat(n("approved"), F.lit(" approved")),
         F.when(c("declined") > 0, "warn").otherwise("good")),
        ("Fraud Cases", n("cases"), F.concat(c("high_risk").cast("string"), F.lit(" medium-high/high after dedupe")),
         F.when(c("high_risk") > 0, "bad").otherwise("good")),
        ("Max Risk Score", n("max_score"), F.concat(n("failed_logins"), F.lit(" failed logins")),
         F.when(c("max_score") >= rules.HIGH_RISK_SCORE_THRESHOLD, "bad").otherwise("warn")),
        ("Duplicate Cases", n("duplicates"), F.concat(n("raw_cases"), F.lit(" raw case rows")),
         F.when(c("duplicates") > 0, "warn").otherwise("good")),
        ("Monitoring Status", F.coalesce(c("_mstatus"), F.lit("missing")),
         F.concat(F.coalesce(c("_findings"), F.lit(0)).cast("string"), F.lit(" findings")),
         F.when(c("_mstatus").isNull(), "warn").otherwise(_tone_of(c("_mstatus")))),
        ("Alerts Delivered", thousands(F.coalesce(c("_alerts"), F.lit(0))), F.lit("local alert history"),
         F.when(c("_astatus").isNull(), "warn").otherwise(_tone_of(c("_astatus")))),
    ]
    arr = F.array(*[F.struct(F.lit(i + 1).alias("kpi_order"), F.lit(lbl).alias("label"), v.alias("value"),
                             note.alias("note"), tone.alias("tone")) for i, (lbl, v, note, tone) in enumerate(tiles)])
    return m.select("process_date", F.explode(arr).alias("k")).select("process_date", "k.*")


def operations_summary(metric_rows: DataFrame) -> DataFrame:
    """Ordered operations messages per date and the overall tone."""
    c = F.col
    bad = (c("failed") > 0) | (c("records_rejected") > 0)
    warn = (c("duplicates") > 0) | (c("unmatched_merchants") > 0)
    severity = F.when(bad, "bad").when(warn, "warn").otherwise("good")
    msgs = [
        F.when(c("failed") > 0, F.concat(c("failed").cast("string"), F.lit(" pipeline job is not successful.")))
        .otherwise(F.lit("All latest pipeline jobs are successful.")),
        F.when(c("records_rejected") > 0, F.concat(thousands(c("records_rejected")), F.lit(" records were rejected.")))
        .otherwise(F.lit("No rejected records in latest job health.")),
        F.when(c("duplicates") > 0, F.concat(thousands(c("duplicates")),
                                             F.lit(" duplicate fraud case rows detected across repeated runs."))),
        F.when(c("unmatched_merchants") > 0, F.concat(thousands(c("unmatched_merchants")),
                                                      F.lit(" fraud cases have no matched merchant."))),
        F.when(c("declined") > 0, F.concat(F.lit("Decline rate is "),
                                           percent(c("declined"), c("transactions")).cast("string"),
                                           F.lit("% for this partition."))),
    ]
    arr = F.array_compact(F.array(*[F.when(mm.isNotNull(), F.struct(F.lit(i + 1).alias("message_order"),
                                                                    mm.alias("message")))
                                    for i, mm in enumerate(msgs)]))
    return metric_rows.select("process_date", severity.alias("severity"), F.explode(arr).alias("m")) \
        .select("process_date", "severity", "m.message_order", "m.message")
