"""Per-date pipeline runner with its sinks (A9-A13, the job order of the
orchestrated partition run).

Storage layout under one root (shared storage on a cluster):

    bronze/<topic>/ingest_date=D/             parquet, append-only
    silver/card|login/process_date=D/         parquet, replaced by a run
    quarantine/process_date=D/                parquet, append
    gold/tx|fraud|health|health_latest/process_date=D/
    audit/process_date=D/                     one row per job run, append
    monitoring/metrics|findings|status|summary/process_date=D/
    monitoring/alert_history/process_date=D/  append (not de-duplicated across reruns)

A Silver or Gold job whose result is empty records a failed audit row, leaves
the old partition in place and stops the jobs that need it. Every other partition is
replaced by name, so an empty result (no findings on a healthy day) clears what an
earlier run left. Partitions are replaced atomically (``publish``): a job that is
killed while it writes leaves the old one. A partition that was never written reads as an
empty table with the schema of its operator.

The counters of the audit rows are observed while a job writes its output, always in the
last stage of a write, whose tasks count once however often they are tried.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions import rules
from lakestrata.operators import gold, health, marts, monitoring, silver, validation
from lakestrata.plans import publish
from lakestrata.session import configure
from lakestrata.sources.bronze import ENVELOPE_SCHEMA

AUDIT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("job_name", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("process_date", T.StringType()),
    T.StructField("input_prefix", T.StringType()), T.StructField("output_prefix", T.StringType()),
    T.StructField("records_read", T.LongType()), T.StructField("records_written", T.LongType()),
    T.StructField("records_rejected", T.LongType()), T.StructField("started_at", T.StringType()),
    T.StructField("finished_at", T.StringType()), T.StructField("error_message", T.StringType()),
])


def _now() -> datetime:
    return datetime.now(timezone.utc)


def run_id(job_name: str, at: datetime | None = None) -> str:
    """``job-YYYYmmddTHHMMSSZ-8hex``."""
    at = at or _now()
    return f"{job_name}-{at.strftime('%Y%m%dT%H%M%SZ')}-{uuid.uuid4().hex[:8]}"


@dataclass
class Layout:
    root: str

    def p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])


def write_partition(df: DataFrame, path: str, process_date: str, keep_if_empty: bool = False, **counters) -> publish.Staged:
    """Replace one date's partition by name, also by no rows at all (A9), unless told to
    keep the old one then. Returns what was written, with its observed counters."""
    rows = df.where(F.col("process_date") == process_date).drop("process_date")
    staged = publish.stage(rows, path, f"process_date={process_date}", **counters)
    if keep_if_empty and not staged.rows:
        publish.discard(df.sparkSession, staged)
    else:
        publish.commit(df.sparkSession, staged)
    return staged


def append_partition(df: DataFrame, path: str) -> None:
    df.write.mode("append").partitionBy("process_date").parquet(path)


def write_audit(spark: SparkSession, layout: Layout, job_name: str, status: str, process_date: str,
                input_prefix: str, output_prefix: str, read: int, written: int, rejected: int,
                started_at: datetime, error_message: str | None = None) -> dict:
    """Append one audit record (A11). The record is a single row: it is the
    only thing built on the driver."""
    rec = {"run_id": run_id(job_name), "job_name": job_name, "status": status, "process_date": process_date,
           "input_prefix": input_prefix, "output_prefix": output_prefix, "records_read": int(read),
           "records_written": int(written), "records_rejected": int(rejected),
           "started_at": started_at.isoformat(), "finished_at": _now().isoformat(),
           "error_message": error_message}
    append_partition(spark.createDataFrame([rec], AUDIT_SCHEMA), layout.p("audit"))
    return rec


def read_dated(spark: SparkSession, path: str, schema: T.StructType, column: str, date: str) -> DataFrame:
    """One date's partition of a table, by an explicit schema; a partition that
    does not exist is an empty table (A7)."""
    data = T.StructType([f for f in schema.fields if f.name != column])
    folder = publish.current_folder(spark, path, f"{column}={date}")
    df = spark.read.schema(data).parquet(folder) if folder else spark.createDataFrame([], data)
    return df.withColumn(column, F.lit(date))


def table_schemas(spark: SparkSession) -> dict[str, T.StructType]:
    """The schema of every table, taken from its operator on empty inputs (no job runs)."""
    bronze = spark.createDataFrame([], ENVELOPE_SCHEMA)
    cards, logins = silver.silver_cards(bronze), silver.silver_logins(bronze)
    tx = gold.transaction_monitoring(cards)
    cases = gold.fraud_cases(cards, logins, gold.risk_events(bronze))
    history = health.pipeline_health(spark.createDataFrame([], AUDIT_SCHEMA))
    latest = health.latest_per_job(history)
    m = monitoring.metrics(latest, tx, cases)
    f = monitoring.findings(m, latest)
    st = monitoring.status(m, f)
    frames = {"silver/card": cards, "silver/login": logins, "gold/tx": tx, "gold/fraud": cases, "gold/health": history,
              "gold/health_latest": latest, "monitoring/metrics": m, "monitoring/findings": f, "monitoring/status": st,
              "monitoring/summary": monitoring.alert_summary(monitoring.alerts(f, st), st)}
    return {name: df.schema for name, df in frames.items()} | {"audit": AUDIT_SCHEMA}


class PartitionRun:
    """Runs the jobs of one business date in the orchestrated order.

    Cards are read from the business date's own landing partition; logins and
    risk events may have landed under other dates."""

    def __init__(self, spark: SparkSession, root: str, process_date: str, ingest_date: str | None = None,
                 risk_ingest_date: str | None = None, card_ingest_date: str | None = None):
        self.spark = configure(spark)
        self.layout = Layout(root)
        self.process_date = process_date
        self.card_ingest_date = card_ingest_date or process_date
        self.ingest_date = ingest_date or process_date
        self.risk_ingest_date = risk_ingest_date or self.ingest_date
        self.schemas = table_schemas(spark)

    def table(self, name: str) -> DataFrame:
        """This date's partition of ``layer/name``."""
        return read_dated(self.spark, self.layout.p(*name.split("/")), self.schemas[name], "process_date", self.process_date)

    def replace(self, df: DataFrame, name: str, keep_if_empty: bool = False, **counters) -> publish.Staged:
        return write_partition(df, self.layout.p(*name.split("/")), self.process_date, keep_if_empty, **counters)

    def audit(self, job: str, status: str, source: str, target: str, read: int, written: int, rejected: int,
              started: datetime, error: str | None = None) -> dict:
        return write_audit(self.spark, self.layout, job, status, self.process_date, source, target, read, written,
                           rejected, started, error)

    # -- Bronze -> Silver ------------------------------------------------------------
    def _bronze(self, topic_dir: str, date: str) -> DataFrame:
        return read_dated(self.spark, self.layout.p("bronze", topic_dir), ENVELOPE_SCHEMA, "ingest_date", date)

    def silver(self, kind: str) -> dict:
        started = _now()
        if kind == "card":
            job, check, date = rules.JOB_SILVER_CARD, silver.check_cards, self.card_ingest_date
        else:
            job, check, date = rules.JOB_SILVER_LOGIN, silver.check_logins, self.ingest_date
        # Quarantine and Silver read the checked rows from a stored table: each body is parsed
        # once, and a lost executor takes no part of it along.
        bad = F.count_if(F.col("rejection_reason").isNotNull())
        work = publish.stage(check(self._bronze(kind, date), self.process_date), self.layout.p("_work", job),
                             f"process_date={self.process_date}", rejected=bad)
        try:
            return self._silver_outputs(job, kind, work, started)
        finally:
            publish.discard(self.spark, work)

    def _silver_outputs(self, job: str, kind: str, work: publish.Staged, started: datetime) -> dict:
        checked = self.spark.read.parquet(work.folder)
        read, rejected = work.rows, int(work.observed.get("rejected") or 0)
        out_path = self.layout.p("silver", kind)
        if rejected:
            append_partition(silver.quarantine(checked, job), self.layout.p("quarantine"))
        written = self.replace(silver.silver_from_checked(checked), f"silver/{kind}", keep_if_empty=True).rows
        if not written:
            return self.audit(job, "failed", kind, out_path, read, 0, rejected, started, "No valid Silver records produced.")
        return self.audit(job, "success", kind, out_path, read, written, rejected, started)

    # -- Gold ----------------------------------------------------------------------------
    def gold_transactions(self) -> dict:
        started, job, path = _now(), "gold_transaction_monitoring", self.layout.p("gold", "tx")
        # every card is counted in one group, so the groups tell how many were read
        done = self.replace(gold.transaction_monitoring(self.table("silver/card")), "gold/tx", keep_if_empty=True,
                            read=F.sum("transaction_count"))
        if not done.rows:
            return self.audit(job, "failed", "silver/card", path, 0, 0, 0, started,
                              "No Gold transaction monitoring records produced.")
        return self.audit(job, "success", "silver/card", path, int(done.observed["read"]), done.rows, 0, started)

    def gold_fraud(self) -> dict:
        started, job, path = _now(), "gold_fraud_investigation", self.layout.p("gold", "fraud")
        cards, logins = self.table("silver/card"), self.table("silver/login")
        risks = gold.risk_events(self._bronze("risk", self.risk_ingest_date), self.process_date)
        read = cards.count() + logins.count()  # from the Parquet footers
        n_risk = self.replace(gold.fraud_cases(cards, logins, risks), "gold/fraud", keep_if_empty=True).rows  # a case each
        if not n_risk:
            return self.audit(job, "failed", "silver;bronze/risk", path, read, 0, 0, started,
                              "No fraud investigation records produced.")
        return self.audit(job, "success", "silver;bronze/risk", path, read + n_risk, n_risk, 0, started)

    def gold_health(self) -> dict:
        started = _now()
        n = self.replace(health.pipeline_health(self.table("audit")), "gold/health").rows
        latest = self.replace(health.latest_per_job(self.table("gold/health")), "gold/health_latest").rows
        return self.audit("gold_pipeline_health", "success" if n else "failed", "audit", "gold/health;gold/health_latest",
                          n, n + latest, 0, started, None if n else "No pipeline health records produced.")

    # -- monitoring, alerts, dashboard ---------------------------------------------------
    def monitor(self, channel: str = rules.DEFAULT_ALERT_CHANNEL) -> dict:
        """Metrics, findings, status and alerts of the date; a date without any
        rows has its absences as findings."""
        date = self.spark.createDataFrame([(self.process_date,)], "process_date string")
        latest = self.table("gold/health_latest")
        self.replace(monitoring.metrics(latest, self.table("gold/tx"), self.table("gold/fraud"), date), "monitoring/metrics")
        m = self.table("monitoring/metrics")
        self.replace(monitoring.findings(m, latest), "monitoring/findings")
        self.replace(monitoring.status(m, self.table("monitoring/findings")), "monitoring/status")
        st = self.table("monitoring/status")
        a = monitoring.alerts(self.table("monitoring/findings"), st, channel)
        append_partition(a, self.layout.p("monitoring", "alert_history"))
        self.replace(monitoring.alert_summary(a, st, channel), "monitoring/summary")
        row = st.collect()  # one row per date
        return row[0].asDict() if row else {}

    def dashboard(self) -> dict[str, DataFrame]:
        m, st, su = (self.table(f"monitoring/{n}") for n in ("metrics", "status", "summary"))
        tx, cases = self.table("gold/tx"), self.table("gold/fraud")
        return {"kpis": marts.kpis(m, st, su), "ops": marts.operations_summary(m),
                "approval_mix": marts.approval_mix(tx), "channel_amount": marts.channel_amount(tx),
                "risk_levels": marts.risk_levels(cases), "top_tx": marts.top_transaction_groups(tx),
                "top_fraud": marts.top_fraud_cases(cases), "alerts": monitoring.first_alerts(su)}

    # -- gates ----------------------------------------------------------------------------
    def validate(self, name: str) -> list[dict]:
        """The summary of a table's validator; a table without rows has none and fails."""
        checks = {"silver/card": validation.check_silver_cards, "silver/login": validation.check_silver_logins,
                  "gold/tx": validation.check_gold_tx, "gold/fraud": validation.check_gold_fraud,
                  "gold/health": validation.check_gold_health, "gold/health_latest": validation.check_gold_health}
        checked = checks[name](self.table(name))
        rows = (validation.silver_summary(checked) if name.startswith("silver") else validation.summary(checked)).collect()
        return [r.asDict() for r in rows] or [{"process_date": self.process_date, "records_checked": 0, "records_failed": 0,
                                               "duplicate_keys": 0, "status": "failed"}]

    def validate_silver(self) -> list[dict]:
        return self.validate("silver/card") + self.validate("silver/login")

    def latest_runs(self) -> DataFrame:
        """The listing of the date's latest runs (F8)."""
        return health.latest_listing(self.table("gold/health_latest"), self.process_date)

    def run(self, stop_on_failed_validation: bool = True, report_failures: bool = True) -> dict:
        """Silver, Gold, health, monitoring and alerts, each job after those that it needs.

        Cards and logins do not need each other; transactions need the cards, fraud cases the cards
        and logins, health both Gold tables. A failed job stops those that need it, as does a failed
        validation (unless told otherwise); ``stopped_at`` names where first, ``stopped`` everywhere.
        With ``report_failures`` health and monitoring report on the date nevertheless. Without,
        they run only if all before them passed, and monitoring only if the listing of the
        latest runs has no failure: the order of the orchestrated run."""
        result: dict = {"stopped": []}
        good: dict[str, bool] = {}

        def stop(where: str) -> bool:
            result["stopped"].append(where)
            result.setdefault("stopped_at", where)
            return False

        def passes(step: str, job, gates: tuple[str, ...], needs: tuple[str, ...] = ()) -> None:
            good[step] = all(good[n] for n in needs)
            if not good[step]:
                return
            result[step] = job()
            if result[step]["status"] != "success":
                good[step] = stop(step)
                return
            for name in gates:
                result[f"validate {name}"] = rows = self.validate(name)
                if stop_on_failed_validation and any(r["status"] != "passed" for r in rows):
                    good[step] = stop(f"validate {name}")
                    return

        passes("silver_card", lambda: self.silver("card"), ("silver/card",))
        passes("silver_login", lambda: self.silver("login"), ("silver/login",))
        passes("gold_tx", self.gold_transactions, ("gold/tx",), ("silver_card",))
        passes("gold_fraud", self.gold_fraud, ("gold/fraud",), ("silver_card", "silver_login"))
        result["silver_validation"] = [r for n in ("card", "login") for r in result.get(f"validate silver/{n}", [])]
        passes("gold_health", self.gold_health, ("gold/health", "gold/health_latest"), () if report_failures else ("gold_tx", "gold_fraud"))
        if not report_failures and (not good["gold_health"] or health.has_failures(self.latest_runs())):
            if good["gold_health"]:
                stop("latest runs")
            return result
        result["monitoring"] = self.monitor()
        return result


def run_partition(spark: SparkSession, root: str, process_date: str, ingest_date: str | None = None,
                  risk_ingest_date: str | None = None) -> dict:
    return PartitionRun(spark, root, process_date, ingest_date, risk_ingest_date).run()
