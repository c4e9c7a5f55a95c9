"""Pipeline health: audit runs -> health history and latest run per job."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.functions.exprs import iso_to_ts, iso_utc

def health_rows(audit: DataFrame) -> DataFrame:
    """One health row per audit run, with the run time in seconds (3 digits), in no order."""
    micros = F.unix_micros(iso_to_ts(F.col("finished_at"))) - F.unix_micros(iso_to_ts(F.col("started_at")))
    return audit.select(
        "run_id", "job_name", "status", "process_date", "records_read", "records_written",
        "records_rejected", "started_at", "finished_at",
        F.round(micros / 1e6, 3).alias("duration_seconds"),
        "input_prefix", "output_prefix", "error_message",
        iso_utc(F.current_timestamp()).alias("gold_processed_time"),
    )


def pipeline_health(audit: DataFrame) -> DataFrame:
    """The health rows in the order of the finish time and the job (F2)."""
    return health_rows(audit).orderBy("finished_at", "job_name")


def latest_per_job(health: DataFrame) -> DataFrame:
    """Latest run per (process date, job): greatest finish time; on a tie the
    smallest run id. ``rn = 1`` is pre-limited on the map side."""
    w = Window.partitionBy("process_date", "job_name").orderBy(
        iso_to_ts(F.col("finished_at")).desc(), F.col("run_id").asc())
    return health.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def run_listing(runs: DataFrame, process_date: str | None = None, job_name: str | None = None) -> DataFrame:
    """Audit rows of a date and job as the listing shows them (F7): sorted by finish time and run id, with ``is_failure`` as the listing's gate."""
    picked = runs
    if process_date is not None:
        picked = picked.where(F.col("process_date") == process_date)
    if job_name is not None:
        picked = picked.where(F.col("job_name") == job_name)
    failed = F.coalesce(F.col("status"), F.lit("unknown")) != "success"
    return picked.select("process_date", "run_id", "job_name", "status", "records_read", "records_written",
                         "records_rejected", "finished_at", failed.alias("is_failure")).orderBy(
        iso_to_ts(F.col("finished_at")), "run_id")


def latest_listing(latest: DataFrame, process_date: str | None = None) -> DataFrame:
    """The latest run of each job of a date as the listing shows it (F8): by job, with its
    run time; ``is_failure`` is the listing's gate."""
    picked = latest if process_date is None else latest.where(F.col("process_date") == process_date)
    failed = F.coalesce(F.col("status"), F.lit("unknown")) != "success"
    return picked.select("job_name", "status", "records_read", "records_written", "records_rejected", "duration_seconds",
                         "finished_at", failed.alias("is_failure")).orderBy("job_name")


def has_failures(listing: DataFrame) -> bool:
    """Whether a listing must end with an error: some listed run failed."""
    return not listing.where("is_failure").isEmpty()
