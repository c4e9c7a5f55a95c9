"""Session helpers: defaults that every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the operators depend on for correct results.
REQUIRED_CONF = {
    # Timestamps are rendered as ISO-8601 strings with a +00:00 offset.
    "spark.sql.session.timeZone": "UTC",
    # Last value wins for duplicate JSON keys, like Python's json.loads.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Re-running one business date replaces only that date's partition.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Business-date partition values stay strings when read back.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# Settings that matter for throughput at scale; callers may override.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    # Checkpoint files of released frames are deleted, so the shared
    # checkpoint folder does not grow with every job of a long session.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app_name: str = "lakestrata",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for key, value in {**TUNING_CONF, **REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set to shared storage; executors would write to
    their own disks otherwise, so an unset folder is an error there. In local
    mode (tests) a private scratch folder is created."""
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)  # named in the conf before the context started
        return current
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    # spark.checkpoint.dir cannot be changed at run time; the context's
    # checkpoint folder is what later calls find.
    path = tempfile.mkdtemp(prefix="lakestrata-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


@contextmanager
def released_shuffles(spark: SparkSession):
    """Jobs run inside delete their shuffle files when they have ended, not only
    when the driver collects its garbage. For jobs that end in a stored table,
    so that nothing reads those files again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def materialize(df):
    """Compute ``df`` once and store it as Parquet in the shared checkpoint
    folder. Later jobs (and task retries after an executor loss) read the
    columns they need from there, with filters pushed down, instead of
    recomputing the plan above. What the job has shuffled is deleted when the
    layer is written, so the disk never holds the shuffles of two layers."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/layer-{uuid.uuid4().hex}"
    with released_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
