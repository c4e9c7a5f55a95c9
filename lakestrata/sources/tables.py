"""Access to the given parquet tables (one file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Deal a scan's rows round-robin to ``partitions`` tasks, if a number is given.

    For a table that is stored as one file or row group, which a single task
    would parse; the caller knows and says so, nothing is inferred from the
    cluster. Round-robin, not by a key, so a key that holds a third of the rows
    cannot land in one task; Spark sorts each input partition before such a
    repartition, so a retried task sends every row to the same place.
    """
    return df if partitions is None else df.repartition(partitions)


def input_partitions(spark: SparkSession) -> int | None:
    """The number that the job's ``spark.lakestrata.inputPartitions`` asks for, if set."""
    asked = spark.conf.get("spark.lakestrata.inputPartitions", None)
    return int(asked) if asked else None
