"""The change-feed fold as a stream (R1): each micro-batch is merged into the
latest change of every key.

The state is dealt into buckets by a hash of the key. A batch reads and rewrites only
the buckets of its keys, so what it writes follows the batch, not the state, and a small
manifest names for every bucket the batch that holds it. The manifest appears by a rename when
all buckets are written. A batch starts from the manifest before its own, so one that is run
again after a failure gives the same state.

The state keeps winning deletes, so a late change of a smaller LSN cannot bring
a row back.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.operators.core import latest_changes
from lakestrata.plans.publish import Files

#: Buckets of a new state; a state keeps the number that it began with.
BUCKETS = 256


def _manifests(files: Files, path: str) -> list[int]:
    return sorted(int(n.partition("=")[2]) for n in files.names(f"{path}/manifests") if n.startswith("batch="))


def _manifest(files: Files, path: str, batch_id: int) -> dict:
    return json.loads(files.read_text(f"{path}/manifests/batch={batch_id}"))


def _folders(path: str, held: dict[str, int], buckets) -> list[str]:
    return [f"{path}/batch={held[str(b)]}/bucket={b}" for b in buckets if str(b) in held]


def merge_batch(batch: DataFrame, batch_id: int, state_path: str, key: str, lsn: str = "lsn", buckets: int = BUCKETS) -> list[int]:
    """Merge ``batch`` into the state as version ``batch_id``; the buckets that were rewritten.
    What the two newest versions do not need is deleted."""
    spark = batch.sparkSession
    files = Files(spark, state_path)
    older = [v for v in _manifests(files, state_path) if v < batch_id]
    before = _manifest(files, state_path, older[-1]) if older else {"buckets": buckets, "held": {}}
    buckets, held = before["buckets"], dict(before["held"])
    bucket = F.pmod(F.xxhash64(F.coalesce(F.col("after." + key), F.col("before." + key)).cast("string")), F.lit(buckets)).cast("int")
    batch = batch.withColumn("bucket", bucket).persist()
    try:
        touched = sorted(r["bucket"] for r in batch.select("bucket").distinct().collect())  # ``buckets`` at most
        if touched or not older:
            state = batch
            if old := _folders(state_path, held, touched):
                kept = spark.read.schema(batch.drop("bucket").schema).parquet(*old)
                state = batch.unionByName(kept.withColumn("bucket", bucket))
            out = f"{state_path}/batch={batch_id}"
            latest_changes(state, key, lsn).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(out)
            held.update({str(b): batch_id for b in touched})
    finally:
        batch.unpersist()
    text = json.dumps({"buckets": buckets, "held": held, "schema": batch.drop("bucket").schema.json()})
    files.delete(f"{state_path}/manifests/batch={batch_id}")
    files.write_text(f"{state_path}/manifests/_new-{batch_id}", text)
    files.rename(f"{state_path}/manifests/_new-{batch_id}", f"{state_path}/manifests/batch={batch_id}")
    _clean(files, state_path, [before["held"], held], older[:-1])
    return touched


def _clean(files: Files, path: str, needed: list[dict[str, int]], old: list[int]) -> None:
    for v in old:
        files.delete(f"{path}/manifests/batch={v}")
    used = {(v, int(b)) for held in needed for b, v in held.items()}
    newest = max((v for v, _ in used), default=-1)
    for name in files.names(path):
        v = int(name.partition("=")[2]) if name.startswith("batch=") else newest + 1
        if v > newest:
            continue
        own = {b for u, b in used if u == v}
        if not own:
            files.delete(f"{path}/{name}")
            continue
        for part in files.names(f"{path}/{name}"):
            if part.startswith("bucket=") and int(part.partition("=")[2]) not in own:
                files.delete(f"{path}/{name}/{part}")


def fold_stream(changes: DataFrame, state_path: str, checkpoint_path: str, key: str, lsn: str = "lsn", buckets: int = BUCKETS):
    """Start the fold of a streaming change feed over what is available now."""
    return (changes.writeStream
            .foreachBatch(lambda batch, batch_id: merge_batch(batch, batch_id, state_path, key, lsn, buckets) and None)
            .option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start())


def current_state(spark: SparkSession, state_path: str, lsn: str = "lsn", schema: T.StructType | None = None) -> DataFrame:
    """The rows of the newest version, without deleted keys. A state without a version is an empty
    table, of the feed's ``schema`` if that is given."""
    files = Files(spark, state_path)
    versions = _manifests(files, state_path)
    if not versions:
        if schema is None:
            return spark.createDataFrame([], "source_lsn long, last_op string")
        rows = spark.createDataFrame([], schema)
    else:
        newest = _manifest(files, state_path, versions[-1])
        kind = T.StructType.fromJson(json.loads(newest["schema"]))
        folders = _folders(state_path, newest["held"], range(newest["buckets"]))
        rows = spark.read.schema(kind).parquet(*folders) if folders else spark.createDataFrame([], kind)
    return rows.where(F.col("op") != "d").select("after.*", F.col(lsn).alias("source_lsn"), F.col("op").alias("last_op"))
