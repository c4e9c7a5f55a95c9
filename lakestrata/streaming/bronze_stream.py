"""Streaming Bronze ingest (A1-A3): Kafka -> envelope -> append-only,
date-partitioned Bronze table, checkpointed so a restart neither loses nor
duplicates messages (the file sink commits each micro-batch exactly once).

A broker is optional: ``ingest`` takes any streaming DataFrame with the
Kafka source's columns (``key, value, topic, partition, offset, timestamp``),
so tests drive it from a file stream.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakestrata.sources.bronze import envelope


def kafka_source(spark: SparkSession, bootstrap_servers: str, topic: str,
                 max_offsets_per_trigger: int | None = None, starting_offsets: str = "earliest") -> DataFrame:
    """Subscribe to one topic from the earliest offset. ``maxOffsetsPerTrigger``
    bounds each micro-batch; with ``availableNow`` the backlog is drained in
    such batches and the query stops."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return reader.load()


def ingest(messages: DataFrame, bronze_path: str, checkpoint_path: str, ingest_date: str | None = None,
           available_now: bool = True, query_name: str | None = None, interval: str = "10 seconds") -> StreamingQuery:
    """Land a message stream as Bronze. ``ingest_date`` is the business date
    the caller assigns; by default the message time's date is used (never
    the wall clock), so replays land in the same partition."""
    date_col = F.lit(ingest_date) if ingest_date else F.date_format(F.col("timestamp"), "yyyy-MM-dd")
    bronze = envelope(messages, date_col, F.col("timestamp"))
    writer = (bronze.writeStream.format("parquet")
              .option("checkpointLocation", checkpoint_path)
              .option("path", bronze_path)
              .partitionBy("ingest_date")
              .outputMode("append"))
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def ingest_bounded(messages: DataFrame, bronze_path: str, checkpoint_path: str, max_messages: int,
                   idle_seconds: float = 10.0, ingest_date: str | None = None) -> int:
    """Land a message stream until ``max_messages`` are in, or until none has
    come for ``idle_seconds``; returns how many were landed (A1).

    The stop falls between two micro-batches: the batch that reaches the
    limit lands whole, and so may one that has begun by then. Bound the batches by
    the source (``maxOffsetsPerTrigger``), for Kafka to a divisor of the limit. The
    sink commits each batch once and the checkpoint holds the offsets, so
    the next run goes on where this one ended; a batch that the stop
    interrupts is not committed and belongs to the next run.
    """
    if max_messages <= 0:
        return 0
    query = ingest(messages, bronze_path, checkpoint_path, ingest_date, available_now=False, interval="0 seconds")
    landed: dict[int, int] = {}
    last = time.monotonic()
    try:
        while query.isActive and sum(landed.values()) < max_messages:
            query.awaitTermination(0.1)
            known = len(landed)
            landed.update(_rows_of_batches(query))
            busy = query.status["isTriggerActive"] and query.status["isDataAvailable"]
            if len(landed) > known or busy:
                last = time.monotonic()
            elif time.monotonic() - last >= idle_seconds:
                break
    finally:
        query.stop()
    landed.update(_rows_of_batches(query))
    if query.exception() is not None:
        raise query.exception()
    return sum(landed.values())


def _rows_of_batches(query: StreamingQuery) -> dict[int, int]:
    """Rows by batch id of the finished batches that the query remembers (a hundred)."""
    return {p["batchId"]: p["numInputRows"] for p in query.recentProgress if p["numInputRows"] > 0}
