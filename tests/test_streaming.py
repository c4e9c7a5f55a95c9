import os
import time

from pyspark.sql import types as T

from lakestrata.streaming.bronze_stream import ingest, ingest_bounded

KAFKA_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()), T.StructField("timestamp", T.TimestampType()),
])


def _batch(spark, path, start, n):
    rows = [(b"k", f'{{"event_id": "e{i}"}}'.encode(), "t", i % 3, i, None) for i in range(start, start + n)]
    spark.createDataFrame(rows, KAFKA_SCHEMA).selectExpr(
        "key", "value", "topic", "partition", "offset",
        "timestamp'2024-01-31 10:00:00' AS timestamp").write.mode("append").parquet(path)


def _run(spark, src, out, ckpt):
    stream = spark.readStream.schema(KAFKA_SCHEMA).parquet(src)
    q = ingest(stream, out, ckpt)
    q.awaitTermination(120)
    assert not q.isActive


def test_available_now_restart_is_exactly_once(spark, tmp_root):
    src, out, ckpt = (os.path.join(tmp_root, x) for x in ("src", "bronze", "ckpt"))
    _batch(spark, src, 0, 50)
    _run(spark, src, out, ckpt)
    assert spark.read.parquet(out).count() == 50
    _run(spark, src, out, ckpt)  # nothing new: nothing written twice
    assert spark.read.parquet(out).count() == 50
    time.sleep(1)
    _batch(spark, src, 50, 20)
    _run(spark, src, out, ckpt)
    df = spark.read.parquet(out)
    assert df.count() == 70 and df.select("kafka_offset").distinct().count() == 70
    assert [r[0] for r in df.select("ingest_date").distinct().collect()] == ["2024-01-31"]


def test_bounded_ingest_stops_and_goes_on(spark, tmp_root):
    """A limit in the middle of a batch: that batch lands whole, later ones wait for the next run, which ends when idle."""
    src, out, ckpt = (os.path.join(tmp_root, x) for x in ("src", "bronze", "ckpt"))
    for start in range(0, 80, 10):
        _batch(spark, src, start, 10)
    files = len([f for f in os.listdir(src) if f.endswith(".parquet")])
    run = lambda limit: ingest_bounded(
        spark.readStream.schema(KAFKA_SCHEMA).option("maxFilesPerTrigger", files // 8).parquet(src), out, ckpt, limit, idle_seconds=8)
    assert run(0) == 0 and not os.path.exists(out)
    first = run(25)
    landed = spark.read.parquet(out)
    assert 25 <= first < 80 and landed.count() >= first
    n = landed.count()
    assert run(10 ** 6) == 80 - n
    landed = spark.read.parquet(out)
    assert landed.count() == 80 and landed.select("kafka_offset").distinct().count() == 80
    assert run(5) == 0  # nothing new: idle
    assert spark.read.parquet(out).count() == 80
