"""Bronze layer: the raw envelope around each Kafka message.

A message becomes ``bronze_ingest_time, kafka_topic, kafka_partition,
kafka_offset, kafka_key, raw_value`` plus the ``ingest_date`` partition
column. The body stays raw text; it is parsed late, as VARIANT, by whoever
reads it, so a body that is not JSON is a reject downstream rather than a
failure here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.exprs import iso_utc, parse_body

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("bronze_ingest_time", T.StringType()),
    T.StructField("kafka_topic", T.StringType()),
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("kafka_offset", T.LongType()),
    T.StructField("kafka_key", T.StringType()),
    T.StructField("raw_value", T.StringType()),
    T.StructField("ingest_date", T.StringType()),
])

# The reference's Bronze documents also carry the parsed body; read as text.
BRONZE_DOCUMENT_SCHEMA = T.StructType([
    T.StructField("bronze_ingest_time", T.StringType()),
    T.StructField("kafka_topic", T.StringType()),
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("kafka_offset", T.LongType()),
    T.StructField("kafka_key", T.StringType()),
    T.StructField("raw_value", T.StringType()),
    T.StructField("parsed_value", T.StringType()),
    T.StructField("_corrupt_record", T.StringType()),
])


def envelope(messages: DataFrame, ingest_date: str | Column | None = None,
             ingest_time: Column | None = None) -> DataFrame:
    """Kafka-shaped rows (``key, value, topic, partition, offset, timestamp``,
    key/value binary or string) -> Bronze envelope.

    ``ingest_date`` is the business date the caller lands the batch under; it
    defaults to the date of ``ingest_time``, which defaults to the clock.
    """
    ts = ingest_time if ingest_time is not None else F.current_timestamp()
    if ingest_date is None:
        date_col = F.date_format(ts, "yyyy-MM-dd")
    elif isinstance(ingest_date, Column):
        date_col = ingest_date
    else:
        date_col = F.lit(ingest_date)
    key = F.col("key").cast("string")
    return messages.select(
        iso_utc(ts).alias("bronze_ingest_time"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("bigint").alias("kafka_offset"),
        F.when(key != "", key).alias("kafka_key"),
        F.col("value").cast("string").alias("raw_value"),
        date_col.alias("ingest_date"),
    )


def object_key(prefix: str) -> Column:
    """Deterministic Bronze object name of a message:
    ``{prefix}/ingest_date=D/{topic}-partition=P-offset=O.json``."""
    return F.concat(F.lit(prefix.rstrip("/") + "/ingest_date="), F.col("ingest_date"), F.lit("/"),
                    F.col("kafka_topic"), F.lit("-partition="), F.col("kafka_partition").cast("string"),
                    F.lit("-offset="), F.col("kafka_offset").cast("string"), F.lit(".json"))


def read_bronze(spark: SparkSession, path: str, ingest_date: str | None = None) -> DataFrame:
    """Read a Bronze parquet table; the date filter prunes partitions."""
    df = spark.read.parquet(path)
    if ingest_date is not None:
        df = df.where(F.col("ingest_date") == ingest_date)
    return df


def read_bronze_documents(spark: SparkSession, path: str, ingest_date: str | None = None) -> DataFrame:
    """Read Bronze stored as one (possibly multi-line) JSON document per file.

    Explicit schema, so no inference pass. A file that is not a JSON object is
    kept as a row with only ``_corrupt_record`` set, so it is quarantined
    downstream instead of failing the job. A nested ``parsed_value`` is
    returned as its JSON text and re-parsed as VARIANT.
    """
    df = (spark.read.schema(BRONZE_DOCUMENT_SCHEMA)
          .option("multiLine", True)
          .option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record")
          .json(path))
    if ingest_date is not None:
        if "ingest_date" not in df.columns:
            raise ValueError(f"{path} is not partitioned by ingest_date; a date cannot be selected")
        df = df.where(F.col("ingest_date") == ingest_date)
    body = F.coalesce(F.col("parsed_value"), F.col("raw_value"))
    return df.withColumn("parsed_value", F.when(F.col("_corrupt_record").isNull(), parse_body(body)))


def bronze_from_documents(spark: SparkSession, path: str, ingest_date: str) -> DataFrame:
    """Bronze documents as envelope rows for the Silver checks, with the file
    that each came from as ``source_object_key`` (A4, A5).

    The body is the document's parsed value, or its raw text; a file that is
    not a JSON object has its own text as the body, so that it is rejected and
    quarantined under its path."""
    docs = (spark.read.schema(BRONZE_DOCUMENT_SCHEMA)
            .option("multiLine", True)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .json(path).select("*", F.col("_metadata.file_path").alias("source_object_key")))
    broken = F.col("_corrupt_record").isNotNull()
    body = F.when(broken, F.col("_corrupt_record")).otherwise(F.coalesce("parsed_value", "raw_value"))
    return docs.select("bronze_ingest_time", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_key",
                       body.alias("raw_value"), F.lit(ingest_date).alias("ingest_date"), "source_object_key")


def write_bronze(bronze: DataFrame, path: str) -> None:
    """Append-only Bronze sink partitioned by ``ingest_date``."""
    bronze.write.mode("append").partitionBy("ingest_date").parquet(path)


CARD_FLAT_FIELDS = ["event_id", "transaction_id", "customer_id", "account_id", "card_id", "event_time", "amount",
                    "currency", "merchant_name", "merchant_country", "authorization_status", "channel"]


def flatten_cards(bronze: DataFrame) -> DataFrame:
    """Envelope columns plus the card event fields as text (A5/B1); a body
    that is not an object gives NULL fields."""
    from lakestrata.functions.exprs import json_fields
    f = json_fields(F.col("raw_value"), CARD_FLAT_FIELDS)
    return bronze.select("kafka_topic", "kafka_partition", "kafka_offset", "bronze_ingest_time",
                         f.alias("_f")).select("kafka_topic", "kafka_partition", "kafka_offset",
                                               "bronze_ingest_time", *[F.col("_f." + c).alias(c)
                                                                       for c in CARD_FLAT_FIELDS])
