"""Data-quality validators for every layer.

Unlike the Silver reject path, a validator collects every failure of a
record: one ``_errors`` array per row built from ``when`` terms, then a
failure report (rows with errors) and a per-date summary. Duplicate keys are
found with a grouped count (partial aggregation, skew-safe), not a window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions import rules
from lakestrata.functions.exprs import (CORRUPT, computed_once, json_fields, json_keys, missing_keys, missing_reason, null_or_empty,
                                        parse_object, py_list)
from lakestrata.sources.bronze import object_key


def pyval(c: Column) -> Column:
    """A value as Python would print it in an f-string; NULL prints None."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def _empty(df: DataFrame, field: str) -> Column:
    c = F.col(field)
    if isinstance(df.schema[field].dataType, T.StringType):
        return null_or_empty(c)
    return c.isNull()


def null_or_empty_errors(df: DataFrame, fields: list[str], prefix: str = "field is null or empty: ") -> list[Column]:
    """One error per required field that is absent, NULL or empty (declared order)."""
    out = []
    for f in fields:
        if f in df.columns:
            out.append(F.when(_empty(df, f), F.lit(prefix + f)))
        else:
            out.append(F.lit(prefix + f))
    return out


def missing_columns_error(df: DataFrame, fields: list[str]) -> list[Column]:
    missing = sorted(f for f in fields if f not in df.columns)
    return [F.lit(f"missing fields: {missing}")] if missing else []


def with_errors(df: DataFrame, errors: list[Column]) -> DataFrame:
    return df.withColumn("_errors", F.array_compact(F.array(*errors)))


def failures(checked: DataFrame, keys: list[str]) -> DataFrame:
    """Failure report: one row per failing record with all its errors."""
    return checked.where(F.size("_errors") > 0).select(
        "process_date", *keys, F.size("_errors").alias("error_count"),
        F.array_join("_errors", "; ").alias("errors"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys seen more than once per date."""
    return df.groupBy("process_date", key).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def summary(checked: DataFrame, dup: DataFrame | None = None, dataset: str | None = None) -> DataFrame:
    """Per date: records checked, failed, duplicate keys and the verdict."""
    parts = [checked.groupBy("process_date").agg(
        F.count(F.lit(1)).alias("records_checked"),
        F.count_if(F.size("_errors") > 0).alias("records_failed"))]
    if dup is not None:
        parts.append(dup.groupBy("process_date").agg(F.count(F.lit(1)).alias("duplicate_keys")))
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    g = u.groupBy("process_date").agg(*[F.max(c).alias(c) for c in ["records_checked", "records_failed"]],
                                      *([F.max("duplicate_keys").alias("duplicate_keys")] if dup is not None else []))
    cols = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ["records_checked", "records_failed"]]
    dk = F.coalesce(F.col("duplicate_keys"), F.lit(0)).cast("bigint") if dup is not None else F.lit(0).cast("bigint")
    out = g.select("process_date", *cols, dk.alias("duplicate_keys"))
    ok = (F.col("records_failed") == 0) & (F.col("duplicate_keys") == 0) & (F.col("records_checked") > 0)
    out = out.withColumn("status", F.when(ok, "passed").otherwise("failed"))
    if dataset is not None:
        out = out.withColumn("dataset", F.lit(dataset))
    return out


def _dup_failures(dup: DataFrame, key: str) -> DataFrame:
    return dup.select("process_date", F.col(key), F.lit(1).alias("error_count"),
                      F.concat(F.lit(f"duplicate {key} ("), F.col("copies").cast("string"),
                               F.lit(" copies)")).alias("errors"))


# --- G1 Bronze ------------------------------------------------------------------------

BRONZE_EVENT_FIELDS = rules.BRONZE_REQUIRED_EVENT_FIELDS + rules.BRONZE_EVENT_ID_FIELDS


def _body_errors(keys: Column, field) -> list[Column]:
    """The rules of an event body, of its key list and its fields as text."""
    no_id = reduce(lambda a, b: a & b, [null_or_empty(field(n)) for n in rules.BRONZE_EVENT_ID_FIELDS])
    return [missing_reason(keys, rules.BRONZE_REQUIRED_EVENT_FIELDS, field, "missing event fields: "),
            *[F.when(null_or_empty(field(n)), F.lit("event field is null or empty: " + n))
              for n in rules.BRONZE_REQUIRED_EVENT_FIELDS],
            F.when(no_id, F.lit("missing event identifier: expected one of " + str(sorted(rules.BRONZE_EVENT_ID_FIELDS))))]


def _envelope_errors(field) -> list[Column]:
    return [F.when(null_or_empty(field("raw_value")), F.lit("raw_value is null or empty")),
            F.when(null_or_empty(field("kafka_topic")), F.lit("kafka_topic is null or empty")),
            F.when(field("kafka_partition").isNull(), F.lit("kafka_partition is null")),
            F.when(field("kafka_offset").isNull(), F.lit("kafka_offset is null"))]


NO_OBJECT = "parsed_value must be a JSON object"


def check_bronze(bronze: DataFrame, prefix: str = "") -> DataFrame:
    """Envelope checks of Bronze rows, whose body is their raw text; a body that
    is not a JSON object stops the checks of that record (G1)."""
    raw = F.col("raw_value")
    p = parse_object(bronze, raw, "raw_value", BRONZE_EVENT_FIELDS, rules.BRONZE_REQUIRED_EVENT_FIELDS, [
        F.col("ingest_date").alias("process_date"),
        object_key(prefix).alias("source_object_key"),
        raw, F.col("kafka_topic"), F.col("kafka_partition"), F.col("kafka_offset")])
    checks = F.array_compact(F.array(*_body_errors(F.col("_keys"), lambda n: F.col("_f." + n)), *_envelope_errors(F.col)))
    errors = F.when(F.col("_keys").isNull(), F.array(F.lit(NO_OBJECT))).otherwise(checks)
    return p.select("process_date", "source_object_key", errors.alias("_errors"))


def check_bronze_documents(documents: DataFrame) -> DataFrame:
    """The checks of Bronze stored as JSON documents (``process_date,
    source_object_key, document``), which have the body beside its raw text
    (G1): the envelope's fields, then those of the body. A body that is
    not an object ends the checks; so does a document that is none."""
    fields = rules.BRONZE_DOCUMENT_FIELDS
    keep = [F.col(c) for c in ("process_date", "source_object_key", "document")]
    parsed = computed_once(documents, [json_fields(F.col("document"), fields, {"parsed_value": "map<string,string>"}, CORRUPT).alias("_f"),
                                       json_keys(F.col("document")).alias("_keys"), *keep])
    f = lambda n: F.col("_f." + n)
    body = f("parsed_value")
    lacking = missing_keys(F.col("_keys"), fields)
    missing = F.when(F.size(lacking) > 0, F.concat(F.lit("missing Bronze fields: "), py_list(lacking)))
    checks = F.array(*_body_errors(F.map_keys(body), lambda n: F.element_at(body, n)), *_envelope_errors(f))
    errors = F.when(F.col("_keys").isNull(), F.array(F.lit("document must be a JSON object"))).otherwise(F.array_compact(
        F.concat(F.array(missing), F.when(body.isNull(), F.array(F.lit(NO_OBJECT))).otherwise(checks))))
    return parsed.select("process_date", "source_object_key", errors.alias("_errors"))


def sample_objects(bronze: DataFrame, max_objects: int | None, prefix: str = "") -> DataFrame:
    """The first ``max_objects`` Bronze objects in key order (F5); None keeps
    all. A bounded sample is this operator's purpose when a limit is given."""
    if max_objects is None:
        return bronze
    return bronze.withColumn("_k", object_key(prefix)).orderBy("_k").limit(max_objects).drop("_k")


# --- G2 / G3 Silver ------------------------------------------------------------------

SILVER_CARD_CHECK_FIELDS = rules.CARD_REQUIRED_FIELDS + rules.SILVER_LINEAGE_FIELDS + ["silver_processed_time"]
SILVER_LOGIN_CHECK_FIELDS = rules.LOGIN_REQUIRED_FIELDS + rules.SILVER_LINEAGE_FIELDS + ["silver_processed_time"]


def check_silver_cards(silver: DataFrame) -> DataFrame:
    """24 fields present and non-empty, amount >= 0, USD, known status."""
    amt, cur, st = F.col("amount"), F.col("currency"), F.col("authorization_status")
    errs = [*missing_columns_error(silver, SILVER_CARD_CHECK_FIELDS),
            *null_or_empty_errors(silver, SILVER_CARD_CHECK_FIELDS),
            F.when(F.coalesce(amt >= 0, F.lit(False)) == F.lit(False),
                   F.concat(F.lit("invalid amount: "), pyval(amt))),
            F.when(F.coalesce(cur, F.lit("")) != rules.CARD_ALLOWED_CURRENCY,
                   F.concat(F.lit("invalid currency: "), pyval(cur))),
            F.when(~F.coalesce(st.isin(*rules.CARD_ALLOWED_STATUSES), F.lit(False)),
                   F.concat(F.lit("invalid authorization_status: "), pyval(st)))]
    return with_errors(silver, errs)


def check_silver_logins(silver: DataFrame) -> DataFrame:
    """19 fields present and non-empty, known event type and status."""
    et, st = F.col("event_type"), F.col("login_status")
    errs = [*missing_columns_error(silver, SILVER_LOGIN_CHECK_FIELDS),
            *null_or_empty_errors(silver, SILVER_LOGIN_CHECK_FIELDS),
            F.when(~F.coalesce(et.isin(*rules.LOGIN_ALLOWED_EVENT_TYPES), F.lit(False)),
                   F.concat(F.lit("invalid event_type: "), pyval(et))),
            F.when(~F.coalesce(st.isin(*rules.LOGIN_ALLOWED_STATUSES), F.lit(False)),
                   F.concat(F.lit("invalid login_status: "), pyval(st)))]
    return with_errors(silver, errs)


def silver_failures(checked: DataFrame) -> DataFrame:
    return failures(checked, ["event_id"]).unionByName(_dup_failures(duplicate_keys(checked, "event_id"), "event_id"))


def silver_summary(checked: DataFrame) -> DataFrame:
    return summary(checked, duplicate_keys(checked, "event_id"))


# --- G4-G6 Gold ---------------------------------------------------------------------

def check_gold_tx(tx: DataFrame) -> DataFrame:
    """Fields, status, positive count, approved + declined = count, amounts
    not negative (G4)."""
    c = F.col
    n, a, d = c("transaction_count"), c("approved_count"), c("declined_count")
    errs = [*missing_columns_error(tx, rules.GOLD_TX_REQUIRED_FIELDS),
            *null_or_empty_errors(tx, rules.GOLD_TX_REQUIRED_FIELDS),
            F.when(~F.coalesce(c("authorization_status").isin(*rules.CARD_ALLOWED_STATUSES), F.lit(False)),
                   F.concat(F.lit("invalid authorization_status: "), pyval(c("authorization_status")))),
            F.when(~F.coalesce(n > 0, F.lit(False)), F.concat(F.lit("invalid transaction_count: "), pyval(n))),
            F.when(~F.coalesce(a >= 0, F.lit(False)), F.concat(F.lit("invalid approved_count: "), pyval(a))),
            F.when(~F.coalesce(d >= 0, F.lit(False)), F.concat(F.lit("invalid declined_count: "), pyval(d))),
            F.when(n.isNotNull() & a.isNotNull() & d.isNotNull() & (a + d != n),
                   F.lit("approved_count + declined_count must equal transaction_count")),
            F.when(~F.coalesce(c("total_amount") >= 0, F.lit(False)),
                   F.concat(F.lit("invalid total_amount: "), pyval(c("total_amount")))),
            F.when(~F.coalesce(c("average_amount") >= 0, F.lit(False)),
                   F.concat(F.lit("invalid average_amount: "), pyval(c("average_amount"))))]
    return with_errors(tx, errs)


def check_gold_fraud(cases: DataFrame) -> DataFrame:
    """Fields, integral score, known level, counts >= 0, non-empty
    ``rule_flags`` and ``source_events`` (G5). A score that was not an
    integer in the risk event arrives as NULL."""
    c = F.col
    errs = [*missing_columns_error(cases, rules.GOLD_FRAUD_REQUIRED_FIELDS),
            *null_or_empty_errors(cases, rules.GOLD_FRAUD_REQUIRED_FIELDS),
            F.when(c("risk_score").isNull(), F.lit("risk_score must be an integer: None")),
            F.when(~F.coalesce(c("risk_level").isin(*rules.GOLD_FRAUD_RISK_LEVELS), F.lit(False)),
                   F.concat(F.lit("invalid risk_level: "), pyval(c("risk_level")))),
            *[F.when(~F.coalesce(c(f) >= 0, F.lit(False)),
                     F.concat(F.lit(f"invalid count field {f}: "), pyval(c(f))))
              for f in rules.GOLD_FRAUD_COUNT_FIELDS],
            F.when(~F.coalesce(F.size("rule_flags") > 0, F.lit(False)), F.lit("rule_flags must be a non-empty list")),
            F.when(~F.coalesce(F.size("source_events") > 0, F.lit(False)),
                   F.lit("source_events must be a non-empty list"))]
    return with_errors(cases, errs)


def check_gold_health(health: DataFrame, expected_process_date: str | None = None) -> DataFrame:
    """Fields, status, matching process date, counts and duration >= 0.
    Without an expected date each row is checked against its own partition."""
    c = F.col
    expected = F.lit(expected_process_date) if expected_process_date else c("process_date")
    errs = [*missing_columns_error(health, rules.GOLD_HEALTH_REQUIRED_FIELDS),
            *null_or_empty_errors(health, rules.GOLD_HEALTH_REQUIRED_FIELDS),
            F.when(~F.coalesce(c("status").isin(*rules.GOLD_HEALTH_STATUSES), F.lit(False)),
                   F.concat(F.lit("invalid status: "), pyval(c("status")))),
            F.when(~F.coalesce(c("process_date") == expected, F.lit(False)),
                   F.concat(F.lit("unexpected process_date: "), pyval(c("process_date")))),
            *[F.when(~F.coalesce(c(f) >= 0, F.lit(False)),
                     F.concat(F.lit(f"invalid count field {f}: "), pyval(c(f))))
              for f in rules.GOLD_HEALTH_COUNT_FIELDS],
            F.when(~F.coalesce(c("duration_seconds") >= 0, F.lit(False)),
                   F.concat(F.lit("invalid duration_seconds: "), pyval(c("duration_seconds"))))]
    return with_errors(health, errs)
