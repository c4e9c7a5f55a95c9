"""Silver layer: validate, type and de-duplicate Bronze events.

Each record gets one ``rejection_reason`` column: the first failed check in a
fixed order (body is an object -> required keys present -> required values not
null/empty -> domain rules -> amount parses). NULL means valid. Valid and
rejected rows come from the same scan; valid rows are de-duplicated by
``event_id`` with the last delivery (highest Kafka partition, then offset)
winning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.functions import rules
from lakestrata.functions.exprs import (CORRUPT, computed_once, first_failure, iso_utc, json_fields, missing_reason, null_or_empty,
                                        parse_object)
from lakestrata.sources.bronze import object_key

NOT_OBJECT = "parsed_value must be a JSON object"

# Tie on (partition, offset) means a redelivered message; the raw text breaks
# it so reruns pick the same winner.
def last_delivery() -> list[Column]:
    return [F.col("bronze_kafka_partition").desc(), F.col("bronze_kafka_offset").desc(), F.col("_raw").desc()]


#: A number as text: sign, digits before and behind the point, exponent.
NUMBER = r"\A([+-]?)(?=\.?[0-9])([0-9]*)\.?([0-9]*)(?:[eE]([+-]?[0-9]{1,6}))?\z"


def parse_amount(text: Column) -> Column:
    """Amount text -> decimal(28,2) rounded half-even from all of its digits; NULL when it
    is no number, or one that does not fit.

    Texts of up to two decimals need no rounding and are read as a short decimal, which is several times
    cheaper; others of up to 20 characters without an exponent are read as they are. Of the rest the
    digits are shifted by the exponent, and those behind the third place become a single
    one that tells whether any of them is not zero, so the rounding is that of the whole text."""
    t = F.trim(text)
    plain = F.when(t.rlike(r"\A-?[0-9]{1,15}(\.[0-9]{1,2})?\z"), t.try_cast("decimal(18,2)")).cast("decimal(28,2)")
    # in a function of its own: written out in the projection, its code is too large to be compiled
    return F.coalesce(plain, F.element_at(F.transform(F.array(t), _rounded_amount), 1))


def _rounded_amount(t: Column) -> Column:
    """The amount of a trimmed text that needs rounding or shifting (``parse_amount``)."""
    part = lambda i: F.regexp_extract(t, NUMBER, i)
    digits = F.concat(part(2), part(3))
    point = F.length(part(2)) + F.coalesce(F.when(part(4) != "", part(4)).try_cast("int"), F.lit(0))
    zeros = F.repeat(F.lit("0"), F.least(F.greatest(-point, F.lit(0)), F.lit(4)))
    behind = F.when(point > 0, F.substring(digits, point + 1, F.length(digits))).otherwise(F.concat(zeros, digits))
    # an amount of more than 60 digits before the point is none that fits, unless they are zeros
    shown = F.ltrim(F.when(point > 0, F.substring(digits, F.lit(1), point)).otherwise(F.lit("")), F.lit("0"))
    missing = F.greatest(point - F.length(digits), F.lit(0))
    whole = F.when(shown == "", F.lit("0")).otherwise(F.concat(shown, F.repeat(F.lit("0"), F.least(missing, F.lit(60)))))
    sticky = F.when(F.substring(behind, F.lit(4), F.length(behind)).rlike("[1-9]"), "1").otherwise("0")
    short = F.concat(part(1), whole, F.lit("."), F.rpad(F.substring(behind, 1, 3), 3, "0"), sticky)
    exact = F.when((F.length(t) <= 20) & ~F.contains(F.lower(t), F.lit("e")), t.try_cast("decimal(38,18)"))
    long = F.when(exact.isNull() & t.rlike(NUMBER), short).try_cast("decimal(38,4)")
    return F.coalesce(F.bround(exact, 2).try_cast("decimal(28,2)"), F.bround(long, 2).try_cast("decimal(28,2)"))


def amount_reason(text: Column) -> Column:
    """Why an amount is rejected; a number that does not fit is told apart from
    text that is no number."""
    number = F.trim(text).rlike(r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z")
    return F.when(parse_amount(text).isNull(),
                  F.concat(F.when(number, F.lit("amount out of range: ")).otherwise(F.lit("invalid amount: ")), text))


CARD_FIELDS = rules.CARD_REQUIRED_FIELDS[:13] + ["merchant_city"] + rules.CARD_REQUIRED_FIELDS[13:]
LOGIN_FIELDS = ["event_id", "login_event_id", "customer_id", "event_time", "event_type", "login_status",
                "failure_reason", "device_id", "device_type", "ip_address", "country", "city", "channel",
                "user_agent", "source_system", "schema_version"]


def _lineage() -> list[Column]:
    return [F.col("kafka_topic").alias("bronze_kafka_topic"),
            F.col("kafka_partition").alias("bronze_kafka_partition"),
            F.col("kafka_offset").alias("bronze_kafka_offset"),
            F.col("bronze_ingest_time")]


def parse_events(bronze: DataFrame, fields: list[str], prefix: str, required: list[str],
                 process_date: str | None = None, beside: set[str] | None = None) -> DataFrame:
    """Parse each body: all event fields as text (``_f``) and its key list
    (``_keys``, NULL when the body is not a JSON object), next to lineage and
    raw text (``exprs.parse_object``: key lists only where they matter, each
    step behind a plan barrier). The business date is ``process_date``, or the
    date the message landed under; the object key always has the latter. ``beside`` names
    what is needed of lineage, date, raw text and object key (all by default): every step copies them."""
    kept = [
        *_lineage(),
        (F.lit(process_date) if process_date else F.col("ingest_date")).alias("process_date"),
        F.col("raw_value").alias("_raw"),
        (F.col("source_object_key") if "source_object_key" in bronze.columns else object_key(prefix)).alias("_source_object_key"),
    ]
    kept = [c for name, c in zip(BESIDE, kept, strict=True) if beside is None or name in beside]
    return parse_object(bronze, F.col("raw_value"), "_raw", fields, required, kept)


def _f(name: str) -> Column:
    return F.col("_f." + name)


def _missing_reason(fields: list[str]) -> Column:
    return missing_reason(F.col("_keys"), fields, _f, "missing fields: ")


def _first_null_or_empty(fields: list[str]) -> Column:
    return F.coalesce(*[F.when(null_or_empty(_f(f)), F.lit("field is null or empty: " + f)) for f in fields])


def card_reason() -> Column:
    currency, status, amount = _f("currency"), _f("authorization_status"), _f("amount")
    return first_failure(
        F.when(F.col("_keys").isNull(), F.lit(NOT_OBJECT)),
        _missing_reason(rules.CARD_REQUIRED_FIELDS),
        _first_null_or_empty(rules.CARD_REQUIRED_FIELDS),
        F.when(currency != rules.CARD_ALLOWED_CURRENCY, F.concat(F.lit("unsupported currency: "), currency)),
        F.when(~status.isin(*rules.CARD_ALLOWED_STATUSES),
               F.concat(F.lit("unsupported authorization_status: "), status)),
        amount_reason(amount),
        F.when(~_f("card_present").isin("true", "false"), F.concat(F.lit("invalid card_present: "), _f("card_present"))),
    )


def login_reason() -> Column:
    etype, status = _f("event_type"), _f("login_status")
    return first_failure(
        F.when(F.col("_keys").isNull(), F.lit(NOT_OBJECT)),
        _missing_reason(rules.LOGIN_REQUIRED_FIELDS),
        _first_null_or_empty(rules.LOGIN_REQUIRED_FIELDS),
        F.when(~etype.isin(*rules.LOGIN_ALLOWED_EVENT_TYPES), F.concat(F.lit("unsupported event_type: "), etype)),
        F.when(~status.isin(*rules.LOGIN_ALLOWED_STATUSES), F.concat(F.lit("unsupported login_status: "), status)),
    )


TAIL = ["bronze_kafka_topic", "bronze_kafka_partition", "bronze_kafka_offset", "bronze_ingest_time",
        "process_date"]
BESIDE = [*TAIL, "_raw", "_source_object_key"]
#: What the order of deliveries reads, next to the event's id.
DELIVERY = {"process_date", "bronze_kafka_partition", "bronze_kafka_offset", "_raw"}


def _card_columns() -> list[Column]:
    cols = []
    for f in CARD_FIELDS:
        if f == "amount":
            cols.append(parse_amount(_f(f)).alias(f))
        elif f == "card_present":
            cols.append(F.when(_f(f) == "true", True).when(_f(f) == "false", False).alias(f))
        else:
            cols.append(_f(f).alias(f))
    return cols


def _login_columns() -> list[Column]:
    return [_f(f).alias(f) for f in LOGIN_FIELDS]


def _checked(p: DataFrame, columns: list[Column], reason: Column) -> DataFrame:
    have = [c for c in BESIDE if c in p.columns]
    return p.select(*columns, *[c for c in have if c in TAIL], reason.alias("rejection_reason"), *[c for c in have if c not in TAIL])


def check_cards(bronze: DataFrame, process_date: str | None = None, beside: set[str] | None = None) -> DataFrame:
    """Bronze card envelope -> typed candidate rows with ``rejection_reason``, and ``beside`` them
    what is named of ``BESIDE`` (all by default)."""
    p = parse_events(bronze, CARD_FIELDS, rules.BRONZE_CARD_PREFIX, rules.CARD_REQUIRED_FIELDS, process_date, beside)
    return _checked(p, _card_columns(), card_reason())


def check_logins(bronze: DataFrame, process_date: str | None = None, beside: set[str] | None = None) -> DataFrame:
    """Bronze login envelope -> typed candidate rows with ``rejection_reason``, and ``beside`` them
    what is named of ``BESIDE`` (all by default)."""
    p = parse_events(bronze, LOGIN_FIELDS, rules.BRONZE_LOGIN_PREFIX, rules.LOGIN_REQUIRED_FIELDS, process_date, beside)
    return _checked(p, _login_columns(), login_reason())


def _behind_barrier(checked: DataFrame, columns: list[str]) -> DataFrame:
    """These columns of the checked rows, each computed once (``computed_once``): a filter on the
    bare reason expression is rewritten by the optimizer into a predicate that grows with
    every check (the planner runs out of memory)."""
    return computed_once(checked, [F.col(c) for c in columns])


def deduplicate(checked: DataFrame, key: str = "event_id", columns: list[str] | None = None) -> DataFrame:
    """Keep the last valid delivery per (process_date, key), with the given columns (all, but the
    object key, by default).

    Rejected rows are dropped before the window: a rejected copy can never
    displace a valid one, and a key with no valid copy yields nothing, so the
    shuffle carries only valid rows and no reason text. ``row_number() = 1`` lets Spark insert a partial
    WindowGroupLimit before the shuffle, so even a key that holds a large
    share of all rows is cut to one row per map task before it moves.
    """
    kept = columns or [c for c in checked.columns if c not in ("_source_object_key", "rejection_reason")]
    valid = _behind_barrier(checked, [*kept, "rejection_reason"]) \
        .where(F.col("rejection_reason").isNull()).drop("rejection_reason")
    w = Window.partitionBy(key, "process_date").orderBy(*last_delivery())
    ranked = valid.withColumn("_rn", F.row_number().over(w))
    return ranked.where(F.col("_rn") == 1).drop("_rn")


def silver_from_checked(checked: DataFrame) -> DataFrame:
    out = deduplicate(checked)
    return out.drop("_raw") \
        .withColumn("silver_processed_time", iso_utc(F.current_timestamp()))


def _beside(wanted: list[str] | None) -> set[str]:
    return DELIVERY | set(TAIL if wanted is None else wanted)


def _silver(checked: DataFrame, fields: list[str], columns: list[Column], wanted: list[str] | None) -> DataFrame:
    """Silver rows of checked rows that are not stored. The order of deliveries needs the raw text,
    which holds every field: it alone goes through the shuffle, not the typed row beside it, and the
    winners are parsed again, for the ``wanted`` columns (all by default)."""
    tail = [c for c in TAIL if c in checked.columns]
    last = deduplicate(checked, columns=["event_id", *tail, "_raw"])
    # the columns beside the Generate stay as they are, and with them the rows' partitioning by event
    kept = [(f, c) for f, c in zip(fields, columns, strict=True) if f != "event_id" and (wanted is None or f in wanted)]
    parsed = last
    if kept:
        again = json_fields(F.col("_raw"), [f for f, _ in kept], None, CORRUPT)
        parsed = last.select("event_id", *tail, F.inline(F.array(F.struct(again.alias("_f")))))
    if wanted is not None:
        return parsed.select("event_id", *[c for _, c in kept], *tail).select(*wanted)
    return parsed.select("event_id", *[c for _, c in kept], *tail, iso_utc(F.current_timestamp()).alias("silver_processed_time"))


def silver_cards(bronze: DataFrame, process_date: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """Valid cards, each one's last delivery, with all Silver columns, or those of ``columns`` for a
    reader that needs no others: the checks are the same."""
    return _silver(check_cards(bronze, process_date, _beside(columns)), CARD_FIELDS, _card_columns(), columns)


def silver_logins(bronze: DataFrame, process_date: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """Valid logins, as ``silver_cards``."""
    return _silver(check_logins(bronze, process_date, _beside(columns)), LOGIN_FIELDS, _login_columns(), columns)


def quarantine(checked: DataFrame, job_name: str, source_bucket: str = rules.BRONZE_BUCKET) -> DataFrame:
    """One quarantine record per rejected row, with its reason and raw text."""
    rows = _behind_barrier(checked, ["process_date", "_source_object_key", "rejection_reason", "_raw"])
    return rows.where(F.col("rejection_reason").isNotNull()).select(
        F.lit(job_name).alias("job_name"),
        F.col("process_date"),
        iso_utc(F.current_timestamp()).alias("failed_at"),
        F.lit(source_bucket).alias("source_bucket"),
        F.col("_source_object_key").alias("source_object_key"),
        F.col("rejection_reason"),
        F.col("_raw").alias("raw_record"),
    )


#: The quarantine prefix that each job writes under.
QUARANTINE_PREFIXES = {rules.JOB_SILVER_CARD: rules.QUARANTINE_CARD_PREFIX,
                       rules.JOB_SILVER_LOGIN: rules.QUARANTINE_LOGIN_PREFIX}


def quarantine_prefix() -> Column:
    """The quarantine prefix of a record's job; the job's own name if it has none."""
    known = F.create_map(*[F.lit(x) for item in QUARANTINE_PREFIXES.items() for x in item])
    return F.coalesce(known[F.col("job_name")], F.col("job_name"))


def quarantine_listing(quarantine_rows: DataFrame, prefix: str | None = None,
                       process_date: str | None = None) -> DataFrame:
    """Quarantine records below a quarantine prefix (the job's) and date: job,
    date, reason and the full source path (F9)."""
    q = quarantine_rows
    if process_date is not None:
        q = q.where(F.col("process_date") == process_date)
    if prefix is not None:
        q = q.where(quarantine_prefix().startswith(prefix))
    return q.select("job_name", "process_date", "rejection_reason",
                    F.concat(F.lit("s3://"), F.col("source_bucket"), F.lit("/"),
                             F.col("source_object_key")).alias("source_path"))


def run_counts(checked: DataFrame) -> DataFrame:
    """Per process date: read, valid, rejected, de-duplicated and duplicate
    counts, in one aggregation over the checked rows."""
    valid = F.col("rejection_reason").isNull()
    agg = _behind_barrier(checked, ["process_date", "event_id", "rejection_reason"]).groupBy("process_date").agg(
        F.count(F.lit(1)).alias("records_read"),
        F.count_if(valid).alias("records_valid"),
        F.count_if(~valid).alias("records_rejected"),
        F.count_distinct(F.when(valid, F.col("event_id"))).alias("records_deduplicated"),
    )
    return agg.withColumn("duplicates", F.col("records_valid") - F.col("records_deduplicated"))
