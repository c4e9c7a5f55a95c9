"""Change events as their connector writes them, decoded by the schema of their table.

An event is JSON text: the change itself, or one wrapped as ``payload`` beside a schema. Its ``op``
is r (snapshot), c, u or d; ``before`` and ``after`` hold the row; ``source.lsn``
orders the changes. Values come as the connector encodes them: decimals as text, dates
as days and timestamps as microseconds since 1970, all others as JSON has them.
An event that cannot be decoded keeps its text and the first problem found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.exprs import computed_once

OPS = ("r", "c", "u", "d")


def _texts(row: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in row.fields])


def _event_type(row: T.StructType) -> T.StructType:
    source = T.StructType([T.StructField(n, T.StringType()) for n in ("lsn", "snapshot", "table")])
    own = [T.StructField("before", _texts(row)), T.StructField("after", _texts(row)), T.StructField("source", source),
           T.StructField("op", T.StringType()), T.StructField("ts_ms", T.StringType())]
    return T.StructType([*own, T.StructField("payload", T.StructType(own)), T.StructField("_corrupt", T.StringType())])


def decoded_value(text: Column, kind: T.DataType) -> Column:
    """A field's value from its text; NULL if the text is none of that type."""
    if isinstance(kind, T.DateType):
        return F.date_add(F.lit("1970-01-01").cast("date"), text.try_cast("int"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_micros(text.try_cast("long")).cast(kind)
    return text.try_cast(kind) if not isinstance(kind, T.StringType) else text


def decode_events(events: DataFrame, row: T.StructType, value_col: str = "value") -> DataFrame:
    """(op, before, after, lsn, snapshot, event_ms, problem, value) of each event, beside the columns
    of ``events`` other than these. ``problem`` is NULL for an event that was decoded."""
    own = ("op", "before", "after", "lsn", "snapshot", "event_ms", "problem", "value")
    kept = [c for c in events.columns if c not in own and c != value_col]
    text = F.col(value_col).cast("string")
    parsed = F.from_json(text, _event_type(row), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    # a barrier, so that the text is parsed once for all that is taken from it
    once = computed_once(events, [*[F.col(c) for c in kept], text.alias("value"), parsed.alias("_e")])
    e = F.col("_e")
    flat = F.struct(*[e[n].alias(n) for n in ("before", "after", "source", "op", "ts_ms")])
    # a wrapped change has nothing but its payload and schema
    change = F.when(e["payload"].isNotNull(), e["payload"]).otherwise(flat)
    once = computed_once(once, [*[F.col(c) for c in kept], F.col("value"), e["_corrupt"].alias("_corrupt"), e.isNull().alias("_none"), change.alias("_c")])
    c = F.col("_c")

    def typed(side: str) -> Column:
        fields = [decoded_value(c[side][f.name], f.dataType).alias(f.name) for f in row.fields]
        return F.when(c[side].isNotNull(), F.struct(*fields))

    def bad(side: str) -> list[Column]:
        return [F.when(c[side][f.name].isNotNull() & decoded_value(c[side][f.name], f.dataType).isNull(), F.lit(f"bad value: {side}.{f.name}"))
                for f in row.fields if not isinstance(f.dataType, T.StringType)]

    lsn = c["source"]["lsn"].try_cast("long")
    problem = F.coalesce(
        F.when(F.col("value").isNull() | F.col("_none") | F.col("_corrupt").isNotNull() | ~F.ltrim("value").startswith("{"), F.lit("event must be a JSON object")),
        F.when(~F.coalesce(c["op"].isin(*OPS), F.lit(False)), F.concat(F.lit("unknown op: "), F.coalesce(c["op"], F.lit("none")))),
        F.when(lsn.isNull(), F.lit("missing source.lsn")),
        F.when((c["op"] != "d") & c["after"].isNull(), F.lit("missing after")),
        F.when((c["op"] == "d") & c["before"].isNull(), F.lit("missing before")),
        *bad("after"), *bad("before"))
    return once.select(*[F.col(x) for x in kept], c["op"].alias("op"), typed("before").alias("before"), typed("after").alias("after"), lsn.alias("lsn"),
                       c["source"]["snapshot"].alias("snapshot"), c["ts_ms"].try_cast("long").alias("event_ms"), problem.alias("problem"), "value")


def changes_of(decoded: DataFrame) -> DataFrame:
    """The decoded changes, as ``core.fold_changes`` takes them."""
    return decoded.where(F.col("problem").isNull()).drop("problem", "value")


def quarantined_events(decoded: DataFrame, topic: str) -> DataFrame:
    """The events that could not be decoded, with their problem and whole text."""
    return decoded.where(F.col("problem").isNotNull()).select(
        F.lit(topic).alias("topic"), F.col("problem").alias("rejection_reason"), F.col("value").alias("raw_record"))
