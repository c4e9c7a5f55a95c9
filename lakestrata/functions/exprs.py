"""Column expressions shared by the operators. All are built-in Spark
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


# --- JSON bodies held as VARIANT ----------------------------------------------

def parse_body(raw: Column) -> Column:
    """Parse message text as JSON; NULL when it is not JSON.

    ``try_parse_json`` accepts trailing text after a complete value, which
    Python's ``json.loads`` rejects, so text must also end with a closing
    bracket or a value character after trimming.
    """
    trimmed = F.rtrim(raw)
    return F.when(trimmed.rlike(r'[}\]"0-9el]$'), F.try_parse_json(raw))


def json_shaped(raw: Column) -> Column:
    """Text that starts like a JSON object with a double-quoted key (or is
    empty) and ends with a closing brace."""
    return raw.rlike(r'^\s*\{\s*["}]') & F.rtrim(raw).endswith("}")


def json_keys(raw: Column) -> Column:
    """Keys of a JSON object text (keys with null values included); NULL when
    the text is not a single JSON object. Single-quoted keys and trailing text,
    which Python's json.loads rejects, are rejected too."""
    return F.when(json_shaped(raw), F.json_object_keys(raw))


def json_fields(raw: Column, fields: Iterable[str], types: dict[str, str] | None = None,
                corrupt_column: str | None = None) -> Column:
    """All named fields of a JSON object text in one parse, as text unless a
    type is given (numbers, booleans and nested values keep their JSON text;
    absent keys and JSON nulls both come out NULL; duplicate keys: last wins).

    With ``corrupt_column`` the struct gets that extra field, set to the text
    when it does not parse, and bare NaN/Infinity count as not JSON, as they
    do for the key-list parser (``json_keys``) it stands in for."""
    types = types or {}
    ddl = ", ".join(f"`{f}` {types.get(f, 'string')}" for f in fields)
    opts = {"allowSingleQuotes": "false"}
    if corrupt_column:
        ddl += f", `{corrupt_column}` string"
        opts["columnNameOfCorruptRecord"] = corrupt_column
        opts["allowNonNumericNumbers"] = "false"
    return F.from_json(raw, ddl, opts)


CORRUPT = "_corrupt"


def parse_object(df, raw: Column, raw_out: str, fields: Iterable[str], required: Iterable[str],
                 keep: list[Column], types: dict[str, str] | None = None):
    """Parse a JSON object text column into ``_f`` (all ``fields``, as text unless a type is
    given, plus a corrupt-record field) and ``_keys`` (its key list; NULL when the text is
    not a JSON object), next to the ``keep`` columns, which must carry the raw
    text as ``raw_out``.

    The key list only tells a missing key from a null value and costs a second
    parse, so it is taken only where a required field came out NULL or the
    parse failed; every other body has all required keys and gets an empty
    list, which ``missing_reason`` does not read. Each step sits behind a Generate (``computed_once``) so
    that filters on derived columns do not copy the parse into predicates.
    """
    required = list(required)
    parsed = computed_once(df, [json_fields(raw, fields, types, CORRUPT).alias("_f"), *keep])
    f = F.col("_f")
    needs_keys = f.isNull() | f[CORRUPT].isNotNull()
    for name in required:
        needs_keys = needs_keys | f[name].isNull()
    text = F.col(raw_out)
    keys = F.when(needs_keys, json_keys(text)).when(json_shaped(text), F.array().cast("array<string>"))
    return computed_once(parsed, [keys.alias("_keys"), *[F.col(c) for c in parsed.columns]])


def missing_keys(keys: Column, fields: Iterable[str]) -> Column:
    """Sorted required keys absent from ``keys``."""
    return F.array_sort(F.array_except(F.array(*[F.lit(f) for f in fields]), F.coalesce(
        keys, F.array().cast("array<string>"))))


def missing_reason(keys: Column, fields: list[str], field, prefix: str) -> Column:
    """``prefix`` and the required keys that are absent, or NULL. A key that is absent has
    no value, so the lists are compared only where ``field`` (name -> value) gives a NULL."""
    some_null = reduce(lambda a, b: a | b, [field(f).isNull() for f in fields])
    miss = missing_keys(keys, fields)
    return F.when(some_null, F.when(F.size(miss) > 0, F.concat(F.lit(prefix), py_list(miss))))


def null_or_empty(value: Column) -> Column:
    return value.isNull() | (value == "")


# --- messages -------------------------------------------------------------------

def py_list(arr: Column) -> Column:
    """Render an array of strings the way Python prints a list: ['a', 'b']."""
    quoted = F.transform(arr, lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def first_failure(*reasons: Column) -> Column:
    """First non-NULL reason in check order; NULL means the record is valid."""
    return F.coalesce(*reasons)


# --- exact decimal arithmetic ----------------------------------------------------

def half_even_quotient(num: Column, den: Column) -> Column:
    """Integer nearest to num/den, ties to even. Exact for integral inputs of
    any size that fits decimal(38,0) (no intermediate rounding)."""
    n = num.cast("decimal(38,0)")
    d = den.cast("decimal(38,0)")
    a = F.abs(n)
    r = a % d
    q = ((a - r) / d).cast("decimal(38,0)")
    bump = F.when((r * 2 > d) | ((r * 2 == d) & (q % 2 == 1)), 1).otherwise(0)
    mag = q + bump
    return F.when(n < 0, -mag).otherwise(mag).cast("decimal(38,0)")


def half_even_average(total: Column, count: Column, scale: int = 2, type_name: str = "decimal(18,2)") -> Column:
    """``total / count`` rounded half-even to ``scale`` digits, exactly."""
    factor = 10 ** scale
    units = (total * F.lit(factor)).cast("decimal(38,0)")
    return (half_even_quotient(units, count) / F.lit(factor)).cast(type_name)


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100 rounded half-even to one decimal; 0.0 when whole is 0."""
    tenths = half_even_quotient(part.cast("decimal(38,0)") * 1000, whole)
    return F.when(F.coalesce(whole, F.lit(0)) == 0, F.lit(0).cast("decimal(21,1)")) \
        .otherwise((tenths / 10).cast("decimal(21,1)"))


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text with microseconds and a +00:00 offset (session TZ is UTC)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def iso_to_ts(text: Column) -> Column:
    return F.try_to_timestamp(text)


def thousands(n: Column) -> Column:
    """Integer with thousands separators: 1234567 -> '1,234,567'."""
    return F.format_number(n.cast("decimal(38,0)"), 0)


def money(amount: Column) -> Column:
    """Dollar amount with separators and two digits, half-even: $1,234.50."""
    return F.concat(F.lit("$"), F.format_number(F.bround(amount.cast("decimal(38,2)"), 2), 2))


def alert_id(process_date: Column, severity: Column, rule_id: Column, message: Column) -> Column:
    """First 16 hex digits of SHA-256 of 'date|severity|rule|message'
    (a missing part prints as None)."""
    def txt(c):
        return F.coalesce(c.cast("string"), F.lit("None"))
    raw = F.concat_ws("|", txt(process_date), txt(severity), txt(rule_id), txt(message))
    return F.substring(F.sha2(raw, 256), 1, 16)


# --- plan shaping ------------------------------------------------------------------

def computed_once(df, columns: list[Column]):
    """Evaluate ``columns`` once per row behind a Generate node.

    A filter on a derived column (say, ``rejection_reason IS NULL``) is
    normally pushed below the projection that derives it, which copies the
    whole derivation (JSON parse, dozens of field checks) into the filter.
    Predicates on a generator's output are not pushed below it, so the
    derivation runs once and the filter reads its result.
    """
    from pyspark.sql import functions as _F
    return df.select(_F.inline(_F.array(_F.struct(*columns))))
