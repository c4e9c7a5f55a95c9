"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.session import checkpoint_dir, released_shuffles

#: White space that separates words: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"[\x20\x09-\x0D]"


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, once an application: they need
    not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = os.path.realpath(tempfile.mkdtemp(prefix="lakestrata-code-"))
    path = os.path.join(folder, "lakestrata-code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for base, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(base, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def vocabulary_path(name: str) -> str:
    """Where the installed vocabulary files have ``name``."""
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: lineage ends there, and a lost executor costs no recomputation of
    what lies before."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with released_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing will read again: what was made of them
    is stored itself."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def boxed(names: list[str]) -> Column:
    """Columns as one struct ``row``, so that their names cannot clash with others."""
    return F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]).alias("row")


def unboxed(names: list[str], **instead: Column) -> list[Column]:
    """The columns of ``row`` under their names; ``instead`` replaces some."""
    return [instead.get(c, F.col(f"row.c{i}")).alias(c) for i, c in enumerate(names)]


def rowwise(df: DataFrame, make: Callable[[], Callable[[str], tuple]], schema: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``make()(text)`` for each row's text (null as an empty text), next to the row's id.

    ``make`` is called once a task; ``schema`` names the columns of the tuples
    that its function returns. Only the id and the text are read, so other
    columns of ``df`` cannot clash."""
    from pyspark.sql.types import StructType

    src = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = StructType.fromDDL(schema)
    names = [f.name for f in out.fields]
    full = StructType([*df.select(F.col(id_col).alias(id_col)).schema.fields, *out.fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(full)
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = [work(t) for t in part.column(1).to_pylist()]
                cols = [pa.array(c, type=arrow.field(n).type) for n, c in zip(names, zip(*rows, strict=True), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(arrow.field(0).type), *cols], schema=arrow)

    return src.mapInArrow(run, full)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def span_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def sha_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def base_spans(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
