"""Atomic replacement of one date's partition.

A new version of a partition is written below ``_staged`` (which readers of the
table pass over). Its commit is a small file below ``_commits`` that names it and appears
by a rename: before that the old partition is what readers get, from then on the new one.
Only then the folders are swapped; a swap that a lost driver left half done is finished
by the next reader or writer. Readers that list the table's folder without
``current_folder`` may find the partition missing while folders are swapped.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Files:
    """The few file operations needed, on whatever store the path names."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._jvm = spark._jvm

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        return [f.getPath().getName() for f in self._fs.listStatus(self._path(path))] if self.exists(path) else []

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def rename(self, old: str, new: str) -> None:
        self._fs.mkdirs(self._path(new).getParent())
        if not self._fs.rename(self._path(old), self._path(new)):
            raise OSError(f"{old} could not be renamed to {new}")

    def write_text(self, path: str, text: str) -> None:
        out = self._fs.create(self._path(path), True)
        out.write(bytearray(text.encode()))
        out.close()

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


@dataclass
class Staged:
    """A written version that is not committed: its table, partition, name and number of rows."""

    path: str
    partition: str
    version: str
    rows: int
    observed: dict

    @property
    def folder(self) -> str:
        return f"{self.path}/_staged/{self.partition}/{self.version}"


def stage(df: DataFrame, path: str, partition: str, **counters) -> Staged:
    """Write ``df`` as a version of ``partition`` without effect on readers. The number of rows and
    further ``counters`` (aggregates) are observed while the rows are written."""
    seen = Observation()
    staged = Staged(path, partition, uuid.uuid4().hex, 0, {})
    aggregates = [F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counters.items()]]
    df.observe(seen, *aggregates).write.parquet(staged.folder)
    got = seen.get
    staged.rows, staged.observed = int(got.get("rows") or 0), got
    return staged


def _commit_file(path: str, partition: str) -> str:
    return f"{path}/_commits/{partition}"


def finish(spark: SparkSession, path: str, partition: str) -> None:
    """Swap the folders of a committed version, if there is one left; may be repeated."""
    files, commit = Files(spark, path), _commit_file(path, partition)
    if not files.exists(commit):
        return
    staged, target = f"{path}/_staged/{partition}/{files.read_text(commit)}", f"{path}/{partition}"
    if files.exists(staged):
        files.delete(target)
        files.rename(staged, target)
    files.delete(commit)


def commit(spark: SparkSession, staged: Staged) -> None:
    """Make a staged version the partition; versions that were never committed are deleted."""
    files, name = Files(spark, staged.path), _commit_file(staged.path, staged.partition)
    if not files.exists(f"{staged.folder}/_SUCCESS"):
        raise ValueError(f"{staged.folder} is not complete")
    finish(spark, staged.path, staged.partition)
    files.write_text(f"{staged.path}/_commits/_new-{staged.version}", staged.version)
    files.rename(f"{staged.path}/_commits/_new-{staged.version}", name)
    finish(spark, staged.path, staged.partition)
    files.delete(f"{staged.path}/_staged/{staged.partition}")


def discard(spark: SparkSession, staged: Staged) -> None:
    Files(spark, staged.path).delete(staged.folder)


def current_folder(spark: SparkSession, path: str, partition: str) -> str | None:
    """Where the partition's committed rows are; None if it was never written."""
    files, name = Files(spark, path), _commit_file(path, partition)
    if files.exists(name):
        staged = f"{path}/_staged/{partition}/{files.read_text(name)}"
        if files.exists(staged):
            return staged
    folder = f"{path}/{partition}"
    return folder if files.exists(folder) else None
