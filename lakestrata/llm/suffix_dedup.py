"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Suffixes are ordered only through ``window`` bytes, by passes from the most
significant digit on. The first pass, over the cluster, deals them by the hash
of an anchor that all equal windows share, whole fragments at a time
(``repeats``). Within a shard each pass orders the suffixes of every group by
their next eight bytes and splits the groups there; suffixes alone in their
group, and groups of one document, drop out. The groups that remain after the
last pass are exactly the windows that several documents have.

Defined results: a null text is an empty text; rows with equal id and text get
equal results; a null id comes after all others; an empty table gives an empty
result; texts are used whole, in blocks if very long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm import repeats
from lakestrata.llm.common import unboxed

WINDOW = 50
_CODES = np.random.default_rng(20240131).integers(0, 2**64, 256, np.uint64)


def byte_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    tokens = np.frombuffer(b"".join(texts), np.uint8)
    return _CODES[tokens], np.array([len(t) for t in texts], np.int64), tokens


BYTES = repeats.Kind("bytes", byte_codes, "u1", k=20, density=0.0625, window=WINDOW)


def repeated_windows(ids: np.ndarray, tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A boolean for each byte: a window begins there that an entry of a smaller id has too."""
    begins = np.cumsum(sizes) - sizes
    n = sizes - WINDOW + 1
    at = np.repeat(begins, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    owner = np.repeat(ids, n)
    padded = np.concatenate((tokens, np.zeros(8, np.uint8))).astype(np.uint64)
    digit = np.zeros(len(tokens), np.uint64)
    for j in range(8):
        digit = (digit << np.uint64(8)) | padded[j : j + len(tokens)]
    group = np.zeros(len(at), np.int64)
    marked = np.zeros(len(tokens), bool)
    for depth in range(0, WINDOW, 8):
        if not len(at):
            return marked
        key = digit[at + depth] >> np.uint64(8 * max(0, depth + 8 - WINDOW))
        order = np.lexsort((owner, key, group))
        at, owner, group, key = at[order], owner[order], group[order], key[order]
        new = np.ones(len(at), bool)
        new[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        first = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        last = np.concatenate((first[1:], [len(at)])) - 1
        several = owner[first] != owner[last]  # owners are in order within a group
        keep = several[group]
        at, owner, group = at[keep], owner[keep], group[keep]
    if len(at):
        new = np.ones(len(at), bool)
        new[1:] = group[1:] != group[:-1]
        least = owner[np.flatnonzero(new)][np.cumsum(new) - 1]
        marked[at[owner > least]] = True
    return marked


def kept_bytes(digests: list, ids: list, texts: list[bytes], blobs: list[bytes]) -> Iterator[tuple]:
    sizes = np.array([len(t) for t in texts], np.int64)
    text, start, end = repeats.removed_spans(blobs, sizes)
    at = np.searchsorted(text, np.arange(len(texts) + 1))
    start, end = start.tolist(), end.tolist()
    for i, t in enumerate(texts):
        pieces, done, gone = [], 0, 0
        for j in range(at[i], at[i + 1]):
            pieces.append(t[done : start[j]])
            done = end[j]
            gone += end[j] - start[j]
        yield digests[i], ids[i], len(t), gone, int(at[i + 1] - at[i]), b"".join(pieces) + t[done:]


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept): what is left of each row's text, as bytes."""
    return _results(docs, id_col, text_col, "kept", lambda kept: kept)


def dedup_bytes_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``dedup_bytes``, with the SHA-256 of what is left (only that travels)."""
    return _results(docs, id_col, text_col, "kept_sha256", lambda kept: F.sha2(kept, 256))


def _results(docs: DataFrame, id_col: str, text_col: str, name: str, form: Callable[[Column], Column]) -> DataFrame:
    found = repeats.remove_repeats(docs, BYTES, repeated_windows, kept_bytes, id_col, text_col)
    rows = repeats.for_documents(docs, found, WINDOW, id_col, text_col, form(F.col("kept")), [id_col])
    return rows.select(*unboxed([id_col]), F.col("r.n_tokens").alias("n_bytes"), "n_removed",
                       F.when(F.col("copy"), F.lit(1).cast("long")).otherwise(F.col("r.n_spans")).alias("n_spans"),
                       F.when(F.col("copy"), form(F.lit("").cast("binary"))).otherwise(F.col("r.kept")).alias(name))
