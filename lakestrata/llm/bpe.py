"""Byte-level BPE: encoding and decoding of whole texts by a table of ranks.

The pattern cuts a text into pieces; pieces are encoded once and kept in a
bounded cache. Those not yet known are grouped by length into padded matrices
of token ids. Each round merges, in every row, the leftmost pair of lowest
rank (found through a hashed table of pairs) and moves the cells after it one
to the left; rows without a pair left are done and drop out of the matrix.

Defined results: a null text is an empty text, which has no ids; repeated rows
get equal results; an empty table gives an empty result. Pieces longer than
``WIDE`` bytes are merged by a heap over the same pair table (a matrix of one
very long row would take time in the square of its length).
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

WIDE = 256
#: Lengths are bucketed in steps of so many bytes.
STEP = 4
#: Pieces kept by a task; the cache starts anew when it is full.
CACHE = 400_000
NONE = np.int32(2**31 - 1)


class Merges:
    """Pairs of ids that merge, by rank, where the rank is the merged token's id.

    ``of_byte`` has the id of each byte, ``of_last`` that of a piece's last byte."""

    def __init__(self, pairs: dict[int, int], of_byte: np.ndarray, of_last: np.ndarray, whole: dict[bytes, int]):
        self.pairs, self.of_byte, self.of_last, self.whole = pairs, of_byte, of_last, whole
        self._hash_pairs(np.fromiter(pairs, np.uint64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs)))

    def _hash_pairs(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        """Open addressing with linear probing, at most half full."""
        bits = max(4, int(2 * len(keys) + 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, 2**64 - 1, np.uint64)
        self.values = np.full(1 << bits, NONE, np.int32)
        self.probes, left, step = 0, np.arange(len(keys)), 0
        while len(left):
            at = (self._slot(keys[left]) + step) & self.mask
            free = self.keys[at] == 2**64 - 1
            _, first = np.unique(at, return_index=True)
            won = np.zeros(len(left), bool)
            won[first] = True
            won &= free
            self.keys[at[won]], self.values[at[won]] = keys[left[won]], ranks[left[won]]
            left, step = left[~won], step + 1
        self.probes = step

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge; ``NONE`` where there is none."""
        keys = (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)
        at = self._slot(keys)
        out = np.where(self.keys[at] == keys, self.values[at], NONE)
        open_ = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] != 2**64 - 1))
        for _ in range(1, self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & self.mask
            seen = self.keys[at[open_]]
            hit = seen == keys[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (seen != 2**64 - 1)]
        return out

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as the bytes of an int32 array."""
        out: list[bytes] = [b""] * len(pieces)
        by_length: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            rank = self.whole.get(piece)
            if rank is not None:
                out[i] = np.int32(rank).tobytes()
            elif len(piece) == 1:
                out[i] = self.of_last[piece[0]].tobytes()
            elif len(piece) > WIDE:
                out[i] = self._by_heap(piece)
            else:
                by_length.setdefault(-(-len(piece) // STEP) * STEP, []).append(i)
        for width, rows in by_length.items():
            most = max(1, 2_000_000 // width)
            for at in range(0, len(rows), most):
                self._by_matrix(pieces, rows[at : at + most], width, out)
        return out

    def _by_matrix(self, pieces: list[bytes], rows: list[int], width: int, out: list[bytes]) -> None:
        text = b"".join(pieces[i].ljust(width, b"\0") for i in rows)
        ids = self.of_byte[np.frombuffer(text, np.uint8)].reshape(len(rows), width)
        used = np.array([len(pieces[i]) for i in rows])
        ids[np.arange(len(rows)), used - 1] = self.of_last[[pieces[i][-1] for i in rows]]
        which = np.array(rows)
        cells = np.arange(width - 1)
        ranks = self.pair_ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), width - 1)
        ranks[cells[None, :] >= used[:, None] - 1] = NONE
        while len(which):
            row = np.arange(len(which))
            at = ranks.argmin(axis=1)
            low = ranks[row, at]
            done = low == NONE
            if done.any():
                for r in np.flatnonzero(done):
                    out[which[r]] = ids[r, : used[r]].tobytes()
                keep = ~done
                most = int(used[keep].max()) if keep.any() else 0
                ids, ranks, used, which, at, low = ids[keep, :most], ranks[keep, : max(most - 1, 0)], used[keep], which[keep], at[keep], low[keep]
                cells, row = cells[: max(most - 1, 0)], row[: len(which)]
                if not len(which):
                    return
            source = np.minimum(cells[None, :] + (cells[None, :] > at[:, None]), len(cells) - 1)
            ids[row, at] = low
            tail = np.minimum(np.arange(ids.shape[1])[None, :] + (np.arange(ids.shape[1])[None, :] > at[:, None]), ids.shape[1] - 1)
            ids, ranks = np.take_along_axis(ids, tail, 1), np.take_along_axis(ranks, source, 1)
            used = used - 1
            ranks[cells[None, :] >= used[:, None] - 1] = NONE
            r = np.flatnonzero(at < used - 1)
            ranks[r, at[r]] = self.pair_ranks(ids[r, at[r]], ids[r, at[r] + 1])
            r = np.flatnonzero(at > 0)
            ranks[r, at[r] - 1] = self.pair_ranks(ids[r, at[r] - 1], ids[r, at[r]])

    def _by_heap(self, piece: bytes) -> bytes:
        ids = self.of_byte[np.frombuffer(piece, np.uint8)]
        ids[-1] = self.of_last[piece[-1]]
        first = self.pair_ranks(ids[:-1], ids[1:])
        ids, n = ids.tolist(), len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(int(first[i]), i, ids[i], ids[i + 1]) for i in np.flatnonzero(first != NONE).tolist()]
        heapq.heapify(heap)

        def push(i: int) -> None:
            j = after[i]
            rank = self.pairs.get(ids[i] << 32 | ids[j])
            if rank is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                push(i)
            if before[i] >= 0:
                push(before[i])
        return np.array([x for x in ids if x >= 0], np.int32).tobytes()

class Vocabulary(Merges):
    """A file of ranks: its merges, and the tokens' bytes end to end."""

    def __init__(self, path: str):
        self.ranks: dict[bytes, int] = {}
        with open(path, "rb") as lines:
            for line in lines:
                if line.strip():
                    token, rank = line.split()
                    self.ranks[base64.b64decode(token)] = int(rank)
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))[:-1]
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.known = np.zeros(size, bool)
        self.known[list(self.ranks.values())] = True
        of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        super().__init__(pairs, of_byte, of_byte, self.ranks)

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' bytes end to end; an unknown id is an error."""
        ids = np.asarray(ids, np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.flat[np.repeat(self.starts[ids] - ends + sizes, sizes) + np.arange(ends[-1] if len(ids) else 0)].tobytes()


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """Loaded once in each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def splitter(pattern: str):
    """``findall`` of the pattern; white space is Unicode's White_Space."""
    import regex

    return regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")).findall


def bpe_encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>): each row's whole text, every match of ``pattern`` encoded separately."""
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = docs.schema[id_col].dataType
    schema = StructType([StructField(id_col, kind), StructField("ids", ArrayType(IntegerType()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, find, cache = vocabulary(ranks_path), splitter(pattern), {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                pieces = [find(t) for t in part.column(1).to_pylist()]
                new = set().union(*pieces).difference(cache)
                if len(cache) + len(new) > CACHE:
                    cache, new = {}, set().union(*pieces)
                new = list(new)
                cache.update(zip(new, vocab.encode_pieces([p.encode() for p in new]), strict=True))
                ids = [b"".join([cache[p] for p in own]) for own in pieces]
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)])
                flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([part.column(0), lists], [id_col, "ids"])

    return src.mapInArrow(run, schema)


def bpe_decode(ids: Column, ranks_path: str) -> Column:
    """The bytes that a column of id arrays stands for; null ids give null."""

    @F.pandas_udf("binary")
    def decoded(column: pd.Series) -> pd.Series:
        vocab = vocabulary(ranks_path)
        return column.map(lambda x: None if x is None else vocab.decode(x))

    return decoded(ids)
