"""Finding windows of tokens that an earlier document has too, at scale.

``suffix_dedup`` (bytes) and ``fm_dedup`` (words) share this frame; they differ
in what a token is and in how windows are compared in the end.

1. Equal texts become one: the smallest id owns the text, every later copy is
   covered wholly by its own windows. Distinct texts are stored in packs of
   about two megabytes.
2. Every window holds ``window - k + 1`` k-grams. Neighbouring windows with the
   same smallest k-gram hash (their anchor) form a fragment, so equal windows
   have equal anchors and long repeats are mostly cut into equal fragments. A
   pack sends each distinct (anchor, content hash) once, with its smallest id,
   to the anchor's bucket.
3. The bucket answers each entry: removed (the same fragment has a smaller
   owner), or contested (the anchor also occurs in other fragments, so some of
   the windows may occur elsewhere), or neither.
4. Contested fragments travel, with their tokens, to the anchor's shard, where
   an exact method compares every window. Fragments of an anchor with very many
   contents are cut into single windows first, which are dealt by their own
   hash and sent once a pack; so no anchor fills a task.
5. Each pack collects its spans.

Ids order the documents; a null id comes after all others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import boxed, discard, stored

U = np.uint64
LAST = 2**63 - 1
#: Tokens hashed at a time; longer texts are taken in overlapping blocks.
BLOCK = 1 << 20
PACK_BYTES, PACK_TEXTS = 2_000_000, 4096
#: An anchor with more distinct contents is dealt by single windows.
HOT = 2000
REMOVED, CONTESTED, BY_WINDOW = 1, 2, 4


@dataclass(frozen=True)
class Kind:
    """What a token is: ``codes`` gives 64-bit codes of texts (and where each
    text's begin), k the anchor's length, ``wire`` the type that tokens travel as."""

    name: str
    codes: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]]
    wire: str
    k: int
    #: Fragments per byte of text, for the number of buckets.
    density: float
    window: int = 50


class WordHashes(dict):
    """64-bit hashes of words, computed when first asked for; emptied when full."""

    MOST = 600_000

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[list[bytes]], total: int) -> np.ndarray:
        """The hashes of all words, end to end."""
        if len(self) > self.MOST:
            self.clear()
        return np.fromiter(map(self.__getitem__, chain.from_iterable(words)), np.uint64, total)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit hash of two."""
    x = a * U(0x9E3779B97F4A7C15)
    x += b
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(29)
    return x


def grams(codes: np.ndarray, k: int) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """Hashes of 1, 2, 4, ... 32 tokens from each position, and those of ``k``."""
    by = {1: mix(codes, codes ^ U(0x5851F42D4C957F2D))}
    n = 1
    while n < 32:
        h = by[n]
        by[2 * n] = mix(h[:-n], h[n:]) if len(h) > n else h[:0]
        n *= 2
    out, at = None, 0
    for n in (32, 16, 8, 4, 2, 1):
        if k & n:
            part = by[n][at:]
            out = part if out is None else mix(out[: len(part)], part[: len(out)])
            at += n
    return {32: by[32]}, out


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    n = 1
    while 2 * n <= w:
        x, n = np.minimum(x[:-n], x[n:]), 2 * n
    return np.minimum(x[: len(x) - (w - n)], x[w - n :]) if w > n else x


def fragments(codes: np.ndarray, firsts: np.ndarray, sizes: np.ndarray, kind: Kind) -> tuple[np.ndarray, ...]:
    """(text, start, windows, anchor, content) of each fragment of a block of texts;
    starts count from the block's first token, a fragment spans windows + window - 1 tokens."""
    width = kind.window
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U),) * 2
    if len(codes) < width:
        return none
    by, h = grams(codes, kind.k)
    low = sliding_min(h, width - kind.k + 1)
    n = len(codes) - width + 1
    edge = np.zeros(n + 1, np.int32)
    has = sizes >= width
    np.add.at(edge, firsts[has], 1)
    np.add.at(edge, firsts[has] + sizes[has] - width + 1, -1)
    valid = np.cumsum(edge[:n]) > 0
    low = low[:n]
    new = valid.copy()
    new[1:] &= ~(valid[:-1] & (low[1:] == low[:-1]))
    starts = np.flatnonzero(new)
    if not len(starts):
        return none
    # a run ends before the next start or the next window that crosses texts
    gap = np.flatnonzero(~valid)
    stops = np.concatenate((starts[1:], [n]))
    if len(gap):
        at = np.searchsorted(gap, starts)
        stops = np.minimum(stops, np.where(at < len(gap), gap[np.minimum(at, len(gap) - 1)], n))
    runs = stops - starts
    most = width - kind.k + 1
    parts = -(-runs // most)
    if (parts > 1).any():  # one k-gram over and over
        step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        left = np.repeat(runs, parts) - step * most
        starts, runs = np.repeat(starts, parts) + step * most, np.minimum(left, most)
    span = runs + width - 1
    h32 = by[32]
    content = mix(mix(h32[starts], h32[starts + (span - 32) // 2]), mix(h32[starts + span - 32], span.astype(U)))
    anchor = mix(low[starts], low[starts] ^ U(0x2545F4914F6CDD1D))
    return np.searchsorted(firsts, starts, side="right") - 1, starts, runs, anchor, content


def blocks(sizes: np.ndarray, width: int) -> Iterator[tuple[int, int, int, int]]:
    """(first text, last text, from, to): spans of tokens of at most about BLOCK,
    whole texts, or of one long text overlapping by ``width - 1``."""
    ends = np.cumsum(sizes)
    i = 0
    while i < len(sizes):
        base = int(ends[i] - sizes[i])
        if sizes[i] > BLOCK:
            for a in range(0, max(1, int(sizes[i]) - width + 1), BLOCK - width + 1):
                yield i, i + 1, base + a, base + min(int(sizes[i]), a + BLOCK)
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(ends, base + BLOCK, side="right")))
        yield i, j, base, int(ends[j - 1])
        i = j


def all_fragments(texts: list[bytes], kind: Kind) -> tuple[np.ndarray, ...]:
    """(text, start in text, windows, anchor, content), and (tokens, sizes) of the texts."""
    codes, sizes, tokens = kind.codes(texts)
    begins = np.cumsum(sizes) - sizes
    found = []
    for i, j, a, b in blocks(sizes, kind.window):
        firsts = np.maximum(begins[i:j] - a, 0)
        own = np.minimum(begins[i:j] + sizes[i:j], b) - np.maximum(begins[i:j], a)
        t, s, *rest = fragments(codes[a:b], firsts, own, kind)
        found.append((t + i, s + a - begins[t + i], *rest))
    if not found:
        found = [fragments(codes[:0], begins[:0], sizes[:0], kind)]
    return *(np.concatenate(x) for x in zip(*found, strict=True)), tokens, sizes, begins


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    return (((hashes >> U(32)) * U(n)) >> U(32)).astype(np.int64)


# --- 1. distinct texts in packs -------------------------------------------------

def digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def order_key(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))


def squeezed(texts: list[bytes]) -> bytes:
    """Texts as one compressed value: their lengths, then their bytes."""
    sizes = np.array([len(texts), *map(len, texts)], np.int64)
    return zstandard.ZstdCompressor(level=3).compress(sizes.tobytes() + b"".join(texts))


def unsqueezed(value: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(value)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    ends = (8 * (n + 1) + np.cumsum(np.frombuffer(raw, np.int64, n, 8))).tolist()
    return [raw[a:b] for a, b in zip([8 * (n + 1), *ends[:-1]], ends, strict=True)]


def distinct_packs(docs: DataFrame, id_col: str, text_col: str, squeeze: bool = False) -> DataFrame:
    """(pack, digests, ids, texts, copies, size) of the distinct texts, their smallest
    ids, the number of rows that have each, and the bytes of all; ``squeeze`` makes
    the texts one compressed value, for packs that are only passed to Python."""
    rows = docs.select(digest(F.col(text_col)).alias("digest"), order_key(id_col).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    texts = rows.groupBy("digest").agg(F.min("id").alias("id"), F.first("text").alias("text"), F.count("*").alias("copies"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 33, [], 0

        def pack():
            digests, ids, texts, copies = map(list, zip(*held, strict=True))
            kept = pa.array([squeezed(texts)], pa.binary()) if squeeze else pa.array([texts], pa.list_(pa.binary()))
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([digests], pa.list_(pa.binary())), pa.array([ids], pa.list_(pa.int64())),
                 kept, pa.array([copies], pa.list_(pa.int64())), pa.array([size], pa.int64())], ["pack", "digests", "ids", "texts", "copies", "size"])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True):
                    held.append(row)
                    size += len(row[2])
                    if size >= PACK_BYTES or len(held) >= PACK_TEXTS:
                        yield pack()
                        number, held, size = number + 1, [], 0
        if held:
            yield pack()

    kind = "binary" if squeeze else "array<binary>"
    return texts.mapInArrow(run, f"pack long, digests array<binary>, ids array<long>, texts {kind}, copies array<long>, size long")


def each_pack(df: DataFrame, fn: Callable[[dict], Iterable[tuple]], schema: str) -> DataFrame:
    """Rows that ``fn`` makes of each pack with squeezed texts."""
    from pyspark.sql.types import StructType

    full = StructType.fromDDL(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(full)
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                rows = list(fn(row | {"texts": unsqueezed(row["texts"])}))
                if rows:
                    cols = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, full)


# --- 2. and 3. entries and answers ------------------------------------------------

def entries(pack: dict, kind: Kind) -> tuple[np.ndarray, ...]:
    """The fragments in the order of (anchor, content, id), where the distinct
    (anchor, content) begin among them, and the pack's tokens."""
    text, start, runs, anchor, content, tokens, sizes, begins = all_fragments(pack["texts"], kind)
    ids = np.array(pack["ids"], np.int64)[text]
    order = np.lexsort((ids, content, anchor))
    text, start, runs, anchor, content, ids = (x[order] for x in (text, start, runs, anchor, content, ids))
    new = np.ones(len(ids), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])
    return text, start, runs, anchor, content, ids, np.flatnonzero(new), tokens, sizes, begins


def ask(pack: dict, kind: Kind, buckets: int) -> Iterator[tuple]:
    _, _, _, anchor, content, ids, first, *_ = entries(pack, kind)
    anchor, content, ids = anchor[first], content[first], ids[first]
    where = bucket_of(anchor, buckets)
    cuts = np.flatnonzero(np.diff(where)) + 1
    for part in np.split(np.arange(len(where)), cuts):
        if len(part):
            yield int(where[part[0]]), pack["pack"], anchor[part].tobytes() + content[part].tobytes() + ids[part].tobytes()


def answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """For one bucket: a byte of flags for each entry, in the order sent."""
    parts = [np.frombuffer(b, np.int64).reshape(3, -1) for b in pdf["entries"]]
    anchor, content, ids = np.concatenate(parts, axis=1)
    order = np.lexsort((ids, content, anchor))
    a, c, i = anchor[order], content[order], ids[order]
    new_a = np.ones(len(a), bool)
    new_a[1:] = a[1:] != a[:-1]
    new_f = new_a.copy()
    new_f[1:] |= c[1:] != c[:-1]
    f_at, a_at = np.flatnonzero(new_f), np.flatnonzero(new_a)
    owner = i[f_at]  # ids are in order within a fragment
    f_of, a_of = np.cumsum(new_f) - 1, np.cumsum(new_a) - 1
    f_in_a = a_of[f_at]
    contents = np.bincount(f_in_a, minlength=len(a_at))
    at = np.searchsorted(f_in_a, np.arange(len(a_at)))
    mixed = np.minimum.reduceat(owner, at) != np.maximum.reduceat(owner, at)
    flags = np.zeros(len(a), np.uint8)
    flags[i > owner[f_of]] |= REMOVED
    own = (i == owner[f_of]) & mixed[a_of]
    flags[own] |= CONTESTED
    flags[own & (contents[a_of] > HOT)] |= BY_WINDOW
    out = np.empty_like(flags)
    out[order] = flags
    ends = np.cumsum([p.shape[1] for p in parts])
    return pd.DataFrame({"pack": pdf["pack"], "bucket": pdf["bucket"], "flags": [x.tobytes() for x in np.split(out, ends[:-1])]})


# --- 4. contested fragments ---------------------------------------------------------

def spans_blob(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
    return np.stack((text, start, end)).astype(np.int64).tobytes()


def contest(pack: dict, kind: Kind, shards: int) -> Iterator[tuple]:
    """(shard, pack, blob): under shard -1 the spans that are decided, under the
    others the fragments to compare: (id, text, start, tokens) of each."""
    text, start, runs, anchor, content, ids, first, tokens, sizes, begins = entries(pack, kind)
    flags = np.frombuffer(b"".join(x["flags"] for x in pack["answers"]), np.uint8)
    count = np.diff(np.concatenate((first, [len(ids)])))
    flag, least = np.repeat(flags, count), np.repeat(ids[first], count)
    gone = ((flag & REMOVED) > 0) | (ids > least)
    width = kind.window
    yield -1, pack["pack"], spans_blob(text[gone], start[gone], (start + runs + width - 1)[gone])
    own = ((flag & CONTESTED) > 0) & (ids == least)
    sent = np.flatnonzero(own & ((flag & BY_WINDOW) == 0))
    single = np.flatnonzero(own & ((flag & BY_WINDOW) > 0))
    t, s, n, where, i = text[sent], start[sent], runs[sent] + width - 1, bucket_of(anchor[sent], shards), ids[sent]
    if len(single):
        each = np.repeat(single, runs[single])
        at = start[each] + np.arange(len(each)) - np.repeat(np.cumsum(runs[single]) - runs[single], runs[single])
        wt, wi = text[each], ids[each]
        key = window_keys(tokens, begins[wt] + at, width)
        order = np.lexsort((at, wi, key))
        key, wt, wi, at = key[order], wt[order], wi[order], at[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        low = np.repeat(wi[new], np.diff(np.concatenate((np.flatnonzero(new), [len(key)]))))
        later = wi > low
        yield -1, pack["pack"], spans_blob(wt[later], at[later], at[later] + width)
        mine = ~later
        t, s, i = np.concatenate((t, wt[mine])), np.concatenate((s, at[mine])), np.concatenate((i, wi[mine]))
        n = np.concatenate((n, np.full(mine.sum(), width)))
        where = np.concatenate((where, bucket_of(key[mine], shards)))
    order = np.argsort(where, kind="stable")
    t, s, n, i, where = t[order], s[order], n[order], i[order], where[order]
    for part in np.split(np.arange(len(where)), np.flatnonzero(np.diff(where)) + 1):
        if len(part):
            own = np.concatenate([tokens[b : b + m] for b, m in zip((begins[t[part]] + s[part]).tolist(), n[part].tolist(), strict=True)])
            head = np.stack((i[part], t[part], s[part], n[part])).astype(np.int64)
            yield int(where[part[0]]), pack["pack"], np.int64(len(part)).tobytes() + head.tobytes() + own.tobytes()


def window_keys(tokens: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of the window at each place; equal windows have equal hashes."""
    key = np.full(len(at), 0x1234567, U)
    for j in range(width):
        key = mix(key, tokens[at + j].astype(U))
    return key


def settle(method: Callable, wire: str, width: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """For one shard: ``method(ids, tokens, sizes)`` marks the windows (a boolean
    for each place where a window begins) that an entry of a smaller id has too."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        heads, tokens, packs = [], [], []
        for pack, blob in zip(pdf["pack"], pdf["blob"], strict=True):
            n = int(np.frombuffer(blob, np.int64, 1)[0])
            heads.append(np.frombuffer(blob, np.int64, 4 * n, 8).reshape(4, n))
            tokens.append(np.frombuffer(blob, wire, -1, 8 + 32 * n))
            packs.append(np.full(n, pack, np.int64))
        (ids, text, start, sizes), pack = np.concatenate(heads, axis=1), np.concatenate(packs)
        marked = method(ids, np.concatenate(tokens), sizes)
        at = np.flatnonzero(marked)
        begins = np.cumsum(sizes) - sizes
        entry = np.searchsorted(begins, at, side="right") - 1
        where = start[entry] + at - begins[entry]
        order = np.argsort(pack[entry], kind="stable")
        entry, where = entry[order], where[order]
        out = []
        for part in np.split(np.arange(len(entry)), np.flatnonzero(np.diff(pack[entry])) + 1):
            if len(part):
                e = entry[part]
                out.append((int(pack[e[0]]), spans_blob(text[e], where[part], where[part] + width)))
        return pd.DataFrame(out, columns=["pack", "blob"])

    return run


# --- 5. results -----------------------------------------------------------------------

def removed_spans(blobs: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start, end) of the union of spans, in order; ``sizes`` are the texts' lengths."""
    if not blobs:
        return (np.zeros(0, np.int64),) * 3
    text, start, end = np.concatenate([np.frombuffer(b, np.int64).reshape(3, -1) for b in blobs], axis=1)
    base = np.cumsum(sizes + 1) - sizes - 1  # a place between texts keeps their spans apart
    a, b = base[text] + start, base[text] + end
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    if not len(a):
        return (np.zeros(0, np.int64),) * 3
    reach = np.maximum.accumulate(b)
    new = np.ones(len(a), bool)
    new[1:] = a[1:] > reach[:-1]
    first = np.flatnonzero(new)
    a, b = a[first], reach[np.concatenate((first[1:], [len(reach)])) - 1]
    text = np.searchsorted(base, a, side="right") - 1
    return text, a - base[text], b - base[text]


def remove_repeats(docs: DataFrame, kind: Kind, method: Callable, keep: Callable, id_col: str, text_col: str) -> DataFrame:
    """(digest, id, n_tokens, n_removed, n_spans, kept) of each distinct text, for its
    smallest id; ``keep(text, spans)`` is what remains of it."""
    spark = docs.sparkSession
    packs = stored(distinct_packs(docs, id_col, text_col, squeeze=True), "repeats-packs")
    size = packs.agg(F.sum("size")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(size * kind.density / 750_000) + 1)

    asked = each_pack(packs.select("pack", "ids", "texts"), lambda p: ask(p, kind, buckets), "bucket long, pack long, entries binary")
    answers = stored(asked.groupBy("bucket").applyInPandas(answer, "pack long, bucket long, flags binary"), "repeats-answers")
    by_pack = answers.groupBy("pack").agg(F.array_sort(F.collect_list(F.struct("bucket", "flags"))).alias("answers"))
    contested = stored(each_pack(packs.select("pack", "ids", "texts").join(by_pack, "pack"), lambda p: contest(p, kind, buckets), "shard long, pack long, blob binary"), "repeats-contested")
    discard(answers)
    settled = contested.filter("shard >= 0").groupBy("shard").applyInPandas(settle(method, kind.wire, kind.window), "pack long, blob binary")
    spans = contested.filter("shard < 0").select("pack", "blob").unionByName(settled)
    spans = spans.groupBy("pack").agg(F.collect_list("blob").alias("blobs"))

    def finish(pack: dict) -> Iterator[tuple]:
        return keep(pack["digests"], pack["ids"], pack["texts"], pack["blobs"] or [])

    result = each_pack(packs.drop("copies", "size").join(spans, "pack", "left"), finish, "digest binary, id long, n_tokens long, n_removed long, n_spans long, kept binary")
    return result


def for_documents(docs: DataFrame, results: DataFrame, window: int, id_col: str, text_col: str, kept: Column, names: list[str]) -> DataFrame:
    """Each row of ``docs`` (its columns ``names`` as struct ``row``) with the struct
    ``r`` of n_tokens, n_removed, n_spans and ``kept`` (a column of ``results``): the
    owner of a text has its result; of a later copy of a text of at least a window,
    marked by ``copy``, all is removed."""
    found = results.select("digest", F.struct("id", "n_tokens", "n_removed", "n_spans", kept.alias("kept")).alias("r"))
    rows = docs.select(boxed(names), digest(F.col(text_col)).alias("digest"), order_key(id_col).alias("order")).join(found, "digest")
    copy = (F.col("order") > F.col("r.id")) & (F.col("r.n_tokens") >= window)
    n = F.when(copy, F.col("r.n_tokens")).otherwise(F.col("r.n_removed"))
    return rows.select("row", "r", copy.alias("copy"), n.alias("n_removed"))
