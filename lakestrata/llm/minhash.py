"""Near-duplicates by improved consistent weighted sampling of TF-IDF shingles.

1. Equal texts become one (``repeats.distinct_packs``).
2. Document frequencies of five-word shingles are counted over all documents, by
   shingle: each pack sends its distinct shingles once to buckets of their hashes,
   which answer with the counts; a text keeps those of its shingles. A shingle
   weighs its count in the text times the logarithm of the share of documents.
3. Each of ``BANDS * ROWS`` samples draws one (shingle, level) of a text, the
   same for two texts with the probability of their weighted Jaccard similarity
   (Ioffe's scheme: gamma and uniform variates belong to the shingle's hash).
   Texts that agree in all samples of a band meet in its bucket.
4. Candidates are verified by the weighted Jaccard similarity of their texts.
   First each text is compared with the smallest member of its buckets, then
   with the smallest of each bucket; every pair of a bucket that is not yet
   known to be in one class is compared in the end. A pair is left out only
   where links already join its two texts, so no link between classes is lost,
   and no bucket is expanded into all its pairs.
5. Classes are the connected components of the links. The first links make a forest, whose
   roots are found by doubling; later ones only join classes, and only those are searched again.

Defined results: a text of fewer than five words is one shingle; a text without
words (null among them) is a near-duplicate only of equal texts; repeated rows
share a class; a null id comes after all others; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm import repeats
from lakestrata.llm.common import boxed, discard, stored, unboxed

WORDS, SIMILARITY = 5, 0.8
#: At a similarity of 0.8, texts share none of the buckets with a probability of 6e-5.
BANDS, ROWS = 32, 6
#: Buckets of more texts are compared in blocks of about ``BLOCK``, not by pairs of rows.
LARGE, BLOCK = 48, 256
_U = np.uint64
#: A shingle's hash has 52 bits; a pack's text number fits above it.
_HASH = 52
#: A draw is sought among the shingles that may have an a of at most this over the text's weight:
#: first the first (all a are beyond it once in e^4 texts), then the second, then all.
LIMITS = (4.0, 10.0)
#: Samples that are drawn at a time.
ABREAST = 16


def _exponential_integral(x: np.ndarray) -> np.ndarray:
    """The integral of e^-t / t from x on: its series up to 1, its continued fraction beyond."""
    low, high = np.minimum(x, 1.0), np.maximum(x, 1.0)
    total, term = -np.euler_gamma - np.log(low), np.ones_like(low)
    for k in range(1, 25):
        term = term * -low / k
        total -= term / k
    below = high + 241
    for k in range(120, 0, -1):
        below = high + 2 * k - 1 - k * k / below
    return np.where(x <= 1, total, np.exp(-high) / below)


class _Curve:
    """A smooth function by straight lines between many points."""

    def __init__(self, xs: np.ndarray, ys: np.ndarray, step: float):
        at = np.arange(xs[0], xs[-1], step)
        self.low, self.per, self.last, self.value = at[0], 1 / step, len(at) - 2, np.interp(at, xs, ys)
        self.slope = np.diff(self.value)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        at = (x - self.low) * self.per
        np.maximum(at, 0, out=at)
        np.minimum(at, self.last, out=at)
        i = at.astype(np.int64)
        at -= i
        at *= self.slope.take(i)
        at += self.value.take(i)
        return at


def _curves() -> tuple[_Curve, _Curve, _Curve, _Curve]:
    """Of x = c e^-r, whose density is E1(x) (the exponential integral): its logarithm by the
    logit of its quantile and the other way round; ln E1 by ln x and the other way round."""
    ln_x = np.arange(-45.0, 4.2, 1 / 1024)
    x = np.exp(ln_x)
    e1 = _exponential_integral(x)
    logit = np.log(x * e1 - np.expm1(-x)) - np.log(np.exp(-x) - x * e1)
    return _Curve(logit, ln_x, 1 / 256), _Curve(ln_x, logit, 1 / 256), _Curve(ln_x, np.log(e1), 1 / 512), _Curve(np.log(e1[::-1]), ln_x[::-1], 1 / 512)


_X_OF_LOGIT, _LOGIT_OF_X, _E1_OF_X, _X_OF_E1 = _curves()


def _sortable(x: np.ndarray) -> np.ndarray:
    """Numbers, as 32 bits, whose order is that of ``x``."""
    bits = x.astype(np.float32).view(np.int32)
    return (bits ^ ((bits >> 31) | np.int32(-(2**31)))).view(np.uint32).astype(np.uint64)


def _draws(quantile: np.ndarray, z: np.ndarray, ln_w: np.ndarray) -> np.ndarray:
    """For 32-bit quantiles of x = c e^-r, other hashes ``z`` of shingle and sample, and
    weights: ln(a) of Ioffe's scheme in sortable bits above a hash of shingle and level t.
    The smallest a of a text is drawn.

    r and c are gamma variates of shape 2. Given x, c is the sum of v, of density e^-v / v
    from x on, and of an exponential variate, and r = ln(c / x); so all variates have the
    distribution of the scheme, but x, of which a is at least x / w, comes first and alone."""
    fine = z * _U(0xA0761D6478BD642F)
    fine ^= fine >> _U(32)
    fine *= _U(0xE7037ED1A0B428DB)
    u = (quantile + ((fine >> _U(48)) + 0.5) / 65536) / 2.0**32
    ln_x = _X_OF_LOGIT(np.log(u / (1 - u)))
    ln_v = _X_OF_E1(np.log(((z >> _U(32)) + 0.5) / 2.0**32) + _E1_OF_X(ln_x))
    ln_c = np.log(np.exp(ln_v) - np.log(((z & _U(0xFFFFFFFF)) + 0.5) / 2.0**32))
    r = np.maximum(ln_c - ln_x, 1e-9)
    beta = (fine & _U(0xFFFFFFFF)) * 2.0**-32
    t = np.floor(ln_w / r + beta)
    level = (t.astype(np.int64).view(np.uint64) * _U(0x9E3779B97F4A7C15)) >> _U(32)
    name = (z * _U(0xD1B54A32D192ED03)) >> _U(32)
    return (_sortable(ln_c - r * (t - beta) - r) << _U(32)) | (name ^ level)


def _places(few: np.ndarray) -> np.ndarray:
    """Where ``few`` is true, which is seldom; its length is a multiple of 8."""
    eights = np.flatnonzero(few.view(np.uint64))
    at = np.flatnonzero(few.reshape(-1, 8)[eights])
    return (eights[at >> 3] << 3) + (at & 7)


def _scattered(h: np.ndarray, odd, spare: np.ndarray | None) -> np.ndarray:
    """32-bit hashes in place of ``h``."""
    h *= odd
    spare = np.right_shift(h, 15, out=spare)
    h ^= spare
    h *= np.uint32(0x2C1B3C6D)
    return h


def _spread(grams: np.ndarray, odd: np.ndarray) -> np.ndarray:
    z = grams * odd
    z ^= z >> _U(32)
    z *= _U(0xD6E8FEB86659FD93)
    z ^= z >> _U(29)
    return z


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, np.uint64) * _U(2) + _U(1)


class WordHashes:
    """64-bit hashes of the words of texts, for all bytes at once: a word's is a
    polynomial of its bytes' random numbers, from running sums over the bytes."""

    CHUNK = 1 << 17

    def __init__(self):
        r = np.random.default_rng(17)
        self.number = r.integers(0, 2**64, 256, np.uint64)
        self.blank = np.zeros(256, bool)
        self.blank[[9, 10, 11, 12, 13, 32]] = True
        self.base = int(r.integers(0, 2**61)) * 8 + 5
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _raise_to(self, n: int) -> None:
        if len(self.powers) < n:
            for name, base in (("powers", self.base), ("inverses", pow(self.base, -1, 2**64))):
                out = np.full(n, base, np.uint64)
                out[0] = 1
                setattr(self, name, np.multiply.accumulate(out))

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all words, end to end; how many words each text has)."""
        flat = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts])
        hashes, starts, at = [], [], 0
        while at < len(flat):
            to = min(at + self.CHUNK, len(flat))
            while not self.blank[flat[to - 1]]:  # a chunk ends behind a blank, as all bytes do
                step = flat[to : to + self.CHUNK]
                to += int(self.blank[step].argmax()) + 1 if self.blank[step].any() else len(step)
            part = flat[at:to]
            self._raise_to(len(part))
            blank = self.blank[part]
            first = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
            if not blank[0]:
                first = np.concatenate(([0], first))
            last = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
            running = self.number[part]
            running *= self.powers[: len(part)]
            np.cumsum(running, out=running)
            value = running[last - 1]
            value[first > 0] -= running[first[first > 0] - 1]
            value *= self.inverses[first]
            hashes.append(repeats.mix(value, (last - first).astype(np.uint64)))
            starts.append(first + at)
            at = to
        start = np.concatenate([np.empty(0, np.int64), *starts])
        sizes = np.diff(np.searchsorted(start, ends), prepend=0)
        return np.concatenate([np.empty(0, np.uint64), *hashes]), sizes


class Shingler:
    """Distinct shingles of up to 4096 texts, as 52-bit hashes, and how often each has them."""

    def __init__(self):
        self.hashes = WordHashes()

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, hash, count) in the order of text and hash."""
        h, sizes = self.hashes.of(texts)
        total, ends = len(h), np.cumsum(sizes)
        left = np.repeat(ends, sizes) - np.arange(total)  # words from here to the end of the text
        grams = h.copy()
        for j in range(1, WORDS):
            shifted = np.zeros(total, np.uint64)
            shifted[: max(total - j, 0)] = h[j:]
            np.copyto(grams, repeats.mix(grams, shifted), where=left > j)
        use = (left >= WORDS) | (left == np.repeat(sizes, sizes))
        keys = (grams[use] >> _U(64 - _HASH)) | (np.repeat(np.arange(len(texts), dtype=np.uint64), sizes)[use] << _U(_HASH))
        keys.sort()
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(first)
        count = np.diff(np.concatenate((first, [len(keys)])))
        keys = keys[first]
        return (keys >> _U(_HASH)).astype(np.int64), keys & _U((1 << _HASH) - 1), count


def packed(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x.astype(np.int64).tobytes())


def unpacked(value: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(value), np.int64)


def ask(pack: dict, buckets: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(bucket, pack, hashes, documents): the distinct shingles of a pack in the
    order of their hashes, and how many of its documents have each."""
    text, grams, _ = Shingler()(pack["texts"])
    distinct, which = np.unique(grams, return_inverse=True)
    docs = np.bincount(which, np.array(pack["copies"], np.float64)[text], len(distinct)).astype(np.int64)
    bucket = repeats.bucket_of(distinct << _U(64 - _HASH), buckets)
    for part in np.split(np.arange(len(distinct)), np.flatnonzero(np.diff(bucket)) + 1):
        if len(part):
            yield int(bucket[part[0]]), pack["pack"], distinct[part].tobytes(), packed(docs[part])


def answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """For one bucket: in how many documents each shingle is, in the order sent."""
    hashes = [np.frombuffer(x, np.uint64) for x in pdf["hashes"]]
    docs = np.concatenate([unpacked(x) for x in pdf["documents"]])
    distinct, which = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(which, docs, len(distinct)).astype(np.int64)[which]
    ends = np.cumsum([len(x) for x in hashes])
    return pd.DataFrame({"pack": pdf["pack"], "bucket": pdf["bucket"], "documents": [packed(x) for x in np.split(total, ends[:-1])]})


def idf(docs: int, frequency: np.ndarray) -> np.ndarray:
    """The usual smoothed form: 1 for a shingle that every document has."""
    return 1 + np.maximum(np.log((1 + docs) / (1 + frequency)), 0)


def band_keys(text: np.ndarray, grams: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts that have shingles, their keys): a row of ``BANDS`` hashes for each.

    a is at least x / w, and x follows from a 32-bit hash as its quantile, so one comparison
    passes over most shingles; the draws are those of all shingles."""
    samples = BANDS * ROWS
    odd, odd_32 = _odd(samples, 11), _odd(2 * samples, 13).astype(np.uint32) | np.uint32(1)
    some, first = np.unique(text, return_index=True)
    if not len(some):
        return some, np.empty((BANDS, 0), np.uint64)
    ends = np.append(first[1:], len(text))
    ln_w = np.log(weights.astype(np.float64))
    ln_total = np.log(np.add.reduceat(weights.astype(np.float64), first))
    # the quantiles up to which a shingle's a may be within a limit, a little more for rounding
    within, enough = [], []
    for limit in LIMITS:
        near = _LOGIT_OF_X(ln_w + np.repeat(np.log(limit) - ln_total, ends - first) + 1e-3)
        within.append((np.minimum(1 / (1 + np.exp(-near)) + 1e-9, 1) * (2.0**32 - 1)).astype(np.uint32))
        enough.append(_sortable(np.log(limit) - ln_total - 1e-4))
    within.append(np.full(len(text), 2**32 - 1, np.uint32))
    enough.append(np.full(len(some), 2**32, np.uint64))
    low = (grams ^ (grams >> _U(29))).astype(np.uint32)
    drawn = np.empty((samples, len(some)), np.uint64)
    # texts are taken so many at a time that the arrays stay in the processor's cache
    cuts = [0]
    for i in range(1, len(some)):
        if first[i] - first[cuts[-1]] > 50_000:
            cuts.append(i)
    cuts.append(len(some))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        lo, hi = first[a], ends[b - 1]
        g, g_32, ln, own, size = grams[lo:hi], low[lo:hi], ln_w[lo:hi], first[a:b] - lo, ends[a:b] - first[a:b]
        mine, near = np.repeat(np.arange(b - a), size), within[0][lo:hi]
        h, x = np.empty_like(g_32), np.empty_like(g_32)
        few = np.zeros(-(-len(h) // 8) * 8, bool)
        for k in range(0, samples, ABREAST):
            n = min(ABREAST, samples - k)
            got = np.full(n * (b - a), 2**64 - 1, np.uint64)

            def least(at: np.ndarray, sample: np.ndarray, quantile: np.ndarray, k=k, got=got, g=g, ln=ln, mine=mine, texts=b - a) -> None:
                """The smallest draws of the places ``at`` for ``sample``, in the order of samples and places."""
                if not len(at):
                    return
                key = sample * texts + mine[at]
                start = np.flatnonzero(np.diff(key, prepend=-1))
                values = _draws(quantile, _spread(g[at], odd[k + sample]), ln[at])
                got[key[start]] = np.minimum.reduceat(values, start)

            places, quantiles = [], []
            for j in range(k, k + n):
                np.bitwise_xor(g_32, odd_32[2 * j], out=h)
                _scattered(h, odd_32[2 * j + 1], x)
                np.less_equal(h, near, out=few[: len(h)])
                places.append(_places(few))
                quantiles.append(h[places[-1]])
            least(np.concatenate(places), np.repeat(np.arange(n), [len(p) for p in places]), np.concatenate(quantiles))
            for tier in range(1, len(within)):
                rest = np.flatnonzero((got >> _U(32)) > np.tile(enough[tier - 1][a:b], n))
                if not len(rest):
                    break
                sample, which = rest // (b - a), rest % (b - a)
                much = size[which]
                begin = np.cumsum(much) - much
                every = np.repeat(own[which] - begin, much) + np.arange(much.sum())
                sample = np.repeat(sample, much)
                again = _scattered(g_32[every] ^ odd_32[2 * (k + sample)], odd_32[2 * (k + sample) + 1], None)
                use = np.flatnonzero(again <= within[tier][lo:hi][every])
                least(every[use], sample[use], again[use])
            drawn[k : k + n, a:b] = got.reshape(n, b - a)
    drawn &= _U(0xFFFFFFFF)
    keys = np.empty((BANDS, len(some)), np.uint64)
    for band in range(BANDS):
        key = np.full(len(some), band + 1, np.uint64)
        for j in range(ROWS):
            key = repeats.mix(key, drawn[band * ROWS + j])
        keys[band] = key
    return some, keys


def weighed(packs: DataFrame) -> tuple[int, DataFrame]:
    """How many documents there are, and (pack, digests, ids, texts, frequencies, nodes,
    keys): of each text the frequencies of its shingles, in the order of their hashes,
    and the buckets of those that have any; a node is a pack's text. Text i of ``nodes``
    has every ``len(nodes)``-th key from i on."""
    size, docs = packs.agg(F.sum("size"), F.sum(F.aggregate("copies", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    shuffled = int(packs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets, docs = max(shuffled, int((size or 0) / 8_000_000) + 1), docs or 0

    def asked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                columns = list(zip(*ask(batch.slice(at, 1).to_pylist()[0], buckets), strict=True))
                if columns:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
                                                     ["bucket", "pack", "hashes", "documents"])

    rows = packs.select("pack", "texts", "copies").mapInArrow(asked, "bucket long, pack long, hashes binary, documents binary")
    answers = stored(rows.groupBy("bucket").applyInPandas(answer, "pack long, bucket long, documents binary"), "near-answers")
    by_pack = answers.groupBy("pack").agg(F.array_sort(F.collect_list(F.struct("bucket", "documents"))).alias("answers"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler()
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                pack = row.to_pylist()[0]
                text, grams, count = shingles(pack["texts"])
                total = np.concatenate([np.empty(0, np.int64), *(unpacked(a["documents"]) for a in pack["answers"] or [])])
                frequency = total[np.unique(grams, return_inverse=True)[1]]
                some, keys = band_keys(text, grams, idf(docs, frequency) * count)
                each = np.split(frequency, np.searchsorted(text, np.arange(1, len(pack["texts"]))))
                yield pa.RecordBatch.from_arrays(
                    [*row.select(names).columns, pa.array([[packed(x) for x in each]], pa.list_(pa.binary())),
                     pa.array([np.int64(pack["pack"]) * repeats.PACK_TEXTS + some], pa.list_(pa.int64())),
                     pa.array([keys.view(np.int64).ravel()], pa.list_(pa.int64()))], [*names, "frequencies", "nodes", "keys"])

    names = ["pack", "digests", "ids", "texts"]
    found = packs.select(*names).join(by_pack, "pack", "left").mapInArrow(
        run, "pack long, digests array<binary>, ids array<long>, texts array<binary>, frequencies array<binary>, nodes array<long>, keys array<long>")
    found = stored(found, "near-weighed")
    discard(answers)
    return docs, found


def buckets(packs: DataFrame) -> DataFrame:
    """(key, node): the buckets of each distinct text."""
    keys = packs.filter("size(nodes) > 0").select("nodes", F.posexplode("keys").alias("at", "key"))
    return keys.select("key", F.element_at("nodes", (F.col("at") % F.size("nodes") + 1).cast("int")).alias("node"))


def texts_of(packs: DataFrame) -> DataFrame:
    """(node, text): each text and the frequencies of its shingles."""
    return packs.select("pack", F.posexplode(F.arrays_zip("texts", "frequencies")).alias("at", "t")).select(
        (F.col("pack") * repeats.PACK_TEXTS + F.col("at")).alias("node"), F.struct(F.col("t.texts").alias("text"), F.col("t.frequencies").alias("frequencies")).alias("text"))


def nodes(packs: DataFrame) -> DataFrame:
    """(node, digest, id) of each distinct text."""
    return packs.select("pack", F.posexplode(F.arrays_zip("digests", "ids")).alias("at", "t")).select(
        (F.col("pack") * repeats.PACK_TEXTS + F.col("at")).alias("node"), F.col("t.digests").alias("digest"), F.col("t.ids").alias("id"))


def verified(pairs: DataFrame, packs: DataFrame, docs: int, least: float) -> DataFrame:
    """The pairs (a, b) whose texts' weighted Jaccard similarity is ``least`` or more."""
    texts = texts_of(packs)
    both = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    both = both.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler()

        def weights(text: dict):
            _, grams, count = shingles([text["text"]])
            w = idf(docs, unpacked(text["frequencies"]))
            return grams, count, w, float((w * count).sum())

        last, one = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                a, b, keep = part.column(0).to_pylist(), part.column(1).to_pylist(), []
                for i in range(len(a)):
                    if a[i] != last:  # the join brings the pairs of one text together
                        last, one = a[i], weights(part.column(2)[i].as_py())
                    grams, count, w, total = weights(part.column(3)[i].as_py())
                    where = np.minimum(np.searchsorted(one[0], grams), max(len(one[0]) - 1, 0))
                    hit = one[0][where] == grams if len(one[0]) else np.zeros(len(grams), bool)
                    shared = float((w[hit] * np.minimum(count[hit], one[1][where[hit]])).sum())
                    keep.append(shared >= least * (total + one[3] - shared) - 1e-9 and shared > 0)
                yield pa.RecordBatch.from_arrays([pa.array([x for x, k in zip(y, keep, strict=True) if k], pa.int64()) for y in (a, b)], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def dealt_in_blocks(rows: DataFrame) -> DataFrame:
    """(key, i, j, block, node, label): the rows, for each two blocks of a bucket that
    are compared and are or hold theirs.

    The texts outside of the bucket's largest class have the first blocks, which are
    compared with all blocks; those of the largest class have the others, which are
    not compared with one another: their texts are joined already."""
    apart = F.ceil((F.col("m") - F.col("held")) / BLOCK).cast("int")
    parts = F.ceil(F.col("held") / BLOCK).cast("int")
    within, hashed = F.col("label") == F.col("main"), F.xxhash64("node")
    dealt = rows.withColumn("block", F.when(within, apart + F.pmod(hashed, parts)).otherwise(F.pmod(hashed, apart)).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(within, apart).otherwise(apart + parts) - 1)))
    return dealt.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "label")


def linked_in_blocks(rows: DataFrame, packs: DataFrame, docs: int, least: float) -> DataFrame:
    """Links (a, b) between texts of different labels in one bucket.

    ``rows`` are (key, m, held, main, node, label): m the bucket's size, ``held`` and
    ``main`` the size and label of its largest class. Each bucket is parted into
    blocks by a hash; two blocks of it are compared in a task of their own, by
    products of matrices of shingles and texts. Of the links between two labels a
    task returns one."""
    texts = texts_of(packs).select("node", "text.*")
    dealt = dealt_in_blocks(rows)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        text, grams, count = Shingler()(pdf["text"].tolist())
        weight = idf(docs, np.concatenate([unpacked(x) for x in pdf["frequencies"]]))
        total = np.bincount(text, weight * count, len(pdf))
        # a shingle that a text has twice counts as two tokens, so shared weights are those of common tokens
        token = np.repeat(grams, count)
        nth = np.arange(len(token)) - np.repeat(np.cumsum(count) - count, count)
        _, token = np.unique(repeats.mix(token, nth.astype(np.uint64)), return_inverse=True)
        text, weight = np.repeat(text, count), np.repeat(weight, count)
        often = np.bincount(token)[token] > 1
        token, text, weight = token[often], text[often], weight[often]
        order = np.argsort(token, kind="stable")
        token, text, weight = token[order], text[order], weight[order]
        _, token = np.unique(token, return_inverse=True)
        shared = np.zeros((len(pdf), len(pdf)))
        step = 4096
        for low in range(0, int(token.max()) + 1 if len(token) else 0, step):
            a, b = np.searchsorted(token, (low, low + step))
            has, w = np.zeros((len(pdf), step)), np.zeros(step)
            has[text[a:b], token[a:b] - low] = 1
            w[token[a:b] - low] = weight[a:b]
            shared += (has * w) @ has.T
        label, block = pdf["label"].to_numpy(), pdf["block"].to_numpy()
        near = (shared >= least * (total[:, None] + total[None, :] - shared) - 1e-9) & (shared > 0)
        near &= label[:, None] != label[None, :]
        if pdf["i"].iloc[0] != pdf["j"].iloc[0]:
            near &= block[:, None] != block[None, :]
        a, b = np.nonzero(np.triu(near))
        ends = np.sort(np.stack((label[a], label[b]), axis=1), axis=1)
        _, one = np.unique(ends, axis=0, return_index=True)
        node = pdf["node"].to_numpy()
        return pd.DataFrame({"a": node[a[one]], "b": node[b[one]]})

    return dealt.join(texts, "node").groupBy("key", "i", "j").applyInPandas(compare, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of the nodes that have links: the smallest node of each component,
    by passing smaller labels along links and then to where a label points."""
    both = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "near-links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")), "near-labels")
    held = labels
    while True:
        seen = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("seen"))
        nearer = labels.join(seen, labels["node"] == seen["a"]).select("node", F.col("label").alias("before"), F.least("label", "seen").alias("label"))
        far = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        new = stored(nearer.join(far, "label", "left").select("node", "before", F.least("label", F.coalesce("beyond", "label")).alias("label")), "near-labels")
        changed = new.filter("label < before").limit(1).count()
        discard(held)
        held, labels = new, new.select("node", "label")
        if not changed:
            discard(both)
            labels.stored_at = new.stored_at
            return labels


def roots(forest: DataFrame) -> DataFrame:
    """(node, label) of all nodes of a forest: each has one link at most, from b to a smaller
    a. The distance that a label looks up doubles each round."""
    inner = forest.select(F.col("b").alias("node"), F.col("a").alias("label"))
    tops = forest.select("a").distinct().join(forest.select("b"), F.col("a") == F.col("b"), "left_anti")
    labels = stored(inner.unionByName(tops.select(F.col("a").alias("node"), F.col("a").alias("label"))), "near-labels")
    while True:
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        new = stored(labels.join(up, "label").select("node", F.col("label").alias("before"), F.col("beyond").alias("label")), "near-labels")
        changed = new.filter("label < before").limit(1).count()
        discard(labels)
        labels = new.select("node", "label")
        labels.stored_at = new.stored_at
        if not changed:
            return labels


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels with more links: components of the classes that these join."""
    def label(side: str) -> DataFrame:
        return labels.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}"))

    ends = links.join(label("a"), "a", "left").join(label("b"), "b", "left")
    ends = ends.select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b")).filter("a <> b").distinct()
    ends = stored(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "near-ends")
    if not ends.limit(1).count():
        discard(ends)
        return labels
    classes_ = components(ends)
    moved = classes_.select(F.col("node").alias("label"), F.col("label").alias("to"))
    new = labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    alone = classes_.join(labels.select("node"), "node", "left_anti").select("node", "label")
    out = stored(new.unionByName(alone), "near-labels")
    discard(labels, ends, classes_)
    return out


def labels_of(packs: DataFrame, docs: int, least: float) -> DataFrame:
    """(node, label) of the texts that have links."""
    keys = buckets(packs)
    shared = keys.groupBy("key").agg(F.min("node").alias("low"), F.count("*").alias("n")).filter("n > 1")
    members = stored(keys.join(shared.select("key", "low"), "key"), "near-members")
    tested = members.filter("node <> low").groupBy(F.col("node").alias("b")).agg(F.min("low").alias("a")).select("a", "b")
    links = stored(verified(tested, packs, docs, least), "near-links")

    def labelled(labels: DataFrame) -> DataFrame:
        return members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))

    # the smallest of every bucket, where it is not in the text's class yet
    labels = roots(links)
    low = labels.select(F.col("node").alias("low"), F.col("label").alias("low_label"))
    star = labelled(labels).filter("node <> low").join(low, "low", "left").filter(F.coalesce("low_label", "low") != F.col("label"))
    star = stored(star.select(F.col("low").alias("a"), F.col("node").alias("b")).distinct().join(tested, ["a", "b"], "left_anti"), "near-pairs")
    more = stored(verified(star, packs, docs, least), "near-links")
    tested = tested.unionByName(star)
    # every other pair of a bucket whose texts are in different classes: one side at
    # least is outside of the bucket's largest class
    labels = joined(labels, more)
    own = stored(labelled(labels), "near-members")
    sizes = own.groupBy("key", "label").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("key").agg(F.max(F.struct("n", "label")).alias("top"), F.count("*").alias("classes"), F.sum("n").alias("m"))
    mixed = own.join(mixed.filter("classes > 1").select("key", F.col("top.label").alias("main"), F.col("top.n").alias("held"), "m"), "key")
    mixed = stored(mixed, "near-mixed")
    discard(own)
    few = mixed.filter((F.col("label") != F.col("main")) & (F.col("m") <= LARGE)).select("key", F.col("node").alias("x"), F.col("label").alias("x_label"))
    cross = mixed.select("key", "node", "label").join(few, "key").filter("label <> x_label")
    cross = cross.select(F.least("node", "x").alias("a"), F.greatest("node", "x").alias("b")).distinct()
    cross = stored(cross.join(tested, ["a", "b"], "left_anti"), "near-pairs")
    pairwise = stored(verified(cross, packs, docs, least), "near-links")
    blockwise = stored(linked_in_blocks(mixed.filter(F.col("m") > LARGE).select("key", "m", "held", "main", "node", "label"), packs, docs, least), "near-links")
    discard(mixed, star, members, cross, links, more)
    labels = joined(labels, pairwise.unionByName(blockwise))
    discard(pairwise, blockwise)
    return labels


def near_duplicates(docs: DataFrame, least: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(digest, class_id, class_digest): the class of each distinct text, named by the
    smallest id in it, and the text that has that id."""
    plain = stored(repeats.distinct_packs(docs, id_col, text_col), "near-packs")
    n, packs = weighed(plain)
    discard(plain)
    own = nodes(packs).join(labels_of(packs, n, least), "node", "left").withColumn("label", F.coalesce("label", "node"))
    own = stored(own, "near-nodes")
    discard(packs)
    named = own.groupBy("label").agg(F.min(F.struct("id", "digest")).alias("least"))
    return own.join(named, "label").select("digest", F.col("least.id").alias("class_id"), F.col("least.digest").alias("class_digest"))


def classes(docs: DataFrame, least: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, class_id) of each row."""
    found = near_duplicates(docs, least, id_col, text_col)
    rows = docs.select(F.col(id_col).alias(id_col), repeats.digest(F.col(text_col)).alias("digest"))
    return rows.join(found, "digest").select(id_col, F.when(F.col("class_id") != repeats.LAST, F.col("class_id")).alias("class_id"))


def keep_one(docs: DataFrame, least: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row of ``docs`` with the smallest id of each class; of equal rows, one."""
    found = near_duplicates(docs, least, id_col, text_col).filter("digest = class_digest").select("digest")
    rows = docs.select(boxed(docs.columns), repeats.digest(F.col(text_col)).alias("digest"), repeats.order_key(id_col).alias("order"))
    # of equal texts the first by id stays; each task drops most copies before they are shuffled
    first = Window.partitionBy("digest").orderBy("order")
    one = rows.withColumn("n", F.row_number().over(first)).filter("n = 1")
    return one.join(found, "digest", "left_semi").select(*unboxed(docs.columns))
