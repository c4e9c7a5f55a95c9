"""Removal of repeated passages of words by a compressed FM-index per shard.

``repeats`` deals fragments of the documents to shards so that equal windows
meet in one. Each shard indexes its fragments: the suffix array of the word
numbers, the Burrows-Wheeler transform in a wavelet matrix of packed bits, and
per place the interval of suffixes that share ``window - 1`` words. The
fragments are then streamed against the index, all in step: backward search
matches a fragment's last window word by word; from there on each further word
to the left takes one search step, as the match at the threshold is shortened
by one word on the right first (its interval is known) and extended by one on
the left. That gives the matching statistics cut off at the threshold; a place
is reported where the match reaches it and a suffix of the interval belongs to
a smaller document.

Defined results: a null text is an empty text; rows with equal id and text get
equal results; a null id comes after all others; an empty table gives an empty
result; texts are used whole, in blocks if very long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm import repeats
from lakestrata.llm.common import unboxed

WINDOW = 50
_HASHES = repeats.WordHashes()


def word_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words; ``bytes.split`` splits at the six ASCII blanks."""
    words = [t.split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    codes = _HASHES.of(words, int(sizes.sum()))
    return codes, sizes, codes


WORDS = repeats.Kind("words", word_codes, "u8", k=8, density=0.009, window=WINDOW)


class WaveletMatrix:
    """Symbols by bits from the highest: rank of any symbol before any place."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            packed = np.zeros(-(-(len(bit) + 1) // 64) * 64, np.uint8)
            packed[: len(bit)] = bit
            words = np.packbits(packed, bitorder="little").view(np.uint64)
            ones = np.zeros(len(words) + 1, np.uint32)
            np.cumsum(np.bitwise_count(words), out=ones[1:])
            self.levels.append((level, words, ones, int(len(bit) - bit.sum())))
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where the symbol's block of the last level has the symbols before ``place``."""
        place = place.astype(np.int64)
        for level, words, ones, zeros in self.levels:
            word = place >> 6
            below = words[word] & ((np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1))
            rank1 = ones[word] + np.bitwise_count(below)
            place = np.where((symbol >> level) & 1, zeros + rank1, place - rank1).astype(np.int64)
        return place


class FMIndex:
    """Backward search over texts of word numbers from 1 on; 0 ends each text."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        n = len(text)
        ends = text == 0
        rank = np.where(ends, np.cumsum(ends) - 1, text + int(ends.sum())).astype(np.int64)  # no two ends are equal
        classes, h = {1: rank}, 1
        while True:
            shifted = np.zeros(n, np.int64)
            shifted[:-h] = rank[h:] + 1
            key = rank * (n + symbols + 2) + shifted
            order = np.argsort(key, kind="stable")
            new = np.ones(n, bool)
            new[1:] = key[order][1:] != key[order][:-1]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new) - 1
            h *= 2
            classes[h] = rank
            if new.all() or h >= n:
                break
        self.suffixes = order
        # suffixes that share depth - 1 words stand together: compare blocks of powers of two
        same, at = np.ones(n, bool), 0
        same[0] = False
        for p in sorted(classes, reverse=True):
            while at + p <= depth - 1:
                c = np.full(n, -1, np.int64)
                c[: n - at] = classes[p][at:]
                c = c[order]
                same[1:] &= (c[1:] == c[:-1]) & (c[1:] >= 0)
                at += p
        start = np.flatnonzero(~same)
        which = np.cumsum(~same) - 1
        self.low, self.high = start[which], np.concatenate((start[1:], [n]))[which]
        last = text[order - 1]  # the first suffix's is the last end
        self.bits = max(1, int(symbols).bit_length())
        self.matrix = WaveletMatrix(last, self.bits)
        self.first = np.searchsorted(text[order], np.arange(symbols + 2))
        every = np.arange(symbols + 1)
        self.base = self.matrix.rank(every, np.zeros(symbols + 1, np.int64))

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of matches extended by ``symbol`` on the left."""
        shift = self.first[symbol] - self.base[symbol]
        return shift + self.matrix.rank(symbol, low), shift + self.matrix.rank(symbol, high)


def repeated_windows(ids: np.ndarray, tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A boolean for each word: a window begins there that an entry of a smaller id has too."""
    names, numbers = np.unique(tokens, return_inverse=True)
    begins = np.cumsum(sizes) - sizes
    place = np.arange(len(tokens)) + np.repeat(np.arange(len(sizes)), sizes)  # one end for each entry before
    text = np.zeros(len(tokens) + len(sizes), np.int64)
    text[place] = numbers.ravel() + 1
    index = FMIndex(text, len(names), WINDOW)
    owner = np.empty(len(text), np.int64)
    owner[place] = np.repeat(ids, sizes)
    owner[place[begins + sizes - 1] + 1] = ids
    owner = owner[index.suffixes]

    marked = np.zeros(len(tokens), bool)
    active = np.argsort(-sizes, kind="stable")  # the longest first, so that those at work are a prefix
    at = place[begins[active]] + sizes[active] - 1
    symbol = text[at]
    low, high = index.first[symbol], index.first[symbol + 1]
    for _ in range(WINDOW - 1):
        at = at - 1
        low, high = index.step(text[at], low, high)
    found_at, found_low, found_high = [], [], []
    origin, entry, left = place[begins[active]], active, sizes[active] - WINDOW
    while True:
        several = high - low > 1
        found_at.append((begins[entry] + at - origin)[several])
        found_low.append(low[several])
        found_high.append(high[several])
        on = left > 0
        at, low, origin, entry, left = at[on] - 1, low[on], origin[on], entry[on], left[on] - 1
        if not len(at):
            break
        low, high = index.step(text[at], index.low[low], index.high[low])
    where, low, high = (np.concatenate(x) for x in (found_at, found_low, found_high))
    if len(where):
        spots, which = np.unique(low, return_inverse=True)
        top = np.empty(len(spots), np.int64)
        top[which] = high
        # intervals of one depth are apart, so least owners follow from one reduction
        cuts = np.stack((spots, top), axis=1).ravel()
        padded = np.concatenate((owner, [repeats.LAST]))
        least = np.minimum.reduceat(padded, cuts)[::2]
        own = np.repeat(ids, sizes)[where]
        marked[where[own > least[which]]] = True
    return marked


def kept_words(digests: list, ids: list, texts: list[bytes], blobs: list[bytes]) -> Iterator[tuple]:
    words = [t.split() for t in texts]
    text, start, end = repeats.removed_spans(blobs, np.array([len(w) for w in words], np.int64))
    at = np.searchsorted(text, np.arange(len(texts) + 1))
    start, end = start.tolist(), end.tolist()
    for i, own in enumerate(words):
        kept, done, gone = [], 0, 0
        for j in range(at[i], at[i + 1]):
            kept += own[done : start[j]]
            done = end[j]
            gone += end[j] - start[j]
        yield digests[i], ids[i], len(own), gone, int(at[i + 1] - at[i]), b" ".join(kept + own[done:])


def dedup_words_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of each row; kept words joined by one blank."""
    found = repeats.remove_repeats(docs, WORDS, repeated_windows, kept_words, id_col, text_col)
    rows = repeats.for_documents(docs, found, WINDOW, id_col, text_col, F.sha2("kept", 256), [id_col])
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return rows.select(*unboxed([id_col]), F.col("r.n_tokens").alias("n_words"), "n_removed",
                       F.when(F.col("copy"), nothing).otherwise(F.col("r.kept")).alias("kept_sha256"))


def dedup_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated passages removed from the text: the words that are
    kept, joined by one blank, where any are removed; other texts, nulls among
    them, stay as they are."""
    found = repeats.remove_repeats(docs, WORDS, repeated_windows, kept_words, id_col, text_col)
    rows = repeats.for_documents(docs, found, WINDOW, id_col, text_col, F.when(F.col("n_removed") > 0, F.col("kept")), docs.columns)
    before = F.col(f"row.c{docs.columns.index(text_col)}")
    text = F.when(F.col("copy"), F.lit("")).otherwise(F.coalesce(F.decode(F.col("r.kept"), "UTF-8"), before))
    return rows.select(*unboxed(docs.columns, **{text_col: text}))
