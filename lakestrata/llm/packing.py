"""Best-fit packing by a grouping genetic algorithm.

``pieces`` turns texts into token ids and cuts them at the sequence length;
only lengths and a few numbers a piece travel from there on. ``pack`` deals
the pieces into shards of a bounded size. On each shard several islands evolve
groupings of the pieces into sequences: crossover injects whole well-filled
sequences of one parent into the other, drops those that then hold a piece
twice, and best-fits the displaced pieces. Between epochs each island receives
its neighbour's elite. A shard is done as soon as it needs no more sequences
than its tokens fill. The emptiest sequence of a shard and others of few pieces go, with
those of other shards, into the next round, until one shard takes them all.

Defined results: a null text is an empty text, of which the end id alone
remains; repeated rows are packed as rows of their own; an empty table gives
an empty result; only documents longer than a sequence are cut.
"""

from __future__ import annotations

import json
import os
import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from lakestrata.llm.bpe import Merges
from lakestrata.llm.common import stored

#: Chunks whose ids a task keeps; a full cache starts anew.
KNOWN = 1_200_000


def word_merges(path: str) -> Merges | None:
    """The merges of a word vocabulary file; None unless a merge's rank follows
    its token's id and bytes are spelled as byte-level vocabularies spell them."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
    # bytes that are printable characters stand for themselves, the others for 256, 257, ...
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letter = {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in shown)}
    pairs, last = {}, -1
    for merge in model["merges"]:
        a, b = merge.split(" ") if isinstance(merge, str) else merge
        token = vocab[a + b]
        if token <= last:
            return None
        pairs[vocab[a] << 32 | vocab[b]] = last = token
    try:
        of_byte = [vocab[letter[b]] for b in range(256)]
        of_last = [vocab[letter[b] + end] for b in range(256)]
    except KeyError:
        return None
    return Merges(pairs, np.array(of_byte, np.int32), np.array(of_last, np.int32), {})


class WordTokenizer:
    """Ids of whole texts, by white-space-delimited chunks that are encoded once.

    The vocabulary is lower-case and drops white space, and its words never cross
    it, so texts are lower-cased (ASCII letters) and split first; a full stop or
    comma between a letter and white space is a word of its own. A chunk of plain
    Latin-1 letters, digits and punctuation is cut into words as the vocabulary's
    own pattern cuts it, and words are encoded many at a time in matrices; any
    other chunk goes to the tokenizer whole, with its normalisation. A special
    token's literal stands for its id, as in the library; what lies between such
    literals is encoded apart. Other added tokens leave all to the library."""

    PLAIN = re.compile(r"[\x21-\x7E\xA1-\xAC\xAE-\xFF]+\Z")
    STOP = re.compile(rb"(?<=[a-z])[.,](?=[\x20\x09-\x0D])")

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        #: Ids by literal, where literals are found in the text as it is and take no neighbours with them.
        self.special = {t.content.encode(): np.array([i], "<u4").tobytes() for i, t in added.items()}
        self.whole = any(not t.special or t.normalized or t.lstrip or t.rstrip or t.single_word for t in added.values())
        # of literals that begin at one place the library takes the longest
        literals = sorted(self.special, key=lambda x: (-len(x), x))
        self.literal = re.compile(b"(" + b"|".join(map(re.escape, literals)) + b")") if literals else None
        # chunks are lower-cased and hold no literals of the text, so none may be found in them
        self.tokenizer.encode_special_tokens = not self.whole
        self.cut = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+").findall
        self.merges = word_merges(path)
        self.known: dict[bytes, bytes] = {}

    #: Classes of bytes: P punctuation, X what may be a symbol (other than Latin-1
    #: letters), blanks and line feeds as they are, L the others.
    CLASSES = bytes(b if b in b" \n" else ord("X") if b in b"\t\v\f\r\xC2" or b > 0xC3 else ord("P") if 33 <= b < 127 and not chr(b).isalnum() else ord("L")
                    for b in range(256))

    def _spaced(self, text: bytes) -> bytes:
        """The text with full stops and commas that end a word set apart."""
        t = text.lower()
        kinds = t.translate(self.CLASSES)
        if b"X" in kinds or b"PP " in kinds or b"PP\n" in kinds or b"\xC3\x97" in t or b"\xC3\xB7" in t:
            return self.STOP.sub(rb" \g<0>", t)
        return t.replace(b". ", b" . ").replace(b", ", b" , ").replace(b".\n", b" .\n").replace(b",\n", b" ,\n")

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        if self.merges is None:
            return self._encode([w.decode() for w in words])
        return self.merges.encode_pieces(words)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each UTF-8 text as little-endian 32-bit numbers."""
        if self.whole:
            return self._encode([t.decode() for t in texts])
        if self.literal is None:
            return self._encode_plain(texts)
        found = [any(map(t.__contains__, self.special)) for t in texts]
        if not any(found):
            return self._encode_plain(texts)
        cut = [self.literal.split(t) if f else [t] for t, f in zip(texts, found, strict=True)]
        own = self._encode_plain([x for parts in cut for x in parts[::2]])
        out, at = [], 0
        for parts in cut:
            ids = [self.special[x] if i % 2 else b"" for i, x in enumerate(parts)]
            n = (len(parts) + 1) // 2
            ids[::2] = own[at : at + n]
            at += n
            out.append(b"".join(ids))
        return out

    def _encode_plain(self, texts: list[bytes]) -> list[bytes]:
        # text by text, so that its chunks are looked up and joined while they are in the processor's cache
        get, out, waiting, new = self.known.get, [], [], set()
        for text in texts:
            own = self._spaced(text).split()
            got = list(map(get, own))
            if None in got:
                missing, at = [], -1
                for _ in range(got.count(None)):
                    missing.append(at := got.index(None, at + 1))
                chunks = [own[i] for i in missing]
                new.update(chunks)
                waiting.append((len(out), got, missing, chunks))
                out.append(b"")
            else:
                out.append(b"".join(got))
        if new:
            if len(self.known) + len(new) > KNOWN:
                self.known = {}
            self._learn(new)
            for n, got, missing, chunks in waiting:
                for i, chunk in zip(missing, chunks, strict=True):
                    got[i] = self.known[chunk]
                out[n] = b"".join(got)
        return out

    def _learn(self, chunks: set[bytes]) -> None:
        known, words, parts, other = self.known, set(), {}, []
        for chunk in chunks:
            s = chunk.decode()
            if s.isascii() and s.isalpha():
                words.add(chunk)
            elif self.PLAIN.match(s):
                parts[chunk] = own = [w.encode() for w in self.cut(s.lower())]
                words.update(w for w in own if w not in known)
            else:
                other.append(chunk)
        each = list(words)
        known.update(zip(each, self._encode_words(each), strict=True))
        known.update([(c, b"".join([known[w] for w in ws])) for c, ws in parts.items()])
        known.update(zip(other, self._encode([c.decode() for c in other]), strict=True))


_LOADED: dict[str, WordTokenizer] = {}


def pieces(docs: DataFrame, tokenizer_path: str, most: int = 4096, end_id: int = 1, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids): each text's ids and ``end_id``, cut into pieces
    of at most ``most`` ids; ids is their little-endian 32-bit form."""
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = StructType([StructField(id_col, docs.schema[id_col].dataType), StructField("piece", IntegerType()),
                         StructField("start", LongType()), StructField("length", LongType()), StructField("ids", BinaryType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _LOADED:
            _LOADED[tokenizer_path] = WordTokenizer(tokenizer_path)
        tokenizer, last, step = _LOADED[tokenizer_path], np.array([end_id], "<u4").tobytes(), 4 * most
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                row, piece, start, ids = [], [], [], []
                for i, own in enumerate(tokenizer.encode(part.column(1).cast(pa.binary()).to_pylist())):
                    own += last
                    for n, a in enumerate(range(0, len(own), step)):
                        row.append(i)
                        piece.append(n)
                        start.append(a // 4)
                        ids.append(own[a : a + step])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    [id_col, "piece", "start", "length", "ids"])

    return src.mapInArrow(run, schema)


@dataclass(frozen=True)
class Evolution:
    """Sizes of the search; none of them leaves a piece out."""

    shard: int = 8192
    islands: int = 2
    population: int = 6
    generations: int = 10
    #: Beside its emptiest sequence, a shard sends a ``join``-th of its size on to the next round.
    join: int = 64


class Grouping:
    """Pieces in sequences (lists of piece numbers), with best-fit insertion."""

    def __init__(self, lengths: list[int], room: int, bins: list[list[int]] | None = None):
        self.lengths, self.room, self.bins, self.left = lengths, room, [], []
        self.open, self.mask = {}, 0
        for b in bins or []:
            self._close(list(b), room - sum(lengths[i] for i in b))

    def _close(self, members: list[int], left: int) -> None:
        self.bins.append(members)
        self.left.append(left)
        self._offer(len(self.bins) - 1)

    def _offer(self, k: int) -> None:
        if self.left[k]:
            self.open.setdefault(self.left[k], []).append(k)
            self.mask |= 1 << self.left[k]

    def put(self, i: int) -> None:
        """Into the sequence that it leaves the least room in, or a new one."""
        n = self.lengths[i]
        fit = self.mask >> n
        if not fit:
            self._close([i], self.room - n)
            return
        left = n + (fit & -fit).bit_length() - 1
        k = self.open[left].pop()
        if not self.open[left]:
            self.mask &= ~(1 << left)
        self.bins[k].append(i)
        self.left[k] -= n
        self._offer(k)

    def fitness(self) -> tuple[int, float]:
        """Fewer sequences first, then fuller ones."""
        return len(self.bins), -sum(((self.room - x) / self.room) ** 2 for x in self.left)


def crossover(a: Grouping, b: Grouping, rng: random.Random) -> Grouping:
    """``a`` with some of the well-filled sequences of ``b`` injected."""
    ranked = sorted(range(len(b.bins)), key=lambda k: b.left[k])
    top = ranked[: max(1, len(ranked) // 2)]
    injected = [b.bins[k] for k in rng.sample(top, max(1, len(top) // 2))]
    taken = {i for members in injected for i in members}
    kept, displaced = list(injected), []
    for members in a.bins:
        if taken.isdisjoint(members):
            kept.append(members)
        else:
            displaced += [i for i in members if i not in taken]
    child = Grouping(a.lengths, a.room, kept)
    for i in sorted(displaced, key=lambda i: -a.lengths[i]):
        child.put(i)
    return child


def evolve(lengths: list[int], room: int, elites: list[list[list[int]]], seed: int, how: Evolution) -> Grouping:
    """The best grouping found; the search ends where no sequence can be saved."""
    rng, least = random.Random(seed), -(-sum(lengths) // room)
    people = [Grouping(lengths, room, e) for e in elites]
    while len(people) < how.population:
        if people and min(p.fitness() for p in people)[0] <= least:
            break
        noise = 0.0 if not people else 0.05 * len(people)
        one = Grouping(lengths, room)
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i] * (1 + noise * rng.random())):
            one.put(i)
        people.append(one)
    for _ in range(how.generations):
        people.sort(key=Grouping.fitness)
        if len(people) < 2 or len(people[0].bins) <= least:
            break
        a, b = rng.sample(people[: max(2, len(people) // 2)], 2)
        people[-1] = min(people[-1], crossover(a, b, rng), crossover(b, a, rng), key=Grouping.fitness)
    return min(people, key=Grouping.fitness)


def _groups(members: pd.Series) -> list[list[int]]:
    """Piece numbers by sequence; ``members[i]`` is the sequence of piece i."""
    order = np.argsort(members.to_numpy(), kind="stable")
    return [g.tolist() for g in np.split(order, np.flatnonzero(np.diff(members.to_numpy()[order])) + 1) if len(g)]


def _evolve_shards(rows: DataFrame, room: int, how: Evolution, seed: int) -> DataFrame:
    """(uid, length, shard) to (shard, uid, length, bin, on): two epochs on several
    islands. ``on`` marks the emptiest sequence, unless it is full, and the next ones
    as long as all have at most a ``how.join``-th of a shard's pieces."""
    first = rows.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(how.islands - 1))))

    def epoch_one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("uid", ignore_index=True)
        best = evolve(pdf["length"].tolist(), room, [], seed + 1000 * int(pdf["island"][0]) + int(pdf["shard"][0]), how)
        bins = np.empty(len(pdf), np.int64)
        for k, members in enumerate(best.bins):
            bins[members] = k
        return pd.DataFrame({"shard": pdf["shard"], "island": pdf["island"], "uid": pdf["uid"], "length": pdf["length"], "bin": bins})

    elites = first.groupBy("shard", "island").applyInPandas(epoch_one, "shard long, island int, uid long, length long, bin long")
    # each elite goes to its own island and to the next one
    moved = elites.withColumn("to", F.explode(F.array(F.col("island"), (F.col("island") + 1) % how.islands))).distinct()

    def epoch_two(pdf: pd.DataFrame) -> pd.DataFrame:
        own = [g.sort_values("uid", ignore_index=True) for _, g in pdf.groupby("island")]
        lengths = own[0]["length"].tolist()
        best = evolve(lengths, room, [_groups(g["bin"]) for g in own], seed + 7919 + 1000 * int(pdf["to"].iloc[0]) + int(pdf["shard"].iloc[0]), how)
        bins, on, moving = np.empty(len(lengths), np.int64), np.zeros(len(lengths), bool), 0
        for k in sorted(range(len(best.bins)), key=lambda k: -best.left[k]):
            members = best.bins[k]
            bins[members] = k
            if best.left[k] and (not moving or moving + len(members) <= how.shard // how.join):
                on[members] = True
                moving += len(members)
        n, fullness = best.fitness()
        return pd.DataFrame({"shard": own[0]["shard"], "island": pdf["to"].iloc[0], "uid": own[0]["uid"], "length": lengths, "bin": bins, "on": on, "n": n, "fullness": fullness})

    ended = moved.groupBy("shard", "to").applyInPandas(epoch_two, "shard long, island int, uid long, length long, bin long, on boolean, n long, fullness double")
    best = F.min(F.struct("n", "fullness", "island")).over(Window.partitionBy("shard"))
    return ended.withColumn("best", best).filter(F.col("island") == F.col("best.island")).select("shard", "uid", "length", "bin", "on")


def pack(items: DataFrame, room: int = 4096, length_col: str = "length", how: Evolution = Evolution(), seed: int = 42) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``: sequences of at most ``room``
    tokens, gapless from 0. Lengths must be from 1 to ``room``."""
    table = stored(items.withColumn("__uid", F.monotonically_increasing_id()), "packing-pieces")
    full = table.filter(F.col(length_col) >= room).select(F.col("__uid").alias("uid"), (-1 - F.col("__uid")).alias("sequence_id"))
    rest = table.filter(F.col(length_col) < room).select(F.col("__uid").alias("uid"), F.col(length_col).cast("long").alias("length"))
    # the row's number is hashed, so equal rows and neighbours are dealt evenly
    shards = max(1, -(-rest.count() // how.shard))
    rows = rest.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards)))
    placed, level = [full], 0
    while True:
        ended = stored(_evolve_shards(rows, room, how, seed + level), f"packing-round-{level}")
        number = F.lit(level << 58) + F.shiftleft(F.col("shard"), 22) + F.col("bin")
        if shards == 1:
            placed.append(ended.select("uid", number.alias("sequence_id")))
            break
        placed.append(ended.filter("not on").select("uid", number.alias("sequence_id")))
        on = ended.filter("on")
        # as many shards as the pieces fill, but half as many at most: a shard sends no more
        # on than a sequence and a share of its size, so shards stay bounded and rounds end
        arrived, level = on.count(), level + 1
        if not arrived:
            break
        shards = min(-(-arrived // how.shard), -(-shards // 2))
        rows = on.select("uid", "length", F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(shards)).alias("shard"))
    all_ = placed[0]
    for p in placed[1:]:
        all_ = all_.unionByName(p)
    at = Window.partitionBy("sequence_id").orderBy("__uid").rowsBetween(Window.unboundedPreceding, -1)
    out = table.join(all_, table["__uid"] == all_["uid"]).withColumn("offset", F.coalesce(F.sum(length_col).over(at), F.lit(0)).cast("long"))
    return out.drop("__uid", "uid")
