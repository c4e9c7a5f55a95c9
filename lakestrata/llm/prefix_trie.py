"""Trie of conversation prefixes by vertical bitmaps.

1. Turns become (digest, length) before any shuffle: SHA-256 of role and text.
2. Conversations are rebuilt from their group's first one and their own turns.
3. Ranges of conversation ids form shards. A shard indexes (position, turn) to a
   bitset of its conversations. From the root on, depth first, a node's bitset is
   intersected with the postings of its members' next turns: each intersection
   is a child, its popcount the child's members, its intersection with the bitset
   of the conversations of that length the child's end list. One row a node and
   shard travels on, however many conversations share the node.
4. The shards' nodes are merged by their path (a SHA-256 chain): rows come sorted
   by path and id, and a node's end lists run through one hash.
5. Nodes with the same smallest member form a chain downwards, which hangs below
   a node of another chain. Sums of subtrees are running sums along chains plus the
   totals of what hangs there; totals of chains are added up by doubling the
   distance looked down, so the rounds grow with the logarithm of the height.

Defined results: a null role or text is empty; turns of equal number are in the order
of their digests; a null turn number is first; repeated rows are turns of their own;
rows without a conversation id belong to no conversation and are left out; of a
conversation of more than ``DEEP`` turns, those beyond are nodes of one member in
the shard and merged like all others; an empty table gives an empty result. Only the
four columns are read, so others cannot clash; texts of any length travel as digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm.common import discard, stored

#: Conversations and turns that fill a shard; turns of a conversation that are indexed.
MEMBERS, TURNS, DEEP = 2048, 65_536, 4096
#: Conversations are rebuilt within groups of so many ids, from less than ``SHARED`` turns of the first.
GROUP, SHARED = 100, 6
ROOT = hashlib.sha256(b"").digest()


def below(key: bytes, turn: bytes) -> bytes:
    return hashlib.sha256(key + turn).digest()


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, chars) of every turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(F.sha2(said.cast("binary"), 256)).alias("digest"), F.length(text).cast("long").alias("chars"))


def base_of(conv_id: Column) -> Column:
    return conv_id - conv_id % GROUP


def placed(conversations: DataFrame) -> DataFrame:
    """(base, conv_id, pos, h, had, digest, chars): every turn with its place, how many turns
    its conversation takes from its group's first one, and how many that one has (``SHARED`` at most)."""
    conv = F.col("conv_id")
    group = Window.partitionBy("base")
    order = Window.partitionBy("base", "conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    own = turns(conversations).withColumn("base", base_of(conv)).repartition("base")
    own = own.withColumn("pos", F.row_number().over(order) - 1).withColumn("h", (F.crc32(conv.cast("string").cast("binary")) % SHARED).cast("int"))
    own = own.withColumn("had", F.sum(F.when((conv == F.col("base")) & (F.col("pos") < SHARED), 1).otherwise(0)).over(group))
    return own.drop("turn")


def rebuilt(own: DataFrame) -> DataFrame:
    """(conv_id, at, digest, chars): the turns of each rebuilt conversation from 0 on,
    and a row with ``at`` -1 for each conversation, turnless ones too."""
    conv = F.col("conv_id")
    kept = own.filter("pos >= h").select("conv_id", (F.least("h", "had") + F.col("pos") - F.col("h")).cast("long").alias("at"), "digest", "chars")
    heads = own.filter("pos = 0").select("conv_id", "base", "h")
    first = own.filter((conv == F.col("base")) & (F.col("pos") < SHARED - 1)).select("base", F.col("pos").cast("long").alias("at"), "digest", "chars")
    taken = heads.join(first, "base").filter("at < h").select("conv_id", "at", "digest", "chars")
    marks = heads.select("conv_id", F.lit(-1).cast("long").alias("at"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("chars"))
    return kept.unionByName(taken).unionByName(marks)


class Shard:
    """Conversations in the order of their ids, with their bitmaps."""

    def __init__(self):
        self.ids, self.paths, self.ended, self.chars, self.size = [], [], {}, {}, 0
        self.postings: list[dict[bytes, int]] = []

    def add(self, conv_id: int, path: list[bytes], ends: bool) -> None:
        bit = 1 << len(self.ids)
        for at, turn in enumerate(path):
            if at == len(self.postings):
                self.postings.append({})
            self.postings[at][turn] = self.postings[at].get(turn, 0) | bit
        if ends:
            self.ended[len(path)] = self.ended.get(len(path), 0) | bit
        self.ids.append(conv_id)
        self.paths.append(path)
        self.size += len(path) + 1

    def members(self, bits: int) -> Iterator[int]:
        while bits:
            low = bits & -bits
            yield low.bit_length() - 1
            bits ^= low

    def nodes(self) -> Iterator[tuple]:
        """(key, parent, depth, conv_id, n_convs, chars, ends) depth first."""
        stack = [(ROOT, None, 0, 0, (1 << len(self.ids)) - 1)] if self.ids else []
        while stack:
            key, parent, depth, chars, bits = stack.pop()
            ended = bits & self.ended.get(depth, 0)
            first = self.ids[(bits & -bits).bit_length() - 1]
            yield key, parent, depth, first, bits.bit_count(), chars, ",".join(str(self.ids[m]) for m in self.members(ended)) if ended else None
            rest = bits & ~ended
            while rest:
                path = self.paths[(rest & -rest).bit_length() - 1]
                if depth == len(path):  # goes on beyond the index
                    rest &= rest - 1
                    continue
                turn = path[depth]
                child = rest & self.postings[depth][turn]
                rest ^= child
                stack.append((below(key, turn), key, depth + 1, self.chars[turn], child))


NODE = "key binary, parent binary, depth long, conv_id long, n_convs long, chars long, ends string"
_ARROW = pa.schema([("key", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()),
                    ("n_convs", pa.int64()), ("chars", pa.int64()), ("ends", pa.string())])


def _batches(rows: Iterable[tuple], schema: pa.Schema, most: int = 8192) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def shard_nodes(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Nodes of the shards of (conv_id, at, digest, chars) rows in the order of conv_id and at."""
    shard = Shard()
    for conv_id, own in groupby(rows, key=lambda r: r[0]):
        path, key, last = [], None, None
        for _, at, turn, chars in own:
            if at < 0:
                continue
            if at < DEEP:
                path.append(turn)
                shard.chars[turn] = chars
                continue
            if key is None:
                key = ROOT
                for t in path:
                    key = below(key, t)
            if last:
                yield *last, None
            last = (below(key, turn), key, at + 1, conv_id, 1, chars)
            key = last[0]
        if last:
            yield *last, str(conv_id)
        shard.add(conv_id, path, last is None)
        if len(shard.ids) >= MEMBERS or shard.size >= TURNS:
            yield from shard.nodes()
            shard = Shard()
    yield from shard.nodes()


def merged(rows: Iterable[tuple]) -> Iterator[tuple]:
    """One row a node of rows in the order of key and conv_id; end lists become their hash."""
    for key, own in groupby(rows, key=lambda r: r[0]):
        first, n, digest, some = None, 0, hashlib.sha256(), False
        for row in own:
            first = first or row
            n += row[4]
            if row[6] is not None:
                digest.update((("," if some else "") + row[6]).encode())
                some = True
        yield *first[:4], n, first[5], digest.hexdigest()


def _map(df: DataFrame, work, schema: str, arrow: pa.Schema) -> DataFrame:
    return df.mapInArrow(lambda batches: _batches(work(_rows(batches)), arrow), schema)


def trie_nodes(conversations: DataFrame) -> DataFrame:
    """(key, parent, depth, conv_id, n_convs, chars, ends_sha256) of every node of the trie."""
    own = stored(placed(conversations), "trie-turns")
    shards = rebuilt(own).repartitionByRange("conv_id").sortWithinPartitions("conv_id", "at")
    local = stored(_map(shards, shard_nodes, NODE, _ARROW), "trie-shards")
    discard(own)
    by_path = local.repartition("key").sortWithinPartitions("key", "conv_id")
    nodes = stored(_map(by_path, merged, NODE.replace("ends", "ends_sha256"), pa.schema([*list(_ARROW)[:-1], ("ends_sha256", pa.string())])), "trie-nodes")
    discard(local)
    return nodes


def chain_totals(nodes: DataFrame) -> DataFrame:
    """(conv_id, parent_conv_id, at, leaves, saved): each chain, the node that it hangs
    below, and the sums of all nodes below its top."""
    chains = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("top"), F.max("depth").alias("end"), F.min_by("parent", "depth").alias("key"),
        F.sum((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    above = nodes.select("key", F.col("conv_id").alias("parent_conv_id"))
    chains = stored(chains.join(above, "key", "left").select("conv_id", "parent_conv_id", (F.col("top") - 1).alias("at"), "end", "saved"), "trie-chains")
    hung = chains.filter("parent_conv_id IS NOT NULL").select(F.col("parent_conv_id").alias("conv_id"), F.col("at").alias("end")).distinct()
    leaves = chains.join(hung.withColumn("hung", F.lit(0).cast("long")), ["conv_id", "end"], "left")
    sums = stored(leaves.select("conv_id", F.col("parent_conv_id").alias("up"), F.coalesce("hung", F.lit(1).cast("long")).alias("leaves"), "saved"), "trie-sums")
    while sums.filter("up IS NOT NULL").limit(1).count():
        more = sums.filter("up IS NOT NULL").groupBy(F.col("up").alias("conv_id")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        farther = sums.filter("up IS NOT NULL").select(F.col("conv_id").alias("up"), F.col("up").alias("next"))
        added = sums.join(more, "conv_id", "left").join(farther, "up", "left")
        zero = F.lit(0).cast("long")
        new = stored(added.select("conv_id", F.col("next").alias("up"), (F.col("leaves") + F.coalesce("l", zero)).alias("leaves"),
                                  (F.col("saved") + F.coalesce("s", zero)).alias("saved")), "trie-sums")
        discard(sums)
        sums = new
    totals = stored(chains.select("conv_id", "parent_conv_id", "at").join(sums.select("conv_id", "leaves", "saved"), "conv_id"), "trie-totals")
    discard(chains, sums)
    return totals


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row for each node of the trie of the rebuilt conversations: conv_id (its
    smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (code points that members after the first share, over the
    subtree) and ends_sha256."""
    nodes = trie_nodes(conversations)
    totals = chain_totals(nodes)
    long = F.lit(0).cast("long")
    hanging = totals.filter("parent_conv_id IS NOT NULL").groupBy(F.col("parent_conv_id").alias("conv_id"), F.col("at").alias("depth")).agg(
        F.count("*").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    tops = totals.select("conv_id", (F.col("at") + 1).alias("depth"), "parent_conv_id")
    own = nodes.select("conv_id", "depth", long.alias("children"), long.alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
                       F.struct("n_convs", "ends_sha256").alias("node"), F.lit(None).cast("struct<parent_conv_id: long>").alias("top"))
    none = F.lit(None).cast(own.schema["node"].dataType)
    rows = own.unionByName(hanging.select("conv_id", "depth", "children", "leaves", "saved", none.alias("node"), F.lit(None).cast("struct<parent_conv_id: long>").alias("top")))
    rows = rows.unionByName(tops.select("conv_id", "depth", long.alias("children"), long.alias("leaves"), long.alias("saved"), none.alias("node"), F.struct("parent_conv_id").alias("top")))
    # along a chain, from its end upwards
    chain = Window.partitionBy("conv_id").orderBy(F.desc("depth"))
    here, so_far = chain.rangeBetween(Window.currentRow, Window.currentRow), chain.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    deeper = F.max(F.when(F.col("node").isNotNull(), F.col("depth"))).over(so_far)
    rows = rows.withColumn("n_children", F.sum("children").over(here) + F.when(deeper > F.col("depth"), 1).otherwise(0))
    rows = rows.withColumn("top", F.max("top").over(here))
    leaf = F.when(F.col("node").isNotNull() & (F.col("n_children") == 0), 1).otherwise(0) + F.col("leaves")
    rows = rows.withColumn("n_leaves", F.sum(leaf).over(so_far)).withColumn("saved_tokens", F.sum("saved").over(so_far))
    return rows.filter(F.col("node").isNotNull()).select(
        "conv_id", "depth", F.when(F.col("top").isNotNull(), F.col("top.parent_conv_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "node.n_convs", F.col("n_children").cast("long").alias("n_children"), F.col("n_leaves").cast("long").alias("n_leaves"), "saved_tokens", "node.ends_sha256")
