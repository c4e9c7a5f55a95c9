"""Token ids as files of checksummed, independently coded blocks.

``segments`` orders documents by id (a range shuffle, in which equal ids may be
parted by their texts and rows), encodes each text and cuts the stream of ids into segments;
``write`` stores them as files and ``read`` gives the documents back. The id
blocks of a segment are coded by ``context_coder``.

A file is ``MAGIC`` and segments. A segment is the sizes of its two parts and
the CRC-32 of the head (three little-endian 32-bit numbers), the head and the payloads. The head
is zlib-compressed: the numbers of ids, documents, distinct ids and blocks and whether the
first document began before; then document ids (64 bits; a byte each tells the null ones),
their numbers of ids here, the distinct ids in ascending order, their order-0 frequencies, and
the bytes and CRC-32 of each block's payload. Only files that the manifest lists are read: it is
written when all tasks have ended, so a lost task or job leaves nothing that counts.

Defined results: a null text is empty, of which the end id alone remains; a null id
comes last; rows of one id are in the order of their texts' hashes and then of the input;
an empty table gives an empty result; a text longer than a segment goes on in the next.
A special token's literal in a text gets that token's id, as in the library. Only the id
and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from lakestrata.llm import context_coder

MAGIC, MANIFEST = b"TOKMIX3\n", "_manifest.json"
#: Ids of a segment.
SEGMENT = 2048 * context_coder.BLOCK
#: Bytes of the texts that are encoded in one call.
CALL = 8 << 20


class ByteTokenizer:
    """Ids of whole texts by a byte-level vocabulary.

    Where a vocabulary's merges are in the order of their tokens' ids, ``tiktoken``
    gives the same ids from the tokens' ranks, several times faster. Texts of other
    letters than Latin ones (classes of letters differ by the Unicode version of a
    library) or with a special token's literal, and other vocabularies, go to ``tokenizers``.

    Where no white space stands before a blank, a token begins at every blank. Such Latin texts are
    cut there, and each different word of a call is encoded once."""

    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    #: The same where no white space is beside other white space; faster, as nothing is looked ahead for.
    SINGLE = PATTERN.replace(r"\s+(?!\S)|", "")
    FOREIGN = r"[^\x{0}-\x{24f}\x{2010}-\x{2027}\x{20ac}]"
    #: White space of the letters that are not foreign but the blank.
    BREAKS = "\t\n\v\f\r\x85\xa0"
    #: White space before a blank, at which then a token may not begin.
    RUNS = f"[\x20{BREAKS}]\x20"
    #: White space in a word, beside other white space or last.
    WIDE = f"[{BREAKS}](?:[{BREAKS}]|$)"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.literals = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.ranks = self._by_rank(path)

    def _by_rank(self, path: str):
        """The vocabulary as ranks; None where ids do not follow from them."""
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        cut, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and not spec.get("normalizer")
        if not plain or model["type"] != "BPE" or model.get("dropout") or model.get("end_of_word_suffix") or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            return None
        # bytes that are printable characters stand for themselves, the others for 256, 257, ...
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        of_letter = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}
        vocab, last, ranks = model["vocab"], -1, {}
        for letter, b in of_letter.items():
            if letter not in vocab:
                return None
            ranks[bytes([b])] = vocab[letter]
        for merge in model["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            if vocab[a + b] <= last:
                return None
            last = vocab[a + b]
            ranks[bytes(of_letter[x] for x in a + b)] = last
        #: The bytes of each id.
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        self.sizes[list(ranks.values())] = list(map(len, ranks))
        self.single = tiktoken.Encoding(path, pat_str=self.SINGLE, mergeable_ranks=ranks, special_tokens={})
        return tiktoken.Encoding(path, pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _ranked(self, text: str) -> np.ndarray:
        return self.ranks.encode_to_numpy(text, disallowed_special=()).astype("<u4")

    def _joined(self, words: pa.Array, ranks) -> tuple[np.ndarray, np.ndarray]:
        """(ids, the number of each word's ids) of words behind blanks, encoded at once."""
        if not len(words):
            return np.empty(0, "<u4"), np.empty(0, np.int64)
        joined = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), words, pa.scalar("\x20", pa.large_string()))
        last = np.cumsum(pc.binary_length(joined).to_numpy(), dtype=np.int64)
        ids = ranks.encode_to_numpy(joined.buffers()[2].to_pybytes()[: last[-1]].decode(), disallowed_special=()).astype("<u4")
        return ids, np.diff(np.searchsorted(np.cumsum(self.sizes[ids]), last) + 1, prepend=0)

    def _by_word(self, texts: pa.Array) -> list[bytes]:
        """The ids of texts that are cut at blanks; equal words are encoded once."""
        if not len(texts):
            return []
        cut = pc.split_pattern(texts, "\x20")
        ends = cut.offsets.to_numpy().astype(np.int64)
        words = cut.flatten().dictionary_encode()
        which, words = words.indices.to_numpy().astype(np.int64), words.dictionary
        # a blank and a letter begin a token wherever they stand, so such words can be encoded at once
        apart = pc.is_in(pc.utf8_slice_codeunits(words, 0, 1), value_set=pa.array(["", *self.BREAKS], pa.large_string()))
        wide = pc.and_not(pc.match_substring_regex(words, self.WIDE), apart)
        plain = pc.invert(pc.or_(apart, wide))
        # no blank is before the first word of a text
        first = pc.list_element(cut, 0).to_pylist()
        own = [self._ranked(x) for x in [*[f"\x20{word}" for word in words.filter(apart).to_pylist()], *first]]
        which[ends[:-1]] = len(words) + np.arange(len(texts))
        found = [self._joined(words.filter(plain), self.single), self._joined(words.filter(wide), self.ranks),
                 (np.concatenate(own), np.array(list(map(len, own))))]
        ids, count = (np.concatenate(x) for x in zip(*found, strict=True))
        place = np.concatenate([np.flatnonzero(x) for x in (plain, wide, apart)] + [len(words) + np.arange(len(texts))])
        begin = np.empty_like(count)
        begin[place] = np.cumsum(count) - count
        count[place] = count.copy()
        out = []
        for a, b in pairwise([*range(0, len(texts), 256), len(texts)]):
            some = which[ends[a] : ends[b]]
            n = count[some]
            to = np.cumsum(n)
            got = ids[np.repeat(begin[some] - to + n, n) + np.arange(to[-1])].tobytes()
            out += [got[x:y] for x, y in pairwise((4 * np.append(0, to)[ends[a : b + 1] - ends[a]]).tolist())]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        column = pa.array(texts, pa.large_string())
        foreign, runs = (pc.match_substring_regex(column, x).to_pylist() for x in (self.FOREIGN, self.RUNS))
        fast = [self.ranks is not None and not f and not any(x in t for x in self.literals) for t, f in zip(texts, foreign, strict=True)]
        other = iter([np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast([t for t, f in zip(texts, fast, strict=True) if not f], add_special_tokens=False)])
        cut = [f and not r for f, r in zip(fast, runs, strict=True)]
        words = iter(self._by_word(column.filter(pa.array(cut, pa.bool_()))))
        del column
        pa.default_memory_pool().release_unused()  # the coder comes next, and idle workers keep what they hold
        return [next(words) if c else self._ranked(t).tobytes() if f else next(other) for t, f, c in zip(texts, fast, cut, strict=True)]


_LOADED: dict[str, ByteTokenizer] = {}


def packed(first_goes_on: bool, docs: list[tuple[int | None, np.ndarray]]) -> list[bytes]:
    """Documents (id, ids) as segments; one, unless there are more distinct ids than 16 bits tell."""
    ids = np.concatenate([x for _, x in docs])
    counts = np.bincount(ids)
    alphabet = np.flatnonzero(counts)
    ranks = np.zeros(int(alphabet[-1]) + 1, np.uint16)
    if len(alphabet) > 65_534:
        half, before, cut = len(ids) // 2, 0, 0
        while before + len(docs[cut][1]) <= half:
            before += len(docs[cut][1])
            cut += 1
        number, own = docs[cut]
        left = [*docs[:cut], (number, own[: half - before])] if half > before else docs[:cut]
        return packed(first_goes_on, left) + packed(half > before, [(number, own[half - before :]), *docs[cut + 1 :]])
    ranks[alphabet] = np.arange(len(alphabet))
    ranks, n_ids = ranks[ids], len(ids)
    del ids  # the coder needs the room
    lengths = np.full(-(-n_ids // context_coder.BLOCK), context_coder.BLOCK)
    lengths[-1] = n_ids - context_coder.BLOCK * (len(lengths) - 1)
    payloads, abreast, often = [], context_coder.LANES, context_coder.frequencies(counts[alphabet])
    for a in range(0, len(lengths), abreast):
        own = lengths[a : a + abreast]
        grid = np.zeros((len(own), int(own[0])), np.uint16)
        flat = ranks[a * context_coder.BLOCK : a * context_coder.BLOCK + int(own.sum())]
        grid.ravel()[: len(flat)] = flat
        payloads += context_coder.encode(np.ascontiguousarray(grid.T), own, len(alphabet), often)
    head = zlib.compress(b"".join((
        struct.pack("<5q", n_ids, len(docs), len(alphabet), len(payloads), first_goes_on),
        np.array([d is None for d, _ in docs], np.uint8).tobytes(), np.array([d or 0 for d, _ in docs], "<i8").tobytes(),
        np.array([len(x) for _, x in docs], "<i8").tobytes(), alphabet.astype("<u4").tobytes(), often.tobytes(),
        np.array([len(p) for p in payloads], "<u4").tobytes(), np.array([zlib.crc32(p) for p in payloads], "<u4").tobytes())))
    return [struct.pack("<3I", len(head), sum(map(len, payloads)), zlib.crc32(head)) + head + b"".join(payloads)]


def unpacked(head: bytes, crc: int, body: bytes) -> tuple[bool, list[int | None], np.ndarray, np.ndarray]:
    """(whether the first document began before, document ids, their numbers of ids, ids)."""
    if zlib.crc32(head) != crc:
        raise ValueError("the head of a segment is damaged")
    raw, at = zlib.decompress(head), 40
    n_ids, n_docs, n_alphabet, n_blocks, goes_on = struct.unpack_from("<5q", raw)

    def field(kind: str, n: int) -> np.ndarray:
        nonlocal at
        got = np.frombuffer(raw, kind, n, at)
        at += got.nbytes
        return got

    null, docs, sizes = field("u1", n_docs), field("<i8", n_docs), field("<i8", n_docs)
    alphabet, often, bytes_, crcs = (field("<u4", n) for n in (n_alphabet, n_alphabet, n_blocks, n_blocks))
    ends = np.cumsum(bytes_, dtype=np.int64)
    payloads = [body[e - n : e] for e, n in zip(ends.tolist(), bytes_.tolist(), strict=True)]
    if any(zlib.crc32(p) != c for p, c in zip(payloads, crcs.tolist(), strict=True)):
        raise ValueError("a block is damaged")
    ids, abreast, block = np.empty(n_ids, "<u4"), context_coder.LANES, context_coder.BLOCK
    for a in range(0, n_blocks, abreast):
        own = np.minimum(block, n_ids - block * np.arange(a, min(a + abreast, n_blocks)))
        grid = context_coder.decode(payloads[a : a + abreast], own, n_alphabet, often)
        ids[a * block : a * block + own.sum()] = alphabet[np.ascontiguousarray(grid.T).ravel()[: own.sum()]]
    return bool(goes_on), [None if x else d for x, d in zip(null.tolist(), docs.tolist(), strict=True)], sizes, ids


def cut(documents: Iterable[tuple[int | None, np.ndarray]], most: int) -> Iterator[tuple[bool, list[tuple[int | None, np.ndarray]]]]:
    """(whether the first document began before, documents) of up to ``most`` ids."""
    held, size, goes_on = [], 0, False
    for number, ids in documents:
        at = 0
        while len(ids) - at > most - size:
            if most > size:
                held.append((number, ids[at : at + most - size]))
            at += most - size
            yield goes_on, held
            held, size, goes_on = [], 0, at > 0
        held.append((number, ids[at:]))
        size += len(ids) - at
    if held:
        yield goes_on, held


def segments(docs: DataFrame, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(docs, ids, segment): segments in the order of the ids, with the numbers of documents that begin in them and of ids."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    src = src.withColumn("hash", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = [F.col("id").asc_nulls_last(), F.col("hash"), F.col("row")]
    src = src.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _LOADED:
            _LOADED[tokenizer_path] = ByteTokenizer(tokenizer_path)
        tokenizer, last = _LOADED[tokenizer_path], np.array([end_id], "<u4").tobytes()

        def encoded() -> Iterator[tuple[int | None, np.ndarray]]:
            for batch in batches:
                calls = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(), dtype=np.int64) // CALL
                for at, to in pairwise([*np.flatnonzero(np.diff(calls, prepend=-1)).tolist(), batch.num_rows]):
                    part = batch.slice(at, to - at)
                    for number, own in zip(part.column(0).to_pylist(), tokenizer.encode(part.column(1).to_pylist()), strict=True):
                        yield number, np.frombuffer(own + last, "<u4")

        for goes_on, some in cut(encoded(), SEGMENT):
            for n, segment in enumerate(packed(goes_on, some)):
                new = (len(some) - goes_on) if n == 0 else 0
                yield pa.RecordBatch.from_arrays([pa.array([new]), pa.array([sum(len(x) for _, x in some) if n == 0 else 0]), pa.array([segment], pa.binary())],
                                                 ["docs", "ids", "segment"])

    return src.mapInArrow(run, "docs long, ids long, segment binary")


def _store(path: str):
    """(file system, folder) of a path or address."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path).replace("s3a://", "s3://"))


class Written(WriterCommitMessage):
    def __init__(self, part: int, name: str, docs: int, ids: int):
        self.part, self.name, self.docs, self.ids = part, name, docs, ids


class TokenWriter(DataSourceWriter):
    """A file a task; the manifest lists them in the order of the partitions."""

    def __init__(self, path: str):
        self.path = path

    def write(self, rows: Iterator) -> Written:
        store, folder = _store(self.path)
        part = TaskContext.get().partitionId()
        name, docs, ids, out = f"part-{part:06d}-{uuid.uuid4().hex}.tokens", 0, 0, None
        try:
            for row in rows:
                if out is None:
                    store.create_dir(folder)
                    out = store.open_output_stream(f"{folder}/{name}")
                    out.write(MAGIC)
                out.write(bytes(row["segment"]))
                docs, ids = docs + row["docs"], ids + row["ids"]
        finally:
            if out is not None:
                out.close()
        return Written(part, name if out is not None else "", docs, ids)

    def commit(self, messages: list) -> None:
        files, start = [], 0
        for m in sorted((m for m in messages if m is not None and m.name), key=lambda m: m.part):
            files.append({"name": m.name, "docs": m.docs, "ids": m.ids, "start": start})
            start += m.ids
        store, folder = _store(self.path)
        store.create_dir(folder)
        with store.open_output_stream(f"{folder}/{MANIFEST}.new") as out:
            out.write(json.dumps({"files": files, "ids": start}).encode())
        store.move(f"{folder}/{MANIFEST}.new", f"{folder}/{MANIFEST}")

    def abort(self, messages: list) -> None:
        store, folder = _store(self.path)
        for m in messages:
            if m is not None and m.name:
                store.delete_file(f"{folder}/{m.name}")


class TokenFile(InputPartition):
    def __init__(self, name: str, start: int):
        self.name, self.start = name, start


class TokenReader(DataSourceReader):
    """A partition a file; damage to a head or a block is an error."""

    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[TokenFile]:
        store, folder = _store(self.path)
        with store.open_input_stream(f"{folder}/{MANIFEST}") as manifest:
            files = json.loads(manifest.read())["files"]
        return [TokenFile(f["name"], f["start"]) for f in files] or [TokenFile("", 0)]

    def read(self, partition: TokenFile) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        store, folder = _store(self.path)
        with store.open_input_stream(f"{folder}/{partition.name}") as stream:
            if stream.read(len(MAGIC)) != MAGIC:
                raise ValueError(f"{partition.name} is no token file")
            start, open_doc = partition.start, None
            while sizes := stream.read(12):
                n_head, n_body, crc = struct.unpack("<3I", sizes)
                goes_on, docs, lengths, ids = unpacked(stream.read(n_head), crc, stream.read(n_body))
                parts = [x.tobytes() for x in np.split(ids, np.cumsum(lengths)[:-1])]
                if open_doc is not None:
                    if goes_on:
                        docs[0], parts[0] = open_doc[0], open_doc[1] + parts[0]
                    else:
                        docs.insert(0, open_doc[0])
                        parts.insert(0, open_doc[1])
                open_doc = (docs.pop(), parts.pop())  # the next segment may go on with it
                for at in range(0, len(docs), 1024):
                    batch = _batch(docs[at : at + 1024], start, parts[at : at + 1024])
                    start += pc.sum(batch.column(2)).as_py()
                    yield batch
            if open_doc is not None:
                yield _batch([open_doc[0]], start, [open_doc[1]])


def _batch(docs: list, start: int, parts: list[bytes]) -> pa.RecordBatch:
    sizes = np.array([len(p) // 4 for p in parts], np.int64)
    return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(start + np.cumsum(sizes) - sizes), pa.array(sizes), pa.array(parts, pa.binary())],
                                      ["doc_id", "start", "n_tokens", "ids"])


class TokenFiles(DataSource):
    """Token files of a folder as (doc_id, start, n_tokens, ids): ids are little-endian 32-bit numbers."""

    @classmethod
    def name(cls) -> str:
        return "token_files"

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, ids binary"

    def reader(self, schema) -> TokenReader:
        return TokenReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> TokenWriter:
        return TokenWriter(self.options["path"])


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """The texts' ids, each followed by ``end_id``, as token files in a new folder."""
    docs.sparkSession.dataSource.register(TokenFiles)
    segments(docs, tokenizer_path, end_id, id_col, text_col).write.format("token_files").mode("append").save(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the documents of a folder; start counts the ids before."""
    spark.dataSource.register(TokenFiles)
    return spark.read.format("token_files").load(path)
