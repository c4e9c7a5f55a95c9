import random
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import packing
from tests.llm.cases import awkward, clashing, frame

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_library(library):
    own, r = packing.WordTokenizer(PATH), random.Random(2)
    chars = [chr(c) for c in range(0x250)] + ["İ", "\x1c", "\x85", " ", "́", "̧", "中", "😀", "Σ", "ﬁ", "K"]
    for _ in range(1500):
        text = "".join(r.choice(chars if r.random() < 0.4 else "abc the  \n'sdll12ΣÀé") for _ in range(r.randrange(50)))
        assert own.encode([text.encode()])[0] == np.array(library(text), "<u4").tobytes(), text


def test_special_tokens_are_those_of_the_unmodified_library():
    plain, own, r = tokenizers.Tokenizer.from_file(PATH), packing.WordTokenizer(PATH), random.Random(5)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "|>", "<|", "The end", " ", ".", "\n", "don't", "é", "e\u0301", "\u0301", "中", "12", ", "]
    texts = ["the end <|endoftext|> of it", "<|endoftext|>", "", *("".join(r.choice(parts) for _ in range(r.randrange(12))) for _ in range(3000))]
    for text, got in zip(texts, own.encode([t.encode() for t in texts]), strict=True):
        assert got == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text
    assert np.frombuffer(own.encode([texts[0].encode()])[0], "<u4").tolist() == [518, 806, 49407, 539, 585]


def check(spark_rows, room):
    by = {}
    for r in spark_rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= room
    return len(by)


def test_pieces_and_sequences(spark, library):
    rows = awkward()
    cut = packing.pieces(clashing(frame(spark, rows)), PATH)
    got = packing.pack(cut.withColumn("crc", F.crc32("ids"))).collect()
    want = []
    for i, t in rows:
        ids = library(t or "") + [1]
        want += [(i, n, a, len(ids[a:a + 4096]), zlib.crc32(np.array(ids[a:a + 4096], "<u4").tobytes())) for n, a in enumerate(range(0, len(ids), 4096))]
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["crc"]) for r in got), key=str) == sorted(want, key=str)
    assert check(got, 4096) == -(-sum(w[3] for w in want) // 4096)
    assert packing.pack(packing.pieces(frame(spark, []), PATH)).collect() == []


def test_many_shards_lose_nothing(spark):
    r = random.Random(8)
    lengths = [r.choice([r.randrange(1, 30), r.randrange(30, 101), 67, 34]) for _ in range(3000)]
    df = spark.createDataFrame([(n,) for n in lengths], "length long").withColumn("uid", F.lit(1))
    how = packing.Evolution(shard=200, join=8)
    got = packing.pack(df.drop("uid"), 100, how=how).collect()
    assert sorted(x["length"] for x in got) == sorted(lengths)
    whole = packing.Grouping(lengths, 100)  # best fit of all pieces at once, the longest first
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        whole.put(i)
    assert check(got, 100) <= 1.02 * len(whole.bins)


@pytest.mark.parametrize("most, shard, room", [(5, 1024, 512), (20, 1024, 512), (20, 256, 1000)])
def test_short_documents_leave_one_sequence_unfilled(spark, most, shard, room):
    r = random.Random(most)
    lengths = [r.randrange(1, most + 1) for _ in range(12_000)]
    df = spark.createDataFrame([(n,) for n in lengths], "length long")
    got = packing.pack(df, room, how=packing.Evolution(shard=shard)).collect()
    assert sorted(x["length"] for x in got) == sorted(lengths)
    assert check(got, room) == -(-sum(lengths) // room)


def test_crossover_keeps_each_piece_once():
    r = random.Random(3)
    lengths = [r.randrange(1, 60) for _ in range(200)]
    people = []
    for _ in range(2):
        g = packing.Grouping(lengths, 100)
        for i in r.sample(range(200), 200):
            g.put(i)
        people.append(g)
    child = packing.crossover(*people, r)
    assert sorted(i for b in child.bins for i in b) == list(range(200))
    assert all(sum(lengths[i] for i in b) == 100 - left >= 0 for b, left in zip(child.bins, child.left, strict=True))


def test_known_texts_are_joined_one_at_a_time(monkeypatch):
    own, plain = packing.WordTokenizer(PATH), tokenizers.Tokenizer.from_file(PATH)
    texts = [" ".join(f"w{random.Random(i).choice('abc')}{j % 50}." for j in range(2000)).encode() for i in range(40)]
    want = own.encode(texts)
    tracemalloc.start()
    assert own.encode(texts) == want
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * sum(map(len, want))  # the words of all texts at once would take several times that
    monkeypatch.setattr(packing, "KNOWN", 10)  # a cache that overflows at every turn gives the same
    for some in (texts[:3], texts[2:5], [b"", b"one new<x> word", texts[0]]):
        ids = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch([t.decode() for t in some], add_special_tokens=False)]
        assert own.encode(some) == ids
