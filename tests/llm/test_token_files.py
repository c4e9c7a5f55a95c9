import glob
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakestrata.llm import context_coder, queries, token_files
from lakestrata.llm.common import vocabulary_path
from tests.conftest import SF_SMALL
from tests.llm.cases import awkward, clashing, frame, prose

PATH = vocabulary_path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text):
    return np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


@pytest.mark.parametrize("seed", range(6))
def test_blocks_round_trip(seed):
    r = np.random.default_rng(seed)
    size = [1, 2, 300, 5000, 60_000, 65_534][seed]
    lengths = np.sort(r.integers(1, 700, 40))[::-1]
    ids = (size * r.random((lengths[0], 40)) ** 4).astype(np.uint16)
    ids[:, 3] = 0  # one id all the time: long carries and wide chances
    ids[:, 4] = size - 1
    ids[:, 5] = np.arange(lengths[0]) % min(size, 7)
    payloads = context_coder.encode(ids, lengths, size)
    got = context_coder.decode(payloads, lengths, size)
    for lane, n in enumerate(lengths):
        assert (got[:n, lane] == ids[:n, lane]).all()
    # a block does not depend on those beside it
    alone = context_coder.encode(ids[:, 7:8], lengths[7:8], size)
    assert alone == payloads[7:8]
    assert len(payloads[5]) < lengths[5] / 2 or size < 3


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=600))
def test_any_ids_round_trip(ids):
    column = np.array(ids, np.uint16)[:, None]
    payloads = context_coder.encode(column, np.array([len(ids)]), 41)
    assert context_coder.decode(payloads, np.array([len(ids)]), 41)[:, 0].tolist() == ids


def test_wide_alphabets_and_segments():
    r = np.random.default_rng(1)
    docs = [(1, np.arange(70_000, dtype="<u4")), (None, r.integers(0, 2**31, 90_000).astype("<u4")), (3, np.array([5], "<u4"))]
    got: dict = {}
    for goes_on, some in token_files.cut(iter(docs), 50_000):
        for segment in token_files.packed(goes_on, some):
            n_head, n_body, crc = np.frombuffer(segment, "<u4", 3).tolist()
            _, numbers, sizes, ids = token_files.unpacked(segment[12 : 12 + n_head], crc, segment[12 + n_head :])
            assert 12 + n_head + n_body == len(segment)
            for number, part in zip(numbers, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
                got[number] = np.concatenate((got.get(number, part[:0]), part))
    assert all((got[number] == ids).all() for number, ids in docs)


def test_tokenizer_equals_library():
    r = random.Random(2)
    letters = "ab Z9 .,'\n\té \u0085あЖ̀’\x1c  's 'll"
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(40))) for _ in range(500)]
    texts += ["a  b", " a", "a ", "a <|endoftext|>b", "tail \n", "x²½ǅ", "", prose(1, 300), "\U0001f600 ok", "ｆｕｌｌ"]
    got = token_files.ByteTokenizer(PATH).encode(texts)
    for text, own in zip(texts, got, strict=True):
        assert np.frombuffer(own, "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids, repr(text)


def expected(rows):
    out, start = [], 0
    for number, text in rows:
        ids = library_ids(text)
        out.append((number, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def order(spark, rows):
    hashes = [r[0] for r in spark.createDataFrame([(t or "",) for _, t in rows], "t string").selectExpr("xxhash64(t)").collect()]
    return [rows[i] for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, hashes[i]))]


def test_files_round_trip(spark, tmp_root):
    rows = awkward()
    random.Random(3).shuffle(rows)
    rows += [(50, "before <|endoftext|> after"), (-3, "negative"), (60, "あい mixed " + prose(9, 30))]
    token_files.write(clashing(frame(spark, rows)).repartition(3), f"{tmp_root}/a", PATH)
    got = token_files.read(spark, f"{tmp_root}/a").collect()
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(bytes(r["ids"]))) for r in got if r["doc_id"] is not None) + [
        (None, r["start"], r["n_tokens"], zlib.crc32(bytes(r["ids"]))) for r in got if r["doc_id"] is None]
    assert sorted(got, key=lambda r: r[1]) == expected(order(spark, rows))


def test_empty_table(spark, tmp_root):
    token_files.write(frame(spark, []), f"{tmp_root}/a", PATH)
    assert token_files.read(spark, f"{tmp_root}/a").collect() == []


def test_damage_is_found(spark, tmp_root):
    token_files.write(frame(spark, [(1, prose(1, 5000))]), f"{tmp_root}/a", PATH)
    path = glob.glob(f"{tmp_root}/a/*.tokens")[0]
    data = bytearray(open(path, "rb").read())
    for place in (len(data) - 40, 40):
        bad = data.copy()
        bad[place] ^= 1
        open(path, "wb").write(bad)
        with pytest.raises(Exception, match="damaged"):
            token_files.read(spark, f"{tmp_root}/a").collect()


def test_unlisted_files_do_not_count(spark, tmp_root):
    """A lost task's file stays without effect; without a manifest there is nothing to read."""
    token_files.write(frame(spark, [(1, "one two")]), f"{tmp_root}/a", PATH)
    open(f"{tmp_root}/a/part-000009-lost.tokens", "wb").write(b"half a file")
    assert token_files.read(spark, f"{tmp_root}/a").count() == 1
    with pytest.raises(Exception, match="manifest"):
        token_files.read(spark, f"{tmp_root}/b").collect()


def test_query_on_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = sorted(map(tuple, queries.op12_token_output(spark, SF_SMALL).collect()))
    assert got == expected([tuple(r) for r in docs])


def test_equal_words_are_encoded_once():
    tokenizer, given = token_files.ByteTokenizer(PATH), []
    plain = tokenizer.ranks

    class Counting:
        def encode_to_numpy(self, text, **options):
            given.append(len(text))
            return plain.encode_to_numpy(text, **options)

    tokenizer.ranks = Counting()
    texts = [prose(n % 3, 400) for n in range(60)]
    got = tokenizer.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert sum(given) < sum(map(len, texts)) / 4


def test_white_space_between_words():
    r = random.Random(7)
    letters = "ab Z9 .,'\n\té \u0085 \r\v\f\x1c\xa0   's 'll \u201c\u20ac"
    tokenizer = token_files.ByteTokenizer(PATH)
    for _ in range(60):
        texts = ["".join(r.choice(letters) for _ in range(r.randrange(14))) for _ in range(r.randrange(300))]
        got = [np.frombuffer(x, "<u4").tolist() for x in tokenizer.encode(texts)]
        assert got == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("size", [1, 2, 7, 4000, 65_534])
def test_frequencies_reach_every_id(size):
    counts = np.maximum((1e7 / np.arange(1, size + 1) ** 1.5).astype(np.int64), 1)
    for given in (counts, np.zeros(size, np.int64), counts[::-1]):
        often = context_coder.frequencies(given)
        total = int(often.sum())
        assert often.min() >= 1 and total & (total - 1) == 0 and total <= 1 << context_coder.TOTAL_BITS


def test_order_0_is_given_to_all_blocks():
    """Ids without context cost what their frequencies say from the first id on, and rare ones come back."""
    r = np.random.default_rng(4)
    size = 65_534
    ids = (size * r.random((300, 64)) ** 6).astype(np.uint16)
    ids[::50] = size - 1 - np.arange(64)
    counts = np.bincount(ids.ravel(), minlength=size)
    lengths = np.full(64, 300)
    often = context_coder.frequencies(counts)
    payloads = context_coder.encode(ids, lengths, size, often)
    assert (context_coder.decode(payloads, lengths, size, often) == ids).all()
    assert sum(map(len, payloads)) < 0.85 * sum(map(len, context_coder.encode(ids, lengths, size)))


def test_wide_alphabets_are_coded_as_many_blocks_abreast(monkeypatch):
    given, plain = [], context_coder.encode
    monkeypatch.setattr(context_coder, "encode", lambda ids, lengths, *rest: given.append(len(lengths)) or plain(ids[:1], np.minimum(lengths, 1), *rest))
    token_files.packed(False, [(1, np.arange(300 * context_coder.BLOCK, dtype="<u4") % 60_000)])
    assert given == [300]


def test_shares_leave_room_for_every_frequency():
    r = np.random.default_rng(6)
    model = context_coder._Model(2000, context_coder.frequencies(np.ones(65_534)))
    model.table[:] = r.integers(0, 2**32, len(model.table), np.uint32)
    model.mix[:] = r.choice([context_coder._LEAST, context_coder._MOST], len(model.mix))
    model.predict(2000)
    differ = model.ids[0] != model.ids[1]
    assert (model.share_1[~differ] == 0).all() and (model.share_1[differ] >= 64).all() and (model.share_2 >= 64).all()
    assert (65536 - model.share_2.astype(int) - model.share_1 >= 64).all()


def test_quotients():
    r = np.random.default_rng(8)
    unit = r.integers(4, 2 ** r.integers(3, 44, 50_000)).astype(np.uint64)
    times = r.integers(0, 2**18, 50_000).astype(np.uint64)
    for code in (unit * times, unit * times + unit - np.uint64(1), unit * times + r.integers(0, unit.view(np.int64)).astype(np.uint64)):
        assert (context_coder._quotient(code, unit) == times.view(np.int64)).all()


def test_only_wide_white_space_is_looked_ahead_for():
    tokenizer, given = token_files.ByteTokenizer(PATH), []
    plain = tokenizer.ranks

    class Counting:
        def encode_to_numpy(self, text, **options):
            given.append(text)
            return plain.encode_to_numpy(text, **options)

    tokenizer.ranks = Counting()
    texts = ["one two\nthree four\n\nfive six", "one\ttwo seven\n", "eight \u00e9t\u00e9\x85\xa0x nine."]
    got = tokenizer.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert sorted(given) == sorted([" four\n\nfive seven\n \u00e9t\u00e9\x85\xa0x", "one", "one\ttwo", "eight"])
