import base64
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import bpe
from tests.llm.cases import awkward, clashing, frame

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_matrices_equal_the_library(encoding):
    v, find, r = bpe.vocabulary(PATH), bpe.splitter(public_tokenizers.PATTERN), random.Random(1)
    chars = [chr(c) for c in range(0x250)] + [" ", "　", "́", "中", "😀", "﻿"]
    texts = ["".join(r.choice(chars if r.random() < 0.5 else "the of \n'sdll12") for _ in range(r.randrange(60))) for _ in range(1500)]
    texts += ["a" * 3000, "the" * 700 + " " * 500, "".join(r.choice("etaoin") for _ in range(2000)), ""]
    for text in texts:
        ids = np.frombuffer(b"".join(v.encode_pieces([p.encode() for p in find(text)])), np.int32)
        assert ids.tolist() == encoding.encode_ordinary(text)
        assert v.decode(ids) == text.encode()


def test_unknown_ids_are_an_error():
    with pytest.raises(ValueError):
        bpe.vocabulary(PATH).decode(np.array([10**6]))


def test_operator_round_trip(spark, encoding):
    rows = awkward()
    got = bpe.bpe_encode(clashing(frame(spark, rows)), PATH, public_tokenizers.PATTERN).withColumn("back", bpe.bpe_decode(F.col("ids"), PATH)).collect()
    key = lambda x: (x[0] is None, x[0], x[1])
    assert sorted(((r["doc_id"], bytes(r["back"]).decode(), list(r["ids"])) for r in got), key=key) == sorted(((i, t or "", encoding.encode_ordinary(t or "")) for i, t in rows), key=key)
    assert bpe.bpe_encode(frame(spark, []), PATH, public_tokenizers.PATTERN).collect() == []
