import hashlib
import random
from collections import Counter
from itertools import groupby

import pandas as pd
import pytest

from lakestrata.llm import fm_dedup, repeats, suffix_dedup
from tests.llm.cases import awkward, clashing, frame

LAST = repeats.LAST


def brute(rows, words):
    """(id, tokens, removed, spans, kept) of each row."""
    parts = [(LAST if i is None else i, (t or "").encode().split() if words else (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in parts:
        for p in range(len(t) - 49):
            k = tuple(t[p:p + 50]) if words else t[p:p + 50]
            first[k] = min(first.get(k, LAST), i)
    out = []
    for (i, t), (own, _) in zip(parts, rows, strict=True):
        gone = bytearray(len(t))
        for p in range(len(t) - 49):
            if first[tuple(t[p:p + 50]) if words else t[p:p + 50]] < i:
                gone[p:p + 50] = b"\1" * 50
        kept = [x for x, g in zip(t, gone, strict=True) if not g]
        out.append((own, len(t), sum(gone), sum(k for k, _ in groupby(gone)), b" ".join(kept) if words else bytes(kept)))
    return out


def passes(rows, words, packs, buckets):
    """All steps on pandas frames, as Spark deals them."""
    kind, method, keep = ((fm_dedup.WORDS, fm_dedup.repeated_windows, fm_dedup.kept_words) if words
                          else (suffix_dedup.BYTES, suffix_dedup.repeated_windows, suffix_dedup.kept_bytes))
    owner = {}
    for i, t in rows:
        owner[t] = min(owner.get(t, LAST), i)
    items = [(i, t.encode()) for t, i in owner.items()]
    random.Random(1).shuffle(items)
    held = [{"pack": k, "digests": [None] * len(x), "ids": [i for i, _ in x], "texts": [t for _, t in x]} for k, x in enumerate(items[k::packs] for k in range(packs))]
    asked = pd.DataFrame([r for p in held for r in repeats.ask(p, kind, buckets)], columns=["bucket", "pack", "entries"])
    answers = pd.concat([repeats.answer(g.reset_index(drop=True)) for _, g in asked.groupby("bucket")] or [pd.DataFrame(columns=["pack", "bucket", "flags"])])
    spans, sent = [], []
    for p in held:
        p["answers"] = [{"flags": f} for f in answers[answers["pack"] == p["pack"]].sort_values("bucket")["flags"]]
        for shard, pack, blob in repeats.contest(p, kind, buckets) if p["answers"] else ():
            (spans if shard < 0 else sent).append((shard, pack, blob))
    for _, g in pd.DataFrame(sent, columns=["shard", "pack", "blob"]).groupby("shard"):
        found = repeats.settle(method, kind.wire, 50)(g.reset_index(drop=True))
        spans += [(0, int(k), b) for k, b in zip(found["pack"], found["blob"], strict=True)]
    got = {}
    for p in held:
        for r, t in zip(keep(p["digests"], p["ids"], p["texts"], [b for _, k, b in spans if k == p["pack"]]), p["texts"], strict=True):
            got[t] = tuple(r[1:])
    return got


@pytest.mark.parametrize("words", [True, False])
@pytest.mark.parametrize("hot", [0, 3, 2000])
def test_every_window_as_brute_force(monkeypatch, words, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "BLOCK", 400)  # texts longer than a block
    r = random.Random(hot + words)
    for trial in range(4):
        alphabet = ["a", "bc", "def", "é"] if trial % 2 else ["w" * r.randrange(1, 4) + str(i) for i in range(300)]
        base = [[r.choice(alphabet) for _ in range(n)] for n in (0, 5, 49, 50, 51, 80, 200, 600)] + [["x"] * 300]
        rows = []
        for i in range(50):
            t = list(r.choice(base))
            for _ in range(r.randrange(4) if t and r.random() < 0.4 else 0):
                t[r.randrange(len(t))] = r.choice(alphabet)
            if r.random() < 0.3:
                t = t[r.randrange(60):] + r.choice(base)
            rows.append((i if r.random() < 0.9 else i // 2, " ".join(t)))
        owner = {}
        for i, t in rows:
            owner[t] = min(owner.get(t, LAST), i)
        distinct = [(i, t) for t, i in owner.items()]
        got = passes(rows, words, 4, 5)
        for (i, t), want in zip(distinct, brute(distinct, words), strict=True):
            assert got[t.encode()] == want


def test_bytes_operator(spark):
    rows = awkward()
    got = suffix_dedup.dedup_bytes(clashing(frame(spark, rows))).collect()
    want = brute(rows, False)
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got) == Counter(want)
    digests = suffix_dedup.dedup_bytes_digest(frame(spark, rows)).collect()
    assert Counter((r["doc_id"], r["kept_sha256"]) for r in digests) == Counter((w[0], hashlib.sha256(w[4]).hexdigest()) for w in want)
    assert suffix_dedup.dedup_bytes(frame(spark, [])).collect() == []


def test_words_operator(spark):
    rows = awkward()
    df = clashing(frame(spark, rows))
    want = brute(rows, True)
    got = fm_dedup.dedup_words_digest(df).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == Counter((w[0], w[1], w[2], hashlib.sha256(w[4]).hexdigest()) for w in want)
    out = fm_dedup.dedup_words(df)
    assert out.columns == df.columns
    texts = Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert texts == Counter((w[0], w[4].decode() if w[2] else t) for w, (_, t) in zip(want, rows, strict=True))
    assert fm_dedup.dedup_words(frame(spark, [])).collect() == []
