import random
from collections import Counter

import numpy as np
import pytest

from lakestrata.llm import minhash
from tests.llm.cases import awkward, clashing, frame, prose


def weighted(texts):
    """Weighted Jaccard similarity of two texts, from the definition."""
    words = [t.split() for t in texts]
    sets = [Counter(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1 if w else 0))) for w in words]
    frequency = Counter(s for c in sets for s in c)
    idf = {s: 1 + max(np.log((1 + len(texts)) / (1 + n)), 0) for s, n in frequency.items()}

    def similarity(a, b):
        both = sum(idf[s] * min(sets[a][s], sets[b][s]) for s in sets[a] if s in sets[b])
        total = sum(idf[s] * n for x in (a, b) for s, n in sets[x].items()) - both
        return both / total if total else 0.0

    return similarity


def test_samples_agree_as_often_as_texts_are_alike():
    r = np.random.default_rng(0)
    grams = r.integers(0, 2**52, 300, np.uint64)
    weights = r.integers(1, 6, (2, 300)).astype(np.float32)
    weights[1, :200] = weights[0, :200]
    alike = np.minimum(*weights).sum() / np.maximum(*weights).sum()
    rows, bands = minhash.ROWS, minhash.BANDS
    try:
        minhash.ROWS, minhash.BANDS = 1, 4000
        keys = minhash.band_keys(np.repeat([0, 1], 300), np.tile(grams, 2), weights.ravel())[1]
    finally:
        minhash.ROWS, minhash.BANDS = rows, bands
    assert abs((keys[:, 0] == keys[:, 1]).mean() - alike) < 0.04


@pytest.mark.parametrize("n, edits, weight", [(20_000, 1500, 8.0), (20_000, 1, 9000.0), (2000, 200, 8.0), (30, 4, 2.5)])
def test_light_shingles_of_long_texts_are_drawn(monkeypatch, n, edits, weight):
    r = np.random.default_rng(1)
    shared, own = r.integers(0, 2**52, n, np.uint64), r.integers(0, 2**52, (2, edits), np.uint64)
    grams = np.concatenate([shared, own[0], shared, own[1]])
    weights = np.tile(np.repeat([2.0, weight], [n, edits]), 2)
    monkeypatch.setattr(minhash, "ROWS", 1)
    monkeypatch.setattr(minhash, "BANDS", 2000)
    keys = minhash.band_keys(np.repeat([0, 1], n + edits), grams, weights)[1]
    assert abs((keys[:, 0] == keys[:, 1]).mean() - 2 * n / (2 * n + 2 * edits * weight)) < 0.05


def test_variates_have_the_distribution_of_the_scheme():
    r = np.random.default_rng(2)
    ln_x = minhash._X_OF_LOGIT(np.log(1 / (1 / r.random(200_000) - 1)))
    v = np.exp(minhash._X_OF_E1(np.log(r.random(200_000)) + minhash._E1_OF_X(ln_x)))
    c = v - np.log(r.random(200_000))
    for variate in (c, np.log(c) - ln_x):  # both are gamma variates of shape 2
        share = np.sort(1 - (1 + variate) * np.exp(-variate))
        assert np.abs(share - (np.arange(200_000) + 0.5) / 200_000).max() < 0.005
    assert abs(np.corrcoef(c, np.log(c) - ln_x)[0, 1]) < 0.01


@pytest.mark.parametrize("limits", [(0.01, 0.5), (3.0, 9.0), (50.0, 60.0)])
def test_limits_do_not_change_draws(monkeypatch, limits):
    r = np.random.default_rng(3)
    sizes = r.integers(1, 400, 60)
    text, grams = np.repeat(np.arange(60), sizes), r.integers(0, 2**52, sizes.sum(), np.uint64)
    weights = r.integers(1, 50, len(text)) * r.uniform(1, 13, len(text))
    monkeypatch.setattr(minhash, "LIMITS", (1e9, 2e9))  # no shingle is passed over
    want = minhash.band_keys(text, grams, weights)[1]
    monkeypatch.setattr(minhash, "LIMITS", limits)
    monkeypatch.setattr(minhash, "ABREAST", 5)
    assert (minhash.band_keys(text, grams, weights)[1] == want).all()


def test_word_hashes_are_those_of_words(monkeypatch):
    r = random.Random(4)
    texts = ["".join(r.choice("ab \t\n\x0b\x0c\r\x1cé") for _ in range(r.randrange(60))).encode() for _ in range(300)] + [b"", b"x" * 500, b" y"]
    seen = {}
    for chunk in (1 << 21, 64, 7):
        monkeypatch.setattr(minhash.WordHashes, "CHUNK", chunk)
        hashes, sizes = minhash.WordHashes().of(texts)
        assert sizes.tolist() == [len(t.split()) for t in texts]
        for word, h in zip([w for t in texts for w in t.split()], hashes.tolist(), strict=True):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def changed(text, n, seed):
    r, w = random.Random(seed), text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = "new" + str(r.randrange(10**6))
    return " ".join(w)


@pytest.mark.parametrize("large", [(48, 512), (3, 7)])
def test_classes_are_the_components(spark, monkeypatch, large):
    monkeypatch.setattr(minhash, "LARGE", large[0])
    monkeypatch.setattr(minhash, "BLOCK", large[1])
    rows = []
    for g in range(12):
        base = prose(100 + g, 150)
        rows += [(1000 * g + k, changed(base, k // 3, 17 * g + k)) for k in range(9)]
    hub = prose(500, 200)
    rows += [(50_000 + k, changed(hub, 2, k)) for k in range(60)]  # a large group of near copies
    rows += [(60_000 + k, changed(hub, 5 + k % 6, 900 + k)) for k in range(60)]  # and some that are less alike
    rows += [(90_000 + k, prose(700 + k, 100)) for k in range(40)]
    texts = [t for _, t in rows]
    alike = weighted(texts)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if alike(a, b) >= 0.8:
                parent[find(a)] = find(b)
    groups = {}
    for a, (i, _) in enumerate(rows):
        groups.setdefault(find(a), []).append(i)
    want = {i: min(g) for g in groups.values() for i in g}
    got = {r["doc_id"]: r["class_id"] for r in minhash.classes(frame(spark, rows)).collect()}
    assert got == want


def test_classes_of_links(spark):
    r = random.Random(6)
    forest = [(b - 1 if b < 40 else r.randrange(b), b) for b in range(1, 300) if b not in (50, 100, 200)]  # a chain, and trees
    more = [(3, 60), (50, 51), (400, 401), (401, 7), (100, 200), (500, 501)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    labels = minhash.roots(spark.createDataFrame(forest, "a long, b long"))
    for links, make in ((forest, lambda x: x), (more, lambda x: minhash.joined(x, spark.createDataFrame(more, "a long, b long"))), ([], lambda x: minhash.joined(x, spark.createDataFrame([], "a long, b long")))):
        labels = make(labels)
        for a, b in links:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
        assert {x["node"]: x["label"] for x in labels.collect()} == {x: find(x) for x in parent}


def test_frequencies_are_counted_by_shingle(spark, monkeypatch):
    from lakestrata.llm import repeats

    monkeypatch.setattr(repeats, "PACK_BYTES", 3000)  # many packs
    base = [prose(100 + k % 7, 60) for k in range(40)]
    texts = [" ".join(b.split()[: 30 + k]) for k, b in enumerate(base)] + base + ["one", "one", "", None, prose(3, 5000)]
    words = [(t or "").split() for t in texts]
    frequency = Counter(s for w in words for s in {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1 if w else 0))})
    docs, packs = minhash.weighed(minhash.stored(repeats.distinct_packs(frame(spark, list(enumerate(texts))), "doc_id", "text"), "t"))
    assert docs == len(texts)
    seen = set()
    for r in minhash.texts_of(packs).select("text.*").collect():
        w = bytes(r["text"]).decode().split()
        own = {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1 if w else 0))}
        seen.add(" ".join(w))
        assert sorted(minhash.unpacked(r["frequencies"]).tolist()) == sorted(frequency[s] for s in own)
    assert seen == {" ".join(w) for w in words}


def test_rare_shingles_keep_their_weight_in_a_large_corpus(spark):
    # forty texts share a passage and end in unique shingles, beside 2.4 million of others
    hub = prose(1, 120)
    rows = [(k, hub + "".join(f" own{k}x{j}" for j in range(8))) for k in range(40)] + [(1000 + k, prose(5000 + k, 40_000)) for k in range(60)]
    alike = weighted([t for _, t in rows])
    assert all(0.73 < alike(a, b) < 0.74 for a in range(40) for b in range(a))
    for least, want in ((0.75, 40), (0.72, 1)):
        found = minhash.classes(frame(spark, rows), least).collect()
        assert len({r["class_id"] for r in found if r["doc_id"] < 40}) == want


@pytest.mark.parametrize("apart", [1, 700])
def test_blocks_of_the_main_class_are_not_compared(spark, apart):
    label = [0] * 2000 + list(range(1, apart + 1))
    rows = spark.createDataFrame([(7, len(label), 2000, 0, n, x) for n, x in enumerate(label)], "key long, m long, held long, main long, node long, label long")
    groups, n = {}, 0
    for r in minhash.dealt_in_blocks(rows).collect():
        groups.setdefault((r["i"], r["j"]), []).append((r["block"], r["node"]))
        n += 1
    met = Counter()
    for (i, j), own in groups.items():
        sides = [[x for b, x in own if b == k] for k in (i, j)]
        met.update({(min(x, y), max(x, y)) for x in sides[0] for y in sides[1] if x != y})
    want = {(min(x, y), max(x, y)) for x in range(2000, len(label)) for y in range(len(label)) if x != y}
    assert set(met.values()) == {1} and want <= set(met)
    assert not any(b < 2000 for _, b in met)
    assert n == 2000 * -(-apart // 256) + apart * (-(-apart // 256) + 8)


def test_awkward_rows(spark):
    rows = awkward()
    df = clashing(frame(spark, rows))
    got = minhash.classes(df).collect()
    assert len(got) == len(rows)
    classes = {}
    for r in got:
        classes.setdefault(r["doc_id"], set()).add(r["class_id"])
    assert classes[5] == classes[6] == classes[7] == {5} and classes[1] == classes[2] == {1} and classes[3] == {3}
    assert classes[None] == {5, None}
    kept = minhash.keep_one(df)
    assert kept.columns == df.columns
    # one row of each class: nulls and empty texts are equal, blank texts are apart
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(c) for c in {c for s in classes.values() for c in s})
    assert minhash.classes(frame(spark, [])).collect() == [] and minhash.keep_one(frame(spark, [])).collect() == []
