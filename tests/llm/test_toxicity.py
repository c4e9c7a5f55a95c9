import random

import numpy as np
import pytest

from lakestrata.llm import toxicity
from tests.llm.cases import awkward, clashing, frame, prose

CHAIN = {"junk": "quality = 0", "toxic": "toxic = 1"}


def corpus(n, seed):
    r, rows, labels = random.Random(seed), [], []
    for i in range(n):
        toxic, junk = r.random() < 0.3, r.random() < 0.2
        words = prose(seed * 1000 + i, r.randrange(20, 80)).split()
        if toxic:
            for _ in range(3):
                words.insert(r.randrange(len(words)), "snark" + r.choice(["le", "ly", "ing", "ed", ""]))
        if junk:
            words += ["%%% blah"] * 5
        rows.append((i, " ".join(words)))
        labels.append((i, 0 if junk else 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus(600, 1)
    given = spark.createDataFrame(labels[:400], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(clashing(frame(spark, rows)), given, CHAIN).collect()}
    right = [(got[i]["p_toxic"] >= 0.5) == bool(t) and (got[i]["p_junk"] >= 0.5) == (q == 0) for i, q, t in labels[400:]]
    assert sum(right) / len(right) > 0.97


def test_chain_uses_out_of_fold_probabilities():
    # one feature a row of its own: in-fold predictions would be perfect, out-of-fold ones say nothing
    n = 90
    first, which = np.arange(n), np.arange(n)
    y = np.random.default_rng(0).integers(0, 2, (n, 2))
    models = toxicity.fit_chain(first, which, y, n, np.arange(n) % toxicity.FOLDS)
    assert abs(models[1].chain[0]) < 1.0


def random_rows(seed, n, rows, sizes):
    r = np.random.default_rng(seed)
    each = [np.sort(r.choice(n, min(n, int(s)), replace=False)) for s in r.choice(sizes, rows)]
    truth = np.array([[x[x < n // 4].size + r.normal() > 0.25 * x.size, r.random() < 0.3] for x in each], int)
    truth[:, 1] |= truth[:, 0] & (r.random(rows) < 0.5)
    return each, truth


def newton(x, y, ridge=1.0):
    """Plain dense Newton steps with halving; the last column is the constant."""
    w, keep = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 1, ridge), 0.0)

    def loss(w):
        z = x @ w
        return (np.logaddexp(0, z) - y * z).sum() + 0.5 * (keep * w * w).sum()

    for _ in range(100):
        p = 1 / (1 + np.exp(-(x @ w)))
        g = x.T @ (p - y) + keep * w
        d = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(keep), -g)
        size = 1.0
        while size > 1e-8 and loss(w + size * d) > loss(w) + 1e-12:
            size /= 2
        w = w + size * d
    return w


@pytest.mark.parametrize("sizes", [[0, 1], [1], [2, 3], [40], [0, 1, 5, 60, 120], [150]])
def test_chain_equals_plain_newton(sizes):
    n, rows = 150, 240
    each, truth = random_rows(3, n, rows, sizes)
    first, which = toxicity._starts(np.array([len(x) for x in each])), np.concatenate(each).astype(np.int64)
    fold = np.arange(rows) % toxicity.FOLDS
    models = toxicity.fit_chain(first, which, truth, n, fold)
    words = np.zeros((rows, n))
    for i, x in enumerate(each):
        words[i, x] = 1
    before = np.zeros((rows, 0))
    for j, model in enumerate(models):
        x, y, out = np.column_stack((words, before, np.ones(rows))), truth[:, j].astype(float), np.zeros(rows)
        g, _ = toxicity.Logistic(first, which, before, y, n, 1.0).gradient(np.concatenate((model.words, model.chain, [model.constant])))
        assert np.linalg.norm(g) < 1e-4  # the chain's inputs differ by rounding
        p = 1 / (1 + np.exp(-(x @ newton(x, y))))
        assert np.abs(p - model.predict(first, which, before)).max() < 1e-6
        for f in range(toxicity.FOLDS):
            out[fold == f] = 1 / (1 + np.exp(-(x[fold == f] @ newton(x[fold != f], y[fold != f]))))
        before = np.column_stack((before, out))


@pytest.mark.parametrize("sizes", [[1], [0, 3], [300], [0, 2, 700]])
def test_gradient_at_the_end(sizes):
    each, truth = random_rows(4, 1000, 2000, sizes)
    first, which, none = toxicity._starts(np.array([len(x) for x in each])), np.concatenate(each).astype(np.int64), np.zeros((2000, 0))
    model = toxicity.fit(first, which, none, truth[:, 0].astype(float), 1000)
    g, _ = toxicity.Logistic(first, which, none, truth[:, 0].astype(float), 1000, 1.0).gradient(np.append(model.words, model.constant))
    assert np.linalg.norm(g) <= toxicity.GRADIENT


def test_awkward_rows_and_labels(spark):
    rows, labels = corpus(100, 2)
    df = clashing(frame(spark, awkward() + [(i + 1000, t) for i, t in rows]))
    odd = [(i + 1000, q, t) for i, q, t in labels] + [(None, 1, 1), (5, None, None), (77_777, 1, 1), (1000, 1, 0)]
    given = spark.createDataFrame(odd, "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(df, given, CHAIN).collect()
    assert len(got) == df.count() and all(0 <= r["p_toxic"] <= 1 for r in got)
    assert len({r["p_toxic"] for r in got if r["doc_id"] in (1, 2, 3)}) == 1


def test_no_usable_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(frame(spark, awkward()), none, CHAIN).collect()
    assert len(got) == len(awkward()) and all(r["p_toxic"] < 1e-9 for r in got)
    assert toxicity.toxicity(frame(spark, []), none, CHAIN).collect() == []
