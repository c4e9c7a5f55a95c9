import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import queries, whitening
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, components=4):
    """{id: rows}, covariance by definition and numpy's eigenvectors."""
    kept = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(np.float32(c)) for c in v)]
    width = max((len(v) for _, v in kept), default=0)
    kept = [(i, tuple(v + [0] * (width - len(v)))) for i, v in kept]
    fit = sorted({v for _, v in kept})
    n, sums = len(fit), [sum(v[j] for v in fit) for j in range(width)]
    x = np.array(fit, float).reshape(n, width) - np.array(sums, float) / max(n, 1)
    values, vectors = np.linalg.eigh(x.T @ x / n) if n and width else (np.zeros(0), np.zeros((0, 0)))
    values, vectors = values[::-1], vectors[:, ::-1]
    return kept, n, sums, width, values, vectors


def check(spark, rows, components=4, rank=None, close=1e-8):
    df = spark.createDataFrame(rows, SCHEMA)
    clash = df.withColumns({c: F.lit(1) for c in ("id", "x", "rows", "n", "component", "at")})
    got = sorted(map(tuple, whitening.whiten(clash, components).collect()), key=str)
    kept, n, sums, width, values, vectors = brute(rows)
    k = min(components, width, int((values > 1e-9 * values.sum()).sum()) if width else 0)
    assert k == (k if rank is None else rank)
    assert len(got) == len(kept) * k
    want = sorted(((i, c + 1, n, sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True))) for i, v in kept for c in range(k)), key=str)
    assert sorted((r[:4] for r in got), key=str) == want
    gaps = [min([abs(values[c] - values[j]) for j in range(width) if j != c], default=1.0) / values[0] for c in range(k)]
    for c in range(k):
        if gaps[c] < 1e-6:
            continue
        mine = sorted(((r[0], r[3], r[4]) for r in got if r[1] == c + 1), key=lambda r: (str(r[0]), r[1], abs(r[2])))
        theirs = [(i, sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)), float((np.array(v) - np.array(sums) / n) @ vectors[:, c] / np.sqrt(values[c]))) for i, v in kept]
        theirs = sorted(theirs, key=lambda r: (str(r[0]), r[1], abs(r[2])))
        a, b = np.array([r[2] for r in mine]), np.array([r[2] for r in theirs])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < close / gaps[c] ** 0.5
        assert all(abs(r[5] - values[c] / values.sum()) <= 1e-6 * r[5] for r in got if r[1] == c + 1)
    assert all(r[6] <= 1e-8 for r in got)
    return got


@pytest.mark.parametrize("block", [262_144, 64])
def test_equals_eigenvectors(spark, monkeypatch, block):
    monkeypatch.setattr(whitening, "BLOCK", block)
    r = np.random.default_rng(1)
    x = r.normal(size=(300, 12)) * np.linspace(3, 0.5, 12) + r.normal(size=12)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000 + i, x[0].tolist()) for i in range(150)]  # a third are one vector
    check(spark, rows)


def test_flat_and_repeated_variances(spark):
    """Equal eigenvalues and a fit that needs new directions."""
    corners = [[a, b, c, d, 5.0 * e] for a in (-1, 1) for b in (-1, 1) for c in (-1, 1) for d in (-1, 1) for e in (-1, 1)]
    got = check(spark, [(i, [float(c) for c in v]) for i, v in enumerate(corners)])
    assert {round(r[5], 9) for r in got if r[1] > 1} == {round(1 / 29, 9)}
    # every component is a unit direction of its variance: the identity error says so


def test_less_rank_than_components(spark):
    r = np.random.default_rng(2)
    a, b = r.normal(size=8), r.normal(size=8)
    rows = [(i, (x * np.round(256 * a) / 256 + y * np.round(256 * b) / 256).tolist()) for i, (x, y) in enumerate(r.integers(-4, 5, (60, 2)).astype(float))]
    check(spark, rows, rank=2)


def test_awkward_rows(spark):
    rows = [(1, [1.0, 2.0, 0.5]), (2, None), (3, [1.0, None, 2.0]), (4, [float("nan")] * 3), (5, [float("inf"), 0.0, 0.0]), (6, []), (7, [0.25]),
            (None, [-3.0, 1.0, 4.0]), (8, [1.0, 2.0, 0.5]), (8, [1.0, 2.0, 0.5]), (9, [-0.0, 0.0, 1.0]), (10, [1e-9, -1e-9, 7.0])]
    check(spark, rows)
    check(spark, [])
    check(spark, [(1, None)])
    check(spark, [(1, [1.0, 2.0])], rank=0)
    check(spark, [(1, []), (2, [])], rank=0)
    check(spark, [(1, [1.0]), (2, [2.0])], rank=1)


def test_deviations_beyond_doubles():
    x = np.array([[2**40, -3], [5, 7]])
    sums = np.array([2**41, 11], object)
    assert whitening.deviations(x, 3, sums) == [None, (15 - 2**41) ** 2 + 100 if (15 - 2**41) ** 2 + 100 < 2**63 else None]
    assert whitening.deviations(x[1:], 3, np.array([2**30, 11], object)) == [(15 - 2**30) ** 2 + 100]


def test_query_on_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    kept, n, sums, width, values, vectors = brute(rows)
    got = queries.op13_whitening(spark, SF_SMALL).collect()
    assert len(got) == 4 * len(kept) and {r["n"] for r in got} == {n}
    x = np.array([v for _, v in kept], float) - np.array(sums, float) / n
    at = {i: j for j, (i, _) in enumerate(kept)}
    for c in range(4):
        mine = np.zeros(len(kept))
        for r in got:
            if r["component"] == c + 1:
                mine[at[r["vec_id"]]] = r["whitened"]
        theirs = x @ vectors[:, c] / np.sqrt(values[c])
        assert min(np.abs(mine - theirs).max(), np.abs(mine + theirs).max()) < 1e-6
    assert got[0]["identity_error"] < 1e-9
