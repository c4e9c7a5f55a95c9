"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other: each logistic regression sees a
document's words and the probabilities of the categories before it. While
training, those probabilities are out-of-fold predictions, so a later model
does not learn from an earlier one's own training rows. Words count by
themselves and by their first letters (inflected forms share those); the
features that tell the categories apart best are kept.

The models are fitted on ``TRAINING_ROWS`` labelled rows at most, taken in the
order of a hash of the id; every document is scored, over its whole text.

Defined results: a null text is an empty text and is scored by the constant
terms; labels that are null or name no document are ignored; repeated rows get
equal results; texts of any length count by their distinct words; only the id and text
(and the columns that the conditions name) are read, so others cannot clash; a category without positive labels has probability 0 (as have
all, if no label is usable); an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import discard, rowwise, stored

TRAINING_ROWS = 20_000
#: Features kept for each category; a feature is seen in so many training rows at least.
FEATURES, LEAST_ROWS = 1500, 4
FOLDS = 3
#: The norm of the loss' gradient at which a fit has ended.
GRADIENT = 1e-6
PREFIXES = (4, 5, 6)
#: Words whose features a task keeps.
CACHE = 300_000

_WORD = re.compile(r"[^\W\d_]+")


def features_of_word(word: str) -> list[str]:
    """The word itself, and its beginnings (marked) as far as it is longer."""
    return [word, *(word[:n] + "~" for n in PREFIXES if len(word) > n)]


def features(text: str) -> set[str]:
    return {f for w in set(_WORD.findall(text.lower())) for f in features_of_word(w)}


def select_features(rows: DataFrame, categories: list[str]) -> list[str]:
    """Features with the highest chi-square statistic for each category, by documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        positive = [Counter() for _ in categories]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256).to_pydict()
                for i, text in enumerate(part["text"]):
                    found = features(text)
                    seen.update(found)
                    for c, own in zip(categories, positive, strict=True):
                        if part[c][i]:
                            own.update(found)
        names = list(seen)
        for at in range(0, len(names), 100_000):
            some = names[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array([c[x] for x in some], pa.int64()) for c in (seen, *positive))], ["feature", "n", *categories])

    counted = rows.mapInArrow(run, "feature string, n long, " + ", ".join(f"`{c}` long" for c in categories))
    counted = counted.groupBy("feature").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in categories]).filter(F.col("n") >= LEAST_ROWS)
    counted = stored(counted, "toxicity-features")
    total = rows.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in categories]).first()
    chosen: dict[str, None] = {}
    for c in categories:
        all_, yes = float(total["n"]), float(total[c] or 0)
        if not 0 < yes < all_:
            continue
        off = F.col(c) * all_ - F.col("n") * yes
        chi = off * off * all_ / (F.col("n") * (all_ - F.col("n") + 0.5) * yes * (all_ - yes))
        best = counted.select("feature", chi.alias("chi")).orderBy(F.desc("chi"), "feature").limit(FEATURES)
        chosen.update(dict.fromkeys(r["feature"] for r in best.collect()))
    discard(counted)
    return list(chosen)


@dataclass
class Linear:
    """Weights of features (by number), of the probabilities before, and a constant."""

    words: np.ndarray
    chain: np.ndarray
    constant: float

    def predict(self, first: np.ndarray, which: np.ndarray, before: np.ndarray) -> np.ndarray:
        """``which`` has all rows' features, ``first`` where each row's begin."""
        z = row_sums(self.words[which], first) + before @ self.chain + self.constant
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    ends = np.concatenate(([0.0], np.cumsum(values)))
    return ends[np.concatenate((first[1:], [len(values)]))] - ends[first]


class Logistic:
    """Loss, gradient and curvature of a logistic regression with a ridge on all but the constant."""

    def __init__(self, first: np.ndarray, which: np.ndarray, before: np.ndarray, y: np.ndarray, n: int, ridge: float):
        self.first, self.which, self.before, self.y, self.n, self.ridge = first, which, before, y, n, ridge
        self.m = before.shape[1]
        row = np.repeat(np.arange(len(first)), np.diff(np.concatenate((first, [len(which)]))))
        # sums over rows and over features are sums over runs: of the pairs as they come, and by feature
        self.filled = np.flatnonzero(np.diff(np.concatenate((first, [len(which)]))))
        self.runs = first[self.filled]
        order = np.argsort(which, kind="stable")
        self.by_feature, sorted_ = row[order], which[order]
        self.starts = np.flatnonzero(np.diff(sorted_, prepend=-1))
        self.seen = sorted_[self.starts]

    def scores(self, w: np.ndarray) -> np.ndarray:
        z = self.before @ w[self.n : self.n + self.m] + w[-1]
        if len(self.runs):
            z[self.filled] += np.add.reduceat(w.take(self.which), self.runs)
        return z

    def across(self, rows: np.ndarray) -> np.ndarray:
        """The rows' values summed over the rows that have each feature."""
        return np.concatenate((self.over_rows(rows), self.before.T @ rows, [rows.sum()]))

    def over_rows(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n)
        if len(self.starts):
            out[self.seen] = np.add.reduceat(rows.take(self.by_feature), self.starts)
        return out

    def loss(self, w: np.ndarray) -> float:
        z = self.scores(w)
        return float((np.logaddexp(0, z) - self.y * z).sum() + 0.5 * self.ridge * (w[:-1] @ w[:-1]))

    def gradient(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The gradient, and each row's p (1 - p)."""
        p = 1 / (1 + np.exp(-np.clip(self.scores(w), -500, 500)))
        g = self.across(p - self.y)
        g[:-1] += self.ridge * w[:-1]
        return g, p * (1 - p)

    def curved(self, d: np.ndarray, bend: np.ndarray) -> np.ndarray:
        h = self.across(bend * self.scores(d))
        h[:-1] += self.ridge * d[:-1]
        return h

    def step(self, g: np.ndarray, bend: np.ndarray, close: float) -> np.ndarray:
        """Newton's direction by conjugate gradients, scaled by the diagonal of the curvature."""
        scale = np.concatenate((self.over_rows(bend), (self.before * self.before).T @ bend, [bend.sum()]))
        scale[:-1] += self.ridge
        scale[-1] += 1e-12
        d, r = np.zeros(len(g)), -g
        z = r / scale
        along, rz = z.copy(), float(r @ z)
        for _ in range(len(g) + 10):
            if np.linalg.norm(r) <= close:
                break
            h = self.curved(along, bend)
            a = rz / float(along @ h)
            d += a * along
            r -= a * h
            z = r / scale
            rz, before = float(r @ z), rz
            along = z + (rz / before) * along
        return d


def fit(first: np.ndarray, which: np.ndarray, before: np.ndarray, y: np.ndarray, n: int, ridge: float = 1.0, start: Linear | None = None) -> Linear:
    """Logistic regression with a ridge by Newton's method, until the gradient's norm is
    below ``GRADIENT``; each step is halved until the loss falls. Any ``start`` ends in the same model."""
    if not 0 < y.sum() < len(y):
        return Linear(np.zeros(n), np.zeros(before.shape[1]), -30.0 if not y.sum() else 30.0)
    model = Logistic(first, which, before, y, n, ridge)
    w = np.zeros(n + model.m + 1)
    w[-1] = np.log(y.mean() / (1 - y.mean()))
    if start is not None:
        w = np.concatenate((start.words, start.chain, [np.clip(start.constant, -20, 20)]))
    loss = model.loss(w)
    for _ in range(200):
        g, bend = model.gradient(w)
        norm = float(np.linalg.norm(g))
        if norm <= GRADIENT:
            break
        d = model.step(g, bend, min(0.1, np.sqrt(norm / len(y))) * norm)
        slope, size = float(g @ d), 1.0
        while size > 1e-9 and (new := model.loss(w + size * d)) > loss + 1e-4 * size * slope + 1e-12 * abs(loss):
            size /= 2
        w, loss = w + size * d, new
    return Linear(w[:n], w[n : n + model.m], float(w[-1]))


def fit_chain(first: np.ndarray, which: np.ndarray, labels: np.ndarray, n: int, fold: np.ndarray) -> list[Linear]:
    """A model for each column of ``labels``, in order; ``fold`` parts the rows."""
    models, before = [], np.zeros((len(first), 0))
    sizes = np.diff(np.concatenate((first, [len(which)])))
    for j in range(labels.shape[1]):
        y, out = labels[:, j].astype(float), np.zeros(len(first))
        whole = fit(first, which, before, y, n)
        for f in range(FOLDS):
            held = fold == f
            inside, outside = ~held, held
            use = np.repeat(inside, sizes)
            model = fit(_starts(sizes[inside]), which[use], before[inside], y[inside], n, start=whole)
            out[outside] = model.predict(_starts(sizes[outside]), which[~use], before[outside])
        models.append(whole)
        before = np.column_stack((before, out))
    return models


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, str], id_col: str, text_col: str) -> tuple[list[str], list[Linear]]:
    """(features, models) from the documents that ``labels`` name; ``categories`` gives,
    in the order of the chain, a condition on the columns of ``labels``."""
    names = list(categories)
    named = labels.select(F.col(id_col).alias("id"), *[F.coalesce(F.expr(c), F.lit(False)).cast("int").alias(n) for n, c in categories.items()])
    named = named.filter("id is not null").dropDuplicates(["id"])
    sample = named.orderBy(F.xxhash64("id"), "id").limit(TRAINING_ROWS)  # its bound makes it small enough to broadcast
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(sample), "id")
    rows = stored(texts, "toxicity-training")
    chosen = select_features(rows, names)
    number = {f: i for i, f in enumerate(chosen)}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                which = [np.array(sorted(number[f] for f in features(t) if f in number), np.int32).tobytes() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(which, pa.binary()), *(part.column(c) for c in names)], ["id", "which", *names])

    kind = rows.schema["id"].dataType.simpleString()
    got = rows.mapInArrow(run, f"id {kind}, which binary, " + ", ".join(f"`{c}` int" for c in names)).dropDuplicates(["id"]).collect()
    discard(rows)
    if not got:
        return chosen, [Linear(np.zeros(len(chosen)), np.zeros(j), -30.0) for j in range(len(names))]
    got.sort(key=lambda r: r["id"])
    each = [np.frombuffer(r["which"], np.int32) for r in got]
    truth = np.array([[r[c] for c in names] for r in got])
    fold = np.random.default_rng(5).permutation(len(got)) % FOLDS
    return chosen, fit_chain(_starts(np.array([len(x) for x in each])), np.concatenate(each), truth, len(chosen), fold)


def score(docs: DataFrame, chosen: list[str], models: list[Linear], names: list[str], id_col: str, text_col: str) -> DataFrame:
    """(id, a probability p_<category> for each) of every row."""

    def make() -> Callable[[str], tuple]:
        number, known = {f: i for i, f in enumerate(chosen)}, {}

        def work(text: str) -> tuple:
            hit: set[int] = set()
            for w in set(_WORD.findall(text.lower())):
                own = known.get(w)
                if own is None:
                    if len(known) >= CACHE:
                        known.clear()
                    own = known[w] = tuple(number[f] for f in features_of_word(w) if f in number)
                hit.update(own)
            which, before = np.array(sorted(hit), np.int64), np.zeros((1, 0))
            for m in models:
                before = np.column_stack((before, m.predict(np.zeros(1, np.int64), which, before)))
            return tuple(before[0].tolist())

        return work

    return rowwise(docs, make, ", ".join(f"p_{n} double" for n in names), id_col, text_col)


def toxicity(docs: DataFrame, labels: DataFrame, categories: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, p_<category> ...) of every document, by a chain trained on ``labels``."""
    chosen, models = train(docs, labels, categories, id_col, text_col)
    return score(docs, chosen, models, list(categories), id_col, text_col)
