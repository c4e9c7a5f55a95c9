"""Personal data: fixed patterns, and spans found by weak supervision.

Labelers of three sorts (patterns, gazetteers, context) vote yes, no or nothing
on every candidate span. Expectation-maximisation estimates, without labels,
how reliable each labeler is, and gives every combination of votes a
probability; a logistic regression on the votes and the span's shape, trained
on those probabilities, decides. Both need only the number of candidates with
each combination, which is counted over all documents; the combinations are
bounded by the labelers and shapes, not by the data.

The base spans (fixed patterns) are always returned; spans of accepted
candidates that touch none of them are added under the kind ``likely``.

Defined results: a null text is an empty text and has no spans; repeated rows
get equal results; an empty table, or one without candidates, adds no spans; a
text of any length is scanned whole, in linear time.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import rowwise

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "likely")
SPANS = "spans array<struct<kind:string,start:int,end:int>>"
_RANK = {k: i for i, k in enumerate(KINDS)}

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
#: A match starts where digits start: from within a run of digits the same text follows.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The pattern's matches, found from each @ outwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            yield start, done
        at = text.find("@", m.end() if m else at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("email", a, b) for a, b in emails(text)]
    if DIGIT.search(text):
        found += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(DIGIT.findall(m[0])) <= 15]
    return found


# --- candidates and labelers ------------------------------------------------------------

#: Groups of digits, spelled-out addresses, account numbers, and names after a title.
CANDIDATES = re.compile(
    r"(?P<digits>(?<![0-9A-Za-z])\+?\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,18}(?![0-9A-Za-z]))"
    r"|(?P<account>\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b)"
    r"|(?P<spelled>(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z]{2,63}){1,4})"
    r"|(?P<name>\b(?:Mr|Mrs|Ms|Dr|Herr|Frau|Monsieur|Madame|Señor|Señora)\.?\x20[A-ZÀ-Þ][a-zß-ÿ]{1,30}(?:\x20[A-ZÀ-Þ][a-zß-ÿ]{1,30}){0,2})"
)

NEAR_YES = re.compile(r"(?:e-?mail|contact|kontakt|contacto|phone|telefon|teléfono|téléphone|\btel\b|mobile|handy|call|fax|card|karte|carte|tarjeta|visa|account|konto|iban|ssn|social security|passport|\bip\b|address)[^\n]{0,12}\Z", re.I)
NEAR_NO = re.compile(r"(?:isbn|issn|version|\bv|page|seite|pages?|order|invoice|build|chapter|article|figure|table|doi|license|copyright|\$|€|£)[^\n]{0,8}\Z", re.I)
FIRST_NAMES = frozenset("anna ben carla carlos david elena emma eva felix hans isabel jan jean john jose juan julia klaus laura lea louis lucas maria marie max michael paul peter pierre sara sarah sofia sophie thomas".split())
ISSUERS = re.compile(r"4|5[1-5]|3[47]|6011|65")
CALLING = re.compile(r"\+?(?:1|33|34|39|41|43|44|49|351)(?=[\x20(.-])")


def iban(text: str) -> bool:
    s = text.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _yes(x) -> int:
    return 1 if x else 0


def _no(x) -> int:
    return -1 if x else 0


@dataclass(frozen=True)
class Span:
    shape: str
    text: str
    digits: str
    before: str
    base: str


#: Each votes 1 (personal data), -1 (not) or 0 (nothing).
LABELERS = (
    ("pattern: base", lambda s: _yes(s.base)),
    ("pattern: check digits", lambda s: 0 if s.shape not in ("digits", "account") or len(s.digits) < 14 else (1 if (iban(s.text) if s.shape == "account" else luhn(s.digits)) else -1)),
    ("pattern: phone groups", lambda s: _yes(s.shape == "digits" and re.fullmatch(r"(?:\+?[0-9]{1,3}[\x20.-])?\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}", s.text))),
    ("pattern: social security", lambda s: _yes(re.fullmatch(r"[0-9]{3}-[0-9]{2}-[0-9]{4}", s.text))),
    ("pattern: spelled address", lambda s: _yes(s.shape == "spelled")),
    ("pattern: date or amount", lambda s: _no(re.fullmatch(r"(?:19|20)[0-9]{2}[.-]?[01]?[0-9][.-]?[0-3]?[0-9]|[0-9]{1,3}(?:[.][0-9]{3})+(?:[.][0-9]{2})?|[0-9]+\.[0-9]{1,2}", s.text))),
    ("pattern: plain number", lambda s: _no(s.shape == "digits" and s.text.isdigit() and not s.base)),
    ("pattern: few distinct digits", lambda s: _no(s.shape == "digits" and len(set(s.digits)) < 3)),
    ("gazetteer: first name", lambda s: _yes(s.shape == "name" and any(w.lower() in FIRST_NAMES for w in s.text.split()[1:]))),
    ("gazetteer: card issuer", lambda s: _yes(s.shape == "digits" and 14 <= len(s.digits) <= 19 and ISSUERS.match(s.digits) and luhn(s.digits))),
    ("gazetteer: calling code", lambda s: _yes(s.shape == "digits" and CALLING.match(s.text))),
    ("context: named before", lambda s: _yes(NEAR_YES.search(s.before))),
    ("context: other before", lambda s: _no(NEAR_NO.search(s.before))),
)


def candidates(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, int, str]]]:
    """(base spans, candidates): of each candidate its place and its votes and shape."""
    base = base_spans(text)
    spans = [(a, b, "base", k) for k, a, b in base]
    for m in CANDIDATES.finditer(text):
        a, b = m.span()
        if not any(a < y and x < b for x, y, *_ in spans[: len(base)]):
            spans.append((a, b, m.lastgroup, ""))
    out = []
    for a, b, shape, kind in spans:
        t = text[a:b]
        digits = "".join(DIGIT.findall(t))
        s = Span("digits" if kind in ("card", "phone", "ip") else "spelled" if kind == "email" else shape, t, digits, text[max(0, a - 32) : a], kind)
        votes = "".join("-0+"[f(s) + 1] for _, f in LABELERS)
        out.append((a, b, f"{votes}|{s.shape}|{min(len(digits), 20) // 4}"))
    return base, out


def combination_counts(docs: DataFrame, id_col: str, text_col: str) -> dict[str, int]:
    """How many candidates have each combination of votes and shape, over all documents."""
    src = docs.select(F.col(text_col).alias("text")).filter("text is not null")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                for text in batch.slice(at, 512).column(0).to_pylist():
                    seen.update(c for _, _, c in candidates(text)[1])
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(seen.keys()), pa.array(seen.values(), pa.int64())], ["combination", "n"])

    rows = src.mapInArrow(run, "combination string, n long").groupBy("combination").agg(F.sum("n").alias("n")).collect()
    return {r["combination"]: r["n"] for r in rows}


def expectation_maximisation(votes: np.ndarray, n: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(probability of personal data for each combination, reliability of each labeler).

    Each labeler has a chance of each vote given the truth; the start trusts
    votes by 0.8, and a little smoothing keeps all chances above zero."""
    kinds, m = np.array([-1, 0, 1]), votes.shape[1]
    is_kind = votes[:, :, None] == kinds[None, None, :]
    chance = np.tile(np.array([[0.2, 0.5, 0.8], [0.8, 0.5, 0.2]])[:, None, :], (1, m, 1))
    chance /= chance.sum(axis=2, keepdims=True)
    prior = np.array([0.5, 0.5])
    for _ in range(rounds):
        like = np.log(prior)[None, :] + np.einsum("cmk,ymk->cy", is_kind, np.log(chance))
        like -= like.max(axis=1, keepdims=True)
        post = np.exp(like)
        post /= post.sum(axis=1, keepdims=True)
        weight = post * n[:, None]
        prior = (weight.sum(axis=0) + 1) / (n.sum() + 2)
        chance = np.einsum("cy,cmk->ymk", weight, is_kind) + np.array([[0.4, 1.0, 1.6], [1.6, 1.0, 0.4]])[:, None, :]
        chance /= chance.sum(axis=2, keepdims=True)
    voted = chance[0][:, 2] + chance[1][:, 0], chance.sum(axis=0)[:, [0, 2]].sum(axis=1)
    return post[:, 0], voted[0] / np.maximum(voted[1], 1e-9)


def _features(combinations: list[str]) -> tuple[np.ndarray, dict[str, int]]:
    names: dict[str, int] = {"bias": 0}
    rows = []
    for c in combinations:
        votes, shape, size = c.split("|")
        keys = ["bias", f"shape {shape}", f"digits {size}", *(f"{i}{v}" for i, v in enumerate(votes) if v != "0")]
        rows.append([names.setdefault(k, len(names)) for k in keys])
    x = np.zeros((len(rows), len(names)))
    for i, r in enumerate(rows):
        x[i, r] = 1
    return x, names


def span_classifier(counts: dict[str, int]) -> dict[str, float]:
    """Each combination's probability by the trained classifier."""
    if not counts:
        return {}
    combinations = sorted(counts)
    n = np.array([counts[c] for c in combinations], float)
    votes = np.array([["-0+".index(v) - 1 for v in c.split("|")[0]] for c in combinations])
    target, _ = expectation_maximisation(votes, n)
    x, _ = _features(combinations)
    w, weight = np.zeros(x.shape[1]), np.sqrt(n)  # frequent combinations count more, but do not drown the others
    for _ in range(50):  # Newton's method with a ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - target)) + 0.1 * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return dict(zip(combinations, (1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))).tolist(), strict=True))


def find_personal_data(docs: DataFrame, least: float = 0.9, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): base spans of each row's text, and candidates with a probability of
    ``least`` or more; positions in code points, end exclusive, by start and kind."""
    accepted = {c for c, p in span_classifier(combination_counts(docs, id_col, text_col)).items() if p >= least}

    def make():
        def scan(text: str) -> tuple:
            base, found = candidates(text)
            spans = base + [("likely", a, b) for a, b, c in found[len(base):] if c in accepted]
            spans.sort(key=lambda s: (s[1], _RANK[s[0]], s[2]))
            return ([dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans],)

        return scan

    return rowwise(docs, make, SPANS, id_col, text_col)
