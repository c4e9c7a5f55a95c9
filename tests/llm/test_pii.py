import random
import re

import numpy as np

from lakestrata.llm import pii
from tests.llm.cases import awkward, clashing, frame


def brute(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and sum(sum(map(int, str(int(c) * (1 + i % 2)))) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_base_spans_equal_the_patterns():
    r = random.Random(3)
    for _ in range(30_000):
        t = "".join(r.choice("0123456789. -+()@ab.@1é") for _ in range(r.randrange(40)))
        assert sorted(pii.base_spans(t)) == brute(t), t


def test_long_runs_take_linear_time():
    for t in ("a" * 300_000 + "@", "1" * 300_000, "1." * 100_000, "+1" * 100_000, "@" * 200_000):
        pii.base_spans(t)


def test_reliabilities_are_recovered():
    r = np.random.default_rng(2)
    truth = r.random(20_000) < 0.4
    right = np.array([0.95, 0.8, 0.7, 0.9])
    votes = np.where(r.random((20_000, 4)) < right, truth[:, None], ~truth[:, None]) * 2 - 1
    votes[r.random((20_000, 4)) < 0.2] = 0
    rows, n = np.unique(votes, axis=0, return_counts=True)
    post, reliability = pii.expectation_maximisation(rows, n.astype(float))
    assert np.abs(reliability - right).max() < 0.05
    each = {tuple(v): p for v, p in zip(rows.tolist(), post, strict=True)}
    guess = np.array([each[tuple(v)] >= 0.5 for v in votes.tolist()])
    assert (guess == truth).mean() > 0.93


def test_names_need_no_digit_beside_them():
    for text, name in (("Frau Anna Schmidt kommt morgen", "Frau Anna Schmidt"), ("Señora María López", "Señora María López"), ("Dr. Max Klein", "Dr. Max Klein")):
        assert [text[a:b] for a, b, _ in pii.candidates(text)[1]] == [name]
        assert pii.candidates(text)[1][0] == pii.candidates(text + " 1 at")[1][0]


def test_operator(spark):
    text = "mail me: a.b@c.example or +1 (555) 123-4567, card 4111 1111 1111 1111, host 10.0.0.1"
    rows = awkward() + [(40 + i, text) for i in range(30)] + [(80, "call 555-123-4567 now"), (90, "see page 12345678")]
    got = {}
    for r in pii.find_personal_data(clashing(frame(spark, rows))).collect():
        got.setdefault(r["doc_id"], []).append([(s["kind"], s["start"], s["end"]) for s in r["spans"]])
    assert [s for s in got[40][0] if s[0] != "likely"] == sorted(brute(text), key=lambda s: s[1])
    assert got[1] == [[]] and got[2] == [[]] and len(got[7]) == 2
    assert not got[90][0]
    assert pii.find_personal_data(frame(spark, [])).collect() == []
    assert pii.find_personal_data(frame(spark, [(1, "nothing here")])).first()["spans"] == []
