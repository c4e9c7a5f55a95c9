import math
import random
import re
from collections import Counter

from lakestrata.llm import secret_scan as S
from tests.llm.cases import awkward, clashing, frame

NAMES = r"""((?:p|P)(?:a|A)(?:s|S)(?:s|S)(?:w|W)(?:o|O)(?:r|R)(?:d|D)|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"""


def brute(text):
    out = []
    for m in re.finditer(NAMES + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_base_spans_equal_the_patterns():
    r, scan = random.Random(4), S.scanner(S.EntropyRules())
    parts = ["password", "PassWord", "token", "secret", "api_key", "apikey", "paſsword", "toKen", ":", "=", " ", "'", '"', "abcdef", "a.b", "AKIA", "AKIA" + "Z9" * 9, "0a1b2c3d" * 3, "é", "x"]
    for _ in range(20_000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(12)))
        assert sorted(s for s in scan(text) if s[0] != "entropy") == brute(text), text


def test_entropy_is_that_of_each_window():
    rules, r = S.EntropyRules(), random.Random(6)
    gains = [c * math.log2(c) if c else 0.0 for c in range(rules.window + 2)]
    for _ in range(300):
        text = "".join(r.choice("abcdefABCDEF0123456789xyzXYZ"[: r.randrange(3, 29)]) for _ in range(r.randrange(20, 60)))
        cover = set()
        least = rules.hex_bits if re.fullmatch("[0-9a-f]+|[0-9A-F]+", text) else rules.alnum_bits
        for i in range(len(text) - 19):
            n = Counter(text[i:i + 20])
            if -sum(c / 20 * math.log2(c / 20) for c in n.values()) >= least - 1e-9:
                cover.update(range(i, i + 20))
        got = {i for a, b in S.entropy_spans(text, 0, rules, gains) for i in range(a, b)}
        assert got == cover


def test_allow_list_and_prose_are_left_alone():
    scan = S.scanner(S.EntropyRules())
    assert not scan("Donaudampfschifffahrtsgesellschaft and https://example.org/a/very/long/path/with/many/words")
    assert not scan("id 550e8400-e29b-41d4-a716-446655440000 or EXAMPLEkey9aZ8bY7cX6dW5eV4fU")
    assert [s[0] for s in scan("key 9aZ8bY7cX6dW5eV4fU3gT2hS here")] == ["entropy"]


def test_a_secret_beside_an_allowed_word_is_found():
    scan, r = S.scanner(S.EntropyRules()), random.Random(8)
    chars = "ABCDEFGHIJKLMNOPQRSTUVWYZabcdefghijklmnopqrstuvwyz0123456789"
    secret = "".join(r.sample(chars, 40))
    for before, after in (("//host/samples/", ""), ("example_auth=", ""), ("", "/dummy"), ("a_", "-changeme_or_sample")):
        spans = [(a, b) for k, a, b in scan(before + secret + after) if k == "entropy"]
        at, covered = len(before), {i for a, b in spans for i in range(a, b)}
        assert covered >= set(range(at, at + 40)), (before, after)
    long = "".join(r.choice(chars) for _ in range(5000))
    spans = scan(long[:2500] + "xxxx" + long[2500:])
    assert [k for k, *_ in spans] == ["entropy"] * len(spans) and sum(b - a for _, a, b in spans) > 4900
    assert not any(a < 2504 and b > 2500 for _, a, b in spans)
    for text in ("placeholder9aZ8bY7cX6dW5eV4fU3gT2hS1", "9aZ8bY7cX6-example-1aB2cD3eF4", "a1------------------------b2"):
        assert not scan(text), text


def test_operator_and_mask(spark):
    secret = 'x token = "ab8ca1b325bc4f85aa6a79e73fc4cbfc2098878e" y'
    rows = awkward() + [(30, secret), (30, secret)]
    df = clashing(frame(spark, rows))
    got = S.find_secrets(df).collect()
    assert len(got) == len(rows)
    assert [[(s["kind"], s["start"], s["end"]) for s in r["spans"]][:2] for r in got if r["doc_id"] == 30] == [[("assign", 2, 51), ("hex", 11, 51)]] * 2
    masked = S.mask_secrets(df)
    assert masked.columns == df.columns
    texts = Counter((r["doc_id"], r["text"]) for r in masked.collect())
    assert texts[(30, 'x [SECRET]" y')] == 2 and texts[(1, None)] == 1
    assert texts == Counter((i, t if i != 30 else 'x [SECRET]" y') for i, t in rows)
    assert S.find_secrets(frame(spark, [])).collect() == []
