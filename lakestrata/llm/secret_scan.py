r"""Secret scan: fixed patterns, and strings whose sliding-window entropy is high.

A candidate string is a maximal run of at least ``window`` characters of
``[A-Za-z0-9+/_=-]`` that holds a digit and a letter. A window moves over it
one character at a time; its Shannon entropy follows from the counts of its
characters, of which each step changes two. The threshold depends on the
candidate's character class. Windows at or over it are merged into ``entropy``
spans. A pattern of the allow list that begins with ``\A`` and ends with ``\Z``
judges the whole candidate; any other one excludes the windows that overlap its
match or what stands with it between separators (a window's length at most).

Defined results: a null text is an empty text and has no spans; rows are
judged alone, so repeated rows get equal results; an empty table gives an empty
result; a text of any length is scanned whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import rowwise

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "entropy")
SPANS = "spans array<struct<kind:string,start:int,end:int>>"

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
#: ASSIGN needs one of these words; a plain search for them rules out most texts.
ASSIGN_WORD = re.compile(r"passw|secret|token|api_?key", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Runs are maximal, so asking for 24 characters at once finds the same matches as filtering afterwards.
HEX = re.compile(r"[0-9a-f]{24,}")


@dataclass(frozen=True)
class EntropyRules:
    """Window length, bits per character by class, and what is no secret."""

    window: int = 20
    hex_bits: float = 2.75
    alnum_bits: float = 3.5
    base64_bits: float = 3.75
    allow: tuple[str, ...] = field(default=(
        r"(?i)example|sample|placeholder|changeme|dummy|xxxx",
        r"(?i)0123456789|123456789|abcdefghij|qwerty",
        r"(?i)\A[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\Z",
        r"\A[A-Za-z]+(?:[-_/=+][A-Za-z]+)*[-_/=+]?[0-9]{1,4}\Z",
        r"\A[0-9]{1,4}(?:[-_/=+]?[A-Za-z]+)+\Z",
        r"(?:[-=_+/]){6,}",
    ))


SEPARATORS = frozenset("/=_+-")


def excluded(text: str, allow: list[re.Pattern], window: int) -> list[tuple[int, int]]:
    """The matches of ``allow`` in ``text``, each with what stands with it between
    separators, but at most ``window`` characters on either side; in order, merged."""
    found = []
    for p in allow:
        for m in p.finditer(text):
            a, b = m.span()
            if a == b:
                continue
            low, high = max(0, a - window), min(len(text), b + window)
            if text[a] not in SEPARATORS:
                while a > low and text[a - 1] not in SEPARATORS:
                    a -= 1
            if text[b - 1] not in SEPARATORS:
                while b < high and text[b] not in SEPARATORS:
                    b += 1
            found.append((a, b))
    out = []
    for a, b in sorted(found):
        if out and out[-1][1] >= a:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def entropy_spans(text: str, start: int, rules: EntropyRules, gains: list[float], skip: Sequence[tuple[int, int]] = ()) -> list[tuple[int, int]]:
    """Merged windows of ``text`` at or over its class's threshold, shifted by ``start``;
    windows that overlap a range of ``skip`` (in order) are left out.

    ``gains[c]`` is ``c * log2(c)``; with the sum S of it over the window's
    counts, the entropy is ``log2(w) - S / w``."""
    w = rules.window
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", text):
        least = rules.hex_bits
    elif text.isalnum():
        least = rules.alnum_bits
    else:
        least = rules.base64_bits
    most = w * (math.log2(w) - least) + 1e-9
    counts: dict[str, int] = {}
    total, out = 0.0, []
    ranges = iter(skip)
    low, high = next(ranges, (len(text), len(text)))
    for i, ch in enumerate(text):
        c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += gains[c + 1] - gains[c]
        if i >= w:
            old = text[i - w]
            c = counts[old]
            counts[old] = c - 1
            total += gains[c - 1] - gains[c]
        while i - w + 1 >= high and high < len(text):
            low, high = next(ranges, (len(text), len(text)))
        if i >= w - 1 and total <= most and i < low:
            a, b = start + i - w + 1, start + i + 1
            if out and out[-1][1] >= a:
                out[-1] = (out[-1][0], b)
            else:
                out.append((a, b))
    return out


def scanner(rules: EntropyRules):
    """A function from a text to its spans, by start and then by kind."""
    candidate = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % rules.window)
    mixed = re.compile(r"[A-Za-z][^0-9]*[0-9]|[0-9][^A-Za-z]*[A-Za-z]")
    whole = [re.compile(p) for p in rules.allow if r"\A" in p and p.endswith(r"\Z")]
    allow = [re.compile(p) for p in rules.allow if not (r"\A" in p and p.endswith(r"\Z"))]
    gains = [c * math.log2(c) if c else 0.0 for c in range(rules.window + 2)]
    rank = {k: i for i, k in enumerate(KINDS)}

    def scan(text: str) -> list[tuple[str, int, int]]:
        found = []
        if ASSIGN_WORD.search(text):
            found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
        if "AKIA" in text:
            found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
        found += [("hex", *m.span()) for m in HEX.finditer(text)]
        for m in candidate.finditer(text):
            if mixed.search(m[0]) and not any(a.search(m[0]) for a in whole):
                skip = excluded(m[0], allow, rules.window)
                found += [("entropy", a, b) for a, b in entropy_spans(m[0], m.start(), rules, gains, skip)]
        return sorted(found, key=lambda s: (s[1], rank[s[0]], s[2]))

    return scan


def find_secrets(docs: DataFrame, rules: EntropyRules = EntropyRules(), id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, spans): the secrets of each row's text, positions in code points, end exclusive."""

    def make():
        scan = scanner(rules)
        return lambda text: ([dict(zip(("kind", "start", "end"), s, strict=True)) for s in scan(text)],)

    return rowwise(docs, make, SPANS, id_col, text_col)


def mask_secrets(docs: DataFrame, rules: EntropyRules = EntropyRules(), mask: str = "[SECRET]",
                 text_col: str = "text") -> DataFrame:
    """``docs`` with each secret replaced by ``mask``; overlapping spans become
    one. Null texts stay null, and the other columns stay as they are."""

    @F.pandas_udf("string")
    def masked(texts):
        scan = scanner(rules)

        def one(text):
            if text is None:
                return None
            out, at = [], 0
            for _, a, b in scan(text):
                if a >= at:
                    out += [text[at:a], mask]
                at = max(at, b)
            return "".join(out) + text[at:] if out else text

        return texts.map(one)

    return docs.withColumn(text_col, masked(F.col(text_col)))
