import re
from collections import Counter

from lakestrata.llm import quality
from tests.llm.cases import awkward, clashing, frame, prose

BLANK = r"[\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    w = [x for x in re.split(BLANK, text) if x]
    seen, cover = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7)), set()
    for i in range(len(w) - 7):
        if seen[tuple(w[i:i + 8])] > 1:
            cover.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover),
            len(w) < 20 or 100 * len(cover) > 30 * len(w))


def test_measures_equal_brute_force(spark):
    line = prose(9, 12)
    rows = awkward() + [(20, f"{line}\n{line}\n\n{line}"), (21, "a b c d e f g h " * 9), (22, "#x %% <y> " + prose(10, 30)), (22, "#x")]
    got = quality.judge(clashing(frame(spark, rows))).collect()
    assert len(got) == len(rows)
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter((r["doc_id"], *(r[c] for c in columns)) for r in got) == Counter((i, *brute(t)) for i, t in rows)
    assert all(not r["kept"] for r in got if r["base_failed"])


def test_rules_reject_junk_and_keep_prose(spark):
    good = "The cat sat on the mat and the dog was in the house with a man that is old. " + prose(1, 30)
    # prose without stop words is short enough not to be judged by them
    rows = [(1, good), (2, " ".join(f"%%{i}** $$" for i in range(60))), (3, " ".join(f"WORD{c}" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))]
    assert [r["kept"] for r in quality.judge(frame(spark, rows)).orderBy("doc_id").collect()] == [True, False, False]


def test_keep_good_returns_rows_as_they_are(spark):
    df = clashing(frame(spark, awkward()))
    kept = quality.keep_good(df)
    assert kept.columns == df.columns
    verdicts = {(r["doc_id"], r["n_words"]) for r in quality.judge(df).filter("kept").collect()}
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in verdicts}


def test_empty_table(spark):
    assert quality.judge(frame(spark, [])).collect() == [] and quality.keep_good(frame(spark, [])).collect() == []
