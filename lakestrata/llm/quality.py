"""Quality rules: a table of thresholds compiled into one Spark projection.

``measures`` counts words, symbols, lines and stop words with SQL functions
alone; ``RULES`` bounds ratios of those counts, and ``verdict`` turns the table
into one boolean. Ratios are compared by cross-multiplied integers, so there is
no rounding.

Defined results: a null or empty text has no words and fails the base rule;
rows are judged alone, so repeated rows get equal results; an empty table gives
an empty result. Windows of eight words are compared by 64-bit hashes of their
words' 64-bit hashes, within one text only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import BLANKS, boxed, let, unboxed

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Frequent words of the languages at hand; a text in none of them has few.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "with", "on", "was", "this", "be", "it", "by", "are", "as",
    "der", "die", "und", "das", "ein", "eine", "ist", "nicht", "von", "mit", "sich", "auf", "für", "den", "im", "zu",
    "le", "la", "les", "de", "des", "et", "un", "une", "du", "est", "que", "pour", "par", "dans", "qui", "avec", "sur",
    "el", "los", "las", "y", "en", "una", "por", "con", "para", "del", "se", "su", "como", "al",
)


@dataclass(frozen=True)
class Rule:
    """Reject where ``per * over`` is above ``most * under`` (or below ``least * under``)."""

    name: str
    over: str
    under: str
    per: int
    least: int | None = None
    most: int | None = None
    #: Only texts with at least so many of ``under`` are judged.
    from_: int = 0


#: The thresholds; over and under name measures.
RULES = (
    Rule("mean word length", "word_chars", "n_words", 1, least=2, most=20),
    Rule("symbols to words", "n_symbols", "n_words", 100, most=30),
    Rule("words with a letter", "n_letter_words", "n_words", 100, least=60),
    Rule("stop words", "n_stop_words", "n_words", 1000, least=10, from_=50),
    Rule("upper-case words", "n_shouted", "n_words", 100, most=60),
    Rule("repeated lines", "n_dup_lines", "n_lines", 100, most=50),
    Rule("lines that end in an ellipsis", "n_ellipsis_lines", "n_lines", 100, most=50),
    Rule("lines that start with a bullet", "n_bullet_lines", "n_lines", 100, most=90, from_=5),
)


def repeated_words(words: Column, window: int = 8) -> Column:
    """Words covered by a window of ``window`` words (a power of two) that is
    found twice or more among ``words``, the first included."""
    def paired(step: int):
        """Hashes of ``step`` words each to hashes of twice as many."""
        return lambda h: F.when(
            F.size(h) > step,
            F.zip_with(F.slice(h, F.lit(1), F.size(h) - step), F.slice(h, F.lit(step + 1), F.size(h) - step), lambda a, b: F.xxhash64(a, b)),
        ).otherwise(F.array().cast("array<bigint>"))

    hashes, step = F.transform(words, lambda w: F.xxhash64(w)), 1
    while step < window:
        hashes, step = let(hashes, paired(step)), step * 2

    def covered(starts: Column) -> Column:
        """Each start covers the window or as far as the next start."""
        gaps = F.zip_with(starts, F.slice(starts, F.lit(2), F.size(starts)), lambda a, b: F.least(F.lit(window), F.coalesce(b - a, F.lit(window))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, g: total + g)

    def starts(pairs: Column) -> Column:
        """Of (hash, start) in order, the starts whose hash a neighbour has too."""
        n = F.size(pairs)
        before = F.concat(F.array(F.lit(None).cast("bigint")), F.transform(F.slice(pairs, F.lit(1), n - 1), lambda p: p["h"]))
        after = F.transform(F.slice(pairs, F.lit(2), n), lambda p: p["h"])
        sides = F.arrays_zip(pairs.alias("p"), before.alias("b"), after.alias("a"))
        kept = F.filter(sides, lambda s: F.coalesce(s["p"]["h"] == s["b"], F.lit(False)) | F.coalesce(s["p"]["h"] == s["a"], F.lit(False)))
        return F.array_sort(F.transform(kept, lambda s: s["p"]["i"]))

    return let(hashes, lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h),
        let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), lambda p: let(starts(p), covered)),
    ).otherwise(F.lit(0).cast("long")))


def measures(text: Column) -> Column:
    """A struct of the counts that the rules use; null counts as empty."""
    text = F.coalesce(text, F.lit(""))

    def count(words: Column, keep) -> Column:
        return F.size(F.filter(words, keep)).cast("long")

    def of_words(words: Column) -> list[Column]:
        return [
            F.size(words).cast("long").alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
            repeated_words(words).alias("n_repeat_words"),
            count(words, lambda w: w.rlike(r"\p{L}")).alias("n_letter_words"),
            count(words, lambda w: F.lower(F.translate(w, ".,;:!?", "")).isin(*STOP_WORDS)).alias("n_stop_words"),
            count(words, lambda w: (F.length(w) > 1) & w.rlike(r"\p{Lu}") & ~w.rlike(r"\p{Ll}")).alias("n_shouted"),
        ]

    def of_lines(lines: Column) -> list[Column]:
        return [
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            count(lines, lambda x: x.rlike(rf"(?:\.\.\.|…){BLANKS}*\z")).alias("n_ellipsis_lines"),
            count(lines, lambda x: x.rlike(rf"\A{BLANKS}*[•‣▪*-]\x20")).alias("n_bullet_lines"),
        ]

    def of_text(t: Column) -> Column:
        words = F.filter(F.split(t, f"{BLANKS}+"), lambda w: w != "")
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        symbols = (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols")
        return F.struct(
            let(words, lambda w: F.struct(*of_words(w))).alias("w"),
            let(lines, lambda x: F.struct(*of_lines(x))).alias("l"),
            symbols,
        )

    return let(text, of_text)


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """True where every rule of the table holds."""
    ok = F.lit(True)
    for r in rules:
        over, under = F.col(r.over) * r.per, F.col(r.under)
        good = F.lit(True)
        if r.least is not None:
            good &= over >= under * r.least
        if r.most is not None:
            good &= over <= under * r.most
        ok &= good if not r.from_ else (good | (under < r.from_))
    return ok


COUNTS = ("n_words", "word_chars", "n_repeat_words", "n_letter_words", "n_stop_words", "n_shouted")
LINES = ("n_lines", "n_dup_lines", "n_ellipsis_lines", "n_bullet_lines")


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, every measure, base_failed, kept) of each row."""
    m = docs.select(F.col(id_col).alias(id_col), F.inline(F.array(F.struct(measures(F.col(text_col)).alias("m")))))
    flat = m.select(id_col, *[F.col(f"m.w.{c}").alias(c) for c in COUNTS], *[F.col(f"m.l.{c}").alias(c) for c in LINES], F.col("m.n_symbols").alias("n_symbols"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return flat.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the base rule and the table keep, as they are."""
    m = docs.select(F.inline(F.array(F.struct(boxed(docs.columns), measures(F.col(text_col)).alias("m")))))
    flat = m.select("row", *[F.col(f"m.w.{c}").alias(c) for c in COUNTS], *[F.col(f"m.l.{c}").alias(c) for c in LINES], F.col("m.n_symbols").alias("n_symbols"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return flat.filter(~failed & verdict(rules)).select(*unboxed(docs.columns))
