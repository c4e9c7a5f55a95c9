"""Documents with every awkward case, for all operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(50)) for _ in range(n))


def awkward():
    """(doc_id, text): nulls, empty and blank texts, a long one, copies, repeated rows, shared passages."""
    shared, base = prose(1, 70), prose(2, 120)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, base), (6, base), (7, base + " and more"), (7, base + " and more"),
            (8, prose(3, 40) + " " + shared + "\n" + prose(4, 30)), (9, shared), (10, shared + " " + prose(5, 30)),
            (11, prose(6, 20_000)), (12, "x " * 400), (13, "x " * 300), (14, "é ü " + prose(7, 60)), (None, base), (None, "null id " + prose(8, 60)),
            (15, "a\x0bb\x0cc\rd\x1ce\x85f\xa0g")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], SCHEMA)


def clashing(df):
    """Extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(
        ["id", "spans", "kept", "ids", "label", "node", "key", "pack", "n_words", "uid", "shard", "row", "m", "class_id", "length", "digest", "r", "order", "copy", "n", "text_"])])
