import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lakestrata.llm import prefix_trie
from tests.llm.cases import clashing

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = tuple(own.get(base, [])[:h] + ts[h:])
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    out = []
    for path, ids in members.items():
        under = [p for p in members if p[: len(path)] == path]
        children = [p for p in under if len(p) == len(path) + 1]
        leaves = [p for p in under if not any(q != p and q[: len(p)] == p for q in under)]
        ends = ",".join(str(c) for c in ids if len(built[c]) == len(path))
        out.append((ids[0], len(path), members[path[:-1]][0] if path else None, len(ids), len(children), len(leaves),
                    sum((len(members[p]) - 1) * len(p[-1][1]) for p in under if p), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, n=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(n)
    got = prefix_trie.prefix_trie(clashing(df).withColumns({c: F.lit(0) for c in ("base", "pos", "h", "at", "digest", "chars", "depth")}))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, got.collect()), key=str)


def talk(r, c, n, few=3):
    return [(c, t, r.choice(["user", "assistant"]), f"turn {r.randrange(few)}") for t in range(n)]


@pytest.mark.parametrize("limits", [(2048, 65_536, 4096), (7, 30, 3), (1, 1, 1)])
def test_equals_brute_force(spark, monkeypatch, limits):
    r = random.Random(5)
    rows = [x for c in [*range(0, 40), *range(-8, 0), 100, 105, 250, 251, 10**12] for x in talk(r, c, r.randrange(1, 9))]
    rows += [x for c in range(300, 330) for x in [(c, 0, "user", "hello"), (c, 1, "assistant", "hi")]]  # a third are copies
    for name, value in zip(("MEMBERS", "TURNS", "DEEP"), limits, strict=True):
        monkeypatch.setattr(prefix_trie, name, value)
    # the workers import the module anew, so the limits are also tried in this process
    assert run(spark, rows) == brute(rows)
    flat = prefix_trie.rebuilt(prefix_trie.placed(spark.createDataFrame(rows, SCHEMA))).orderBy("conv_id", "at").collect()
    nodes = sorted(prefix_trie.shard_nodes(map(tuple, flat)), key=lambda x: (x[0], x[3]))
    got = {(x[3], x[2], x[4], x[6]) for x in prefix_trie.merged(nodes)}
    assert got == {(x[0], x[1], x[3], x[7]) for x in brute(rows)}


def test_awkward_rows(spark):
    rows = [(0, None, "user", "first"), (0, 1, None, None), (0, 1, "", ""), (0, 2, "user", "é" * 5), (0, 2, "user", "ab"),
            (7, 0, "user", "one"), (7, 0, "user", "one"), (8, 3, "a", "b"), (9, 3, "ab", ""), (None, 0, "user", "nobody"),
            (205, 0, "user", "x" * 200_000), (206, 0, "user", "x" * 200_000), (207, None, None, None), (499, 0, "user", "alone"), (433, 0, "u", "gone")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    assert run(spark, [(None, 0, "user", "nobody")]) == []


def test_high_chains(spark):
    """Each conversation leaves the one before it a turn later: chains hang in chains."""
    rows = []
    for c in range(100, 140):
        rows += [(c * 100, t, "u", f"{min(t, c - 100)} {'' if t <= c - 100 else c}") for t in range(45)]
    rows += [(c, t, "u", str(c)) for c in (50_001, 50_002) for t in range(300)]
    assert run(spark, rows) == brute(rows)
