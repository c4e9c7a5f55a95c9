"""DuckDB SQL for the queries of this package that SQL can express."""

from lakestrata.llm.quality import MAX_REPEAT_PERCENT, MIN_WORDS, RULES, STOP_WORDS

SQL: dict[str, str] = {}

BLANK = r"[\x20\x09-\x0D]+"
WORDS = rf"list_filter(string_split_regex(coalesce(text, ''), '{BLANK}'), lambda x: x <> '')"


def _verdict() -> str:
    """The table of thresholds as one condition."""
    parts = []
    for r in RULES:
        bounds = [f"{r.per} * {r.over} >= {r.least} * {r.under}"] * (r.least is not None)
        bounds += [f"{r.per} * {r.over} <= {r.most} * {r.under}"] * (r.most is not None)
        parts.append(f"(({' AND '.join(bounds)})" + (f" OR {r.under} < {r.from_}" if r.from_ else "") + ")")
    return " AND ".join(parts)


_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)

SQL["op1_quality_rules"] = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t, {WORDS} AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
win AS (
  SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS g
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM d WHERE len(ws) >= 8)),
again AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
rep AS (
  SELECT r, sum(least(8, coalesce(nxt - i, 8))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM again) GROUP BY r),
m AS (
  SELECT d.doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
    len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
    len(list_filter(ws, lambda x: regexp_matches(x, '\pL'))) AS n_letter_words,
    len(list_filter(ws, lambda x: lower(translate(x, '.,;:!?', '')) IN ({_STOPS}))) AS n_stop_words,
    len(list_filter(ws, lambda x: length(x) > 1 AND regexp_matches(x, '\p{{Lu}}') AND NOT regexp_matches(x, '\p{{Ll}}'))) AS n_shouted,
    len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis_lines,
    len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[•‣▪*-]\x20'))) AS n_bullet_lines
  FROM d LEFT JOIN rep ON rep.r = d.r),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND {_verdict()} AS kept
FROM f
"""

# Windows of an earlier document, merged into spans; what lies between spans is kept.
_SPANS = """
first AS (SELECT g, min(doc_id) AS first_id FROM win GROUP BY g),
hit AS (SELECT w.r, w.i FROM win w JOIN first f ON f.g = w.g WHERE w.doc_id > f.first_id),
isle AS (
  SELECT r, i, sum(CASE WHEN i > p + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS k
  FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS p FROM hit)),
span AS (SELECT r, k, min(i) AS a, max(i) + 50 AS b FROM isle GROUP BY r, k),
total AS (SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed FROM span GROUP BY r),
gap AS (
  SELECT r, lag(b, 1, CAST(1 AS BIGINT)) OVER (PARTITION BY r ORDER BY a) AS a, a AS b FROM span
  UNION ALL
  SELECT d.r, coalesce(max(s.b), 1), d.n + 1 FROM d LEFT JOIN span s ON s.r = d.r GROUP BY d.r, d.n)"""

SQL["op3_substring_dedup"] = rf"""
WITH d AS (SELECT doc_id, r, ws, len(ws) AS n FROM (SELECT doc_id, row_number() OVER () AS r, {WORDS} AS ws FROM documents)),
win AS (
  SELECT r, doc_id, i, array_to_string(ws[i:i + 49], ' ') AS g
  FROM (SELECT r, doc_id, ws, unnest(range(1, n - 48)) AS i FROM d WHERE n >= 50)),
{_SPANS},
kept AS (
  SELECT d.r, coalesce(string_agg(array_to_string(d.ws[g.a:g.b - 1], ' '), ' ' ORDER BY g.a) FILTER (WHERE g.b > g.a), '') AS k
  FROM d JOIN gap g ON g.r = d.r GROUP BY d.r)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_words, CAST(coalesce(t.n_removed, 0) AS BIGINT) AS n_removed,
  sha256(k.k) AS kept_sha256
FROM d JOIN kept k ON k.r = d.r LEFT JOIN total t ON t.r = d.r
"""

SQL["op9_suffix_dedup"] = f"""
WITH d AS (
  SELECT doc_id, r, x, length(x) // 2 AS n
  FROM (SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS x FROM documents)),
win AS (
  SELECT r, doc_id, i, substr(x, 2 * i - 1, 100) AS g
  FROM (SELECT r, doc_id, x, unnest(range(1, n - 48)) AS i FROM d WHERE n >= 50)),
{_SPANS},
kept AS (
  SELECT d.r, coalesce(string_agg(substr(d.x, 2 * g.a - 1, 2 * (g.b - g.a)), '' ORDER BY g.a) FILTER (WHERE g.b > g.a), '') AS k
  FROM d JOIN gap g ON g.r = d.r GROUP BY d.r)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, CAST(coalesce(t.n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(t.n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(k.k)) AS kept_sha256
FROM d JOIN kept k ON k.r = d.r LEFT JOIN total t ON t.r = d.r
"""

SQL["op2_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS uid,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (
  SELECT q.vec_id AS query_id, q.uid AS q_uid, d.vec_id AS vec_id, d.uid AS uid,
         CAST(list_inner_product(q.e, d.e) AS BIGINT) AS score
  FROM v q JOIN v d ON q.uid <> d.uid
  WHERE q.vec_id % 50 = 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY q_uid ORDER BY score DESC, vec_id, uid) AS rk FROM s)
SELECT query_id, CAST(rk AS INTEGER) AS rank, vec_id, score FROM r WHERE rk <= 5
"""

# CRC-32 bit by bit, as SQL has no function for it.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
  lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))))"""

SQL["op11_prefix_trie"] = f"""
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, length(coalesce(text, '')) AS chars, turn,
         sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, said) - 1 AS pos FROM t),
conv AS (SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS base, {_CRC} % 6 AS h FROM t),
built AS (
  SELECT c.conv_id, o.pos AS k, 0 AS part, o.said, o.chars FROM conv c JOIN own o ON o.conv_id = c.base AND o.pos < c.h
  UNION ALL
  SELECT c.conv_id, o.pos, 1, o.said, o.chars FROM conv c JOIN own o ON o.conv_id = c.conv_id AND o.pos >= c.h),
path AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(said, '/') OVER w AS p, chars
  FROM built WINDOW w AS (PARTITION BY conv_id ORDER BY part, k)),
every AS (SELECT conv_id, depth, p, chars FROM path UNION ALL SELECT conv_id, 0, '', 0 FROM conv),
len AS (SELECT conv_id, max(depth) AS n FROM every GROUP BY conv_id),
node AS (
  SELECT e.p, e.depth, min(e.conv_id) AS conv_id, count(*) AS n_convs, any_value(e.chars) AS chars,
         coalesce(string_agg(CAST(e.conv_id AS VARCHAR), ',' ORDER BY e.conv_id) FILTER (WHERE len.n = e.depth), '') AS ends
  FROM every e JOIN len ON len.conv_id = e.conv_id GROUP BY e.p, e.depth),
up AS (
  SELECT n.p, a.p AS ap FROM node n JOIN every e ON e.conv_id = n.conv_id AND e.depth <= n.depth JOIN node a ON a.p = e.p AND a.depth = e.depth),
kids AS (
  SELECT a.p AS ap, n.p FROM node n JOIN every e ON e.conv_id = n.conv_id AND e.depth = n.depth - 1 JOIN node a ON a.p = e.p AND a.depth = e.depth),
kid AS (SELECT ap, count(*) AS n FROM kids GROUP BY ap),
sums AS (
  SELECT u.ap, sum(CASE WHEN k.n IS NULL THEN 1 ELSE 0 END) AS leaves, sum((n.n_convs - 1) * n.chars) AS saved
  FROM up u JOIN node n ON n.p = u.p LEFT JOIN kid k ON k.ap = u.p GROUP BY u.ap)
SELECT n.conv_id, n.depth, a.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(k.n, 0) AS BIGINT) AS n_children,
  CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM node n JOIN sums s ON s.ap = n.p LEFT JOIN kid k ON k.ap = n.p
LEFT JOIN kids q ON q.p = n.p LEFT JOIN node a ON a.p = q.ap
"""
