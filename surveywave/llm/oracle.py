"""DuckDB SQL of the training-data queries that SQL can express, written from the
contracts with plain grouping, windows and recursion."""

from __future__ import annotations

# The CRC-32 of an ASCII string, bit by bit: a byte is added, then eight shifts.
_CRC32 = ("xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}, ''), "
          "lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), "
          "lambda r, b: CASE WHEN b >= 0 THEN xor(r, b) ELSE xor(r >> 1, 3988292384 * (r & 1)) END), 4294967295)")
_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n
  FROM documents),
k AS (
  SELECT doc_id, n,
         first_value(doc_id) OVER w AS keep_id,
         row_number() OVER w AS place,
         count(*) OVER (PARTITION BY n) AS group_size
  FROM d
  WINDOW w AS (PARTITION BY n ORDER BY length(t) DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(n) AS text_sha256 FROM k
"""


def _field(x: str) -> str:
    return f"coalesce(strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR, '-')"


_HEAD = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
# Nodes of a forest with the digests on either side inside their run of three.
_SIDES = """
  SELECT tree, lvl, pos, digest, n,
         string_agg(digest, '' ORDER BY pos) OVER (PARTITION BY tree, lvl, pos // 3 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,
         string_agg(digest, '' ORDER BY pos) OVER (PARTITION BY tree, lvl, pos // 3 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r
  FROM {0}"""
_LEVELS = """
  SELECT tree, 0 AS lvl, pos, digest, n FROM {0}
  UNION ALL
  SELECT tree, lvl + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), max(n + 2) // 3
  FROM {1} WHERE n > 1 GROUP BY tree, lvl, pos // 3"""

OP11_SQL = f"""
WITH RECURSIVE
d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, sha256({_HEAD} || {_field('text')}) AS leaf,
         sha256({_HEAD} || {_field("CASE WHEN coalesce(" + _CRC32.format("doc_id::VARCHAR") + ", 1) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")}) AS seen
  FROM documents),
s AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM d)),
leaves AS (
  SELECT rid, doc_id, leaf, seen, leaf AS digest, tree,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
low AS ({_LEVELS.format('leaves', 'low')}),
low_sides AS ({_SIDES.format('low')}),
subroots AS (SELECT 0 AS tree, tree AS pos, digest, count(*) OVER () AS n FROM low WHERE n = 1),
high AS ({_LEVELS.format('subroots', 'high')}),
high_sides AS ({_SIDES.format('high')}),
up AS (
  SELECT rid, tree, 0 AS lvl, pos, seen AS folded, '' AS proof FROM leaves
  UNION ALL
  SELECT u.rid, u.tree, u.lvl + 1, u.pos // 3, sha256(coalesce(x.l, '') || u.folded || coalesce(x.r, '')), u.proof || coalesce(x.l, '') || coalesce(x.r, '')
  FROM up u JOIN low_sides x USING (tree, lvl, pos) WHERE x.n > 1),
at_subroot AS (SELECT u.* FROM up u JOIN low x USING (tree, lvl, pos) WHERE x.n = 1),
over AS (
  SELECT rid, 0 AS lvl, tree AS pos, folded, proof FROM at_subroot
  UNION ALL
  SELECT u.rid, u.lvl + 1, u.pos // 3, sha256(coalesce(x.l, '') || u.folded || coalesce(x.r, '')), u.proof || coalesce(x.l, '') || coalesce(x.r, '')
  FROM over u JOIN high_sides x USING (lvl, pos) WHERE x.n > 1),
done AS (SELECT u.*, x.digest AS root FROM over u JOIN high x USING (lvl, pos) WHERE x.n = 1)
SELECT doc_id, leaf, b.digest AS subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM leaves JOIN done USING (rid) JOIN subroots b ON b.pos = leaves.tree
"""

# Buckets of the sketches: values under 64 stand alone, then 32 buckets a doubling.
_SHIFT = "(length(bin({0})) - 6)"
_BUCKET = f"CASE WHEN {{0}} < 64 THEN {{0}} ELSE 32 * {_SHIFT} + ({{0}} >> {_SHIFT}) END"
_LOW = "CASE WHEN bucket < 64 THEN bucket ELSE (bucket - 32 * (bucket // 32 - 1)) << (bucket // 32 - 1) END"
_HIGH = f"({_LOW}) + CASE WHEN bucket < 64 THEN 0 ELSE (1::BIGINT << (bucket // 32 - 1)) - 1 END"

OP12_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT rid, g.i AS i, count(*) OVER (PARTITION BY rid, g.words) AS times
  FROM (SELECT rid, unnest(list_transform(range(1, len(w) - 6), lambda i: {{'i': i, 'words': array_to_string(w[i:i + 7], ' ')}})) AS g FROM d)),
repeated AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM windows WHERE times > 1) GROUP BY rid),
m AS (
  SELECT d.rid, doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines
  FROM d LEFT JOIN repeated USING (rid)),
v AS (
  SELECT rid, lang, source, unnest(['word_length', 'symbol_share', 'dup_line_share', 'repeat_share']) AS rule,
         unnest([CASE WHEN n_words > 0 THEN 1000 * word_chars // n_words END, CASE WHEN word_chars > 0 THEN 10000 * n_symbols // word_chars END,
                 CASE WHEN n_lines > 0 THEN 10000 * n_dup_lines // n_lines END, CASE WHEN n_words > 0 THEN 10000 * n_repeat_words // n_words END]) AS value
  FROM m),
b AS (SELECT *, {_BUCKET.format('value')} AS bucket FROM v WHERE value IS NOT NULL),
-- a document counts in its own group, in its language and in the corpus
g AS (
  SELECT lvl, CASE WHEN lvl < 2 THEN lang END AS lang, CASE WHEN lvl < 1 THEN source END AS source, rule, bucket, count(*) AS k
  FROM b, (VALUES (0), (1), (2)) AS levels(lvl) GROUP BY ALL),
r AS (
  SELECT *, sum(k) OVER (PARTITION BY lvl, lang, source, rule ORDER BY bucket) AS upto, sum(k) OVER (PARTITION BY lvl, lang, source, rule) AS n FROM g),
q AS (
  SELECT lvl, lang, source, rule, min({_LOW}) FILTER (4 * upto >= n) AS q1, min({_HIGH}) FILTER (4 * upto >= 3 * n) AS q3
  FROM r WHERE n >= 100 GROUP BY ALL),
f AS (
  SELECT lvl, lang, source, rule,
         q3 + 4 * greatest(q3 - q1, CASE rule WHEN 'word_length' THEN 250 WHEN 'symbol_share' THEN 100 WHEN 'dup_line_share' THEN 1000 ELSE 600 END) AS high,
         CASE WHEN rule = 'word_length' THEN q1 - 4 * greatest(q3 - q1, 250) END AS low
  FROM q),
failed AS (
  SELECT DISTINCT v.rid FROM v
  LEFT JOIN f a ON a.lvl = 0 AND a.rule = v.rule AND a.lang IS NOT DISTINCT FROM v.lang AND a.source IS NOT DISTINCT FROM v.source
  LEFT JOIN f l ON l.lvl = 1 AND l.rule = v.rule AND l.lang IS NOT DISTINCT FROM v.lang
  LEFT JOIN f c ON c.lvl = 2 AND c.rule = v.rule
  WHERE v.value > coalesce(a.high, l.high, c.high) OR v.value < coalesce(a.low, l.low, c.low)),
base AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed.rid IS NULL AS kept
FROM base LEFT JOIN failed USING (rid)
"""

_ROLES = ["user", "user", "assistant", "user"]
_NEXT = [2, 2, 3, 2]
_KEPT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]


def _edit(cost: str, initial: str, state: str, line: str | None) -> str:
    turns = f"{state}.o" if line is None else f"list_prepend({line}, {state}.o)"
    return f"{{'c': {cost} + {state}.c, 'a': '{initial}' || {state}.a, 'o': {turns}}}"


def _consumed(q: int) -> str:
    """The best of the edits that consume a row in state q, by cost, then initials."""
    gone = _edit("2", "D", f"s{q}", None)
    named = _edit("1 + extra", "R", f"s{_NEXT[q]}", f"'{_ROLES[q]}:' || text")
    kept = " ".join(f"WHEN initial = '{i}' THEN " + f"[{_edit('extra', 'K', f's{to}', chr(39).join(['role || ', ':', ' || text']))}]"
                    for i, to in _KEPT[q].items())
    return f"list_sort([{gone}] || CASE WHEN must_go THEN [] ELSE [{named}] || CASE {kept} ELSE [] END END)[1]"


def _inserted(q: int) -> str:
    """The best of going on at once, after one insertion, or after two."""
    one = _edit("5", "I", f"b{_NEXT[q]}", f"'{_ROLES[q]}:'")
    then = _NEXT[_NEXT[q]]
    two = f"{{'c': 10 + b{then}.c, 'a': 'II' || b{then}.a, 'o': ['{_ROLES[q]}:', '{_ROLES[_NEXT[q]]}:'] || b{then}.o}}"
    return f"list_sort([b{q}, {one}, {two}])[1]"


OP13_SQL = rf"""
WITH RECURSIVE
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_CRC32.format("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS k
  FROM conversations),
hurt AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM raw WHERE k <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 64), sha256(text), copy) AS i,
         count(*) OVER (PARTITION BY conv_id) AS n, left(role, 1) AS initial
  FROM hurt),
faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'ok' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
seen AS (
  SELECT *, fault IN ('blank', 'duplicate') AS must_go, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS extra FROM faults),
back AS (
  SELECT DISTINCT conv_id, n + 1 AS i, {{'c': 0::BIGINT, 'a': '', 'o': []::VARCHAR[]}} AS s0,
         {{'c': 10::BIGINT, 'a': 'II', 'o': ['user:', 'assistant:']}} AS s1,
         {{'c': 5::BIGINT, 'a': 'I', 'o': ['assistant:']}} AS s2, {{'c': 0::BIGINT, 'a': '', 'o': []::VARCHAR[]}} AS s3
  FROM seen
  UNION ALL
  SELECT conv_id, i, {', '.join(_inserted(q) for q in range(4))}
  FROM (SELECT r.conv_id, r.i, {', '.join(f'{_consumed(q)} AS b{q}' for q in range(4))}
        FROM back JOIN seen r ON r.conv_id IS NOT DISTINCT FROM back.conv_id AND r.i = back.i - 1)),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM seen GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(s0.c, 0) AS cost, coalesce(s0.a, '') AS audit,
       sha256(coalesce(array_to_string(s0.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN back b ON b.conv_id IS NOT DISTINCT FROM e.conv_id AND b.i = 1
"""
