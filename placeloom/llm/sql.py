"""The same results in SQL, written from the definitions: patterns over joined words, deletion neighbours, all pairs of equal word sequences."""
from __future__ import annotations

from placeloom.llm.licences import PHRASES, TEMPLATES, as_pattern, words_of

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _nibble(k: int) -> int:
    """Entry of the half-byte table of crc32 with the reflected polynomial 0xEDB88320."""
    for _ in range(4):
        k = k >> 1 ^ (0xEDB88320 if k & 1 else 0)
    return k


# crc32 half a byte at a time: the digits of a byte's hex code are taken last first.
_TABLE = ", ".join(f"{_nibble(k)}" for k in range(16))


def crc32(text: str) -> str:
    """SQL for the unsigned crc32 of a text's UTF-8 bytes."""
    digits = f"list_transform(range(length(hex(encode({text})))), lambda k: strpos('0123456789ABCDEF', substr(hex(encode({text})), (k + CASE WHEN k % 2 = 0 THEN 2 ELSE 0 END)::BIGINT, 1)) - 1)"
    step = f"lambda c, d: xor(c >> 4, ([{_TABLE}]::BIGINT[])[(xor(c & 15, d) & 15) + 1])"
    return f"xor(list_reduce(list_transform({digits}, lambda d: d::BIGINT), {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


def _phrase(phrase: str) -> str:
    return " AND ".join(f"w[i + {k}] = '{x.decode()}'" for k, x in enumerate(words_of(phrase.encode())))


_QUOTED = lambda s: s.replace("'", "''")
_PLACES = "list_concat(" + ", ".join(f"list_transform(list_filter(range(1, len(w) + 1), lambda i: {_phrase(text)}), lambda i: {{'label': '{label}', 's': i - 1}})" for text, label in PHRASES) + ")"
_FOUND = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(line, '{_QUOTED(as_pattern(text))}') THEN '{label}' END" for _, label, text in TEMPLATES) + "], lambda x: x IS NOT NULL)"

OP11 = f"""
WITH t AS (SELECT doc_id, regexp_extract_all({_FOLD}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
m AS (SELECT doc_id, w, {_PLACES} AS places, ' ' || array_to_string(w, ' ') || ' ' AS line FROM t),
f AS (SELECT *, {_FOUND} AS found FROM m)
SELECT doc_id, len(w)::BIGINT AS n_words, len(places)::BIGINT AS n_base, list_min(list_transform(places, lambda p: p.s))::BIGINT AS first_word,
  list_max(list_transform(places, lambda p: p.s))::BIGINT AS last_word, coalesce(array_to_string(list_sort(list_distinct(list_transform(places, lambda p: p.label))), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(list_transform(places, lambda p: p.label), found))), ','), '') AS labels,
  CASE WHEN len(found) > 0 THEN 1.0 WHEN len(places) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM f"""

OP12 = f"""
WITH RECURSIVE r AS (SELECT coalesce(doc_id::VARCHAR, '') AS d, unnest(regexp_extract_all({_FOLD}, '[a-zÀ-ÿ]+')) AS w FROM documents),
k AS (SELECT d, w, count(*) AS n FROM r WHERE length(w) >= 6 GROUP BY d, w),
h AS (SELECT w, n, {crc32("d || ':' || w")} AS h FROM k),
e AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM h),
v AS (SELECT word, sum(n)::BIGINT AS n FROM e WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
x AS (SELECT word, p, substr(word, 1, p) || substr(word, p + 2) AS cut FROM (SELECT word, unnest(range(length(word))) AS p FROM v)),
near AS (
  SELECT a.word, b.word AS other FROM x a JOIN x b USING (p, cut) WHERE a.word <> b.word
  UNION SELECT x.word, v.word FROM x JOIN v ON v.word = x.cut
  UNION SELECT v.word, x.word FROM x JOIN v ON v.word = x.cut),
best AS (SELECT near.word, count(*) AS n_near, min({{'m': -v.n, 'w': near.other}}) AS b FROM near JOIN v ON v.word = near.other GROUP BY near.word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -b.m >= 5 * v.n THEN b.w END AS form, CASE WHEN -b.m >= 5 * v.n THEN -b.m END::BIGINT AS form_n FROM v LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS root, 0 AS k FROM f UNION ALL SELECT walk.word, f.form, k + 1 FROM walk JOIN f ON f.word = walk.root WHERE f.form IS NOT NULL),
ends AS (SELECT word, max_by(root, k) AS root FROM walk GROUP BY word)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN ends USING (word)"""

# A word sequence of five is in every run at least twice, one period apart: from there neighbours on one lag are put together.
OP13 = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w0, {crc32("coalesce(doc_id::VARCHAR, '')")} AS h FROM documents),
s AS (SELECT *, len(w0) AS n, h // 10 AS g FROM t),
l AS (SELECT r, doc_id, n, w0, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a, CASE WHEN h % 10 = 0 AND n > 0 THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM s),
w AS (SELECT r, doc_id, n, CASE WHEN p IS NULL THEN w0 ELSE list_transform(range(n), lambda i: w0[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM l),
g AS (SELECT r, n, i, hash(w[i + 1], w[i + 2], w[i + 3], w[i + 4], w[i + 5]) AS k FROM (SELECT r, n, w, unnest(range(n - 4)) AS i FROM w)),
pairs AS (SELECT a.r, a.i, b.i - a.i AS q FROM g a JOIN g b ON a.r = b.r AND a.k = b.k AND b.i > a.i AND 4 * (b.i - a.i) <= a.n),
isles AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS isle FROM pairs),
cand AS (SELECT r, q, min(i) AS start, count(*) + 4 + q AS length FROM isles GROUP BY r, q, isle HAVING count(*) + 4 + q >= greatest(6, 4 * q)),
runs AS (SELECT * FROM cand c WHERE NOT EXISTS (SELECT 1 FROM cand d WHERE d.r = c.r AND d.q < c.q AND d.start <= c.start AND d.start + d.length >= c.start + c.length)),
told AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS listed FROM runs GROUP BY r),
top AS (SELECT * FROM runs x WHERE NOT EXISTS (SELECT 1 FROM runs y WHERE y.r = x.r AND (y.length * x.q > x.length * y.q OR y.length * x.q = x.length * y.q AND (y.start < x.start OR y.start = x.start AND y.q < x.q)))),
gone AS (SELECT DISTINCT r, unnest(range(start + q, start + length)) AS i FROM runs),
kept AS (SELECT w.r, string_agg(w.word, ' ' ORDER BY w.i) AS text FROM (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS i FROM w WHERE r IN (SELECT r FROM told)) w ANTI JOIN gone ON gone.r = w.r AND gone.i = w.i GROUP BY w.r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, top.start::BIGINT AS start, top.length::BIGINT AS length, top.q::BIGINT AS period, (1000 * top.length // top.q)::BIGINT AS exponent_milli,
  sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept.text, array_to_string(w.w, ' '), '')) AS collapsed_sha256
FROM w LEFT JOIN told USING (r) LEFT JOIN top USING (r) LEFT JOIN kept USING (r)"""
