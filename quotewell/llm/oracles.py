"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

import string

from quotewell.llm.secret_scan import BASE, RULES

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def _components(k: int, num: int, columns: str = "") -> str:
    """Groups of documents whose sets of k-word shingles have a Jaccard similarity of num percent or more."""
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS l FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(l) = 0 THEN [] WHEN len(l) < {k} THEN [array_to_string(l, ' ')]
        ELSE list_transform(range(1, len(l) - {k - 2}), lambda i: array_to_string(l[i:i + {k - 1}], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
meet AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM meet JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * o >= {num} * (p.n + q.n - o)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT x, y FROM edges UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(min(r.y), d.doc_id)) AS component_id{columns}
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach r ON r.x = d.doc_id GROUP BY d.doc_id, n.n"""


NGRAM_JOIN = _components(4, 85)
MINHASH = _components(2, 80, ", d.doc_id = least(d.doc_id, coalesce(min(r.y), d.doc_id)) AS kept")

CHAT = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn NULLS FIRST, r, x)) AS turns_sha256,
  CAST(sum(CASE WHEN r = 'assistant' THEN length(x) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(x, '' ORDER BY turn NULLS FIRST, r, x) FILTER (r = 'assistant'), '')) AS loss_sha256,
  CAST(sum(14 + length(regexp_replace(r, '([\\#<:])', 'x\1', 'g')) + length(regexp_replace(x, '([\\#<])', 'x\1', 'g'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""


def _hits(place: int) -> str:
    rule = RULES[place]
    pattern = "'" + rule.pattern.replace("'", "''") + "'"
    return f"""SELECT doc_id, {place} AS place, '{rule.kind}' AS kind, {rule.least} AS least, string_split_regex(t, {pattern}) AS s,
        regexp_extract_all(t, {pattern}, 0) AS m, regexp_extract_all(t, {pattern}, {rule.group}) AS v
        FROM d WHERE regexp_matches(t, {pattern})"""


_LINE = "coalesce(string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, place) FILTER ({}), '')"
SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
h AS ({" UNION ALL ".join(_hits(i) for i in range(len(RULES)))}),
i AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM h),
f AS (SELECT doc_id, place, kind, CAST(list_sum(list_transform(s[1:i], lambda z: length(z))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda z: length(z))), 0) AS BIGINT) AS a,
        length(m[i]) AS size FROM i WHERE length(v[i]) >= least),
e AS (SELECT *, a + size AS b FROM f)
SELECT d.doc_id, {", ".join(f"count(*) FILTER (place = {i}) AS n_{r.kind}" for i, r in enumerate(BASE))},
  sha256({_LINE.format(f"place < {len(BASE)}")}) AS base_sha256, {_LINE.format("place IS NOT NULL")} AS spans
FROM d LEFT JOIN e USING (doc_id) GROUP BY d.doc_id"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT *, strlen(h) AS n, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest, CASE WHEN n >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id < top THEN top END AS refers_to FROM q"""


def _windows(k: int) -> str:
    """Words in k-word windows that a text has twice or more."""
    return f"""SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + {k})) AS j FROM (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM (
          SELECT doc_id, i, array_to_string(l[i:i + {k - 1}], ' ') AS s FROM (SELECT doc_id, l, unnest(range(1, len(l) - {k - 2})) AS i FROM w))) WHERE c > 1) GROUP BY doc_id"""


QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, {_WORDS.format("t")} AS l FROM d),
three AS ({_windows(3)}), twenty AS ({_windows(20)}),
lines AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id),
b AS (SELECT d.doc_id, w.l, len(w.l) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(lines.n, 0) AS n_dup_lines,
        coalesce(three.n, 0) AS n_repeat_words, coalesce(twenty.n, 0) AS n_passage_words,
        len(w.l) < 50 OR 100 * coalesce(three.n, 0) > 50 * len(w.l) AS base_failed
      FROM d JOIN w USING (doc_id) LEFT JOIN three USING (doc_id) LEFT JOIN twenty USING (doc_id) LEFT JOIN lines USING (doc_id)),
long AS (SELECT doc_id, i, array_to_string(l[i:i + 30], ' ') AS s FROM (SELECT doc_id, l, unnest(range(1, len(l) - 29)) AS i FROM b WHERE NOT base_failed)),
pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS gap FROM long x JOIN long y ON x.doc_id = y.doc_id AND x.s = y.s AND x.i < y.i),
runs AS (SELECT doc_id, max(n) + 30 AS longest FROM (SELECT doc_id, gap, start, count(*) AS n FROM (
           SELECT doc_id, gap, i - row_number() OVER (PARTITION BY doc_id, gap ORDER BY i) AS start FROM pairs) GROUP BY ALL) GROUP BY doc_id)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_passage_words <= 0.2 * n_words AND NOT (coalesce(longest, 0) > 30 AND coalesce(longest, 0) > 0.05 * n_words) AS kept
FROM b LEFT JOIN runs USING (doc_id)"""



def _written(*columns: str) -> str:
    """A row's leaf: its columns with their lengths, or - for null."""
    return "sha256(" + " || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in columns) + ")"


_ID, _CHARS = "CAST(doc_id AS VARCHAR)", "CAST(n_chars AS VARCHAR)"
# CRC-32 of the decimal digits, a bit a step; its lowest bit tells who is tampered with.
_BITS = f"""list_reduce(list_prepend(4294967295, flatten(list_transform(range(1, length({_ID}) + 1), lambda i: [CAST(ascii(substr({_ID}, i, 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
        lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1)))"""
MERKLE = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce('=' || source, '') AS g, {_written(_ID, "source", "lang", _CHARS, "text")} AS leaf,
        {_written(_ID, "source", "lang", _CHARS, f"CASE WHEN xor({_BITS}, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS found FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d),
up AS (SELECT g, 0 AS l, i, n, leaf AS h FROM o
  UNION ALL SELECT g, l + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY g, l, i // 3, n),
s AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1),
high AS (SELECT 0 AS l, i, n, subroot AS h FROM s
  UNION ALL SELECT l + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM high WHERE n > 1 GROUP BY l, i // 3, n),
steps AS (SELECT a.g, a.l, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS x, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS y
  FROM up a JOIN up b ON a.g = b.g AND a.l = b.l AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY a.g, a.l, a.i),
tops AS (SELECT a.l, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS x, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS y
  FROM high a JOIN high b ON a.l = b.l AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY a.l, a.i),
p AS (SELECT o.g, o.i AS leaf_i, t.l, t.x, t.y FROM o JOIN steps t ON t.g = o.g AND t.i = o.i // CAST(pow(3, t.l) AS BIGINT)
  UNION ALL SELECT o.g, o.i, 1000 + t.l, t.x, t.y FROM o JOIN s USING (g) JOIN tops t ON t.i = s.i // CAST(pow(3, t.l) AS BIGINT)),
q AS (SELECT g, leaf_i, list(struct_pack(x := x, y := y) ORDER BY l) AS path FROM p GROUP BY ALL),
f AS (SELECT doc_id, leaf, o.g, coalesce(path, []) AS path, 0 AS done, found AS node FROM o LEFT JOIN q ON q.g = o.g AND q.leaf_i = o.i),
fold AS (SELECT doc_id, leaf, g, path, 1 AS k, node FROM f
  UNION ALL SELECT doc_id, leaf, g, path, k + 1, sha256(path[k].x || node || path[k].y) FROM fold WHERE k <= len(path)),
r AS (SELECT h AS root FROM high WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda z: z.x || z.y), '')) AS proof_sha256, node AS folded_root, node = root AS verified
FROM fold JOIN s USING (g), r WHERE k = len(path) + 1"""

ORACLES = {"op11_minhash": MINHASH, "op12_merkle": MERKLE, "op4_ngram_join": NGRAM_JOIN, "op6_chat": CHAT, "op7_secrets": SECRETS, "op8_warc": WARC, "op10_quality": QUALITY}
