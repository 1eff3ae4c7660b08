"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

from reportloom.llm import licences as lc, rules

DECONTAMINATION = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, list_slice(w, p, p + least(len(w), 13) - 1) AS words
  FROM i, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS t(p) WHERE len(w) > 0),
pos AS (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS p FROM d WHERE len(w) > 0),
hit AS (SELECT doc_id, p, n, item_id FROM pos JOIN win ON pos.w[p] = win.words[1] AND (n = 1 OR pos.w[p + 1] = win.words[2])
  WHERE p + n - 1 <= len(w) AND list_slice(w, p, p + n - 1) = words),
covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS q FROM hit) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

LINES = r"""
WITH lines AS (SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
toks AS (SELECT doc_id, pos, line, list_filter(regexp_split_to_array(regexp_replace(line, '[0-9]+', '<*>', 'g'), '[ \t\r]+'), lambda t: t <> '') AS t FROM lines
  WHERE regexp_replace(line, '[0-9 \t\r]+', '', 'g') <> ''),
parts AS (SELECT doc_id, pos, len(t) AS n, t, line, CASE WHEN len(t) >= 8 THEN list_transform([0, 1, 2, 3], lambda j: list_slice(t, 4 + (len(t) - 3) * j // 4, 3 + (len(t) - 3) * (j + 1) // 4)) END AS p FROM toks),
often AS (SELECT t, min(doc_id) AS first FROM parts GROUP BY t HAVING count(DISTINCT doc_id) >= CASE WHEN max(n) >= 8 OR max(length(line)) >= 50 THEN 2 ELSE 10 END),
keyed AS (SELECT doc_id, pos, n, t, i || '-' || j || to_json([list_slice(t, 1, 3), p[i], p[j]]) AS k FROM parts, (VALUES (1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4)) AS u(i, j) WHERE n >= 8),
heads AS (SELECT n, k, arg_min(t, (doc_id, pos)) AS theirs, min(doc_id) AS first FROM keyed GROUP BY n, k HAVING count(DISTINCT t) > 1),
later AS (SELECT DISTINCT t FROM (SELECT t, n, theirs, min(first) AS first, min(doc_id) AS own FROM keyed JOIN heads USING (n, k) GROUP BY 1, 2, 3)
  WHERE first < own AND 100 * len(list_filter(list_zip(t, theirs), lambda x: x[1] = x[2])) >= 85 * n),
rec AS (SELECT t, min(first) AS first FROM (SELECT * FROM often UNION ALL SELECT t, -1 AS first FROM later) GROUP BY t),
gone AS (SELECT DISTINCT doc_id, pos, n FROM parts JOIN rec USING (t) WHERE first < doc_id),
kept AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) AS text FROM lines l ANTI JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY 1),
lost AS (SELECT doc_id, count(*) AS n_dropped, sum(n) AS n_tokens FROM gone GROUP BY 1)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text, CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines,
  coalesce(lost.n_dropped, 0) AS n_dropped, CAST(coalesce(len(list_filter(regexp_split_to_array(d.text, '[ \t\r\n]+'), lambda t: t <> '')), 0) AS BIGINT) AS n_tokens,
  CAST(coalesce(lost.n_tokens, 0) AS BIGINT) AS n_dropped_tokens
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""


_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F«»“”‘’„—–…]+"


def _canonical(text: str) -> str:
    bare = f"regexp_replace(regexp_replace(lower({text}), '{lc.COPYRIGHT_LINE}', '', 'g'), '{_NOT_WORD}', ' ', 'g')"
    for other, one in lc.EQUIVALENT:
        bare = f"replace({bare}, '{other}', '{one}')"
    return f"trim({bare})"


def _digest(text: str) -> str:
    return f"CASE WHEN {_canonical(text)} <> '' THEN sha256({_canonical(text)}) END"


LICENCES = f"""
WITH known AS (SELECT DISTINCT licence, {_digest("text")} AS digest FROM (VALUES {", ".join(f"('{n}', '{t}')" for n, t in lc.KNOWN)}) AS k(licence, text)),
d AS (SELECT doc_id, text, {_digest("text")} AS digest FROM documents),
l AS (SELECT doc_id, {_digest("line")} AS digest FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)),
n AS (SELECT doc_id, string_agg(licence, ',' ORDER BY licence) AS notices FROM (SELECT DISTINCT doc_id, licence FROM l JOIN known USING (digest)) GROUP BY 1)
SELECT doc_id, d.digest, (SELECT min(licence) FROM known WHERE known.digest = d.digest) AS licence, coalesce(n.notices, '') AS notices
FROM d LEFT JOIN n USING (doc_id)
"""

_VALUES = {"symbols": "n_symbols / n_words", "repeats": "n_repeat_words / n_words", "dup_lines": "n_dup_lines / n_lines", "word_length": "word_chars / n_words"}
_GRID = ", ".join(f"('{r}', {c})" for r, cuts in rules.CUTOFFS.items() for c in cuts)
_RATE = rules.LIMIT / len(rules.CUTOFFS)
RULES = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
win AS (SELECT doc_id, p, list_slice(w, p, p + 2) AS x FROM d, unnest(generate_series(1, len(w) - 2)) AS t(p)),
twice AS (SELECT doc_id, x FROM win GROUP BY 1, 2 HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT q) AS n_repeat_words FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM win JOIN twice USING (doc_id, x)) GROUP BY 1),
m AS (SELECT doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)),
v AS ({" UNION ALL ".join(f"SELECT doc_id, stratum, '{r}' AS rule, coalesce(CAST({e.split(' / ')[0]} AS DOUBLE) / nullif({e.split(' / ')[1]}, 0), 0) AS value FROM m" for r, e in _VALUES.items())}),
good AS (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY 1 HAVING min(quality) = 1),
held AS (SELECT stratum, rule, cutoff, count(*) AS n, count(*) FILTER (value > cutoff) AS k
  FROM v SEMI JOIN good USING (doc_id) JOIN (VALUES {_GRID}) AS g(rule, cutoff) USING (rule) GROUP BY 1, 2, 3),
tail AS (SELECT stratum, rule, cutoff, list_sum(list_transform(generate_series(0, k), lambda i:
    exp(lgamma(n + 1) - CASE WHEN i = 0 THEN 0 ELSE lgamma(i + 1) END - CASE WHEN i = n THEN 0 ELSE lgamma(n - i + 1) END + i * ln({_RATE}) + (n - i) * ln(1 - {_RATE})))) AS p
  FROM held WHERE k <= n * {_RATE}),
cut AS (SELECT stratum, rule, min(cutoff) AS cutoff FROM tail
  WHERE p <= {rules.RISK} / ((SELECT count(DISTINCT stratum) FROM m) * {sum(map(len, rules.CUTOFFS.values()))}) GROUP BY 1, 2),
bad AS (SELECT DISTINCT doc_id FROM v JOIN cut USING (stratum, rule) WHERE value > cutoff)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND bad.doc_id IS NULL AS kept
FROM m LEFT JOIN bad ON m.doc_id = bad.doc_id
"""

_ESCAPE = "replace(replace({}, '&', '&amp;'), '<|', '&lt;|')"
CHATS = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>' || replace({_ESCAPE.format("role")}, chr(10), '&#10;') || chr(10) || {_ESCAPE.format("text")} || '<|im_end|>' || chr(10))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

JACCARD = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, p, p + 3), ' ') AS shingle
  FROM d, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS t(p) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
half AS (SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 85 * (a.n + b.n - i)),
link AS MATERIALIZED (SELECT x, y FROM half UNION ALL SELECT y, x FROM half),
reach AS (SELECT doc_id, doc_id AS to_id FROM documents UNION SELECT r.doc_id, l.y FROM reach r JOIN link l ON r.to_id = l.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT count(*) FROM link WHERE x = d.doc_id) AS n_links,
  (SELECT min(to_id) FROM reach WHERE reach.doc_id = d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id)
"""

SUFFIXES = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, unnest(generate_series(0, len(h) // 2 - 100)) AS p, h FROM d WHERE len(h) >= 200),
s AS (SELECT doc_id, p, md5_number(substr(h, 2 * p + 1, 200)) AS s FROM p),
again AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS n FROM s) WHERE n > 1),
span AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM (SELECT doc_id, p, sum(opens) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM
  (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 100 THEN 0 ELSE 1 END AS opens FROM again)) GROUP BY doc_id, run),
parts AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS kept_from FROM span),
gone AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last FROM parts GROUP BY 1),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * kept_from + 1, 2 * (a - kept_from)), '' ORDER BY a) AS kept FROM parts JOIN d USING (doc_id) GROUP BY 1)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

PHRASES = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM pieces),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM (SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
  FROM w, (VALUES (1), (2), (3)) AS ks(k), unnest(generate_series(1, len(w) - k + 1)) AS t(i)) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY 1),
c AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
often AS MATERIALIZED (SELECT lang, phrase, f FROM f WHERE f >= 10),
ways AS (SELECT lang, k, phrase, a, j, array_to_string(list_slice(w, 1, j), ' ') AS first, array_to_string(list_slice(w, j + 1, k), ' ') AS rest
  FROM c, (VALUES (1), (2)) AS js(j) WHERE j < k),
cut AS (SELECT ways.lang, k, ways.phrase, a, j, x.f AS l, y.f AS r, CAST(1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM ways JOIN often x ON x.lang = ways.lang AND x.phrase = first JOIN often y ON y.lang = ways.lang AND y.phrase = rest),
weak AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS nth FROM cut),
around AS (SELECT lang, phrase, max(a) AS longer FROM (SELECT lang, a, array_to_string(list_slice(w, s, s + 1), ' ') AS phrase FROM c, (VALUES (1), (2)) AS ss(s) WHERE k = 3) GROUP BY 1, 2),
best AS (SELECT lang, phrase, a, l, r, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM weak LEFT JOIN around USING (lang, phrase) WHERE nth = 1 AND NOT (k = 2 AND coalesce(100 * longer >= 50 * a, false)))
SELECT lang, rank, phrase, a, l, r, n, score FROM best JOIN n USING (lang) WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op1_line_dedup": LINES,
    "op2_decontamination": DECONTAMINATION,
    "op5_license_scan": LICENCES,
    "op7_quality_rules": RULES,
    "op8_chat_format": CHATS,
    "op9_jaccard": JACCARD,
    "op12_suffix_dedup": SUFFIXES,
    "op13_collocations": PHRASES,
}
