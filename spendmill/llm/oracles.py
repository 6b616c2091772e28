"""The same results in DuckDB's SQL, written independently of the Spark plans.

Operators that SQL cannot express have no entry; their tests hold them against brute force.
"""

from __future__ import annotations

from spendmill.llm.license_scan import BASE_PHRASES, TEMPLATES
from spendmill.llm.line_dedup import BASE, PRIME
from spendmill.llm.quality_rules import LADDERS, Risk

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)


def license_scan() -> str:
    phrases = _values((label, at, word) for p, label in BASE_PHRASES.items() for at, word in enumerate(p.split()))
    lengths = _values((label, len(p.split())) for p, label in BASE_PHRASES.items())
    postings = _values((name, at, word) for name, t in TEMPLATES.items() for at, word in enumerate(t.words))
    keys = _values((name, t.key_start + j, w) for name, t in TEMPLATES.items() for j, w in enumerate(t.key.split()))
    sizes = _values((name, len(t.words), len(t.key.split())) for name, t in TEMPLATES.items())
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
words AS (SELECT r, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM docs),
phrases(label, pos, word) AS (VALUES {phrases}), lengths(label, n) AS (VALUES {lengths}),
postings(template, pos, word) AS (VALUES {postings}), keys(template, pos, word) AS (VALUES {keys}),
sizes(template, n, n_key) AS (VALUES {sizes}),
base AS (SELECT r, label, i - pos AS start FROM words JOIN phrases ON word = w JOIN lengths USING (label)
  GROUP BY r, label, i - pos HAVING count(*) = max(n)),
base_sum AS (SELECT r, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word FROM base GROUP BY r),
verified AS (SELECT words.r, k.template, i - pos AS start FROM words JOIN keys k ON k.word = w JOIN sizes z USING (template)
  GROUP BY words.r, k.template, i - pos HAVING count(*) = max(n_key)),
shares AS (SELECT v.r, v.template, v.start, count(w.w) / max(z.n) AS share FROM verified v
  JOIN postings p ON p.template = v.template JOIN sizes z ON z.template = v.template
  LEFT JOIN words w ON w.r = v.r AND w.i = v.start + p.pos AND w.w = p.word GROUP BY ALL),
labels AS (SELECT r, string_agg(label, ',' ORDER BY label) AS labels FROM
  (SELECT DISTINCT r, label FROM (SELECT r, label FROM base UNION ALL SELECT r, template FROM verified)) GROUP BY r),
base_labels AS (SELECT r, string_agg(label, ',' ORDER BY label) AS base_labels FROM (SELECT DISTINCT r, label FROM base) GROUP BY r)
SELECT doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  round(coalesce(share, CASE WHEN n_base > 0 THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS score, coalesce(n_found, 0) AS n_found
FROM docs LEFT JOIN base_sum USING (r) LEFT JOIN base_labels USING (r) LEFT JOIN labels USING (r)
LEFT JOIN (SELECT r, max(share) AS share, count(*) AS n_found FROM shares GROUP BY r) USING (r)
"""


def line_dedup() -> str:
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT r, doc_id, md5(text) AS t, len(ls) AS n, unnest(ls) AS l, unnest(range(len(ls))) AS i FROM docs),
hashed AS (SELECT *, ('0x' || substr(md5(l), 1, 7))::BIGINT AS h FROM lines),
rolled AS (SELECT *, (h * {BASE} + lead(h) OVER d) % {PRIME} AS v FROM hashed WINDOW d AS (PARTITION BY r ORDER BY i)),
signed AS (SELECT * EXCLUDE (v), v * sign AS v, sign FROM rolled, (VALUES (1), (-1)) AS signs(sign)),
beside AS (SELECT *, lag(v) OVER d AS p, lead(v) OVER d AS q FROM signed WINDOW d AS (PARTITION BY r, sign ORDER BY i)),
ends AS (SELECT *, i = n - 1 OR (i > 0 AND i < n - 2 AND ((v < p AND v <= q) OR (v = p AND i % 2 = 1))) AS e FROM beside),
numbered AS (SELECT *, sum(e::INT) OVER (PARTITION BY r, sign ORDER BY i) - e::INT AS chunk FROM ends),
chunks AS (SELECT r, sign, doc_id, t, chunk, min(i) AS start, count(*) AS len, string_agg(l, chr(10) ORDER BY i) AS body
  FROM numbered GROUP BY r, sign, doc_id, t, chunk),
copies AS (SELECT *, dense_rank() OVER (PARTITION BY body ORDER BY doc_id NULLS LAST, start) AS k FROM chunks WHERE len > 1),
gone AS (SELECT DISTINCT r, unnest(range(start, start + len)) AS i FROM copies WHERE k > 1),
kept AS (SELECT n.r, string_agg(l, chr(10) ORDER BY n.i) FILTER (g.i IS NULL) AS text, count(g.i) AS n_removed
  FROM lines n LEFT JOIN gone g ON g.r = n.r AND g.i = n.i GROUP BY n.r)
SELECT doc_id, len(ls) AS n_lines, n_removed, coalesce(kept.text, '') AS text FROM docs JOIN kept USING (r)
"""


def substring_dedup(words: int) -> str:
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
starts AS (SELECT r, unnest(range(len(ws) - {words - 1})) AS i, ws FROM docs WHERE len(ws) >= {words}),
windows AS (SELECT r, i, md5(array_to_string(ws[i + 1:i + {words}], ' ')) AS w FROM starts),
again AS (SELECT r, i FROM windows WHERE w IN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1)),
gone AS (SELECT DISTINCT r, i + j AS i FROM again, range({words}) AS o(j)),
words AS (SELECT r, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM docs),
kept AS (SELECT w.r, string_agg(w.w, ' ' ORDER BY w.i) FILTER (g.i IS NULL) AS body, count(g.i) AS n_removed
  FROM words w LEFT JOIN gone g ON g.r = w.r AND g.i = w.i GROUP BY w.r)
SELECT doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""


def suffix_dedup(size: int) -> str:
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
starts AS (SELECT r, unnest(range(octet_length(b) - {size - 1})) AS i, b FROM docs WHERE octet_length(b) >= {size}),
windows AS (SELECT r, i, md5_number(b[i + 1:i + {size}]::VARCHAR) AS w FROM starts),
again AS (SELECT r, i FROM windows WHERE w IN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1)),
runs AS (SELECT r, i, sum((coalesce(i - before, {size} + 1) > {size})::INT) OVER (PARTITION BY r ORDER BY i) AS run
  FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM again)),
spans AS (SELECT r, min(i) AS a, max(i) + {size} AS z FROM runs GROUP BY r, run),
gaps AS (SELECT r, lag(z, 1, 0) OVER (PARTITION BY r ORDER BY a) AS low, a AS high FROM spans
  UNION ALL SELECT r, max(z), NULL FROM spans GROUP BY r),
kept AS (SELECT r, string_agg(hex(b[low + 1:coalesce(high, octet_length(b))]), '' ORDER BY low) AS h
  FROM gaps JOIN docs USING (r) WHERE low < coalesce(high, octet_length(b)) GROUP BY r),
sums AS (SELECT r, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY r)
SELECT doc_id, octet_length(b) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  CASE WHEN sums.r IS NULL THEN sha256(b) ELSE sha256(unhex(coalesce(h, ''))) END AS kept_sha256
FROM docs LEFT JOIN sums USING (r) LEFT JOIN kept USING (r)
"""


def quality_rules() -> str:
    risk = Risk()
    alpha = risk.alpha / len(LADDERS)
    ladder = _values((rule, k, c) for rule, cutoffs in LADDERS.items() for k, c in enumerate(cutoffs))
    stats = {
        "symbols_per_word": "n_symbols / greatest(n_words, 1)",
        "chars_per_word": "word_chars / greatest(n_words, 1)",
        "repeated_lines": "n_dup_lines / greatest(n_lines, 1)",
        "repeated_words": "n_repeat_words / greatest(n_words, 1)",
    }
    long = " UNION ALL ".join(f"SELECT r, doc_id, lang, t, base_failed, '{k}' AS rule, {v} AS x FROM measured" for k, v in stats.items())
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
grams AS (SELECT r, unnest(range(len(ws) - 2)) AS i, ws FROM docs WHERE len(ws) > 2),
named AS (SELECT r, i, array_to_string(ws[i + 1:i + 3], ' ') AS g FROM grams),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM named) WHERE c > 1),
repeats AS (SELECT r, count(DISTINCT i + j) AS n FROM again, range(3) AS o(j) GROUP BY r),
counted AS (SELECT r, doc_id, lang, md5(text) AS t, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, len(ls) AS n_lines,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words FROM docs LEFT JOIN repeats USING (r)),
measured AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted),
long AS ({long}),
good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
held AS (SELECT DISTINCT long.lang, long.t, long.rule, long.x FROM long JOIN good USING (doc_id) WHERE NOT base_failed),
ladder(rule, rung, cutoff) AS (VALUES {ladder}),
counts AS (SELECT lang, rule, rung, cutoff, count(*) AS n, count(*) FILTER (x > cutoff) AS k
  FROM held JOIN ladder USING (rule) GROUP BY ALL),
tested AS (SELECT *, list_sum(list_transform(range(k + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
    + j * ln({alpha}) + (n - j) * ln({1 - alpha})))) <= {risk.delta} /
    ((SELECT count(*) FROM (SELECT DISTINCT lang FROM held)) * {len(LADDERS)}) AS ok FROM counts),
chain AS (SELECT *, bool_and(ok) OVER (PARTITION BY lang, rule ORDER BY rung) AS good_so_far FROM tested),
cutoffs AS (SELECT lang, rule, min(cutoff) AS cutoff FROM chain WHERE good_so_far GROUP BY lang, rule),
verdict AS (SELECT long.r, bool_and(coalesce(x <= cutoff, true)) AS passes
  FROM long LEFT JOIN cutoffs ON cutoffs.rule = long.rule AND cutoffs.lang IS NOT DISTINCT FROM long.lang GROUP BY long.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND passes AS kept
FROM measured JOIN verdict USING (r)
"""


def source_divergence(min_documents: int = 30, top: int = 50) -> str:
    """All kept terms of all sources side by side: dense, without collapsed texts."""
    smooth = "1 + (1000000000::HUGEINT * ({} + 5)) // ({} + 5 * v)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT r, lang, source, unnest(ws) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= {min_documents}),
sizes AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
totals AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS held,
    {smooth.format('coalesce(c.n, 0)', 'coalesce(totals.n, 0)')} AS p, {smooth.format('kept.n', 'sizes.n')} AS q
  FROM g JOIN kept USING (lang) JOIN sizes USING (lang)
  LEFT JOIN totals ON totals.lang = g.lang AND totals.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
distances AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0) AS f
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE held > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY f DESC, item) AS n FROM parts)
SELECT lang, source, part, item, CAST(f AS BIGINT) AS value, CAST(n AS INTEGER) AS rank FROM ranked
WHERE part = 'pair' OR n <= {top}
"""


ORACLES: dict[str, str] = {
    "op1_license_scan": license_scan(),
    "op2_line_dedup": line_dedup(),
    "op4_substring_dedup": substring_dedup(35),
    "op8_suffix_dedup": suffix_dedup(200),
    "op9_quality_rules": quality_rules(),
    "op11_source_divergence": source_divergence(),
}
