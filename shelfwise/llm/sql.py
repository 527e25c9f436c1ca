"""SQL counterparts of the corpus queries that SQL can express (DuckDB)."""

from __future__ import annotations

from shelfwise.llm import url_filter

_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"

MIX = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no
  FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][no % 3 + 1] AS BIGINT) AS weight, 2 * source_size AS cap FROM s),
r AS (
  SELECT *, CAST(cap AS DOUBLE) / weight AS room,
    1.5::DOUBLE * (SELECT sum(source_size)::BIGINT FROM w) - CAST(sum(cap) OVER o - cap AS BIGINT) AS left_words,
    CAST((SELECT sum(weight) FROM w) - (sum(weight) OVER o - weight) AS BIGINT) AS left_weight
  FROM w WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / weight, no)),
f AS (
  SELECT room, no, left_words, left_weight FROM r
  WHERE left_words * weight / left_weight <= cap ORDER BY room, no LIMIT 1),
t AS (
  SELECT r.source, r.no, r.source_size,
    CASE WHEN (r.room, r.no) >= (f.room, f.no) THEN f.left_words * r.weight / f.left_weight
      ELSE CAST(r.cap AS DOUBLE) END AS target
  FROM r LEFT JOIN f ON true),
q AS (SELECT *, CAST(round(target) AS BIGINT) AS quota FROM t),
c AS (
  SELECT d.doc_id, d.size, q.no, q.source_size, q.quota,
    unnest(range(0, (q.quota - 1) // q.source_size + 1)) AS epoch
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source WHERE d.size > 0 AND q.quota > 0),
l AS (
  SELECT *, epoch * source_size + CAST(sum(size) OVER (
    PARTITION BY no, epoch ORDER BY md5(concat_ws('|', doc_id, epoch, '7')), doc_id) AS BIGINT) AS stop FROM c),
k AS (
  SELECT doc_id, CAST(sum(greatest(0, least(stop, quota) - (stop - size))) AS BIGINT) AS taken FROM l GROUP BY doc_id)
SELECT d.doc_id, d.size, q.source_size, q.target, coalesce(k.taken, 0) AS taken, d.source
FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source LEFT JOIN k USING (doc_id)
"""

EXACT = rf"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM n JOIN g USING (text_sha256)
"""

VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
sound AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x <> 0)) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""

MINHASH = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y USING (shingle)
  WHERE x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""


def _url() -> str:
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    hit = "regexp_matches({}, '(^|[^a-z0-9]){}([^a-z0-9]|$)')"
    url = lower.format("coalesce(url, '')")
    strict = " + ".join(f"CAST(strict_{i} AS INT)" for i in range(len(url_filter.STRICT)))
    soft = " + ".join(f"CAST({hit.format('low', t)} AS INT)" for t in url_filter.SOFT)
    # Counts of strict hits would need overlapping matches; whether there are any does not.
    hits = ", ".join(f"{hit.format('low', t)} AS strict_{i}" for i, t in enumerate(url_filter.STRICT))
    fits = []
    for rule in sorted(url_filter.RULES, key=lambda r: -len(r.host + r.path)):
        fits.append((
            f"(host = '{rule.host}' OR ends_with(host, '.{rule.host}')) AND starts_with(path, '{rule.path}')",
            rule.host + rule.path, rule.verdict,
        ))
    names = " ".join(f"WHEN {f} THEN '{name}'" for f, name, _ in fits)
    verdicts = " ".join(f"WHEN {f} THEN '{verdict}'" for f, _, verdict in fits)
    return rf"""
WITH r AS (
  SELECT page_id, {url} AS low,
    CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, low, {lower.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, {hits} FROM r)
SELECT page_id, host, path, CASE {names} END AS rule,
  CASE {verdicts} WHEN {strict} > 0 OR {soft} >= {url_filter.SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict
FROM h
"""


LINES = rf"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS no
  FROM documents),
k AS (
  SELECT doc_id, no, list_transform(
    string_split(trim(regexp_replace(line, '{_SPACE}', ' ', 'g'), ' '), ' '),
    lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS tokens FROM l),
m AS (
  SELECT doc_id, no, len(tokens) AS n, (len(tokens) - 3) // 4 AS w, tokens, array_to_string(tokens, ' ') AS masked FROM k
  WHERE replace(array_to_string(tokens, ''), '<*>', '') <> ''),
f AS (
  SELECT doc_id, no, n, w, tokens, unnest(list_distinct(list_append(range(3, n - w + 1, (w + 1) // 2), n - w))) AS s
  FROM m WHERE w >= 1 AND (len(masked) - len(replace(masked, '<*>', ''))) // 3 <= w),
e AS (
  SELECT doc_id, no, n, s, array_to_string(tokens[1:s], ' ') AS pre, array_to_string(tokens[s + w + 1:], ' ') AS post FROM f),
fields AS (SELECT n, s, pre, post FROM e GROUP BY ALL HAVING count(DISTINCT doc_id) >= 8),
whole AS (
  SELECT masked, min(doc_id) AS first_id, count(DISTINCT doc_id) AS documents FROM m GROUP BY masked
  HAVING count(DISTINCT doc_id) >= CASE WHEN min(n) >= 50 THEN 2 ELSE 8 END),
gone AS (
  SELECT doc_id, no FROM m JOIN whole USING (masked) WHERE documents >= 8 OR doc_id <> first_id
  UNION SELECT doc_id, no FROM e SEMI JOIN fields USING (n, s, pre, post)),
g AS (SELECT doc_id, list_sort(list(no)) AS nos FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(nos), 0) AS n_dropped,
  coalesce(array_to_string(nos, ','), '') AS dropped_lines,
  sha256(CASE WHEN nos IS NULL THEN text ELSE coalesce(array_to_string(list_filter(
    string_split(text, chr(10)), lambda x, i: NOT list_contains(nos, i - 1)), chr(10)), '') END) AS kept_sha256
FROM documents d LEFT JOIN g USING (doc_id)
"""


AUDIT = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
w AS (SELECT row_number() OVER () AS no, * FROM d),
t AS (SELECT no, lang, source, unnest(terms) AS term FROM w),
k AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT no) >= 30),
g AS (SELECT DISTINCT lang, source FROM w),
v AS (SELECT lang, count(*)::HUGEINT AS terms, sum(lang_n)::HUGEINT AS total FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
n AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + 1000000000 * (coalesce(c.n, 0) + 5)::HUGEINT // (coalesce(n.total, 0) + 5 * v.terms) AS p,
    1 + 1000000000 * (k.lang_n + 5)::HUGEINT // (v.total + 5 * v.terms) AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
x AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q),
o AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM r)
SELECT lang, source, part, item, value, rank FROM o WHERE part = 'pair' OR rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mix_sources": MIX,
        "op2_exact_dedup": EXACT,
        "op4_near_vectors": VECTORS,
        "op8_minhash": MINHASH,
        "op9_url_filter": _url(),
        "op10_line_templates": LINES,
        "op11_source_audit": AUDIT,
    }
