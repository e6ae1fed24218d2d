"""SQL with the same results as the queries, where SQL can express them.

Model fits, hashes of shingles, alignments, merges and file formats are beyond it; those queries are tested against plain versions.
"""

from __future__ import annotations

from .secrets import EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES
from .vectors import COSINE


# The patterns of the contract and of the method, written out apart from those of the operator.
ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""(?i)^(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
MIXED = "[A-Za-z0-9+/_-]{20,}"
LEAST_VALUE = 6


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _matches(kind: str, rank: int, pattern: str) -> str:
    """All matches of a pattern with their positions, which follow from the lengths of the parts between them."""
    p = _quoted(pattern)
    return f"""
SELECT doc_id, source, {rank} AS rank, '{kind}' AS kind, found[i] AS hit, place AS start, place + length(found[i]) AS stop
FROM (SELECT *, CAST(list_sum(list_transform(parts[:i], lambda x: length(x)))
   + coalesce(list_sum(list_transform(found[:i - 1], lambda x: length(x))), 0) AS BIGINT) AS place
 FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i
  FROM (SELECT doc_id, source, regexp_extract_all(text, {p}) AS found, string_split_regex(text, {p}) AS parts FROM documents)))"""


_SECRETS = f"""
WITH base AS (
 SELECT *, regexp_extract(hit, {_quoted(ASSIGN_VALUE)}, 1) AS value FROM ({_matches("assign", 0, ASSIGN)})
 WHERE length(regexp_extract(hit, {_quoted(ASSIGN_VALUE)}, 1)) >= {LEAST_VALUE}
 UNION ALL SELECT *, hit FROM ({_matches("access", 1, ACCESS)})
 UNION ALL SELECT *, hit FROM ({_matches("hex", 2, HEX)})),
mixed AS (
 SELECT *, hit AS value FROM ({_matches("mixed", 3, MIXED)}) AS m
 WHERE regexp_matches(hit, '[A-Z]') AND regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[0-9]')
  AND NOT EXISTS (SELECT 1 FROM base AS b WHERE b.doc_id = m.doc_id AND b.start < m.stop AND m.start < b.stop)),
findings AS (SELECT * FROM base UNION ALL SELECT * FROM mixed),
owners AS (
 SELECT value, count(DISTINCT coalesce(source, chr(0))) < {EXAMPLE_OWNERS}
  AND count(DISTINCT (coalesce(source, chr(0)), coalesce(doc_id, -1))) < {EXAMPLE_REPOSITORIES} AS live FROM findings GROUP BY value),
spans AS (
 SELECT doc_id, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access,
  count(*) FILTER (WHERE rank = 2) AS n_hex,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (WHERE rank < 3) AS base,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (WHERE rank < 3 OR live) AS spans,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (WHERE live) AS live_spans
 FROM findings JOIN owners USING (value) GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
 sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(live_spans, '') AS live_spans
FROM documents LEFT JOIN spans USING (doc_id)"""

_VECTORS = f"""
WITH RECURSIVE vectors AS (
 SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v,
  sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))) AS norm FROM embeddings),
usable AS (
 SELECT * FROM vectors
 WHERE label IS NOT NULL AND norm > 0 AND isfinite(norm) AND len(v) = len(list_filter(v, lambda x: x IS NOT NULL))),
links AS (
 SELECT a.vec_id AS a, b.vec_id AS b FROM usable AS a JOIN usable AS b ON a.label = b.label AND a.vec_id <> b.vec_id
 WHERE list_inner_product(a.v, b.v) / a.norm / b.norm >= {COSINE}),
reached AS (
 SELECT vec_id AS node, vec_id AS other FROM embeddings
 UNION SELECT node, b FROM reached JOIN links ON other = a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least AS component_id, e.vec_id = least AS kept
FROM embeddings AS e
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) ON a = vec_id
JOIN (SELECT node, min(other) AS least FROM reached GROUP BY node) ON node = vec_id"""


def _codes_sql(rounds: int = 4) -> str:
    """Codebooks round by round: every part against every entry, component by component."""
    steps = [
        """
kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, * FROM embeddings
 WHERE embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
places AS (SELECT r, vec_id, label, unnest(embedding) AS x, unnest(range(len(embedding))) AS i, len(embedding) // 4 AS width FROM kept),
parts AS MATERIALIZED (SELECT r, vec_id, label, i // width AS part, i % width AS i, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM places),
book0 AS MATERIALIZED (SELECT part, r - 1 AS entry, i, x AS c FROM parts WHERE r <= 256)"""
    ]
    for k in range(rounds + 1):
        steps.append(f"""
near{k} AS MATERIALIZED (SELECT r, part, min_by(entry, d * 256 + entry) AS entry, min(d) AS d FROM (
 SELECT r, part, entry, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d FROM parts JOIN book{k} USING (part, i) GROUP BY ALL) GROUP BY ALL)""")
        if k < rounds:
            steps.append(f"""
book{k + 1} AS MATERIALIZED (SELECT part, entry, i, coalesce(m, c) AS c FROM book{k} LEFT JOIN (
 SELECT part, entry, i, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS m
 FROM near{k} JOIN parts USING (r, part) GROUP BY ALL) USING (part, entry, i))""")
    return f"""
WITH {",".join(steps)},
digest AS (SELECT sha256(string_agg(c, ',' ORDER BY part, entry, i)) AS codebooks_sha256 FROM book{rounds}),
coded AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (r) CROSS JOIN digest"""


# Terms, counts and probabilities of the audit are written out once more here.
_DIVERGENCE = r"""
WITH docs AS (
 SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
 FROM documents),
kept AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(words)) AS term FROM docs) GROUP BY ALL HAVING count(*) >= 30),
found AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(words) AS term FROM docs)
 JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
totals AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM groups LEFT JOIN found USING (lang, source) GROUP BY ALL),
p AS (SELECT lang, source, term, coalesce(n, 0) AS n, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 5) // (total + 5 * v) AS p
 FROM totals JOIN sizes USING (lang) JOIN kept USING (lang) LEFT JOIN found USING (lang, source, term)),
q AS (SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (sum(n) + 5) // (any_value(all_n) + 5 * any_value(v)) AS q
 FROM found JOIN sizes USING (lang) JOIN (SELECT lang, sum(n) AS all_n FROM found GROUP BY lang) USING (lang) GROUP BY lang, term),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
 FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
  SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p AS x JOIN p AS y
  ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) AS s
 ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
both_parts AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM both_parts)
WHERE part = 'pair' OR rank <= 50"""

ORACLES: dict[str, str] = {
    "op6_near_vectors": _VECTORS,
    "op8_secret_ownership": _SECRETS,
    "op11_vector_codes": _codes_sql(),
    "op13_source_divergence": _DIVERGENCE,
}
