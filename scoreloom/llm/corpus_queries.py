"""Registered queries of the operators that compare or sample whole corpora."""

from __future__ import annotations

from scoreloom.llm import divergence, resampling, simhash
from scoreloom.llm.registry import query, table

_DIVERGENCE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
words AS (
  SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
sizes AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
group_sizes AS (SELECT lang, source, sum(n) AS n FROM counts GROUP BY lang, source),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS count,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(t.n, 0) + 5 * s.v) AS p,
    1 + (1000000000::HUGEINT * (k.total + 5)) // (s.n + 5 * s.v) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN sizes s ON s.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN group_sizes t ON t.lang = g.lang AND t.source = g.source),
distances AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE count > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50"""


@query(_DIVERGENCE_SQL)
def op11_source_divergence(spark, sf_dir):
    """Distances of the sources of each language, and the terms that set each source apart."""
    return divergence.audit(table(spark, sf_dir, "documents"))


@query()
def op12_simhash_near_dedup(spark, sf_dir):
    """Fingerprint and near-duplicate class of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op13_importance_resampling(spark, sf_dir):
    """Every document's weight towards the benchmark texts, and its rank among the drawn quarter."""
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
