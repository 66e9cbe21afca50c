"""DuckDB oracles of the queries that SQL can express."""

from __future__ import annotations

from .quality import BASE_RULES, RULES, STOP_WORDS


def quality_rules() -> str:
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)

    def broken(r) -> str:
        tests = ([f"{r.metric} < {r.smallest}"] if r.smallest is not None else []) + (
            [f"{r.metric} > {r.largest}"] if r.largest is not None else [])
        return f"coalesce({' OR '.join(tests)}, false)"

    names = ", ".join(f"CASE WHEN {broken(r)} THEN '{r.name}' END" for r in (*BASE_RULES, *RULES))
    base = " OR ".join(broken(r) for r in BASE_RULES)
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce("text", '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM d
), win AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w)
), rep AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p
        FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1)
  GROUP BY rid
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         len(l) AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         len(list_filter(l, lambda x: regexp_matches(x, '^[ \t]*[-*•]'))) AS n_bullet_lines,
         len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[ \t]*$'))) AS n_ellipsis_lines,
         len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS n_stop_words,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (rid)
), r AS (
  SELECT *, 100 * n_repeat_words - 50 * n_words AS repeat_excess,
         word_chars / nullif(n_words, 0) AS chars_per_word, n_symbols / nullif(n_words, 0) AS symbols_per_word,
         n_stop_words / nullif(n_words, 0) AS stop_word_ratio, n_dup_lines / nullif(n_lines, 0) AS dup_line_ratio,
         n_bullet_lines / nullif(n_lines, 0) AS bullet_line_ratio,
         n_ellipsis_lines / nullif(n_lines, 0) AS ellipsis_line_ratio
  FROM m
), v AS (
  SELECT *, ({base}) AS base_failed, list_filter([{names}], lambda x: x IS NOT NULL) AS failed FROM r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       len(failed) = 0 AS kept, array_to_string(failed, ',') AS failed_rules
FROM v"""


def extendible_sharding(limit: int) -> str:
    """Shallowest hash prefix whose bytes fit (documents larger than a shard and repeated keys aside)."""
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, octet_length(encode(coalesce("text", '')))::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, chr(0) || 'null')), 1, 15))::BIGINT AS h
  FROM documents
), sums AS (
  SELECT t.depth, h >> (60 - t.depth) AS prefix, sum(n_bytes)::BIGINT AS shard_bytes
  FROM d, range(0, 61) t(depth) GROUP BY ALL
), fit AS (
  SELECT rid, doc_id, n_bytes, h, s.depth, prefix, shard_bytes
  FROM d JOIN sums s ON d.h >> (60 - s.depth) = s.prefix WHERE shard_bytes <= {limit}
)
SELECT doc_id, n_bytes, depth::INTEGER AS depth,
       CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth::INTEGER, '0') END AS shard, shard_bytes
FROM fit QUALIFY row_number() OVER (PARTITION BY rid ORDER BY depth) = 1"""


def source_divergence(min_docs: int, top: int) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce("text", ''), '{upper}', '{upper.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= {min_docs}),
l AS (SELECT lang, sum(n)::HUGEINT AS n, count(*) AS v FROM k GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
s AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (s.n + 2 * l.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 2)) // (l.n + 2 * l.v) AS q
  FROM s JOIN l USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sums.value, 0)::BIGINT AS value
  FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM rows
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {top}
"""


def hard_negatives() -> str:
    return """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT a.r AS a, a.id AS anchor_id, b.r AS b, b.id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v AS a JOIN v AS b ON a.r <> b.r WHERE a.id % 100 = 0
), p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id, b) <= 5
)
SELECT p.anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.id, s.b)::INTEGER AS rank,
       s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY rank <= 10
"""
