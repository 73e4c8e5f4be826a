"""SQL of the queries that SQL can express."""

from __future__ import annotations

_NEIGHBOURS = """
WITH valid AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_reduce(list_prepend(CAST(0 AS DOUBLE), list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), lambda a, b: a + b) AS score
    FROM valid q JOIN valid c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
),
ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

_TOP_K = """
WITH valid AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
    FROM valid q JOIN valid c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
),
ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def _codes(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    """Rounds of assignment and replacement, one after another."""
    ctes = [
        f"""
valid AS (
    SELECT row_number() OVER () AS r, vec_id, label,
           list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
sized AS (SELECT CAST(ceil(max(len(v)) / {parts}) AS BIGINT) AS w FROM valid),
filled AS (SELECT r, vec_id, label, list_resize(v, {parts} * w, 0) AS v, w FROM valid, sized),
piece AS MATERIALIZED (
    SELECT r, p.p AS p, list_slice(v, p.p * w + 1, (p.p + 1) * w) AS v FROM filled, range({parts}) p(p)
),
begun AS (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, v, r) - 1 AS e FROM filled QUALIFY e < {entries}),
book0 AS MATERIALIZED (SELECT p, e, v FROM piece JOIN begun USING (r))"""
    ]
    distance = "list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for n in range(rounds + 1):
        ctes.append(
            f"""
near{n} AS MATERIALIZED (
    SELECT r, p, first(v) AS v, min(struct_pack(d := d, e := e)) AS best
    FROM (SELECT a.r, a.p, a.v, b.e, CAST({distance} AS BIGINT) AS d FROM piece a JOIN book{n} b USING (p))
    GROUP BY r, p
)"""
        )
        if n < rounds:
            ctes.append(
                f"""
mean{n} AS (
    SELECT p, e, list(m ORDER BY i) AS v FROM (
        SELECT p, e, i, CAST(floor_div AS BIGINT) AS m FROM (
            SELECT p, e, i, (s - ((s % c) + c) % c) // c AS floor_div FROM (
                SELECT p, best.e AS e, i, CAST(sum(v[i]) AS HUGEINT) AS s, count(*) AS c
                FROM near{n}, sized, LATERAL (SELECT unnest(range(1, w + 1)) AS i) GROUP BY p, best.e, i
            )
        )
    ) GROUP BY p, e
),
book{n + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.v, b.v) AS v FROM book{n} b LEFT JOIN mean{n} m USING (p, e))"""
            )
    return f"""
WITH {",".join(ctes)},
digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}),
coded AS (
    SELECT r, string_agg(lower(printf('%02x', best.e)), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
    FROM near{rounds} GROUP BY r
),
named AS (SELECT vec_id, label, code, error FROM filled JOIN coded USING (r))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM named, digest
"""

_DIVERGENCE = """
WITH plain AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
),
words AS (
    SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM plain
),
kept AS MATERIALIZED (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
counts AS MATERIALIZED (
    SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term
),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (
    SELECT lang, source, coalesce(v, 0) AS v, coalesce(total, 0) AS total
    FROM (SELECT DISTINCT lang, source FROM plain) LEFT JOIN sizes USING (lang)
    LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source) USING (lang, source)
),
shares AS MATERIALIZED (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           CAST(1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.total + 5 * g.v) AS BIGINT) AS p
    FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
lang_totals AS (SELECT lang, sum(n) AS total FROM counts GROUP BY lang),
lang_shares AS (
    SELECT lang, term, CAST(1 + (1000000000::HUGEINT * (sum(n) + 5)) // (any_value(total) + 5 * any_value(v)) AS BIGINT) AS q
    FROM counts JOIN lang_totals USING (lang) JOIN sizes USING (lang) GROUP BY lang, term
),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(sum(abs(s.p - t.p)), 0) AS BIGINT) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN shares s ON s.lang = a.lang AND s.source = a.source
    LEFT JOIN shares t ON t.lang = b.lang AND t.source = b.source AND t.term = s.term
    GROUP BY a.lang, a.source, b.source
),
own AS (
    SELECT lang, source, 'term' AS part, term AS item, p - q AS value
    FROM shares JOIN lang_shares USING (lang, term) WHERE n > 0 AND p > q
),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM own)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_block_neighbours": _NEIGHBOURS, "op7_term_at_a_time": _TOP_K, "op11_source_divergence": _DIVERGENCE, "op12_vector_codes": _codes()}
