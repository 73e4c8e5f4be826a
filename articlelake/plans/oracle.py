"""The registered queries as SQL for an independent engine (DuckDB dialect)."""

SPACE = (
    r"[\t\n\x0b\x0c\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
TRIM = (
    r"^[\t\n\x0b\x0c\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
    r"|[\t\n\x0b\x0c\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+$"
)


def collapse(c: str) -> str:
    return f"trim(regexp_replace({c}, '{SPACE}', ' ', 'g'), ' ')"


def trimmed(c: str) -> str:
    return f"regexp_replace({c}, '{TRIM}', '', 'g')"


def raw(keep_unknown: bool, name: str = "raw") -> str:
    """The raw articles of the test tables as a CTE."""
    toxic, relevance = "l.toxic = 1", "CASE l.quality WHEN 0 THEN 'low' WHEN 1 THEN 'high' END"
    if keep_unknown:
        toxic, relevance = f"coalesce({toxic}, false)", f"coalesce({relevance}, 'high')"
    return f"""
{name}_days AS (
  SELECT d.*, l.quality, l.toxic, DATE '2022-01-01' + CAST(d.doc_id % 365 AS INTEGER) AS day,
         ['Affordability', 'BTO', 'Rental', 'Resale'] AS v,
         list_filter([0, 1, 2, 3], lambda i: (CAST(d.doc_id % 15 + 1 AS INTEGER) >> i) & 1 = 1) AS idx
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
{name} AS (
  SELECT l.doc_id, '  Doc ' || l.doc_id || ' ' AS title,
         'https://example.test/' || l.doc_id AS url,
         CASE WHEN l.doc_id % 2 = 0 THEN strftime(day, '%Y-%m-%d') || 'T23:31:00+08:00'
              ELSE month(day) || '/' || day(day) || '/' || year(day) || ' 23:31' END AS published_date,
         {collapse('text')} AS content, source AS news_site,
         {relevance} AS housing_relevance, {toxic} AS exclude_from_housing_analysis,
         CASE WHEN source = 'src3' THEN 'advertisement_or_sponsored' ELSE 'news' END AS article_type,
         array_to_string(list_transform(list_reverse(idx), lambda i: v[i + 1]), ' | ') AS topics,
         '{{' || array_to_string(list_transform(idx, lambda i: '"' || v[i + 1] || '": '
             || ((l.doc_id * 7 + i * 13) % 5 - 2)), ', ') || '}}' AS sentiment_by_topic,
         '{{' || array_to_string(list_transform(idx, lambda i: '"' || v[i + 1] || '": "why '
             || v[i + 1] || '"'), ', ') || '}}' AS sentiment_reason_by_topic
  FROM {name}_days l)"""


MASK = """(exclude_from_housing_analysis OR housing_relevance IN ('low', 'none')
  OR article_type IN ('irrelevant', 'advertisement_or_sponsored'))"""

PARSED_DAY = r"""coalesce(
    try_strptime(regexp_replace(regexp_replace(published_date, '^([^T]*)T', '\1 '), '\+08:00$', ''), '%Y-%m-%d %H:%M:%S'),
    try_strptime(regexp_replace(regexp_replace(published_date, '^([^T]*)T', '\1 '), '\+08:00$', ''), '%m/%d/%Y %H:%M'))"""

# cleaned articles (JSON still as text) and their topics, from the kept raw rows
BASE = f"""
kept AS (SELECT *, CAST({PARSED_DAY} AS DATE) AS pday FROM raw WHERE NOT {MASK}),
base AS (
  SELECT doc_id, trim(title, ' ') || ' | ' || strftime(pday, '%Y-%m-%d') || ' | ' || news_site AS article_id,
         trim(title, ' ') AS title, url, strftime(pday, '%Y-%m-%d') AS published_date,
         CAST(year(pday) AS BIGINT) AS year, year(pday) || 'Q' || quarter(pday) AS quarter_year,
         content, news_site, sentiment_by_topic AS s, sentiment_reason_by_topic AS r,
         strftime(pday, '%Y-%m') AS month_id
  FROM kept),
flat AS (
  SELECT b.* EXCLUDE (s, r, content), b.article_id || ' | ' || topic AS article_topic_key, topic,
         CAST(json_extract(s, '$."' || topic || '"') AS DOUBLE) AS sentiment_score,
         json_extract_string(r, '$."' || topic || '"') AS explanation
  FROM (SELECT *, unnest(json_keys(s)) AS topic FROM base) b)"""

KEPT = f"WITH {raw(True)}, {BASE}"

FLAT_COLUMNS = """article_id, article_topic_key, title, url, published_date, year, quarter_year,
  news_site, topic, sentiment_score, explanation"""


def units(source: str, key: str, content: str, maximum: int) -> str:
    """CTEs `sents` and `units` (token count n, prefix sums c and cb) of a source."""
    return f"""
sents AS (
  SELECT k, row_number() OVER (PARTITION BY k ORDER BY p) AS j, s FROM (
    SELECT k, unnest(a) AS s, generate_subscripts(a, 1) AS p FROM (
      SELECT {key} AS k, string_split(regexp_replace({collapse(content)},
        '([.!?]) (["''(\\[]?[A-Z0-9])', '\\1' || chr(1) || '\\2', 'g'), chr(1)) AS a FROM {source}))
  WHERE s <> ''),
parts AS (
  SELECT k, j, p, CASE WHEN len(w) <= {maximum} THEN s
                       ELSE array_to_string(w[p * {maximum} + 1:(p + 1) * {maximum}], ' ') END AS unit
  FROM (SELECT k, j, s, w, unnest(range(0, CAST(ceil(len(w) / {maximum}) AS BIGINT))) AS p
        FROM (SELECT *, string_split(s, ' ') AS w FROM sents))),
units AS MATERIALIZED (
  SELECT *, sum(n) OVER (PARTITION BY k ORDER BY i) - n AS cb, sum(n) OVER (PARTITION BY k ORDER BY i) AS c
  FROM (SELECT k, row_number() OVER (PARTITION BY k ORDER BY j, p) AS i, unit,
               len(string_split(unit, ' ')) AS n FROM parts))"""


def windows(target: int, maximum: int, overlap: int) -> str:
    """CTEs `wins` (k, w, a, b) and `chunks` (k, w, chunk) over `units`."""
    return f"""
carry AS MATERIALIZED (
  SELECT u.k, u.i, coalesce(min(q.i), u.i + 1) AS q FROM units u
  LEFT JOIN units q ON q.k = u.k AND q.i <= u.i AND q.i >= u.i - {overlap} AND u.c - q.cb <= {overlap}
  GROUP BY u.k, u.i),
steps AS MATERIALIZED (
  SELECT u.k, u.i, u.n, u.c, u.cb, y.q FROM units u
  LEFT JOIN carry y ON y.k = u.k AND y.i = u.i - 1),
walk AS (
  SELECT k, 1 AS i, 1 AS st, 0 AS a, 0 AS b FROM units WHERE i = 1
  UNION ALL
  SELECT u.k, u.i,
    CASE WHEN u.c - s.cb > {maximum} OR u.cb - s.cb >= {target} THEN greatest(r.st, u.q) ELSE r.st END,
    CASE WHEN u.c - s.cb > {maximum} OR u.cb - s.cb >= {target} THEN r.st ELSE 0 END,
    CASE WHEN u.c - s.cb > {maximum} OR u.cb - s.cb >= {target} THEN r.i ELSE 0 END
  FROM walk r JOIN steps u ON u.k = r.k AND u.i = r.i + 1 JOIN steps s ON s.k = r.k AND s.i = r.st),
ends AS (SELECT k, max(i) AS i FROM units GROUP BY k),
spans AS (
  SELECT k, a, b FROM walk WHERE b > 0
  UNION ALL SELECT w.k, w.st, w.i FROM walk w JOIN ends e ON e.k = w.k AND e.i = w.i),
wins AS MATERIALIZED (SELECT k, row_number() OVER (PARTITION BY k ORDER BY b) - 1 AS w, a, b FROM spans),
chunks AS (
  SELECT x.k, x.w, string_agg(u.unit, ' ' ORDER BY u.i) AS chunk
  FROM wins x JOIN units u ON u.k = x.k AND u.i BETWEEN x.a AND x.b GROUP BY x.k, x.w)"""


def recursive(ctes: str) -> str:
    return ctes.replace("WITH ", "WITH RECURSIVE ", 1)


TOPIC_NAMES = "array_to_string(json_keys(s), ', ')"
RETRIEVAL = f"'Title: ' || title || chr(10) || 'Topics: ' || {TOPIC_NAMES} || chr(10) || chr(10) || 'Article excerpt:' || chr(10) || chunk"
CHUNK_SELECT = f"""article_id || ':chunk_' || w AS chunk_id, article_id, CAST(w AS BIGINT) AS chunk_index,
  chunk AS content_chunk, {RETRIEVAL} AS retrieval_text, title, published_date, news_site, url,
  {TOPIC_NAMES} AS topics, year"""


def article_chunks(target: int, maximum: int, overlap: int) -> str:
    return recursive(
        f"{KEPT}, {units('base', 'article_id', 'content', maximum)}, {windows(target, maximum, overlap)}"
    )


FAULTY = f"""WITH {raw(True, 'sound')}, faulty AS (
  SELECT doc_id, doc_id % 50 AS f, url, news_site, housing_relevance, article_type,
    CASE doc_id % 50 WHEN 1 THEN '   ' WHEN 2 THEN NULL WHEN 14 THEN 'Same story' ELSE title END AS title,
    CASE doc_id % 50 WHEN 3 THEN '2022-02-30 10:00:00' WHEN 14 THEN '8/8/2022 3:05' ELSE published_date END AS published_date,
    CASE doc_id % 50 WHEN 4 THEN '  ' WHEN 5 THEN NULL WHEN 6 THEN 'BTO|BTO' WHEN 7 THEN 'BTO|' WHEN 12 THEN 'BTO' ELSE topics END AS topics,
    CASE doc_id % 50 WHEN 8 THEN '{{bad' WHEN 9 THEN NULL WHEN 10 THEN '{{"BTO": null}}' WHEN 12 THEN '{{"BTO": 1, "Rental": 2}}' WHEN 17 THEN '{{"BTO": 0.5}} trailing' WHEN 18 THEN '{{"BTO": 1}}{{"Rental": 2}}' ELSE sentiment_by_topic END AS scores,
    CASE doc_id % 50 WHEN 11 THEN rtrim(sentiment_reason_by_topic, '}}') || ', "Other": "x"}}' WHEN 12 THEN '{{"BTO": "a"}}' ELSE sentiment_reason_by_topic END AS reasons,
    CASE doc_id % 50 WHEN 13 THEN NULL ELSE exclude_from_housing_analysis END AS exclude_from_housing_analysis,
    CASE doc_id % 50 WHEN 15 THEN NULL WHEN 16 THEN content || chr(10) || 'next' ELSE content END AS content
  FROM sound),
vocab AS (SELECT DISTINCT t FROM (SELECT {trimmed('unnest(string_split(topics, chr(124)))')} AS t FROM faulty) WHERE t <> ''),
kept AS (
  SELECT *, CAST({PARSED_DAY} AS DATE) AS pday, {trimmed('title')} AS ttitle,
    list_transform(string_split(topics, '|'), lambda x: {trimmed('x')}) AS own,
    coalesce(json_valid(scores), true) AND coalesce(json_valid(reasons), true) AS good
  FROM faulty WHERE NOT {MASK}),
keyed AS (
  SELECT *, trim(ttitle, ' ') || ' | ' || strftime(pday, '%Y-%m-%d') || ' | ' || news_site AS article_id,
    CASE WHEN json_valid(coalesce(scores, '{{}}')) THEN list_filter(json_keys(CASE WHEN json_valid(coalesce(scores, '{{}}')) THEN coalesce(scores, '{{}}') ELSE '{{}}' END),
      lambda t: json_extract_string(CASE WHEN json_valid(coalesce(scores, '{{}}')) THEN coalesce(scores, '{{}}') ELSE '{{}}' END, '$."' || t || '"') IS NOT NULL
        AND t IN ('Affordability', 'BTO', 'Rental', 'Resale')) END AS skeys,
    list_filter(json_keys(coalesce(reasons, '{{}}')), lambda t: t IN ('Affordability', 'BTO', 'Rental', 'Resale')) AS rkeys
  FROM kept)"""


def _count(guard: str, condition: str, source: str = "keyed") -> str:
    return f"SELECT '{guard}' AS guard, CAST(count(*) AS BIGINT) AS violations FROM {source} WHERE {condition}"


GUARD_SQL = FAULTY + "\n" + "\nUNION ALL ".join(
    [
        _count("missing_published_date", "pday IS NULL"),
        _count("missing_title", "ttitle IS NULL OR ttitle = ''"),
        _count("duplicate_article_id", "n > 1", "(SELECT count(*) AS n FROM keyed GROUP BY article_id)"),
        _count("empty_topics", f"topics IS NULL OR {trimmed('topics')} = ''"),
        _count("duplicate_topics", "len(own) <> len(list_distinct(own))"),
        _count("malformed_json", "NOT good"),
        _count("topic_sentiment_mismatch", "list_sort(own) <> list_sort(skeys)"),
        _count("topic_reason_mismatch", "list_sort(own) <> list_sort(rkeys)"),
        _count("row_conservation", f"{MASK} IS NULL", "faulty"),
        _count("out_of_batch_range", "NOT pday BETWEEN DATE '2022-03-01' AND DATE '2022-11-30'"),
        _count("null_content", "content IS NULL"),
        _count("multiline_content", "contains(content, chr(10))"),
    ]
)

# ids and their months as the lake queries use them
MONTHS = "SELECT DISTINCT strftime(o_orderdate, '%Y') AS y, strftime(o_orderdate, '%m') AS m FROM orders"
CANDIDATES = f"""months AS ({MONTHS}), ids AS (
  SELECT y || '-' || m AS batch_id FROM months
  UNION SELECT y || '-01_to_' || y || '-' || m FROM months
  UNION SELECT y || '-' || m || '_to_' || y || '-01' FROM months
  UNION SELECT y || '-' || m || '_to_' || (CAST(y AS INTEGER) + 1) || '-' || m FROM months
  UNION SELECT y || '-' || CAST(m AS INTEGER) FROM months
  UNION SELECT y || '-' || m || '.csv' FROM months
  UNION SELECT y || '-' || (CAST(m AS INTEGER) + 12) FROM months
  UNION SELECT y FROM months)"""
MANIFEST = rf"""{CANDIDATES}, matched AS (
  SELECT batch_id, regexp_matches(batch_id, '^\d{{4}}-\d{{2}}(_to_\d{{4}}-\d{{2}})?$') AS ok,
    try_cast(substr(batch_id, 1, 4) AS INTEGER) AS y1, try_cast(substr(batch_id, 6, 2) AS INTEGER) AS m1,
    coalesce(try_cast(substr(batch_id, 12, 4) AS INTEGER), try_cast(substr(batch_id, 1, 4) AS INTEGER)) AS y2,
    coalesce(try_cast(substr(batch_id, 17, 2) AS INTEGER), try_cast(substr(batch_id, 6, 2) AS INTEGER)) AS m2
  FROM ids), classed AS (
  SELECT *, CASE WHEN NOT ok THEN 'malformed' WHEN NOT (m1 BETWEEN 1 AND 12 AND m2 BETWEEN 1 AND 12) THEN 'month'
    WHEN y1 <> y2 THEN 'cross_year' WHEN m1 > m2 THEN 'reversed' END AS error FROM matched),
manifest AS (
  SELECT batch_id, CASE WHEN error IS NULL THEN y1 END AS year,
    CASE WHEN error IS NULL THEN make_date(y1, m1, 1) END AS start_date,
    CASE WHEN error IS NULL THEN last_day(make_date(y2, m2, 1)) END AS end_date, error FROM classed)"""


def oracle_sql() -> dict[str, str]:
    small = (35, 50, 8)
    default = (350, 500, 75)
    doc_units = units("documents", "doc_id", "text", 50)
    embedded = f"""{article_chunks(*default)},
texts AS (SELECT {CHUNK_SELECT} FROM chunks JOIN base ON k = article_id)
SELECT {{more}}chunk_id, CAST(i AS BIGINT) AS position,
  (CAST('0x' || substr(md5(retrieval_text), 2 * i + 1, 2) AS INTEGER) - 128) / 128.0::DOUBLE AS value
FROM texts, range(8) r(i)"""
    embedded, resumed = (embedded.replace("{more}", m) for m in ("", "article_id, md5(retrieval_text) AS text_md5, "))
    return {
        "raw_articles_view": f"WITH {raw(False)} SELECT * EXCLUDE (doc_id) REPLACE (CAST(exclude_from_housing_analysis AS VARCHAR) AS exclude_from_housing_analysis) FROM raw",
        "csv_export_roundtrip": f"WITH {raw(False)} SELECT * EXCLUDE (doc_id) REPLACE (CAST(exclude_from_housing_analysis AS VARCHAR) AS exclude_from_housing_analysis) FROM raw",
        "spanning_csv": """SELECT 'https://example.test/' || doc_id AS url, '  Doc ' || doc_id || ' ' AS title,
  md5(text) AS content_md5, CAST(length(text) AS INTEGER) AS characters FROM documents""",
        "exclusion_accounting": f"""WITH {raw(False)} SELECT count(*) AS raw_rows,
  CAST(count(*) FILTER ({MASK}) AS BIGINT) AS excluded_rows,
  CAST(count(*) FILTER (NOT {MASK}) AS BIGINT) AS base_rows,
  CAST(count(*) FILTER ({MASK} IS NULL) AS BIGINT) AS unaccounted_rows FROM raw""",
        "clean_base": f"""{KEPT} SELECT article_id, title, url, published_date, year, quarter_year,
  content, news_site, array_to_string(list_transform(json_keys(s), lambda t: t || '=' ||
    json_extract_string(s, '$."' || t || '"') || '(' || json_extract_string(r, '$."' || t || '"') || ')'), ';') AS topics
FROM base""",
        "topic_vocabulary": f"""WITH {raw(False)} SELECT DISTINCT trim(t, ' ') AS topic
FROM (SELECT unnest(string_split(topics, '|')) AS t FROM raw) WHERE trim(t, ' ') <> ''""",
        "date_parse_audit": rf"""WITH {raw(False)}, spelled AS (
  SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN replace(published_date, '+08:00', 'Z')
    WHEN 1 THEN substr(published_date, 1, 10) WHEN 2 THEN published_date || '.5'
    WHEN 3 THEN '13/' || published_date WHEN 4 THEN replace(published_date, 'T', ' ')
    ELSE published_date END AS published_date FROM raw)
SELECT published_date IS NOT NULL AND day IS NULL AS unparsed, strftime(day, '%Y-%m-%d') AS day, CAST(count(*) AS BIGINT) AS rows
FROM (SELECT published_date, {PARSED_DAY} AS day FROM spelled) GROUP BY ALL""",
        "flat_topics": f"{KEPT} SELECT {FLAT_COLUMNS} FROM flat",
        "topic_quarter_rollup": f"""{KEPT} SELECT quarter_year, topic, count(*) AS articles,
  avg(sentiment_score) AS avg_sentiment, min(sentiment_score) AS min_sentiment, max(sentiment_score) AS max_sentiment,
  count(*) FILTER (sentiment_score < 0) AS negative, count(*) FILTER (sentiment_score > 0) AS positive
FROM flat GROUP BY ALL""",
        "guard_report": GUARD_SQL,
        "duplicate_ids": """SELECT article_id, count(*) AS count FROM (
  SELECT lang || ' | ' || source || ' | ' || (n_chars // 100) AS article_id FROM documents) GROUP BY 1 HAVING count(*) > 1""",
        "out_of_range_rows": f"""{KEPT} SELECT title, published_date, news_site FROM base
WHERE published_date NOT BETWEEN '2022-03-01' AND '2022-05-31'""",
        "content_verdict": r"""SELECT lang, coalesce(bool_and(text IS NOT NULL), true) AS no_nulls,
  coalesce(bool_and(NOT contains(text, chr(10))), true) AS single_line FROM documents GROUP BY lang""",
        "flatten_conservation": f"""{KEPT} SELECT (SELECT CAST(sum(len(json_keys(s))) AS BIGINT) FROM base) AS expected_rows,
  (SELECT count(*) FROM flat) AS actual_rows,
  (SELECT CAST(sum(len(json_keys(s))) AS BIGINT) FROM base) = (SELECT count(*) FROM flat) AS conserved""",
        "sentences": f"""WITH {doc_units} SELECT k AS doc_id, CAST(j - 1 AS BIGINT) AS position, s AS sentence FROM sents""",
        "long_unit_split": f"""WITH {doc_units} SELECT k AS doc_id, CAST(i - 1 AS BIGINT) AS position, unit, CAST(n AS BIGINT) AS tokens FROM units""",
        "document_windows": recursive(
            f"""WITH {doc_units}, {windows(*small)} SELECT x.k AS doc_id, CAST(w AS BIGINT) AS chunk_index,
  CAST(a AS BIGINT) AS first_unit, CAST(b AS BIGINT) AS last_unit, CAST(z.c - y.cb AS BIGINT) AS tokens
FROM wins x JOIN units y ON y.k = x.k AND y.i = a JOIN units z ON z.k = x.k AND z.i = b"""
        ),
        "rag_chunks_words": f"""{article_chunks(*small)} SELECT {CHUNK_SELECT} FROM chunks JOIN base ON k = article_id""",
        "rag_chunks_default": f"""{article_chunks(*default)} SELECT {CHUNK_SELECT} FROM chunks JOIN base ON k = article_id""",
        "chunk_numbering": recursive(
            f"""WITH {doc_units}, {windows(*small)} SELECT source AS article_id, doc_id,
  CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id, w) - 1 AS BIGINT) AS chunk_index, md5(chunk) AS chunk_md5
FROM chunks JOIN documents ON k = doc_id"""
        ),
        "sparse_numbering": f"""WITH {doc_units}, found AS (
  SELECT source, md5(coalesce(text, '')) AS digest FROM sents JOIN documents ON k = doc_id),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY digest) - 1 AS chunk_index FROM found)
SELECT source, digest, CAST(chunk_index - min(chunk_index) OVER (PARTITION BY source, digest) AS BIGINT) AS position,
  CAST(chunk_index AS BIGINT) AS chunk_index FROM numbered""",
        "chunk_windows_stats": recursive(
            f"""WITH {doc_units}, {windows(*small)}, sized AS (
  SELECT x.*, z.c - y.cb AS t, lag(b) OVER (PARTITION BY x.k ORDER BY w) AS pb
  FROM wins x JOIN units y ON y.k = x.k AND y.i = a JOIN units z ON z.k = x.k AND z.i = b),
art AS (SELECT k, count(*) AS chunks, sum(t) AS ct, count(*) FILTER (a > pb) AS bare FROM sized GROUP BY k),
tot AS (SELECT k, sum(n) AS tokens FROM units GROUP BY k)
SELECT count(*) AS articles, CAST(sum(chunks) AS BIGINT) AS chunks, median(tokens)::DOUBLE AS median_tokens,
  count(*) FILTER (chunks = 1) AS single_chunk_articles, count(*) FILTER (chunks = 1) / count(*)::DOUBLE AS single_chunk_share,
  CAST(sum(chunks) - count(*) AS BIGINT) AS boundaries, CAST(sum(bare) AS BIGINT) AS zero_overlap_boundaries,
  sum(bare)::DOUBLE / (sum(chunks) - count(*))::DOUBLE AS zero_overlap_share,
  (sum(ct) - sum(tokens))::DOUBLE / sum(tokens)::DOUBLE AS duplication_share
FROM art JOIN tot USING (k)"""
        ),
        "unique_chunk_ids": f"""{article_chunks(*small)} SELECT count(*) AS chunks, count(DISTINCT k || ':chunk_' || w) AS chunk_ids,
  count(*) = count(DISTINCT k || ':chunk_' || w) AS "unique" FROM chunks""",
        "content_length_stats": """SELECT min(length(text)) AS min_article_len, max(length(text)) AS max_article_len,
  avg(length(text)) AS avg_article_len, median(length(text)) AS median_article_len FROM documents""",
        "json_map_decode": """SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k,
  CAST(len(json_keys(props)) AS BIGINT) AS keys FROM events""",
        "embed_local": embedded,
        "embed_resumed": resumed,
        "embed_sample": f"""{article_chunks(*default)} SELECT article_id || ':chunk_' || w AS chunk_id, CAST(w AS BIGINT) AS chunk_index
FROM chunks JOIN base ON k = article_id ORDER BY article_id, w LIMIT 25""",
        "embed_resume_pending": f"""{article_chunks(*default)} SELECT k || ':chunk_' || w AS chunk_id FROM chunks WHERE k >= 'Doc 5'""",
        "paced_requests": """WITH RECURSIVE texts AS (
  SELECT (row_number() OVER (ORDER BY doc_id) - 1) // 20 AS i, length(coalesce(text, '')) AS n FROM documents),
requests AS MATERIALIZED (SELECT i, CAST(sum(n) AS BIGINT) AS tokens FROM texts GROUP BY i),
walk AS (
  SELECT i, tokens, 0.0::DOUBLE AS start, least(3000000.0::DOUBLE, 3000000.0) - tokens AS level FROM requests WHERE i = 0
  UNION ALL
  SELECT i, tokens, start, least(3000000.0::DOUBLE, filled + 50000.0::DOUBLE * (start - now)) - tokens FROM (
    SELECT *, now + greatest(0.0::DOUBLE, 1.0::DOUBLE - (now - last), (least(tokens, 3000000.0::DOUBLE) - filled) / 50000.0::DOUBLE) AS start FROM (
      SELECT r.i, r.tokens, w.start AS last, w.start + 0.25::DOUBLE AS now,
        least(3000000.0::DOUBLE, w.level + 50000.0::DOUBLE * ((w.start + 0.25::DOUBLE) - w.start)) AS filled
      FROM walk w JOIN requests r ON r.i = w.i + 1)))
SELECT CAST(floor(start / 60) AS BIGINT) AS minute, count(*) AS starts, CAST(sum(tokens) AS BIGINT) AS tokens FROM walk GROUP BY 1""",
        "retried_requests": """WITH texts AS (SELECT (row_number() OVER (ORDER BY doc_id) - 1) // 20 AS request FROM documents)
SELECT CAST(request AS BIGINT) AS request, CAST(request % 5 + 1 AS BIGINT) AS attempts,
  CAST(5 * (power(2, request % 5) - 1) AS BIGINT) AS waited, count(*) AS texts FROM texts GROUP BY request""",
        "size_errors": """SELECT DISTINCT target, maximum, overlap, array_to_string(list_filter([
  CASE WHEN NOT target > 0 THEN 'not 0 < target' END, CASE WHEN NOT target <= maximum THEN 'not target <= maximum' END,
  CASE WHEN NOT overlap >= 0 THEN 'not 0 <= overlap' END, CASE WHEN NOT overlap < maximum THEN 'not overlap < maximum' END],
  lambda x: x IS NOT NULL), ', ') AS broken
FROM (SELECT CAST(l_quantity AS INTEGER) - 10 AS target, CAST(l_linenumber AS INTEGER) * 8 AS maximum,
  CAST(l_linenumber AS INTEGER) * 5 - CAST(l_quantity AS INTEGER) AS overlap FROM lineitem)""",
        "embed_attach_validate": """SELECT count(*) AS chunks, count(*) FILTER (embedding IS NULL) AS missing_embedding,
  CAST(min(len(embedding)) AS BIGINT) AS min_dimension, CAST(max(len(embedding)) AS BIGINT) AS max_dimension,
  count(*) FILTER (len(embedding) <> 64) AS wrong_dimension, min(len(embedding)) = max(len(embedding)) AS uniform
FROM documents LEFT JOIN embeddings ON doc_id = vec_id""",
        "batch_manifest": f"""WITH {MANIFEST} SELECT batch_id, CAST(year AS VARCHAR) AS year,
  strftime(start_date, '%Y-%m-%d') AS start_date, strftime(end_date, '%Y-%m-%d') AS end_date, error FROM manifest""",
        "batch_overlap": f"""WITH {MANIFEST} SELECT CAST(a.year AS BIGINT) AS year, a.batch_id, b.batch_id AS other_batch_id
FROM manifest a JOIN manifest b ON a.batch_id < b.batch_id AND a.start_date <= b.end_date AND b.start_date <= a.end_date""",
        "batch_presence": """SELECT batch_id, batch_id IN (SELECT strftime(ts, '%Y-%m') FROM events) AS listed
FROM (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS batch_id FROM orders)""",
        "batch_lineage_roundtrip": f"""{KEPT} SELECT article_id, year, month_id AS batch_id,
  CASE WHEN month_id = '2022-06' THEN 'Revised: ' || title ELSE title END AS title, content FROM base""",
        "batch_retire": f"""{KEPT} SELECT {FLAT_COLUMNS}, month_id AS batch_id FROM flat WHERE month_id <> '2022-03'""",
        "stale_outputs": f"""{KEPT} SELECT DISTINCT month_id AS batch_id, stage FROM base, (VALUES ('base'), ('flattened')) v(stage)
WHERE stage = 'base' OR quarter_year IN ('2022Q1', '2022Q2')""",
        "batch_run": f"""{KEPT} SELECT {FLAT_COLUMNS}, '2022-01_to_2022-12' AS batch_id FROM flat""",
        "batch_run_embeddings": embedded,
        "batch_conflicts": f"""WITH {MANIFEST}, span AS (SELECT min(year(o_orderdate)) AS y FROM orders)
SELECT batch_id FROM manifest, span WHERE error IS NOT NULL OR start_date <= make_date(y, 6, 30) AND end_date >= make_date(y, 2, 1)
  AND batch_id <> y || '-02_to_' || y || '-06'""",
        "incremental_ingest": f"""{KEPT} SELECT {FLAT_COLUMNS},
  CASE WHEN month_id <= '2022-06' THEN '2022-01_to_2022-06' ELSE '2022-07_to_2022-12' END AS batch_id FROM flat""",
        "landed_delivery": f"""{KEPT} SELECT url, 'by ' || url AS author, upper(CAST(exclude_from_housing_analysis AS VARCHAR)) AS flag FROM raw""",
        "run_all_stages": f"""{article_chunks(*default)}, n AS (SELECT count(*) AS c FROM chunks)
SELECT 'base' AS stage, count(*) AS rows FROM base UNION ALL SELECT 'flattened', count(*) FROM flat
UNION ALL SELECT 'chunks', c FROM n UNION ALL SELECT 'embeddings', c FROM n""",
        "failed_rerun": f"""{article_chunks(*default)} SELECT k || ':chunk_' || w AS chunk_id, md5(chunk) AS chunk_md5 FROM chunks""",
        "stage_compaction": f"""{KEPT} SELECT {FLAT_COLUMNS}, month_id AS batch_id FROM flat""",
        "compaction_choice": f"""{KEPT} SELECT month_id AS batch_id, count(*) AS rows,
  month_id IN ('2022-04', '2022-05') AS rewritten, CAST(1 AS BIGINT) AS files_after FROM flat GROUP BY month_id""",
        "stale_stages": f"""{KEPT}, months AS (SELECT DISTINCT month_id AS batch_id FROM base),
ends AS (SELECT max(batch_id) AS newest FROM months)
SELECT batch_id, stage, CASE WHEN batch_id = newest OR stage = 'embeddings' OR stage = 'chunks' AND batch_id >= '2022-10' THEN 'missing'
  WHEN batch_id = '2022-06' THEN 'stale' ELSE 'fresh' END AS status
FROM months, ends, (VALUES ('base'), ('flattened'), ('chunks'), ('embeddings')) v(stage)""",
        "repeated_in_batch": """WITH articles AS (
  SELECT source || ' | ' || lang || ' | ' || (n_chars // 50) AS article_id,
    strftime(DATE '2022-01-01' + CAST(doc_id % 365 AS INTEGER), '%Y-%m') AS batch_id FROM documents)
SELECT article_id, count(DISTINCT batch_id) AS batches FROM articles
WHERE article_id IN (SELECT article_id FROM articles WHERE batch_id = '2022-12')
GROUP BY article_id HAVING count(DISTINCT batch_id) > 1""",
        "cross_batch_duplicates": """SELECT article_id, count(DISTINCT batch_id) AS batches FROM (
  SELECT source || ' | ' || lang || ' | ' || (n_chars // 50) AS article_id,
    strftime(DATE '2022-01-01' + CAST(doc_id % 365 AS INTEGER), '%Y-%m') AS batch_id FROM documents)
GROUP BY article_id HAVING count(DISTINCT batch_id) > 1""",
    }
