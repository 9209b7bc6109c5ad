"""The same results in SQL, from the tables' own numbers and dates instead of the text."""

from __future__ import annotations

# meaning of the messy order texts; k = order, c = customer
EXPECTED = """
WITH m AS (
  SELECT o_orderkey AS k, o_custkey AS c, CAST(o_orderdate AS DATE) AS d,
         CAST(floor(o_totalprice) AS BIGINT) AS n, o_orderpriority AS pr
  FROM orders
), e AS (
  SELECT k, c, pr, n, d,
    CASE WHEN k % 10 IN (0, 1, 2) THEN n
         WHEN k % 10 = 3 THEN CAST(round_even(n::DOUBLE * 1.1::DOUBLE, 0) AS BIGINT)
         WHEN k % 10 = 4 THEN CAST(round_even(n::DOUBLE * 1.27::DOUBLE, 0) AS BIGINT)
         WHEN k % 10 = 5 THEN CAST(round_even(n::DOUBLE * (1::DOUBLE / 150::DOUBLE), 0) AS BIGINT)
         WHEN k % 10 = 6 THEN n + 1000 END AS usd,
    CASE WHEN k % 10 < 6 THEN 'valid' WHEN k % 10 = 6 THEN 'valid_range'
         WHEN k % 10 = 9 THEN 'unparseable' ELSE 'invalid_missing' END AS status,
    CASE k % 10 WHEN 3 THEN 'EUR' WHEN 4 THEN 'GBP' WHEN 5 THEN 'JPY' WHEN 7 THEN NULL
         WHEN 8 THEN NULL WHEN 9 THEN NULL ELSE 'USD' END AS currency,
    k % 10 = 6 AS is_range,
    CASE WHEN (k // 10) % 7 = 6 THEN NULL
         WHEN (k // 10) % 7 IN (2, 3) AND day(d) <= 12 AND month(d) > day(d)
           THEN make_date(year(d), day(d), month(d))
         ELSE d END AS day,
    CASE WHEN c % 25 <> 24 THEN 'NATION_' || (c % 25) END AS nation,
    CASE WHEN c % 25 = 24 THEN 'GHOST ' || ((c // 25) % 3)
         WHEN (c // 25) % 4 = 0 THEN 'NATION_' || (c % 25)
         WHEN (c // 25) % 4 = 1 THEN 'nation_' || (c % 25)
         WHEN (c // 25) % 4 = 2 THEN 'Nation-' || (c % 25)
         ELSE 'NATION_' || (c % 25) || 'S' END AS company_raw,
    CASE pr WHEN '1-URGENT' THEN 'AI_ML' WHEN '2-HIGH' THEN 'CLOUD_COMPUTING'
         WHEN '3-MEDIUM' THEN 'FINTECH' ELSE 'UNKNOWN' END AS category_group,
    'ART-' || upper(substr(sha1(CAST(k AS VARCHAR)), 1, 16)) AS article_id,
    CASE k % 10 WHEN 7 THEN 'Not disclosed' WHEN 8 THEN 'N/A' WHEN 9 THEN 'garbage' END AS failed_text
  FROM m
)"""

COMPANIES = """
, co AS (
  SELECT n_name, n_nationkey AS nk, 1950 + n_nationkey AS founded_year,
         'Region ' || n_regionkey AS headquarters,
         CASE WHEN n_nationkey <> 7 THEN CAST(n_nationkey * 2000 AS BIGINT) END AS employee_count,
         CASE WHEN n_regionkey = 1 THEN 'AI/ML' ELSE 'FinTech' END AS industry,
         n_nationkey % 2 = 0 AS is_public,
         CASE WHEN n_nationkey % 2 = 0 THEN 'N' || n_nationkey END AS stock_ticker
  FROM nation
), a AS (
  SELECT e.*, co.*, CAST(year(day) - founded_year AS BIGINT) AS company_age,
         CASE WHEN employee_count < 10000 THEN 'Small' WHEN employee_count <= 30000 THEN 'Medium'
              WHEN employee_count IS NOT NULL THEN 'Large' END AS company_size_category
  FROM e LEFT JOIN co ON e.nation = co.n_name
)"""

# observations with each customer as a company
FACTS = EXPECTED + """
, f0 AS (
  SELECT *, 'COMP-' || upper(substr(sha1(CAST(c AS VARCHAR)), 1, 16)) AS company_id
  FROM e WHERE usd IS NOT NULL AND day IS NOT NULL
), f AS (
  SELECT k, c, company_id, article_id, day AS observation_date, usd AS arr_usd,
         'ARR-' || upper(substr(sha1(company_id || '|' || article_id || '|' ||
                                     strftime(day, '%Y-%m-%d')), 1, 24)) AS arr_observation_id
  FROM f0
)"""

LATEST = FACTS + """
, l AS (
  SELECT *, row_number() OVER (PARTITION BY company_id
                               ORDER BY observation_date DESC, arr_observation_id) AS rn
  FROM f
)"""

QUARTERS = FACTS + """
, q0 AS (
  SELECT *, CAST(year(observation_date) AS BIGINT) AS published_year,
         CAST(quarter(observation_date) AS BIGINT) AS published_quarter FROM f
), q1 AS (
  SELECT *, row_number() OVER (PARTITION BY company_id, published_year, published_quarter
                               ORDER BY observation_date DESC, arr_observation_id) AS rn FROM q0
), q AS (
  SELECT company_id, published_year, published_quarter, observation_date, arr_usd
  FROM q1 WHERE rn = 1
)"""

_PLAIN_REVENUE = """
SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS arr_usd, 'USD' AS currency,
       false AS is_range, 'valid' AS status
FROM orders"""

_HIT = "FROM customer JOIN nation ON c_nationkey = n_nationkey"

ORACLES = {
    "revenue_suffix": _PLAIN_REVENUE,
    "revenue_symbol_commas": _PLAIN_REVENUE,
    "revenue_word_scale": _PLAIN_REVENUE,
    "revenue_fx": """
SELECT o_orderkey,
       CAST(round_even(floor(o_totalprice)::DOUBLE * CASE o_orderkey % 3 WHEN 0 THEN 1.1::DOUBLE
         WHEN 1 THEN 1.27::DOUBLE ELSE 1::DOUBLE / 150::DOUBLE END, 0) AS BIGINT) AS arr_usd,
       CASE o_orderkey % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'GBP' ELSE 'JPY' END AS currency,
       false AS is_range, 'valid' AS status
FROM orders""",
    "revenue_range_midpoint": """
SELECT o_orderkey,
       CAST(round_even((2 * floor(o_totalprice) + 2000 + o_orderkey % 2)::DOUBLE / 2, 0) AS BIGINT)
         AS arr_usd,
       'USD' AS currency, true AS is_range, 'valid_range' AS status
FROM orders""",
    "revenue_missing_status": EXPECTED + """
SELECT k AS o_orderkey, usd AS arr_usd, currency, is_range, status FROM e""",
    "revenue_lineitem": """
SELECT l_suppkey,
       CAST(sum(CAST(floor(l_extendedprice) AS BIGINT) + CASE WHEN l_linenumber % 3 = 2 THEN 5 ELSE 0 END)
            AS BIGINT) AS arr_usd,
       count(*) AS n, CAST(sum(CASE WHEN l_linenumber % 3 = 2 THEN 1 ELSE 0 END) AS BIGINT) AS ranges
FROM lineitem GROUP BY l_suppkey""",
    "date_formats": EXPECTED + """
SELECT k AS o_orderkey, day AS parsed_date,
       CASE WHEN day IS NULL THEN 'invalid' ELSE 'valid' END AS status FROM e""",
    "date_ambiguous": """
SELECT o_orderkey,
       CASE WHEN day(o_orderdate) <= 12
            THEN make_date(year(o_orderdate), least(day(o_orderdate), month(o_orderdate)),
                           greatest(day(o_orderdate), month(o_orderdate)))
            ELSE CAST(o_orderdate AS DATE) END AS parsed_date
FROM orders""",
    "date_parts": """
SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS year,
       CAST(quarter(o_orderdate) AS BIGINT) AS quarter, CAST(month(o_orderdate) AS BIGINT) AS month
FROM orders""",
    "category_taxonomy": """
SELECT event_id,
       CASE event_type WHEN 'view' THEN 'AI_ML' WHEN 'click' THEN 'DATA_ANALYTICS'
            WHEN 'purchase' THEN 'FINTECH' ELSE 'UNKNOWN' END AS category_standardized,
       event_type = 'view' AS is_ai
FROM events""",
    "surrogate_keys": """
WITH i AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d,
         CASE WHEN o_custkey % 10 <> 0
              THEN 'COMP-' || upper(substr(sha1(CAST(o_custkey AS VARCHAR)), 1, 16)) END AS company_id,
         'ART-' || upper(substr(sha1(CAST(o_orderkey AS VARCHAR)), 1, 16)) AS article_id
  FROM orders)
SELECT o_orderkey, company_id, article_id,
       'ARR-' || upper(substr(sha1(company_id || '|' || article_id || '|' ||
                                   strftime(d, '%Y-%m-%d')), 1, 24)) AS arr_observation_id
FROM i""",
    "entity_exact_alias": f"""
SELECT c_custkey,
       CASE WHEN c_custkey % 4 = 3 OR (c_custkey % 4 = 1 AND c_nationkey = 4) THEN NULL
            ELSE n_name END AS company_name_resolved,
       CASE WHEN c_custkey % 4 = 0 THEN 'exact' WHEN c_custkey % 4 = 2 THEN 'alias'
            WHEN c_custkey % 4 = 1 AND c_nationkey <> 4 THEN 'case_insensitive' END AS stage
{_HIT}""",
    "entity_compact": f"""
SELECT c_custkey, n_name AS company_name_resolved, 'compact' AS stage {_HIT}""",
    "entity_fuzzy": f"""
SELECT c_custkey, CASE WHEN c_custkey % 3 < 2 THEN n_name END AS company_name_resolved,
       CASE WHEN c_custkey % 3 < 2 THEN 'fuzzy' END AS stage {_HIT}""",
    "entity_fuzzy_many": """
SELECT c_custkey, substr(sha1(c_name), 1, 20) AS company_name_resolved, 'fuzzy' AS stage
FROM customer""",
    "silver_articles": EXPECTED + """
SELECT k AS o_orderkey, article_id, company_raw AS company_name_raw,
       nation AS company_name_resolved,
       'COMP-' || upper(substr(sha1(nation), 1, 16)) AS company_id, day AS published_date,
       CAST(year(day) AS BIGINT) AS published_year, category_group AS category_standardized,
       usd AS arr_usd, currency AS revenue_currency, is_range AS revenue_is_range,
       status AS arr_parse_status
FROM e""",
    "parse_errors": EXPECTED + """
SELECT article_id, CAST(k AS VARCHAR) AS source_article_id,
       coalesce(nation, company_raw) AS company_name, 'revenue' AS field,
       failed_text AS raw_value, status AS issue
FROM e WHERE usd IS NULL
UNION ALL
SELECT article_id, CAST(k AS VARCHAR), coalesce(nation, company_raw), 'published_date',
       'not a date', 'invalid'
FROM e WHERE day IS NULL""",
    "unmatched_counts": EXPECTED + """
SELECT company_raw AS company_name_raw, count(*) AS article_count
FROM e WHERE nation IS NULL GROUP BY company_raw""",
    "fact_valid": EXPECTED + """
, g AS (
  SELECT *, 'COMP-' || upper(substr(sha1(nation), 1, 16)) AS company_id FROM e
  WHERE usd IS NOT NULL AND day IS NOT NULL AND nation IS NOT NULL)
SELECT 'ARR-' || upper(substr(sha1(company_id || '|' || article_id || '|' ||
                                   strftime(day, '%Y-%m-%d')), 1, 24)) AS arr_observation_id,
       company_id, article_id, day AS observation_date, usd AS arr_usd,
       CASE k % 10
         WHEN 0 THEN '$' || format('{:,}', n)
         WHEN 1 THEN (n // 1000) || '.' || lpad(CAST(n % 1000 AS VARCHAR), 3, '0') || 'K'
         WHEN 2 THEN '$' || (n // 1000000) || '.' || lpad(CAST(n % 1000000 AS VARCHAR), 6, '0')
                     || ' million'
         WHEN 3 THEN '€' || format('{:,}', n)
         WHEN 4 THEN '£' || format('{:,}', n)
         WHEN 5 THEN '¥' || format('{:,}', n)
         ELSE '$' || n || ' - $' || (n + 2000) END AS arr_raw_value,
       currency AS arr_currency, is_range AS arr_is_range
FROM g""",
    "dim_enrichment": EXPECTED + COMPANIES + """
SELECT k AS o_orderkey, industry, headquarters, employee_count,
       CAST(founded_year AS BIGINT) AS founded_year, is_public, stock_ticker, company_age,
       company_size_category
FROM a""",
    "ai_export_filter": EXPECTED + COMPANIES + """
SELECT article_id, 'Order ' || k AS title, coalesce(nation, company_raw) AS company_name,
       day AS published_date,
       CASE pr WHEN '1-URGENT' THEN 'Machine Learning' WHEN '2-HIGH' THEN ' Cloud '
            WHEN '3-MEDIUM' THEN 'FinTech' WHEN '4-NOT SPECIFIED' THEN 'saas' END AS category,
       usd AS arr_usd, industry, company_age, company_size_category
FROM a
WHERE (pr = '1-URGENT' OR industry = 'AI/ML') AND year(day) BETWEEN 1995 AND 1998
  AND usd > 200000""",
    "latest_per_company": LATEST + """
SELECT company_id, observation_date, arr_usd, arr_observation_id FROM l WHERE rn = 1""",
    "latest_top5": LATEST + """
SELECT company_id, observation_date, arr_usd FROM l WHERE rn = 1
ORDER BY arr_usd DESC, company_id LIMIT 5""",
    "quarterly_last": QUARTERS + " SELECT * FROM q",
    "quarterly_growth": QUARTERS + """
, w AS (
  SELECT *, lag(arr_usd) OVER (PARTITION BY company_id
                               ORDER BY published_year, published_quarter) AS previous_arr_usd
  FROM q)
SELECT *, arr_usd - previous_arr_usd AS change_usd,
       round((arr_usd - previous_arr_usd)::DOUBLE / nullif(previous_arr_usd, 0)::DOUBLE, 6)
         AS change_ratio
FROM w""",
    "quarterly_with_dimensions": FACTS + """
, q AS (
  SELECT c_name AS company_name, CAST(year(o_orderdate) AS BIGINT) AS published_year,
         CAST(quarter(o_orderdate) AS BIGINT) AS published_quarter, observation_date, arr_usd,
         row_number() OVER (PARTITION BY company_id, year(o_orderdate), quarter(o_orderdate)
                            ORDER BY observation_date DESC, arr_observation_id) AS rn
  FROM f JOIN customer ON c_custkey = f.c JOIN orders ON o_orderkey = f.k)
SELECT company_name, published_year, published_quarter, observation_date, arr_usd
FROM q WHERE rn = 1""",
    "series_one_company": FACTS + """
SELECT observation_date, arr_usd, arr_observation_id
FROM f WHERE c = (SELECT c_custkey FROM customer WHERE c_name = 'Customer#000000007')
ORDER BY observation_date, arr_observation_id""",
    "lineage": FACTS + """
SELECT arr_observation_id, k AS o_orderkey, observation_date, arr_usd, true AS same FROM f""",
    "quality_summary": """
SELECT 'orders' AS table_name, count(*) AS row_count FROM orders
UNION ALL SELECT 'customer', count(*) FROM customer
UNION ALL SELECT 'nation', count(*) FROM nation
UNION ALL SELECT 'lineitem', count(*) FROM lineitem""",
    "quality_duplicates": """
SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) AS row_count
FROM orders GROUP BY ALL HAVING count(*) > 1""",
    "vector_topk": """
WITH q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 0),
s AS (SELECT vec_id, list_dot_product(embedding::DOUBLE[], v) AS score FROM embeddings, q)
SELECT vec_id, round(score, 6) AS similarity FROM s ORDER BY score DESC, vec_id LIMIT 10""",
    "vector_top3_all": """
WITH p AS (
  SELECT a.vec_id AS id, b.vec_id AS neighbour,
         list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS score
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, neighbour) AS rank FROM p)
SELECT id, rank, neighbour, round(score, 6) AS similarity FROM r WHERE rank <= 3""",
    "vector_hybrid": """
WITH q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 0),
s AS (
  SELECT vec_id, label, round(list_dot_product(embedding::DOUBLE[], v)
           / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS similarity
  FROM embeddings, q
  WHERE label BETWEEN 1 AND 6 AND vec_id * 1000 > 20000 AND label IN (1, 2, 3, 4, 9)
    AND vec_id % 2 = 1)
SELECT vec_id AS article_id, 'Vector ' || vec_id AS title, CAST(2000 + label AS BIGINT) AS published_year,
       'L' || label AS category, 'odd' AS industry, vec_id * 1000 AS arr_usd, similarity
FROM s ORDER BY similarity DESC, vec_id LIMIT 10""",
    "text_encoding": r"""
WITH w AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS word FROM documents),
b AS (
  SELECT doc_id, CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % 384 AS bucket, count(*) AS n
  FROM w GROUP BY ALL),
m AS (SELECT *, max(n) OVER (PARTITION BY doc_id) AS most FROM b)
SELECT doc_id, count(*) AS filled, arg_min(bucket, struct_pack(a := -n, b := bucket)) AS top_bucket,
       count(*) FILTER (WHERE 2 * n >= most) AS heavy
FROM m GROUP BY doc_id""",
    "csv_source": EXPECTED + """
SELECT k AS o_orderkey, 'He said "Order ' || k || '",' || chr(10) || 'then left' AS title,
       CASE k % 10
         WHEN 0 THEN '$' || format('{:,}', n)
         WHEN 1 THEN (n // 1000) || '.' || lpad(CAST(n % 1000 AS VARCHAR), 3, '0') || 'K'
         WHEN 2 THEN '$' || (n // 1000000) || '.' || lpad(CAST(n % 1000000 AS VARCHAR), 6, '0')
                     || ' million'
         WHEN 3 THEN '€' || format('{:,}', n)
         WHEN 4 THEN '£' || format('{:,}', n)
         WHEN 5 THEN '¥' || format('{:,}', n)
         WHEN 6 THEN '$' || n || ' - $' || (n + 2000)
         WHEN 7 THEN 'Not disclosed' WHEN 8 THEN '' ELSE 'garbage' END AS revenue,
       '' AS url,
       CASE pr WHEN '1-URGENT' THEN 'Machine Learning' WHEN '2-HIGH' THEN ' Cloud '
            WHEN '3-MEDIUM' THEN 'FinTech' WHEN '4-NOT SPECIFIED' THEN 'saas' ELSE '' END AS category
FROM e""",
    "company_json_source": """
SELECT c_name AS company_name, CAST(1950 + c_nationkey AS BIGINT) AS founded_year,
       c_custkey AS employee_count, c_mktsegment AS industry, c_custkey % 2 = 0 AS is_public,
       CAST(NULL AS VARCHAR) AS stock_ticker, true AS hashed
FROM customer""",
    "stored_tables": EXPECTED + """
SELECT nation AS company_name, count(*) AS articles, CAST(sum(usd) AS BIGINT) AS arr_usd
FROM e WHERE year(day) = 1997 AND nation IS NOT NULL GROUP BY nation""",
    "incremental_upsert": EXPECTED + """
SELECT k AS o_orderkey, nation AS company_name_resolved,
       CASE WHEN k % 3 = 0 THEN k * 1000 ELSE usd END AS arr_usd,
       CASE WHEN k % 3 = 0 THEN 'valid' ELSE status END AS arr_parse_status
FROM e""",
    "encoding_text": """
SELECT doc_id, md5(trim(coalesce(nullif(lang, 'de'), '') || ' ' || coalesce(text, ''), w)) AS text_md5
FROM documents, (SELECT string_agg(chr(CAST(c AS INTEGER)), '') AS w FROM (SELECT unnest(
  [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 8232, 8233, 8239, 8287, 12288] || range(8192, 8203)) AS c))""",
    "embeddings_roundtrip": """
SELECT vec_id, CAST(len(embedding) AS BIGINT) AS dimension, round(list_sum(embedding::DOUBLE[]), 6) AS total,
       true AS same FROM embeddings""",
    "provenance": """
SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey,
       sha1(string_agg(c_name, chr(10) ORDER BY c_custkey) || chr(10)) AS source_hash
FROM customer GROUP BY 1""",
}
