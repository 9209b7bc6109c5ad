"""The same results in DuckDB's SQL, where SQL can express them."""

from obslake.llm import url_rules
from obslake.llm.templates import TOKEN, UNITS

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES = {
    "op10_substring_dedup": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
f AS (SELECT g, min(doc_id) AS first FROM g GROUP BY g),
r AS (SELECT doc_id, i FROM g JOIN f USING (g) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM r, (SELECT unnest(range(0, 13)) AS k)),
one AS (SELECT doc_id, i, w[i] AS w FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
kept AS (SELECT one.doc_id, string_agg(w, ' ' ORDER BY one.i) AS kept, count(*) AS n FROM one
         LEFT JOIN gone ON gone.doc_id = one.doc_id AND gone.i = one.i WHERE gone.i IS NULL GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id""",
    "op5_line_runs": r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
p AS (SELECT doc_id, i, l[i] AS line, len(regexp_extract_all(l[i], '[^\x20\x09-\x0D]+')) AS n
      FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM d)),
c AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM p),
-- the least depth that reaches eight words
r AS (SELECT a.doc_id, a.i, min(b.i) AS last FROM c a JOIN c b
      ON b.doc_id = a.doc_id AND b.i >= a.i AND b.upto - a.upto + a.n >= 8 GROUP BY 1, 2),
runs AS (SELECT r.doc_id, r.i, r.last, d.l[r.i:r.last] AS run FROM r JOIN d USING (doc_id)),
f AS (SELECT run, min(struct_pack(doc_id := doc_id, i := i)) AS first FROM runs GROUP BY run),
gone AS (SELECT DISTINCT runs.doc_id, unnest(range(runs.i, runs.last + 1)) AS i FROM runs JOIN f USING (run)
         WHERE f.first < struct_pack(doc_id := runs.doc_id, i := runs.i)),
kept AS (SELECT p.doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY p.i) AS kept FROM p
         LEFT JOIN gone ON gone.doc_id = p.doc_id AND gone.i = p.i WHERE gone.i IS NULL GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(l), 0) - coalesce(n, 0) AS BIGINT) AS n_removed,
       CASE WHEN l IS NOT NULL THEN sha256(coalesce(kept, '')) END AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id""",
    "op5_whole_line_runs": r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
p AS (SELECT doc_id, i, l[i] AS line, len(regexp_extract_all(l[i], '[^\x20\x09-\x0D]+')) AS n
      FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM d)),
c AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM p),
-- every run of eight words or more
r AS (SELECT a.doc_id, a.i, b.i AS last FROM c a JOIN c b
      ON b.doc_id = a.doc_id AND b.i >= a.i AND b.upto - a.upto + a.n >= 8),
runs AS (SELECT r.doc_id, r.i, r.last, d.l[r.i:r.last] AS run FROM r JOIN d USING (doc_id)),
f AS (SELECT run, min(struct_pack(doc_id := doc_id, i := i)) AS first FROM runs GROUP BY run),
gone AS (SELECT DISTINCT runs.doc_id, unnest(range(runs.i, runs.last + 1)) AS i FROM runs JOIN f USING (run)
         WHERE f.first < struct_pack(doc_id := runs.doc_id, i := runs.i)),
kept AS (SELECT p.doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY p.i) AS kept FROM p
         LEFT JOIN gone ON gone.doc_id = p.doc_id AND gone.i = p.i WHERE gone.i IS NULL GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(l), 0) - coalesce(n, 0) AS BIGINT) AS n_removed,
       CASE WHEN l IS NOT NULL THEN sha256(coalesce(kept, '')) END AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id""",
    "op9_legacy_archive": """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
                  sha1(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND last > page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND last > page_id THEN last END AS refers_to
FROM q""",
    "op1_verbatim_leaks": rf"""
WITH raw AS (
    SELECT 'd' AS side, doc_id AS id, regexp_extract_all(lower(text), '{TOKEN}') AS w FROM documents
    UNION ALL SELECT 'b', item_id, regexp_extract_all(lower(text), '{TOKEN}') FROM benchmark),
lengths AS (SELECT DISTINCT least(len(w), 13) AS n FROM raw WHERE side = 'b' AND len(w) > 0),
asked AS (SELECT side, id, w, n FROM raw JOIN lengths ON n <= len(w) WHERE side = 'd' OR n = least(len(w), 13)),
win AS (SELECT side, id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
        FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM asked)),
items AS (SELECT id, n, g, min(i) AS i, count(*) OVER (PARTITION BY id) AS total FROM win
          WHERE side = 'b' GROUP BY id, n, g),
al AS (SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_windows, max(b.total) AS item_windows
       FROM win d JOIN items b USING (n, g) WHERE d.side = 'd' GROUP BY 1, 2, d.i - b.i)
SELECT doc_id, item_id, max(n_windows) AS n_windows, max(item_windows) AS item_windows FROM al GROUP BY 1, 2""",
    "op1_template_leaks": rf"""
WITH raw AS (
    SELECT 'd' AS side, doc_id AS id, regexp_extract_all(text, '{TOKEN}') AS w FROM documents
    UNION ALL SELECT 'b', item_id, regexp_extract_all(text, '{TOKEN}') FROM benchmark),
tok AS (SELECT side, id, w, unnest(range(1, len(w) + 1)) AS i FROM raw),
kind AS (SELECT side, id, i, w[i] AS x, CASE WHEN w[i] < ':' THEN 1
              WHEN i > 1 AND w[i - 1] < ':' AND lower(w[i]) IN ({", ".join(f"'{u}'" for u in UNITS)}) THEN 3
              WHEN lower(w[i]) <> w[i] THEN 2 ELSE 0 END AS k FROM tok),
tpl AS (SELECT side, id, list(CASE WHEN k = 0 THEN x ELSE '<' || k || '>' END ORDER BY i) AS t,
               list(k ORDER BY i) AS k, list(x ORDER BY i) AS x FROM kind GROUP BY 1, 2),
win AS (SELECT side, id, i, array_to_string(t[i:i + 7], ' ') AS g,
               len(list_filter(k[i:i + 7], lambda v: v = 0)) AS literals
        FROM (SELECT *, unnest(range(1, len(t) - 6)) AS i FROM tpl)),
items AS (SELECT id, g, min(i) AS i, count(*) OVER (PARTITION BY id) AS n FROM win
          WHERE side = 'b' AND literals >= 4 GROUP BY id, g),
al AS (SELECT d.id AS doc_id, b.id AS item_id, d.i - b.i AS shift, count(*) AS n_windows, max(b.n) AS item_windows,
              min(b.i) AS low, max(b.i) + 7 AS high
       FROM win d JOIN items b USING (g) WHERE d.side = 'd' GROUP BY 1, 2, 3),
al2 AS (SELECT * FROM al WHERE n_windows >= item_windows * 0.5 OR n_windows >= 6),
slot AS (SELECT a.doc_id, a.item_id, a.shift, b.k, b.x AS x, d.x AS y
         FROM al2 a JOIN kind b ON b.side = 'b' AND b.id = a.item_id AND b.i BETWEEN a.low AND a.high
         JOIN kind d ON d.side = 'd' AND d.id = a.doc_id AND d.i = b.i + a.shift AND d.k = b.k WHERE b.k > 0),
bad AS (SELECT DISTINCT doc_id, item_id, shift FROM (
    SELECT doc_id, item_id, shift FROM slot GROUP BY doc_id, item_id, shift, k, x HAVING count(DISTINCT y) > 1
    UNION ALL
    SELECT doc_id, item_id, shift FROM slot GROUP BY doc_id, item_id, shift, k, y HAVING count(DISTINCT x) > 1)),
ex AS (SELECT doc_id, item_id, shift, bool_and(x = y) AS exact FROM slot GROUP BY 1, 2, 3),
ok AS (SELECT al2.*, coalesce(ex.exact, true) AS exact FROM al2 LEFT JOIN bad USING (doc_id, item_id, shift)
       LEFT JOIN ex USING (doc_id, item_id, shift) WHERE bad.doc_id IS NULL)
SELECT doc_id, item_id, n_windows, item_windows, exact FROM ok
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_windows DESC, exact DESC) = 1""",
    "op13_url_rules": url_rules.brute_force_sql(),
}
