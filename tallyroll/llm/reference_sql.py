"""SQL for the queries that it can express, over the whole tables and straight from their definitions."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_MANY = f"""words AS (SELECT doc_id, regexp_extract_all({{text}}, '{WORD}') AS w FROM documents)"""

OP1 = """WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
starts AS (SELECT doc_id, x, unnest(range(0, n - 99)) AS i FROM texts WHERE n >= 100),
windows AS (SELECT doc_id, i, md5_number(x[2 * i + 1 : 2 * i + 200]) AS k FROM starts),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1 AS again FROM windows),
edges AS (
  SELECT doc_id, i AS a, i + 100 AS b, max(i + 100) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM ranked WHERE again
),
spans AS (
  SELECT doc_id, min(a) AS a, max(b) AS b
  FROM (SELECT *, sum(CASE WHEN before >= a THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY a) AS span FROM edges) e
  GROUP BY doc_id, span
),
gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS low, a AS high FROM spans
  UNION ALL SELECT t.doc_id, coalesce(max(b), 0), any_value(n) FROM texts t LEFT JOIN spans s ON s.doc_id = t.doc_id GROUP BY t.doc_id
),
kept AS (
  SELECT g.doc_id, string_agg(x[2 * low + 1 : 2 * high], '' ORDER BY low) AS rest
  FROM gaps g JOIN texts t ON t.doc_id = g.doc_id GROUP BY g.doc_id
)
SELECT t.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(sum(b - a), 0) AS BIGINT) AS n_removed, count(a) AS n_spans,
  sha256(unhex(any_value(rest))) AS kept_sha256
FROM texts t LEFT JOIN spans s ON s.doc_id = t.doc_id JOIN kept k ON k.doc_id = t.doc_id GROUP BY t.doc_id, n"""

OP2 = f"""WITH {_MANY.format(text=_LOWER)},
single AS (SELECT doc_id, unnest(w) AS b, unnest(range(1, len(w) + 1)) AS i FROM words),
double AS (SELECT s.doc_id, s.i, p.b AS a, s.b FROM single s LEFT JOIN single p ON p.doc_id = s.doc_id AND p.i = s.i - 1),
n1 AS (SELECT b, count(*) AS n FROM single GROUP BY b), own1 AS (SELECT doc_id, b, count(*) AS n FROM single GROUP BY doc_id, b),
n2 AS (SELECT a, b, count(*) AS n FROM double WHERE a IS NOT NULL GROUP BY a, b),
own2 AS (SELECT doc_id, a, b, count(*) AS n FROM double WHERE a IS NOT NULL GROUP BY doc_id, a, b),
total AS (SELECT count(*) AS n FROM single), size AS (SELECT doc_id, count(*) AS n FROM single GROUP BY doc_id),
values AS (
  SELECT d.doc_id, coalesce(n2.n - own2.n, 0) AS pair, coalesce(ca.n - oa.n, 0) AS context, cb.n - ob.n AS word,
    (SELECT n FROM total) - size.n AS rest, d.a IS NOT NULL AS inner_word
  FROM double d JOIN size ON size.doc_id = d.doc_id JOIN n1 cb ON cb.b = d.b JOIN own1 ob ON ob.doc_id = d.doc_id AND ob.b = d.b
  LEFT JOIN n1 ca ON ca.b = d.a LEFT JOIN own1 oa ON oa.doc_id = d.doc_id AND oa.b = d.a
  LEFT JOIN n2 ON n2.a = d.a AND n2.b = d.b LEFT JOIN own2 ON own2.doc_id = d.doc_id AND own2.a = d.a AND own2.b = d.b
),
logs AS (
  SELECT doc_id, sum(CASE WHEN pair > 0 THEN ln(pair) - ln(context)
    ELSE CASE WHEN inner_word THEN ln(0.4) ELSE 0 END + CASE WHEN word > 0 THEN ln(word) - ln(rest) ELSE ln(0.4) - ln(rest + 1) END END) AS s
  FROM values GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(size.n, 0) AS BIGINT) AS n_words, round(coalesce(s, 0), 4) AS log_score, round(s / size.n, 6) AS mean_log_score
FROM documents d LEFT JOIN size ON size.doc_id = d.doc_id LEFT JOIN logs ON logs.doc_id = d.doc_id"""

OP2_TRIGRAMS = f"""WITH {_MANY.format(text=_LOWER)},
single AS (SELECT doc_id, unnest(w) AS c, unnest(range(1, len(w) + 1)) AS i FROM words),
triple AS (
  SELECT s.doc_id, s.i, q.c AS a, p.c AS b, s.c
  FROM single s LEFT JOIN single p ON p.doc_id = s.doc_id AND p.i = s.i - 1 LEFT JOIN single q ON q.doc_id = s.doc_id AND q.i = s.i - 2
),
own1 AS (SELECT doc_id, c, count(*) AS n FROM single GROUP BY doc_id, c), n1 AS (SELECT c, sum(n) AS n FROM own1 GROUP BY c),
own2 AS (SELECT doc_id, b, c, count(*) AS n FROM triple WHERE b IS NOT NULL GROUP BY doc_id, b, c), n2 AS (SELECT b, c, sum(n) AS n FROM own2 GROUP BY b, c),
own3 AS (SELECT doc_id, a, b, c, count(*) AS n FROM triple WHERE a IS NOT NULL GROUP BY doc_id, a, b, c), n3 AS (SELECT a, b, c, sum(n) AS n FROM own3 GROUP BY a, b, c),
left1 AS (SELECT doc_id, c, n1.n - own1.n AS n FROM own1 JOIN n1 USING (c)),
left2 AS (SELECT doc_id, b, c, n2.n - own2.n AS n FROM own2 JOIN n2 USING (b, c)),
left3 AS (SELECT doc_id, a, b, c, n3.n - own3.n AS n FROM own3 JOIN n3 USING (a, b, c)),
total AS (SELECT count(*) AS n FROM single), size AS (SELECT doc_id, count(*) AS n FROM single GROUP BY doc_id),
values AS (
  SELECT t.doc_id, t.b, t.a, x1.n AS one, x2.n AS two, x3.n AS three, y1.n AS context1, y2.n AS context2, (SELECT n FROM total) - size.n AS rest
  FROM triple t JOIN size ON size.doc_id = t.doc_id JOIN left1 x1 ON x1.doc_id = t.doc_id AND x1.c = t.c
  LEFT JOIN left1 y1 ON y1.doc_id = t.doc_id AND y1.c = t.b
  LEFT JOIN left2 x2 ON x2.doc_id = t.doc_id AND x2.b = t.b AND x2.c = t.c
  LEFT JOIN left2 y2 ON y2.doc_id = t.doc_id AND y2.b = t.a AND y2.c = t.b
  LEFT JOIN left3 x3 ON x3.doc_id = t.doc_id AND x3.a = t.a AND x3.b = t.b AND x3.c = t.c
),
logs AS (
  SELECT doc_id, sum(CASE WHEN three > 0 THEN ln(three) - ln(context2)
    ELSE CASE WHEN a IS NOT NULL THEN ln(0.4) ELSE 0 END + CASE WHEN two > 0 THEN ln(two) - ln(context1)
    ELSE CASE WHEN b IS NOT NULL THEN ln(0.4) ELSE 0 END + CASE WHEN one > 0 THEN ln(one) - ln(rest) ELSE ln(0.4) - ln(rest + 1) END END END) AS s
  FROM values GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(size.n, 0) AS BIGINT) AS n_words, round(coalesce(s, 0), 4) AS log_score, round(s / size.n, 6) AS mean_log_score
FROM documents d LEFT JOIN size ON size.doc_id = d.doc_id LEFT JOIN logs ON logs.doc_id = d.doc_id"""

OP3 = f"""WITH {_MANY.format(text="coalesce(text, '')")},
windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words WHERE len(w) >= 13) s
),
owner AS (SELECT k, min(doc_id) AS first FROM windows GROUP BY k),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM (SELECT doc_id, i, unnest(range(0, 13)) AS j FROM windows JOIN owner USING (k) WHERE first < doc_id) g),
single AS (SELECT doc_id, unnest(w) AS b, unnest(range(1, len(w) + 1)) AS i FROM words),
kept AS (SELECT doc_id, string_agg(b, ' ' ORDER BY i) AS rest, count(*) AS n FROM single ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM words w LEFT JOIN kept ON kept.doc_id = w.doc_id"""

OP10 = f"""WITH RECURSIVE {_MANY.format(text=_LOWER)},
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0) s
),
size AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)
),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM ways UNION SELECT reach.a, ways.b FROM reach JOIN ways ON ways.a = reach.b)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id,
  d.doc_id = least(d.doc_id, coalesce(m, d.doc_id)) AS kept
FROM documents d LEFT JOIN size ON size.doc_id = d.doc_id LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) r ON r.a = d.doc_id"""


def reference_sql() -> dict[str, str]:
    return {"op1_suffix_dedup": OP1, "op2_trigram_scoring": OP2_TRIGRAMS, "op2_lm_scoring": OP2, "op3_substring_dedup": OP3, "op10_minhash_dedup": OP10}
