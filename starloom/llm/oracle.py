"""SQL that must give the rows of a query."""

from __future__ import annotations

from .secret_scan import BASE, RULES, Rule


def _spans_sql(rule: Rule, number: int) -> str:
    """Spans of one rule: the text split by the pattern gives the gaps, all matches the lengths; starts are running sums."""
    pattern = ("(?i)" if rule.ignore_case else "") + rule.pattern
    quoted = "'" + pattern.replace("'", "''") + "'"
    keep = f"length(regexp_extract(m, {quoted}, {rule.group})) >= {rule.least}"
    return f"""SELECT doc_id, '{rule.kind}' AS kind, {number} AS k, start, start + length(m) AS stop FROM (
    SELECT doc_id, unnest(hits) AS m, unnest(list_transform(range(1, len(hits) + 1), lambda i:
      list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0))) AS start
    FROM (SELECT doc_id, regexp_extract_all(body, {quoted}) AS hits, regexp_split_to_array(body, {quoted}) AS gaps FROM texts
          WHERE regexp_matches(body, {quoted})) AS s) AS u WHERE {keep}"""


def secret_scan_sql() -> str:
    every = "\nUNION ALL\n".join(_spans_sql(r, k) for k, r in enumerate(RULES))
    base = ", ".join(f"'{r.kind}'" for r in BASE)
    say = "kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT)"
    numbers = ", ".join(f"CAST(count(*) FILTER (kind = '{r.kind}') AS BIGINT) AS n_{r.kind}" for r in BASE)
    return f"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
spans AS ({every}),
joined AS (SELECT doc_id, {numbers}, sha256(coalesce(string_agg({say}, ',' ORDER BY start, k) FILTER (kind IN ({base})), '')) AS base_sha256,
  string_agg({say}, ',' ORDER BY start, k) AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)}, coalesce(base_sha256, sha256('')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents AS d LEFT JOIN joined USING (doc_id)"""


JACCARD = """WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
shingles AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles AS a JOIN shingles AS b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS node, doc_id AS other FROM documents UNION SELECT node, b FROM reach JOIN links ON other = a),
found AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, f.component_id, count(*) OVER (PARTITION BY f.component_id) AS component_rows
FROM documents AS d LEFT JOIN sizes AS z ON z.doc_id = d.doc_id JOIN found AS f ON f.node = d.doc_id"""

AUDIT = """WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM texts),
failing AS (SELECT doc_id, part,
  CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
  || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN 'C' ELSE '' END
  || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS fails FROM words),
marks AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
classes AS (SELECT part, fails, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic, count(*) AS n
  FROM failing LEFT JOIN marks USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM letters AS a, letters AS b, letters AS c, letters AS d, letters AS e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
steps AS (SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) AS s),
seen AS (SELECT part, filter_order, step, letter, n, good, toxic, contains(fails, letter) AS failing, fails = letter AS alone,
  length(translate(earlier, fails, '')) = length(earlier) AS reached FROM classes, steps)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(sum(n) FILTER (reached AND NOT failing), 0) AS BIGINT) AS kept,
  CAST(coalesce(sum(n) FILTER (reached AND failing), 0) AS BIGINT) AS removed, CAST(coalesce(sum(n) FILTER (failing AND NOT reached), 0) AS BIGINT) AS redundant,
  CAST(coalesce(sum(n) FILTER (alone), 0) AS BIGINT) AS unique_fails, CAST(coalesce(sum(n) FILTER (reached AND failing AND good), 0) AS BIGINT) AS good_lost,
  CAST(coalesce(sum(n) FILTER (reached AND failing AND toxic), 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(sum(n) FILTER (reached AND failing), 0)) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM seen GROUP BY part, filter_order, step, letter"""

ORACLE = {"op11_filter_audit": AUDIT, "op1_secret_scan": secret_scan_sql(), "op6_ngram_jaccard": JACCARD}
