"""Queries of `glossmill.llm.queries` that SQL can express in full, over the same tables."""

from __future__ import annotations

_FILL_IN_MIDDLE = r"""WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents),
u AS (
  SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
        OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
      WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
c AS (
  SELECT *, substring(t, 1, least(a, b)) AS p, substring(t, least(a, b) + 1, abs(a - b)) AS m,
    substring(t, greatest(a, b) + 1) AS s FROM u)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(a, b) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN abs(a - b) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM c"""

_FILTER_AUDIT = r"""WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
firsts AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
    max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END
    || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN first_id < d.doc_id THEN 'E' ELSE '' END AS failed
  FROM d JOIN firsts USING (t) LEFT JOIN l ON d.doc_id = l.doc_id),
cell AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, failed),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT o, CAST(unnest([1, 2, 3, 4, 5]) AS INTEGER) AS step FROM orders),
s AS (SELECT o, step, o[step] AS x, '[' || o[1:step - 1] || '0]' AS before, '[' || o[1:step] || ']' AS upto FROM steps),
r AS (
  SELECT part, o AS filter_order, step, x,
    sum(CASE WHEN NOT regexp_matches(failed, upto) THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN contains(failed, x) AND NOT regexp_matches(failed, before) THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN contains(failed, x) AND regexp_matches(failed, before) THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN failed = x THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN contains(failed, x) AND NOT regexp_matches(failed, before) THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN contains(failed, x) AND NOT regexp_matches(failed, before) THEN toxic ELSE 0 END) AS toxic_lost
  FROM cell, s GROUP BY part, o, step, x)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM r"""

ORACLES: dict[str, str] = {
    "op11_fill_in_middle": _FILL_IN_MIDDLE,
    "op13_filter_audit": _FILTER_AUDIT,
}
