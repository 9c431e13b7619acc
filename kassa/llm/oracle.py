"""DuckDB twins of the queries whose results SQL can express.

The page rules are spelled out in ``queries.py`` too; the licence wordings are
read from ``license_scan.py`` (they are data), their matching is written anew.
"""

from __future__ import annotations

from .license_scan import BASE, MATCH_SHARE, TEMPLATES
from .url_filter import SUFFIXES, UNWANTED

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ORACLE: dict[str, str] = {}

ORACLE["op5_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

ORACLE["op3_exact_topk"] = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)
SELECT q.vec_id AS query_id,
       row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, p.v) DESC, p.vec_id)::INTEGER AS rank,
       p.vec_id, list_inner_product(q.v, p.v)::BIGINT AS score
FROM whole q JOIN whole p ON p.vec_id <> q.vec_id AND len(p.v) = len(q.v)
WHERE q.vec_id % 50 = 0
QUALIFY rank <= 5
"""

ORACLE["op6_url_filter"] = f"""
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{UPPER.lower()}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
         regexp_replace(replace(coalesce(html, ''), '&amp;', '&'),
           '(?is)<script.*?</script>|<style.*?</style>|<nav.*?</nav>|<!--.*?-->|<[^>]*>', ' ', 'g') AS txt
  FROM pages),
looked AS (
  SELECT *, regexp_extract_all(txt, '[^\\x20\\x09-\\x0D]+') AS ws,
         len(regexp_extract_all(txt, '[%#*$!|&]{{2,}}|[\\x20\\x09-\\x0D][|]')) AS marks
  FROM parts),
outcomes AS (
  SELECT page_id, host, path, (len(ws) > 0 AND marks * 10 >= len(ws) * 3) OR (len(ws) >= 20 AND len(list_distinct(ws)) * 4 <= len(ws))
         OR regexp_matches(host, '(^|[^a-z])({'|'.join(UNWANTED)})([^a-z]|$)') AS bad
  FROM looked),
ruled AS (
  SELECT *, CASE
      WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM outcomes),
named AS (SELECT *, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS labels, regexp_matches(host, '^[0-9.]+(:[0-9]*)?$') AS number
          FROM ruled),
judged AS (
  SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS by_rule,
         CASE WHEN number THEN '' ELSE array_to_string(labels[-size:], '.') END AS suffix,
         array_to_string(CASE WHEN number THEN labels ELSE labels[-size - 1:] END, '.') AS domain
  FROM (SELECT *, CASE WHEN array_to_string(labels[-2:], '.') IN ({', '.join(f"'{x}'" for x in SUFFIXES)}) THEN 2 ELSE 1 END AS size FROM named)),
h AS (SELECT suffix, domain, host, count(*)::DOUBLE AS n, sum(bad::INT)::DOUBLE AS k
      FROM judged GROUP BY ALL),
d AS (SELECT suffix, domain, sum(n) AS n, sum(k) AS k FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM d GROUP BY ALL),
s1 AS (SELECT *, (SELECT (sum(k) + 0.5) / (sum(n) + 1) FROM s) AS m FROM s),
s2 AS (SELECT coalesce((sum(n * (k / n - m) * (k / n - m)) - sum(m * (1 - m))) / nullif(sum(m * (1 - m) * (n - 1)), 0), 0.5) AS rho FROM s1),
s3 AS (SELECT s1.*, (k + c * m) / (n + c) AS share
       FROM s1, (SELECT round(1 / least(greatest(rho, 1 / 1001), 0.5) - 1, 6) AS c FROM s2)),
d1 AS (SELECT d.*, s3.share AS m FROM d JOIN s3 USING (suffix)),
d2 AS (SELECT coalesce((sum(n * (k / n - m) * (k / n - m)) - sum(m * (1 - m))) / nullif(sum(m * (1 - m) * (n - 1)), 0), 0.5) AS rho FROM d1),
d3 AS (SELECT d1.*, (k + c * m) / (n + c) AS share
       FROM d1, (SELECT round(1 / least(greatest(rho, 1 / 1001), 0.5) - 1, 6) AS c FROM d2)),
h1 AS (SELECT h.*, d3.share AS m FROM h JOIN d3 USING (domain)),
h2 AS (SELECT coalesce((sum(n * (k / n - m) * (k / n - m)) - sum(m * (1 - m))) / nullif(sum(m * (1 - m) * (n - 1)), 0), 0.5) AS rho FROM h1),
h3 AS (SELECT h1.*, c, (k + c * m) / (n + c) AS share
       FROM h1, (SELECT round(1 / least(greatest(rho, 1 / 1001), 0.5) - 1, 6) AS c FROM h2))
SELECT page_id, host, path, rule, coalesce(by_rule,
         CASE WHEN share - 1.645 * sqrt(share * (1 - share) / (n + c + 1)) > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM judged JOIN h3 USING (host)
"""


def _licenses() -> str:
    """Every phrase and wording is searched at every place of the word list."""
    def starts(places: list[tuple[int, str]], n: int) -> str:
        first = min(p for p, _ in places)
        here = " AND ".join(f"ws[s + {p + 1}] = '{w}'" for p, w in places)
        return f"list_filter(range({-n}, len(ws)), lambda s: s + {first} >= 0 AND {here})"

    cols, labels, base_labels, shares, every = [], [], [], [], []
    for i, (phrase, label) in enumerate(BASE.items()):
        words = phrase.split()
        cols.append(f"{starts(list(enumerate(words)), 0)} AS b{i}")
        base_labels.append(f"CASE WHEN len(b{i}) > 0 THEN '{label}' END")
        every.append(f"b{i}")
    for i, t in enumerate(TEMPLATES):
        needed = [(p + j, w) for p, k in t.keys for j, w in enumerate(k)]
        words = [(p, w) for p, w in enumerate(t.words) if w]
        cols.append(f"{starts(needed, len(t.words))} AS s{i}")
        there = " + ".join(f"CASE WHEN s + {p} >= 0 AND ws[s + {p + 1}] = '{w}' THEN 1 ELSE 0 END" for p, w in words)
        shares.append(f"CASE WHEN len(s{i}) > 0 THEN list_max(list_transform(s{i}, lambda s: {there})) / {len(words)}.0::DOUBLE ELSE 0 END AS c{i}")
        labels.append(f"CASE WHEN c{i} >= {MATCH_SHARE} THEN '{t.label}' END")
    best = ", ".join(f"CASE WHEN c{i} >= {MATCH_SHARE} THEN c{i} ELSE 0 END" for i in range(len(TEMPLATES)))
    join = lambda x: f"coalesce(array_to_string(list_sort(list_distinct([{', '.join(x)}])), ','), '')"
    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
f AS (SELECT doc_id, ws, {', '.join(cols)} FROM w),
c AS (SELECT *, list_concat({', '.join(every)}) AS places, {', '.join(shares)} FROM f)
SELECT doc_id, len(ws) AS n_words, len(places) AS n_base, list_min(places)::BIGINT AS first_word,
       list_max(places)::BIGINT AS last_word, {join(base_labels)} AS base_labels, {join(base_labels + labels)} AS labels,
       greatest({best}, CASE WHEN len(places) > 0 THEN 0.5 ELSE 0 END)::DOUBLE AS score
FROM c
"""


ORACLE["op2_license_scan"] = _licenses()

ORACLE["op10_line_dedup"] = """
WITH l AS (
  SELECT doc_id, unnest(range(len(ls))) AS pos, unnest(ls) AS txt
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
w AS (
  SELECT doc_id, pos, md5(txt) AS line, len(regexp_extract_all(txt, '[^\\x20\\x09-\\x0D]+')) AS n
  FROM l),
p AS (
  SELECT *, row_number() OVER d - 1 AS idx, sum(n) OVER d - n AS b, sum(n) OVER d AS e
  FROM w WHERE n > 0 WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
-- the fewest lines from each line on, and up to each line, that hold 50 words
shortest AS (
  SELECT doc_id, idx AS lo, last_value(idx) OVER f AS hi, b, last_value(e) OVER f AS e, string_agg(line, ',') OVER f AS run
  FROM p WINDOW f AS (PARTITION BY doc_id ORDER BY b RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
  UNION
  SELECT doc_id, first_value(idx) OVER f, idx, first_value(b) OVER f, e, string_agg(line, ',') OVER f
  FROM p WINDOW f AS (PARTITION BY doc_id ORDER BY e RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
placed AS (
  SELECT doc_id, lo, hi, min({'d': doc_id, 'i': lo}) OVER (PARTITION BY run) AS origin FROM shortest WHERE e - b >= 50),
later AS (SELECT doc_id, lo, hi FROM placed WHERE origin <> {'d': doc_id, 'i': lo}),
c AS (
  SELECT DISTINCT p.doc_id, p.idx, p.pos, p.n FROM p JOIN later ON p.doc_id = later.doc_id AND p.idx BETWEEN later.lo AND later.hi),
r AS (
  SELECT doc_id, min(pos) AS lo, max(pos) AS hi, sum(n) AS words
  FROM (SELECT *, idx - row_number() OVER (PARTITION BY doc_id ORDER BY idx) AS run FROM c)
  GROUP BY doc_id, run),
cut AS (
  SELECT l.doc_id, string_agg(txt, chr(10) ORDER BY l.pos) AS text
  FROM l JOIN (SELECT DISTINCT doc_id FROM r) USING (doc_id)
  WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.doc_id = l.doc_id AND l.pos BETWEEN r.lo AND r.hi)
  GROUP BY l.doc_id),
sums AS (SELECT doc_id, count(*) AS n_runs, sum(words)::BIGINT AS n_words_removed FROM r GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN n_runs IS NULL THEN d.text ELSE coalesce(cut.text, '') END AS text,
       coalesce(n_runs, 0) AS n_runs, coalesce(n_words_removed, 0) AS n_words_removed
FROM documents d LEFT JOIN sums USING (doc_id) LEFT JOIN cut USING (doc_id)
"""
