"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import jaccard_join, topk_search, url_filters, vector_codes, warc

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

TOPK = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x:
    CAST(floor({topk_search.SCALE:.0f} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, v.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place
      FROM s)
WHERE place <= {topk_search.K}"""

URL_FILTERS = f"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0
    THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (
  SELECT page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR suffix(host, '.www.example.com'))
      AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR suffix(host, '.example.com'))
      AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/') THEN 'com/'
    END AS rule FROM parsed),
decided AS (
  SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block' END AS known FROM ruled),
hosts AS (
  SELECT host, regexp_extract(host, '[^.]*$') AS suffix,
    regexp_extract(host, '[^.]*([.][^.]*)?$') AS domain,
    count(known) AS n, count(*) FILTER (known = 'block') AS bad
  FROM decided GROUP BY host),
root AS (
  SELECT (sum(bad) + 0.5) / (sum(n) + 1) AS mean, sum(n) + 1 AS n FROM hosts),
suffix_in AS (
  SELECT suffix, sum(h.n) AS n, sum(h.bad) AS bad, any_value(r.mean) AS mean,
    any_value(sqrt(r.mean * (1 - r.mean) / (r.n + 1))) AS spread
  FROM hosts AS h, root AS r GROUP BY suffix),
suffixes AS ({{suffixes}}),
domain_in AS (
  SELECT h.domain, h.suffix, sum(h.n) AS n, sum(h.bad) AS bad, any_value(s.mean) AS mean,
    any_value(s.spread) AS spread
  FROM hosts AS h JOIN suffixes AS s USING (suffix) GROUP BY h.domain, h.suffix),
domains AS ({{domains}}),
host_in AS (
  SELECT h.host, h.n, h.bad, d.mean, d.spread
  FROM hosts AS h JOIN domains AS d USING (domain, suffix)),
known_hosts AS ({{hosts}})
SELECT page_id, host, path, rule, coalesce(known,
  CASE WHEN mean - {url_filters.BOUND} * spread > {url_filters.LIMIT}
    THEN 'block' ELSE 'allow' END) AS verdict
FROM decided JOIN known_hosts USING (host)"""


def _shrunk(groups: str) -> str:
    """A level's posteriors from its counts and its parents' means and spreads."""
    return f"""
  WITH rho AS (
    SELECT least(greatest(coalesce(
      sum(n * pow(bad / n - mean, 2) - mean * (1 - mean))
      / nullif(sum(mean * (1 - mean) * (n - 1)), 0), 0.5), 1e-3), 0.9) AS rho
    FROM {groups} WHERE n > 0),
  prior AS (
    SELECT g.*, greatest(mean * (1 - mean)
      / (spread * spread + mean * (1 - mean) * rho) - 1, {url_filters.LEAST_STRENGTH}) AS worth
    FROM {groups} AS g, rho),
  beta AS (SELECT *, worth * mean + bad AS a, worth * (1 - mean) + n - bad AS b FROM prior)
  SELECT * REPLACE (a / (a + b) AS mean,
    sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS spread) FROM beta"""


URL_FILTERS = URL_FILTERS.format(suffixes=_shrunk("suffix_in"), domains=_shrunk("domain_in"),
                                 hosts=_shrunk("host_in"))

JACCARD_JOIN = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")},
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < {jaccard_join.N} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {jaccard_join.N} + 2),
      lambda i: array_to_string(w[i:i + {jaccard_join.N} - 1], ' '))) END AS s FROM words),
tokens AS (SELECT doc_id, len(s) AS size, unnest(s) AS token FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM tokens AS a JOIN tokens AS b USING (token)
  WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.size, b.size
  HAVING 100 * count(*) >= {jaccard_join.PERCENT} * (a.size + b.size - count(*))),
reach AS (
  SELECT doc_id AS node, doc_id AS label FROM sets
  UNION SELECT links.b, reach.label FROM reach JOIN links ON links.a = reach.node)
SELECT s.doc_id, CAST(len(any_value(s.s)) AS BIGINT) AS n_shingles, min(label) AS component_id
FROM sets AS s JOIN reach ON reach.node = s.doc_id GROUP BY s.doc_id"""

WARC = f"""
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest FROM pages),
kept AS (
  SELECT *, CASE WHEN payload_bytes >= {warc.MIN_BYTES}
    THEN max(page_id) OVER (PARTITION BY payload_digest) END AS keeper FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id IS DISTINCT FROM keeper AND keeper IS NOT NULL
    THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
FROM kept"""

def _nearest(round_: int) -> str:
    """Each part's entry of least distance, and that distance, by a round's codebook."""
    return f"""
  SELECT place, vec_id, min(struct_pack(far, entry)) AS best FROM (
    SELECT p.place, p.vec_id, b.entry, sum((p.x - b.x) * (p.x - b.x)) AS far
    FROM parts AS p JOIN book{round_} AS b USING (place, dim) GROUP BY p.place, p.vec_id, b.entry)
  GROUP BY place, vec_id"""


def _vector_codes() -> str:
    rounds = "".join(f"""
near{r} AS MATERIALIZED ({_nearest(r)}),
mean{r} AS (
  SELECT p.place, n.best.entry AS entry, p.dim,
    CAST(floor(CAST(sum(p.x) AS DOUBLE) / count(*)) AS BIGINT) AS x
  FROM parts AS p JOIN near{r} AS n USING (place, vec_id) GROUP BY ALL),
book{r + 1} AS MATERIALIZED (
  SELECT place, entry, dim, coalesce(m.x, b.x) AS x
  FROM book{r} AS b LEFT JOIN mean{r} AS m USING (place, entry, dim)),"""
                     for r in range(vector_codes.ROUNDS))
    last = vector_codes.ROUNDS
    return f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, label, len(embedding) // {vector_codes.PARTS} AS width,
    list_transform(embedding, lambda x:
      CAST(floor({vector_codes.SCALE:.0f} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, (i - 1) // width AS place, (i - 1) % width AS dim, v[i] AS x
  FROM (SELECT vec_id, width, v, unnest(range(1, len(v) + 1)) AS i FROM v)),
book0 AS MATERIALIZED (
  SELECT place, entry, dim, x FROM parts JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v
    QUALIFY entry < {vector_codes.ENTRIES}) USING (vec_id)),{rounds}
last AS MATERIALIZED ({_nearest(last)}),
coded AS (
  SELECT vec_id, string_agg(printf('%02x', best.entry), '' ORDER BY place) AS code,
    CAST(sum(best.far) AS BIGINT) AS error FROM last GROUP BY vec_id)
SELECT vec_id, code, error,
  CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY place, entry, dim))
   FROM book{last}) AS codebooks_sha256
FROM coded JOIN v USING (vec_id)"""


ORACLES = {"op1_topk": TOPK, "op4_url_filters": URL_FILTERS, "op7_jaccard_join": JACCARD_JOIN,
           "op8_warc": WARC, "op12_vector_codes": _vector_codes()}
