"""DuckDB SQL of the queries here that SQL can express.

Learned models, similarity groups, pseudonyms and tokenisation have none; they
are tested against brute force, round trips or held-out accuracy.
"""

from __future__ import annotations

# Window by window over the whole tables, joined on the windows' words.
OP6 = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
gram AS (
  SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT item, w, least(len(w), 10) AS k,
               unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
        FROM item WHERE len(w) > 0)),
win AS (
  SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM doc, (SELECT DISTINCT k FROM gram) WHERE len(w) >= k)),
hit AS (SELECT win.r, win.k, win.i, gram.item FROM win JOIN gram USING (k, g)),
words AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM hit))
  GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""

OP7 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h
  FROM pages),
d AS (
  SELECT *, translate(array_to_string(list_transform(range(8), lambda i: to_base(
    CAST('0x' || h[5 * i + 1:5 * i + 5] AS BIGINT), 32, 4)), ''),
    '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS digest,
    min(page_id) OVER (PARTITION BY h) AS first_id
  FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN first_id IS DISTINCT FROM page_id AND first_id IS NOT NULL THEN 'revisit'
            ELSE 'response' END AS record_type,
       CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
FROM d"""


# Rules, then the posterior bound of the host's rate; one CTE per level.
_RHO = """least(greatest(coalesce(sum((good - n * mu) ** 2 - n * mu * (1 - mu))
       / nullif(sum(n * (n - 1) * mu * (1 - mu)), 0), 1e-4), 1e-4), 0.99)"""
OP10 = f"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN url[instr(url, '://') + 3:] ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
lab AS (
  SELECT doc_id AS page_id, CAST(avg(quality) >= 0.5 AS INTEGER) AS good
  FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
h0 AS (
  SELECT host, count(good) AS n, coalesce(sum(good), 0) AS good, regexp_replace(
    regexp_replace(host, '^.*@', ''), '([^:]):[0-9]*$', '\\1') AS name
  FROM p LEFT JOIN lab USING (page_id) GROUP BY host),
h1 AS (
  SELECT *, string_split(name, '.') AS l,
    regexp_matches(name, '^[0-9]{{1,3}}(\\.[0-9]{{1,3}}){{3}}$') OR starts_with(name, '[') AS address,
    array_to_string(string_split(name, '.')[-2:], '.') IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'co.nz',
    'com.br', 'co.in') AS two FROM h0),
h AS (
  SELECT host, n, good,
    CASE WHEN address THEN name WHEN two AND len(l) > 2 THEN array_to_string(l[-3:], '.')
         WHEN NOT two AND len(l) > 1 THEN array_to_string(l[-2:], '.') ELSE name END AS domain,
    CASE WHEN address THEN name WHEN two THEN array_to_string(l[-2:], '.') ELSE l[-1] END AS suffix
  FROM h1),
o AS (SELECT (sum(good) + 1.0) / (sum(n) + 2.0) AS mu FROM h),
s0 AS (SELECT suffix, sum(n) AS n, sum(good) AS good, any_value(o.mu) AS mu FROM h, o GROUP BY suffix),
s AS (SELECT suffix, (good + k * mu) / (n + k) AS rate
      FROM s0, (SELECT 1 / {_RHO} - 1 AS k FROM s0)),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(good) AS good, any_value(rate) AS mu
       FROM h JOIN s USING (suffix) GROUP BY domain, suffix),
d AS (SELECT domain, (good + k * mu) / (n + k) AS rate
      FROM d0, (SELECT 1 / {_RHO} - 1 AS k FROM d0)),
r0 AS (SELECT host, n, good, rate AS mu FROM h JOIN d USING (domain)),
r AS (SELECT host, (good + k * mu) / (n + k) AS rate, n + k + 1 AS m
      FROM r0, (SELECT 1 / {_RHO} - 1 AS k FROM r0)),
v AS (SELECT host, CASE WHEN rate + 1.645 * sqrt(rate * (1 - rate) / m) < 0.5 THEN 'block'
                        ELSE 'allow' END AS by_host FROM r),
x AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM p LEFT JOIN v USING (host))
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
  CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block'
       WHEN rule IS NOT NULL THEN 'allow' ELSE by_host END AS verdict
FROM x"""


def _spans(kind: str, rank: int, pattern: str, group: int = 0, least: int = 1) -> str:
    """SQL for one rule's spans of ``doc`` (r, t): lengths of the pieces between
    matches and of the matches, added up in turn."""
    return f"""
  SELECT r, '{kind}' AS kind, {rank} AS rank, s, e FROM (
    SELECT r, length(g[i]) AS gl,
      list_sum(list_transform(gaps[1:i], lambda x: length(x)))
        + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s,
      list_sum(list_transform(gaps[1:i], lambda x: length(x)))
        + list_sum(list_transform(m[1:i], lambda x: length(x))) AS e
    FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT r, regexp_extract_all(t, '{pattern}') AS m,
             regexp_extract_all(t, '{pattern}', {group}) AS g,
             regexp_split_to_array(t, '{pattern}') AS gaps FROM doc)))
  WHERE gl >= {least}"""


def _op8() -> str:
    q = "''"
    either = "".join  # letters of the names in either case, without Unicode folding

    def ci(word: str) -> str:
        return either(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)

    names = "|".join([ci("password"), ci("passwd"), ci("secret"), ci("token"),
                      ci("api") + "_?" + ci("key")])
    assign = rf'({names})["{q}]?\x20*[:=]\x20*["{q}]?([A-Za-z0-9+/_.=-]+)'
    rules = [
        ("assign", assign, 2, 6), ("access", "AKIA[A-Z0-9]{16,}", 0, 1),
        ("hex", "[0-9a-f]{24,}", 0, 1),
        ("private_key", "-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", 0, 1),
        ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
        ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
        ("google", "AIza[A-Za-z0-9_-]{35}", 0, 1),
        ("stripe", "[rs]k_live_[A-Za-z0-9]{16,}", 0, 1),
        ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1)]
    spans = "\n  UNION ALL".join(_spans(k, i, p, g, n) for i, (k, p, g, n) in enumerate(rules))
    return f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
span AS ({spans}),
one AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS n_assign,
         count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ','
                    ORDER BY s, rank) FILTER (rank < 3) AS base,
         string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ','
                    ORDER BY s, rank) AS every
  FROM span GROUP BY r)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign,
       CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM doc LEFT JOIN one USING (r)"""


def _op13(k: int = 8, rounds: int = 10, dims: int = 64) -> str:
    """One pair of CTEs a round: distances by dimension, then exact means."""
    ctes = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})""",
            f"""pt AS MATERIALIZED (
  SELECT r, d, CAST(floor(1024 * CAST(embedding[d] AS DOUBLE)) AS BIGINT) AS x
  FROM kept, range(1, {dims + 1}) t(d))""",
            f"""c0 AS MATERIALIZED (
  SELECT c, d, x FROM (SELECT r, row_number() OVER (
    ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)) NULLS LAST, embedding) - 1 AS c
    FROM kept) JOIN pt USING (r) WHERE c < {k})"""]
    for i in range(rounds + 1):
        ctes.append(f"""a{i} AS MATERIALIZED (
  SELECT r, arg_min(c, (dist, c)) AS c, min(dist) AS dist
  FROM (SELECT r, c, sum((pt.x - c{i}.x) * (pt.x - c{i}.x)) AS dist
        FROM pt JOIN c{i} USING (d) GROUP BY r, c) GROUP BY r)""")
        if i < rounds:
            ctes.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c, d, coalesce((s - ((s % n) + n) % n) // n, x) AS x
  FROM c{i} LEFT JOIN (SELECT c, d, sum(x) AS s, count(*) AS n FROM pt JOIN a{i} USING (r)
                       GROUP BY c, d) USING (c, d))""")
    body = ",\n".join(ctes)
    return f"""
WITH {body},
per AS (SELECT c, CAST(sum(dist) AS BIGINT) AS ci FROM a{rounds} GROUP BY c),
digest AS (SELECT c, sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY d)) AS sha
           FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(dist AS BIGINT) AS distance, ci AS cluster_inertia,
       CAST((SELECT sum(ci) FROM per) AS BIGINT) AS inertia, sha AS centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN per USING (c) JOIN digest USING (c)"""


def llm_sql() -> dict[str, str]:
    return {"op6_benchmark_ngrams": OP6, "op7_warc_segments": OP7, "op8_trigram_secrets": _op8(),
            "op10_host_filter": OP10,
            "op13_rotated_centroids": _op13()}
