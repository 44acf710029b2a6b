"""DuckDB SQL of the training-data queries that SQL can express: plain brute force, without sketches or tables of codes."""

_COMPONENTS = """
reach(node, other) AS (
  SELECT id, id FROM nodes
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other
),
component AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
"""

OP1 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT s.a, s.b FROM shared s JOIN sizes x ON x.doc_id = s.a JOIN sizes y ON y.doc_id = s.b
  WHERE 100 * s.both >= 85 * (x.n + y.n - s.both)
),
nodes AS (SELECT doc_id AS id FROM documents),
{_COMPONENTS}
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN component c ON c.node = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

_STRENGTH = """
SELECT greatest(1.0, least(10000.0, CASE WHEN rho > 0 THEN 1 / rho - 1 ELSE 10000.0 END))::DOUBLE AS s FROM (
  SELECT (sum(n * (bad / n - m) * (bad / n - m)) - sum(m * (1 - m))) / nullif(sum(m * (1 - m) * (n - 1)), 0) AS rho
  FROM {children} WHERE n > 0 AND m > 0 AND m < 1)
"""

OP3 = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
thin AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM thin
),
outcomes AS (
  SELECT t.host, CASE WHEN l.quality = 0 OR l.toxic = 1 THEN 1 WHEN l.quality = 1 AND l.toxic = 0 THEN 0 END AS bad
  FROM thin t JOIN labels l ON l.doc_id = t.page_id
),
counted AS (SELECT host, sum(bad)::DOUBLE AS bad, count(*)::DOUBLE AS n FROM outcomes WHERE bad IN (0, 1) GROUP BY host),
hosts AS (SELECT DISTINCT host, string_split(host, '.') AS p FROM thin),
two AS (SELECT *, CASE WHEN len(p) <= 2 THEN host ELSE p[-2] || '.' || p[-1] END AS last_two FROM hosts),
domained AS (
  SELECT host, CASE WHEN last_two IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br', 'co.in', 'co.nz', 'co.za', 'com.cn') AND len(p) > 2
    THEN p[-3] || '.' || last_two ELSE last_two END AS domain
  FROM two
),
known AS (
  SELECT d.host, d.domain, CASE WHEN instr(d.domain, '.') > 0 THEN substr(d.domain, instr(d.domain, '.') + 1) ELSE d.domain END AS suffix,
    coalesce(c.bad, 0) AS bad, coalesce(c.n, 0) AS n
  FROM domained d LEFT JOIN counted c USING (host)
),
domains AS (SELECT suffix, domain, sum(bad) AS bad, sum(n) AS n FROM known GROUP BY suffix, domain),
suffixes AS (SELECT suffix, sum(bad) AS bad, sum(n) AS n FROM domains GROUP BY suffix),
suffix_in AS (SELECT *, (SELECT (sum(bad) + 1) / (sum(n) + 2) FROM suffixes) AS m FROM suffixes),
suffix_s AS ({_STRENGTH.format(children="suffix_in")}),
suffix_m AS (SELECT suffix, (bad + s * m) / (n + s) AS m FROM suffix_in, suffix_s),
domain_in AS (SELECT d.*, x.m FROM domains d JOIN suffix_m x USING (suffix)),
domain_s AS ({_STRENGTH.format(children="domain_in")}),
domain_m AS (SELECT domain, (bad + s * m) / (n + s) AS m FROM domain_in, domain_s),
host_in AS (SELECT k.*, x.m FROM known k JOIN domain_m x USING (domain)),
host_s AS ({_STRENGTH.format(children="host_in")}),
beta AS (SELECT host, bad + s * m AS a, n - bad + s * (1 - m) AS b FROM host_in, host_s),
reputation AS (SELECT host, a / (a + b) AS mean, a / (a + b) - 1.645::DOUBLE * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) AS lower FROM beta)
SELECT r.page_id, r.host, r.path, r.rule,
  CASE WHEN r.rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN r.rule IS NOT NULL OR p.lower > 0.5 THEN 'block' ELSE 'allow' END AS verdict,
  round(p.mean, 6) AS bad_rate, round(p.lower, 6) AS bad_rate_low
FROM ruled r LEFT JOIN reputation p USING (host)
"""

OP5 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.e, y.e) >= 0.93
),
nodes AS (SELECT vec_id AS id FROM embeddings),
{_COMPONENTS},
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT m.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, m.vec_id = c.component_id AS kept
FROM embeddings m JOIN component c ON c.node = m.vec_id LEFT JOIN counts n ON n.a = m.vec_id
"""

OP8 = """
WITH thin AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS s, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents
),
sums AS (SELECT s, source, CAST(sum(size) AS BIGINT) AS source_size FROM thin GROUP BY s, source),
weighed AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w FROM sums),
levelled AS (
  SELECT *, CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER up, 0) AS DOUBLE) / (sum(w) OVER () - coalesce(sum(w) OVER up, 0)) AS level
  FROM weighed WINDOW up AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
topped AS (SELECT *, max(CASE WHEN level * w <= 3 * source_size THEN level END) OVER () AS final FROM levelled),
targets AS (SELECT s, source_size, coalesce(least(final * w, CAST(3 * source_size AS DOUBLE)), CAST(3 * source_size AS DOUBLE)) AS target FROM topped),
rests AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies, target - copies * source_size AS rest FROM targets
),
by_size AS (SELECT s, size, count(*) AS docs FROM thin WHERE size > 0 GROUP BY s, size),
cells AS (
  SELECT s, size, CAST(sum(size * docs) OVER up AS BIGINT) AS below, CAST(sum(size * size * docs) OVER up AS DOUBLE) AS squares
  FROM by_size WINDOW up AS (PARTITION BY s ORDER BY size)
),
chance AS (
  SELECT s, max(c) AS c FROM (SELECT x.s, x.size, (r.rest - (r.source_size - x.below)) / x.squares AS c FROM cells x JOIN rests r USING (s))
  WHERE c * size <= 1 GROUP BY s
),
odds AS (
  SELECT t.doc_id, t.s, t.size, r.source_size, r.target, r.copies, r.rest,
    CASE WHEN t.size > 0 THEN least(1.0::DOUBLE, greatest(k.c, 0.0::DOUBLE) * t.size) ELSE 0.0::DOUBLE END AS p,
    (CAST('0x' || substr(md5('11|' || coalesce(CAST(t.doc_id AS VARCHAR), 'null')), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u
  FROM thin t JOIN rests r USING (s) LEFT JOIN chance k USING (s)
),
ranked AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) * (1 - p) / p END AS q FROM odds),
drawn AS (
  SELECT *, CASE WHEN q IS NOT NULL AND rest > 0 AND sum(size) OVER (PARTITION BY s, q IS NULL ORDER BY q, doc_id, size ROWS UNBOUNDED PRECEDING) <= rest
    THEN 1 ELSE 0 END AS extra FROM ranked
),
gaps AS (SELECT s, any_value(rest) - CAST(sum(size * extra) AS BIGINT) AS gap FROM drawn GROUP BY s),
best AS (
  SELECT s, doc_id FROM drawn JOIN gaps USING (s) WHERE extra = 0 AND q IS NOT NULL AND abs(gap - size) < gap
  QUALIFY row_number() OVER (PARTITION BY s ORDER BY abs(gap - size), q, doc_id) = 1
)
SELECT d.doc_id, d.size, d.source_size, d.target,
  CAST((d.copies + d.extra + CASE WHEN b.doc_id IS NOT NULL THEN 1 ELSE 0 END) * d.size AS BIGINT) AS taken
FROM drawn d LEFT JOIN best b ON b.s = d.s AND b.doc_id = d.doc_id
"""

OP13 = """
WITH sound AS (
  SELECT vec_id, [CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT) for c in embedding] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len([c for c in embedding if c IS NULL OR NOT isfinite(c)]) = 0
)
SELECT q.vec_id AS query_id, CAST(row_number() OVER best AS INTEGER) AS rank, c.vec_id,
  CAST(coalesce(list_sum([q.x[i] * c.x[i] for i in range(1, len(q.x) + 1)]), 0) AS BIGINT) AS score
FROM sound q JOIN sound c ON q.vec_id % 20 = 0 AND len(q.x) = len(c.x) AND q.vec_id IS DISTINCT FROM c.vec_id
WINDOW best AS (
  PARTITION BY q.vec_id ORDER BY coalesce(list_sum([q.x[i] * c.x[i] for i in range(1, len(q.x) + 1)]), 0) DESC, c.vec_id NULLS LAST
)
QUALIFY row_number() OVER best <= 20
"""

ORACLE: dict[str, str] = {"op1_minhash_near_dedup": OP1, "op3_url_filter": OP3, "op5_embedding_near_dedup": OP5, "op8_mixing": OP8, "op13_exact_top_k": OP13}
