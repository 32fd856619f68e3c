"""Registered queries of the corpus operators, and the SQL of those that SQL can state."""

import functools

from tempestry.llm import (
    conversations,
    language_model,
    lexical,
    mixing,
    neighbours,
    packing,
    quality,
    secret_scan,
    simhash,
    suffix_dedup,
    urls,
    warc,
    wrapper,
)
from tempestry.llm.common import read_table, ship
from tempestry.session import Scratch

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


QUERIES = {}


def register(query):
    """Register a query, which first sees to it that executors have the package."""

    @functools.wraps(query)
    def run(spark, sf_dir):
        ship(spark)
        return query(spark, sf_dir)

    QUERIES[query.__name__] = run
    return query


@register
def op1_simhash_components(spark, sf_dir):
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@register
def op4_weak_quality(spark, sf_dir):
    rated = quality.rate_documents(read_table(spark, sf_dir, "documents"), Scratch(spark))
    return rated.drop("probability")


@register
def op5_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


@register
def op6_url_digests(spark, sf_dir):
    return urls.judge_urls(read_table(spark, sf_dir, "pages"))


@register
def op7_assigned_secrets(spark, sf_dir):
    return secret_scan.find_secrets(read_table(spark, sf_dir, "documents"))


@register
def op10_source_mix(spark, sf_dir):
    return mixing.mix_sources(read_table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH rules(verdict, rule) AS (VALUES ('allow', 'com/'), ('block', 'example.com/en/'),
  ('allow', 'www.example.com/en/'), ('block', 'net/es/'), ('block', 'net/fr/')),
parsed AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 2), '') AS path,
    row_number() OVER () AS row_id
  FROM pages
),
fits AS (
  SELECT row_id, verdict, rule, row_number() OVER (PARTITION BY row_id ORDER BY length(rule) DESC) AS k
  FROM parsed JOIN rules
    ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
    AND starts_with(path, substr(rule, length(split_part(rule, '/', 1)) + 1))
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parsed LEFT JOIN (SELECT * FROM fits WHERE k = 1) USING (row_id)"""

OP10_SQL = rf"""
WITH sizes AS (
  SELECT doc_id, source, CAST(coalesce(len({WORDS}), 0) AS BIGINT) AS size FROM documents
),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn
  FROM sizes GROUP BY source
),
weighed AS (SELECT *, turn % 3 + 1 AS weight, source_size * 3 AS cap FROM totals),
levels AS (
  SELECT *, CAST((sum(source_size) OVER ()) - coalesce(sum(cap) OVER room, 0) AS DOUBLE)
    / CAST((sum(weight) OVER ()) - coalesce(sum(weight) OVER room, 0) AS DOUBLE) AS level
  FROM weighed
  WINDOW room AS (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
common AS (
  SELECT level AS common FROM levels WHERE cap >= level * weight ORDER BY cap / weight, turn LIMIT 1
),
plan AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), common * weight) AS target,
    CAST(floor(least(CAST(cap AS DOUBLE), common * weight) + 0.5) AS BIGINT) AS budget
  FROM levels, common
),
keyed AS (
  SELECT source, doc_id, size, substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':0'), 1, 16) AS key,
    count(*) AS copies
  FROM sizes GROUP BY ALL
),
ranked AS (
  SELECT *, CAST(sum(copies * size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, size) AS BIGINT)
    - copies * size AS before
  FROM keyed
),
taken AS (
  SELECT r.source, doc_id, size, source_size, target,
    CASE WHEN source_size = 0 THEN 0 ELSE budget // source_size * size
      + least(greatest((budget % source_size - before) // copies, 0), size) END AS taken
  FROM ranked r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source
)
SELECT s.doc_id, s.size, source_size, target, CAST(taken AS BIGINT) AS taken
FROM sizes s JOIN taken t ON s.source IS NOT DISTINCT FROM t.source
  AND s.doc_id IS NOT DISTINCT FROM t.doc_id AND s.size = t.size"""

SQL = {"op6_url_digests": OP6_SQL, "op10_source_mix": OP10_SQL}


@register
def pipeline(spark, sf_dir):
    from corpus_pipeline import run

    return run(spark, sf_dir)


@register
def op2_suffix_repeats(spark, sf_dir):
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


@register
def op8_kneser_ney(spark, sf_dir):
    return language_model.score_documents(read_table(spark, sf_dir, "documents"))


@register
def op9_wrapper_text(spark, sf_dir):
    return wrapper.extract_text(read_table(spark, sf_dir, "pages"))


@register
def op3_nn_descent(spark, sf_dir):
    return neighbours.nearest(read_table(spark, sf_dir, "embeddings"))


@register
def op13_rmq_search(spark, sf_dir):
    return lexical.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


SQL["op13_rmq_search"] = r"""
WITH fold AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
),
docs AS (SELECT row_number() OVER () AS d, doc_id, terms, len(terms) AS n FROM fold WHERE len(terms) > 0),
totals AS (SELECT count(*) AS n_all, CAST(sum(n) AS BIGINT) AS l_all FROM docs),
postings AS (
  SELECT d, doc_id, n, term, count(*) AS tf FROM (SELECT d, doc_id, n, unnest(terms) AS term FROM docs) GROUP BY ALL
),
asked AS (
  SELECT row_number() OVER () AS i, item_id, unnest(list_distinct(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM benchmark
),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_all + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, totals GROUP BY term, n_all
),
scores AS (
  SELECT i, item_id, d, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf
    + 8 * (100 - 90 + (90 * n * n_all) // l_all)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term), totals GROUP BY i, item_id, d, doc_id
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, d) AS k FROM scores WHERE score > 0
)
SELECT item_id, CAST(k AS INT) AS rank, doc_id, score FROM ranked WHERE k <= 10"""


@register
def op11_prefix_trie(spark, sf_dir):
    return conversations.prefix_trie(read_table(spark, sf_dir, "conversations"))


SQL["op11_prefix_trie"] = r"""
WITH texts AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT conv_id, r, t, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, sha256(length(r) || ':' || r || t)) AS p FROM texts
),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, n, xor(list_reduce(list_concat([4294967295::BIGINT],
      flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
        lambda x: list_concat([ord(x)::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END),
    4294967295) % 4 AS h
  FROM (SELECT conv_id, max(p) AS n FROM turns GROUP BY conv_id)
),
rebuilt AS (
  SELECT c.conv_id, p AS d, r, t FROM convs c JOIN turns b ON b.conv_id = c.base AND p <= h
  UNION ALL
  SELECT c.conv_id, least(c.h, coalesce(b.n, 0)) + p - c.h, r, t
  FROM convs c JOIN turns o ON o.conv_id = c.conv_id AND p > c.h LEFT JOIN convs b ON b.conv_id = c.base
),
lists AS (
  SELECT conv_id, coalesce(s, []) AS s FROM convs LEFT JOIN (
    SELECT conv_id, list({'r': r, 't': t} ORDER BY d) AS s FROM rebuilt GROUP BY conv_id) USING (conv_id)
),
members AS (
  SELECT conv_id, d, len(s) AS total, s[1:d] AS k FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM lists)
),
named AS (SELECT conv_id, d, total, k, min(conv_id) OVER (PARTITION BY d, k) AS rep FROM members),
nodes AS (
  SELECT rep, d, count(*) AS n_convs, any_value(k) AS k,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = total), '')) AS ends
  FROM named GROUP BY rep, d
),
linked AS (SELECT n.*, a.rep AS parent FROM nodes n LEFT JOIN named a ON a.conv_id = n.rep AND a.d = n.d - 1),
kids AS (SELECT parent AS rep, d - 1 AS d, count(*) AS n FROM linked WHERE d > 0 GROUP BY ALL),
valued AS (
  SELECT l.*, coalesce(kids.n, 0) AS n_children, CASE WHEN l.d = 0 THEN 0
    ELSE (n_convs - 1) * len(regexp_extract_all(k[l.d].t, '[^\x20\x09-\x0D]+')) END AS saved
  FROM linked l LEFT JOIN kids ON kids.rep = l.rep AND kids.d = l.d
),
sums AS (
  SELECT a.rep, a.d, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM valued v JOIN named a ON a.conv_id = v.rep AND a.d <= v.d GROUP BY a.rep, a.d
)
SELECT rep AS conv_id, d AS depth, parent AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
  ends AS ends_sha256 FROM valued JOIN sums USING (rep, d)"""


@register
def op12_warc_segments(spark, sf_dir):
    return warc.archive_pages(read_table(spark, sf_dir, "pages"))


SQL["op12_warc_segments"] = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n FROM pages),
firsts AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS first FROM payloads)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> first THEN first END AS refers_to
FROM firsts"""
