"""The queries of the corpus operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagline.llm import (
    automata,
    bpe,
    decontamination,
    hard_negatives,
    links,
    personal,
    rabitq,
    ring,
    set_join,
    simhash,
    simplex,
    suffixes,
    toxicity,
)
from lagline.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def checked_by(sql: str) -> Callable[[Query], Query]:
    """Register a query with SQL for the same rows."""

    def register(function: Query) -> Query:
        ORACLES[function.__name__] = sql
        return query(function)

    return register


def ranks() -> str:
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@query
def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return bpe.round_trip(documents, "doc_id", "text", ranks(), public_tokenizers.PATTERN)


@checked_by(r"""
  WITH folded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
  items AS (
    SELECT item_id, regexp_extract_all(translate(text,
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
  windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n,
           array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS words
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s
          FROM items WHERE len(w) > 0)),
  found AS (
    SELECT doc_id, s, n, item_id
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
          FROM folded, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n) AS d
    JOIN windows USING (n)
    WHERE array_to_string(d.w[d.s : d.s + n - 1], ' ') = windows.words),
  hits AS (
    SELECT doc_id, len(list_distinct(flatten(list(range(s, s + n))))) AS n_hit,
           count(DISTINCT item_id) AS n_items,
           sha256(array_to_string(list_sort(list_distinct(list(item_id::VARCHAR))), ',')) AS digest
    FROM found GROUP BY doc_id)
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
         coalesce(n_items, 0)::BIGINT AS n_items, coalesce(digest, sha256('')) AS items_sha256,
         coalesce(n_hit, 0) > 0 AS contaminated
  FROM folded LEFT JOIN hits USING (doc_id)""")
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    found = decontamination.scan(documents, "doc_id", "text", items, "item_id", "text")
    return decontamination.report(found)


@query
def op8_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    field = personal.train_field(documents, "doc_id", "text")
    return personal.find(documents, "doc_id", "text", field)


@query
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scorer = toxicity.train(documents, labels, "doc_id", "text")
    return toxicity.score(documents, "doc_id", "text", scorer)


@query
def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.linked(table(spark, folder, "documents"), "doc_id", "text", 3, 2)


SHARDS = 16


@query
def op4_ring_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return ring.assign(table(spark, folder, "documents"), "doc_id", "text", SHARDS)


#: Fixed rules: verdict, host, path.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


#: Ranks as sums over all walks from the seeds, by length; 0.85^150 is below 1e-10.
URL_SQL = rf"""
  WITH RECURSIVE cut AS (
    SELECT page_id, html, CASE WHEN contains(url, '://')
             THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
  split AS (
    SELECT page_id, html, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
  rules(verdict, own, start) AS (VALUES {", ".join(map(str, URL_RULES))}),
  fits AS (
    SELECT page_id, arg_max(own || start, length(own || start)) AS rule,
           arg_max(verdict, length(own || start)) AS verdict
    FROM split JOIN rules ON (host = own OR ends_with(host, '.' || own))
      AND starts_with(path, start) GROUP BY 1),
  ruled AS (SELECT page_id, host, path, rule, verdict FROM split LEFT JOIN fits USING (page_id)),
  found AS (
    SELECT host AS source, translate(unnest(regexp_extract_all(html,
             '(?i)href\s*=\s*["'']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\s>]+)', 1)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS target FROM split),
  counted AS (
    SELECT source, target, count(*) AS links FROM found
    WHERE source <> '' AND target <> '' AND source <> target GROUP BY 1, 2),
  edges AS (
    SELECT 'trust' AS kind, source AS host, target, links FROM counted UNION ALL
    SELECT 'distrust', target, source, links FROM counted),
  shares AS (
    SELECT kind, host, target, links / sum(links) OVER (PARTITION BY kind, host) AS share
    FROM edges),
  hosts AS (
    SELECT host, avg((verdict IS NOT DISTINCT FROM 'allow')::INT) AS allowed,
           avg((verdict IS NOT DISTINCT FROM 'block')::INT) AS blocked
    FROM ruled WHERE host <> '' GROUP BY 1),
  seeds AS (
    SELECT 'trust' AS kind, host, allowed / sum(allowed) OVER () AS mass, allowed > 0.5 AS most
    FROM hosts WHERE allowed > 0 UNION ALL
    SELECT 'distrust', host, blocked / sum(blocked) OVER (), blocked > 0.5
    FROM hosts WHERE blocked > 0),
  walks AS (
    SELECT 0 AS steps, kind, host, mass FROM seeds UNION ALL
    SELECT steps + 1, kind, target, sum(mass * share * 0.85)
    FROM walks JOIN shares USING (kind, host) WHERE steps < 150 GROUP BY 1, 2, 3),
  whole AS (SELECT kind, sum(mass) AS whole FROM walks GROUP BY 1),
  counting AS (
    SELECT kind, host, w.mass / whole AS mass
    FROM walks AS w JOIN whole USING (kind) LEFT JOIN seeds AS s USING (kind, host)
    WHERE steps > 0 OR most),
  ranks AS (
    SELECT host, coalesce(sum(mass) FILTER (kind = 'distrust'), 0) AS distrust,
           coalesce(sum(mass) FILTER (kind = 'trust'), 0) AS trust
    FROM counting GROUP BY 1)
  SELECT page_id, host, path, rule,
         coalesce(verdict, CASE WHEN distrust - trust > 1e-9 * (distrust + trust) THEN 'block' END,
                  'allow') AS verdict
  FROM ruled LEFT JOIN ranks USING (host)"""


@checked_by(URL_SQL)
def op10_url_trust(spark: SparkSession, folder: str) -> DataFrame:
    return links.judge(table(spark, folder, "pages"), "page_id", "url", "html", URL_RULES)


@query
def op5_rotated_codes(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return rabitq.search(vectors, "vec_id", "embedding", "vec_id % 20 = 0")


@checked_by(r"""
  WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
  windows AS (
    SELECT doc_id, s, md5(array_to_string(w[s : s + 49], ' ')) AS h
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM words WHERE len(w) >= 50)),
  firsts AS (SELECT h, min(doc_id) AS least FROM windows GROUP BY h),
  gone AS (
    SELECT doc_id, list_distinct(flatten(list(range(s, s + 50)))) AS places
    FROM windows JOIN firsts USING (h) WHERE least < doc_id GROUP BY doc_id)
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
         sha256(array_to_string(CASE WHEN places IS NULL THEN w ELSE
           list_filter(w, lambda x, i: NOT list_contains(places, i)) END, ' ')) AS kept_sha256
  FROM words LEFT JOIN gone USING (doc_id)""")
def op6_suffix_automata(spark: SparkSession, folder: str) -> DataFrame:
    return automata.dedup(table(spark, folder, "documents"), "doc_id", "text")


@query
def op3_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.passages(table(spark, folder, "documents"), "doc_id", "text")


@checked_by("""
  WITH kept AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
  pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
           coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), 0)::BIGINT
             AS score
    FROM kept AS a JOIN kept AS b
      ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
  positives AS (
    SELECT anchor_id, other AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
  SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INTEGER
           AS rank
  FROM positives JOIN pairs USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
  QUALIFY rank <= 3""")
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, folder, "embeddings")
    return hard_negatives.mine(vectors, "vec_id", "embedding", moved, "vec_id % 50 = 0")


@checked_by(r"""
  WITH RECURSIVE folded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x20\x09-\x0D]+') AS w FROM documents),
  shingles AS (
    SELECT DISTINCT doc_id, md5(array_to_string(w[s : s + 4], ' ')) AS h
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s
          FROM folded WHERE len(w) > 0)),
  sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
  overlap AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
    FROM shingles AS a JOIN shingles AS b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
  links AS (
    SELECT x, y FROM overlap JOIN sizes AS a ON x = a.doc_id JOIN sizes AS b ON y = b.doc_id
    WHERE 100 * overlap.n >= 80 * (a.n + b.n - overlap.n)),
  reached AS (
    SELECT doc_id, doc_id AS root FROM documents UNION
    SELECT y, root FROM reached JOIN links ON doc_id = x)
  SELECT doc_id, any_value(coalesce(n, 0))::BIGINT AS n_shingles, min(root) AS component_id
  FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id""")
def op12_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return set_join.join(table(spark, folder, "documents"), "doc_id", "text")


def _centroid_rounds(rounds: int) -> str:
    """Assignments and new centroids, one table after the other."""
    tables = []
    for n in range(rounds + 1):
        tables.append(f"""a{n} AS (
    SELECT id, any_value(vec_id) AS vec_id, any_value(v) AS v, min(d) AS distance,
           arg_min(c, (d, c)) AS c
    FROM (SELECT id, vec_id, v, c,
                 list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) ** 2))::BIGINT AS d
          FROM kept, c{n}) GROUP BY id)""")
        if n < rounds:
            tables.append(f"""c{n + 1} AS (
    SELECT c, coalesce(any_value(moved), any_value(m)) AS m
    FROM c{n} LEFT JOIN (
      SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS moved
      FROM (SELECT c, i, sum(v[i])::BIGINT AS s, count(*) AS n
            FROM a{n}, range(1, 65) AS t(i) GROUP BY c, i) GROUP BY c) USING (c) GROUP BY c)""")
    return ",\n  ".join(tables)


@checked_by(f"""
  WITH kept AS (
    SELECT row_number() OVER () AS id, vec_id,
           list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
  c0 AS (
    SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v AS m
    FROM kept WHERE vec_id IS NOT NULL ORDER BY sha256('1:' || vec_id), v LIMIT 16),
  {_centroid_rounds(3)}
  SELECT vec_id, c::INTEGER AS cluster, distance,
         sum(distance) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
         sum(distance) OVER ()::BIGINT AS inertia,
         sha256(array_to_string(m, ',')) AS centroid_sha256
  FROM a3 JOIN c3 USING (c)""")
def op13_simplex_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return simplex.cluster(table(spark, folder, "embeddings"), "vec_id", "embedding")
