"""One query for each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventlake.llm import (
    centroids,
    divergence,
    inner_products,
    language,
    licenses,
    mih,
    mixing,
    quality,
    sentencepieces,
    simhash,
    token_counts,
    urls,
    warc,
)
from eventlake.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates of ``documents``: fingerprint and component of each document."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op1_mih(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest neighbours of every hundredth row of ``embeddings``."""
    return mih.mih_search(read(spark, sf_dir, "embeddings"), every=100, k=10)


def op2_norm_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five highest integer inner products of every fiftieth row of ``embeddings``."""
    return inner_products.norm_topk(read(spark, sf_dir, "embeddings"), every=50, k=5)


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each of the ``documents``."""
    return mixing.mixture(read(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of each of the ``documents``."""
    return language.predict_languages(read(spark, sf_dir, "documents"))


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of each of the ``pages``."""
    return urls.filter_urls(read(spark, sf_dir, "pages"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of each of the ``documents``."""
    return quality.predict_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of each of the ``documents``, checked against the original and by decoding."""
    return sentencepieces.encode(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-tokens and tokens of each of the ``documents``."""
    return token_counts.count_tokens(read(spark, sf_dir, "documents").select("doc_id", "text"))


def document_path() -> Column:
    """Where a document lies in its source: directories by number, licence files at round numbers."""
    number = F.col("doc_id").cast("string")
    hundreds, tens = (F.floor(F.col("doc_id") / n).cast("string") for n in (1000, 40))
    folder = F.when(F.col("doc_id") % 1000 < 40, hundreds).otherwise(F.concat_ws("/", hundreds, tens))
    name = F.when(F.col("doc_id") % 40 < 20, F.concat(F.lit("LICENSE."), number)).otherwise(number)
    return F.concat_ws("/", F.coalesce("source", F.lit("")), folder, name)


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of each of the ``documents``, its own or its directory's."""
    docs = read(spark, sf_dir, "documents")
    files = docs.select("doc_id", document_path().alias("path"), "text")
    found = licenses.scan(files)
    return found.select("doc_id", "path", "licence", "cosine", "inherited_from", F.size("licences").alias("n_own"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of each of the ``embeddings`` after ten rounds from eight centroids."""
    return centroids.cluster(read(spark, sf_dir, "embeddings"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the ``pages``, read back from the archives that hold them."""
    return warc.round_trip(spark, read(spark, sf_dir, "pages")).drop("record_id")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language of ``documents``."""
    return divergence.audit(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_mih": op1_mih,
    "op2_norm_topk": op2_norm_topk,
    "op3_language": op3_language,
    "op4_licenses": op4_licenses,
    "op5_quality": op5_quality,
    "op6_mix": op6_mix,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_simhash": op8_simhash,
    "op9_token_counts": op9_token_counts,
    "op10_urls": op10_urls,
    "op11_centroids": op11_centroids,
    "op12_warc": op12_warc,
    "op13_divergence": op13_divergence,
}


def _centroid_rounds(rounds: int) -> str:
    """One common table for the assignment and one for the centroids of each round."""
    assigned = """a{0} AS MATERIALIZED (
            SELECT vec_id, v, arg_min(number, (distance, number)) AS cluster, min(distance) AS distance
            FROM (
                SELECT x.vec_id, x.v, c.number,
                       list_sum(list_transform(list_zip(x.v, c.c), lambda p: (p[1] - p[2]) ** 2))::BIGINT AS distance
                FROM vectors x, c{0} c
            ) GROUP BY vec_id, v
        )"""
    moved = """c{1} AS MATERIALIZED (
            SELECT c.number, coalesce(m.c, c.c) AS c
            FROM c{0} c LEFT JOIN (
                SELECT number, list((s - ((s % n) + n) % n) // n ORDER BY place) AS c FROM (
                    SELECT cluster AS number, place, sum(v[place])::BIGINT AS s, count(*) AS n
                    FROM a{0}, range(1, 65) AS places(place) GROUP BY cluster, place
                ) GROUP BY number
            ) m USING (number)
        )"""
    steps = [assigned.format(0)]
    for i in range(rounds):
        steps += [moved.format(i, i + 1), assigned.format(i + 1)]
    return ",\n        ".join(steps)


#: SQL for the queries it can express.
ORACLE: dict[str, str] = {
    "op11_centroids": f"""
        WITH vectors AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY hash) - 1 AS number, c FROM (
                SELECT sha256('3:' || vec_id) AS hash, v AS c FROM vectors ORDER BY hash LIMIT 8
            )
        ), {_centroid_rounds(10)}
        SELECT vec_id, cluster::INTEGER AS cluster, distance,
               (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
               (sum(distance) OVER ())::BIGINT AS inertia,
               sha256(array_to_string(c10.c, ',')) AS centroid_sha256
        FROM a10 JOIN c10 ON a10.cluster = c10.number
    """,
    "op12_warc": """
        WITH payloads AS (
            SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), firsts AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM payloads
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
        FROM firsts
    """,
    "op13_divergence": r"""
        WITH docs AS MATERIALIZED (
            SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ), words AS (SELECT id, lang, source, unnest(terms) AS term FROM docs
        ), kept AS MATERIALIZED (
            SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 3
        ), counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL
        ), members AS (SELECT DISTINCT lang, source FROM docs
        ), cells AS MATERIALIZED (
            SELECT m.lang, m.source, k.term, coalesce(c.n, 0) AS n
            FROM members m JOIN kept k USING (lang)
            LEFT JOIN counts c ON c.lang = m.lang AND c.source = m.source AND c.term = k.term
        ), totals AS (
            SELECT lang, source, sum(n)::HUGEINT AS total, count(*) AS v FROM cells GROUP BY lang, source
        ), shares AS MATERIALIZED (
            SELECT c.*, (1 + (1000000000::HUGEINT * (n + 1)) // (total + v))::BIGINT AS p
            FROM cells c JOIN totals USING (lang, source)
        ), whole AS (
            SELECT lang, term, (1 + (1000000000::HUGEINT * (sum(n) + 1))
                // (sum(sum(n)) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang)))::BIGINT AS q
            FROM cells GROUP BY lang, term
        ), apart AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
            GROUP BY ALL
        ), found AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
            FROM members a JOIN members b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
            UNION ALL
            SELECT s.lang, s.source, 'term', s.term, ((p - q) * (p - q) // q)::BIGINT
            FROM shares s JOIN whole w ON s.lang = w.lang AND s.term = w.term
            WHERE n > 0 AND p > q
        ), ranked AS (
            SELECT *, row_number() OVER (
                PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
            FROM found
        )
        SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
    """,
    "op6_mix": r"""
        WITH sized AS (
            SELECT doc_id, source, len(regexp_extract_all(
                coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
            FROM documents
        ), sums AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
            FROM sized GROUP BY source
        ), levels AS (
            SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER below, 0))::DOUBLE
                   / (sum(weight) OVER () - coalesce(sum(weight) OVER below, 0))::DOUBLE AS level
            FROM sums
            WINDOW below AS (
                ORDER BY 3 * source_size / weight, source NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
            )
        ), targets AS (
            SELECT source, source_size,
                   least(3.0::DOUBLE * source_size, weight::DOUBLE * max(level) OVER ()) AS target
            FROM levels
        ), line AS (
            SELECT s.*, t.source_size, t.target,
                   least(floor(t.target + 0.5)::BIGINT, 3 * t.source_size) AS words,
                   coalesce(sum(s.size) OVER (
                       PARTITION BY s.source ORDER BY md5(concat_ws(':', doc_id, size)), doc_id, size
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
                   ), 0) AS start
            FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
        )
        SELECT doc_id, source, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE
            words // source_size * size
            + greatest(0, least(start + size, words % source_size) - start) END::BIGINT AS taken
        FROM line
    """,
    "op2_norm_topk": """
        WITH vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scores AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
            FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id
            WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (
                PARTITION BY query_id ORDER BY score DESC, vec_id
            )::INTEGER AS rank
            FROM scores
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
}
