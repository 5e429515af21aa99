"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import scratch_path
from . import (
    bpe,
    centroids,
    jaccard_join,
    kdtree,
    licenses,
    line_dedup,
    near_dedup,
    packing,
    quality,
    spelling,
    token_store,
    toxicity,
    warc,
)
from .common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_token_store(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-store")
    token_store.write_store(documents(spark, folder), path, tokenizer_path(), end_id=2)
    return token_store.read_store(spark, path)


@query
def op2_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, folder), width=2, percent=80)


@query
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = line_dedup.drop_repeated_lines(documents(spark, folder))
    return cleaned.select("doc_id", "n_lines", "n_removed", "text")


@query
def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_decode(documents(spark, folder), tokenizer_path())


@query
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(packing.word_lengths(documents(spark, folder)))


@query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return toxicity.score(documents(spark, folder), labels)


@query
def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(spark.read.parquet(f"{folder}/pages.parquet"), path)
    return warc.read_archives(spark, path)


@query
def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(documents(spark, folder))


@query
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(documents(spark, folder))


@query
def op10_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return kdtree.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


@query
def op11_centroids(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return centroids.cluster(vectors, k=8, rounds=10, width=64, scale=1024, seed=3)


@query
def op12_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.components(documents(spark, folder), width=5, percent=80)


@query
def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(documents(spark, folder))


def _lloyd_sql(k: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """The rounds of centroid clustering, one after the other."""

    def assign(i: int) -> str:
        return f"""a{i} AS MATERIALIZED (
    SELECT vec_id, k, d FROM (
        SELECT x.vec_id, c.k, sum((x.x - c.x) * (x.x - c.x)) AS d
        FROM x JOIN c{i} c ON x.i = c.i GROUP BY x.vec_id, c.k)
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, k) = 1)"""

    def move(i: int) -> str:
        return f"""c{i + 1} AS MATERIALIZED (
    SELECT c.k, c.i, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN (
        SELECT a.k, x.i, (sum(x.x) - ((sum(x.x) % count(*)) + count(*)) % count(*)) // count(*) AS x
        FROM x JOIN a{i} a ON x.vec_id = a.vec_id GROUP BY a.k, x.i) m ON c.k = m.k AND c.i = m.i)"""

    steps = ",\n".join(f"{assign(i)},\n{move(i)}" for i in range(rounds))
    return f"""
WITH kept AS (
    SELECT vec_id, embedding FROM embeddings
    WHERE len(embedding) = {width} AND len(list_filter(embedding,
        lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
), x AS MATERIALIZED (
    SELECT vec_id, unnest(range(1, {width + 1})) AS i,
        CAST(floor({scale} * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x
    FROM kept
), seeds AS (
    SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS k FROM kept
    QUALIFY k < {k}
), c0 AS MATERIALIZED (
    SELECT k, i, x FROM x JOIN seeds USING (vec_id)
),
{steps},
{assign(rounds)},
digests AS (
    SELECT k, sha256(string_agg(x, ',' ORDER BY i)) AS digest FROM c{rounds} GROUP BY k
)
SELECT vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
    CAST(sum(d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
    CAST(sum(d) OVER () AS BIGINT) AS inertia, digest AS centroid_sha256
FROM a{rounds} a JOIN digests ON a.k = digests.k
"""


ORACLES = {
    "op11_centroids": _lloyd_sql(),
    "op12_jaccard_join": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
        lambda w: w <> '') AS w
    FROM documents
), shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS MATERIALIZED (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS MATERIALIZED (
    SELECT a, b FROM (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both
        FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL)
    JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * n_both >= 80 * (p.n + q.n - n_both)
), reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least AS component_id
FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id
JOIN (SELECT doc_id, min(other) AS least FROM reach GROUP BY doc_id) r ON d.doc_id = r.doc_id
""",
    "op3_line_dedup": r"""
WITH lines AS (
    SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents
), numbered AS (
    SELECT doc_id, ls, unnest(range(0, len(ls))) AS pos FROM lines
), windows AS (
    SELECT doc_id, pos, ls[pos + 1] || chr(10) || ls[pos + 2] || chr(10) || ls[pos + 3] AS w
    FROM numbered WHERE pos + 3 <= len(ls)
), ranked AS (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS r,
        first(doc_id) OVER (PARTITION BY w ORDER BY doc_id, pos) AS first_doc,
        first(pos) OVER (PARTITION BY w ORDER BY doc_id, pos) AS first_pos
    FROM windows WHERE regexp_matches(w, '[^ \t\r\f\n]')
), spans AS (
    SELECT doc_id, pos + 2 AS stop,
        CASE WHEN doc_id = first_doc THEN greatest(pos, first_pos + 3) ELSE pos END AS start
    FROM ranked WHERE r > 1
), covered AS (
    SELECT DISTINCT doc_id, unnest(range(start, stop + 1)) AS pos FROM spans WHERE start <= stop
), kept AS (
    SELECT n.doc_id, string_agg(ls[n.pos + 1], chr(10) ORDER BY n.pos) AS text, count(*) AS n
    FROM numbered n ANTI JOIN covered c ON n.doc_id = c.doc_id AND n.pos = c.pos
    GROUP BY n.doc_id
)
SELECT l.doc_id, len(l.ls) AS n_lines, len(l.ls) - coalesce(k.n, 0) AS n_removed,
    coalesce(k.text, '') AS text
FROM lines l LEFT JOIN kept k ON l.doc_id = k.doc_id
""",
    "op7_warc": r"""
WITH hashed AS (
    SELECT page_id, url, strlen(coalesce(html, '')) AS payload_bytes,
        sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM hashed
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END
        AS record_type,
    CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN first_id END AS refers_to,
    url
FROM firsts
""",
    "op10_topk": r"""
WITH vectors AS (
    SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings WHERE embedding IS NOT NULL
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
        CAST(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
    FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
""",
}
