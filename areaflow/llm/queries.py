"""The operators over the given tables, in the columns their contracts name."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areaflow.llm import attention_lm, byte_bpe, centroids, chunk_dedup, embedding_dedup, language, line_dedup
from areaflow.llm import ngram_join, packing, pii, quality, secret_scan, spans, token_alignment

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _fold(parts: int) -> Column:
    return F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % parts


@query(
    "op1_chunk_dedup",
    r"""
    WITH plain AS (
        SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
        FROM documents
    )
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
        doc_id = min(doc_id) OVER g AS kept, text_sha256
    FROM plain WINDOW g AS (PARTITION BY text_sha256)
    """,
)
def op1_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.duplicates(_documents(spark, sf_dir))


@query("op2_byte_bpe")
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    ranks = packing.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    vocabulary = byte_bpe.learned(docs, ranks, public_tokenizers.PATTERN)
    ids = F.col("ids")
    listed = F.array_join(ids.cast("array<string>"), ",")
    return byte_bpe.encode(docs, vocabulary).select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.encode(listed, "UTF-8"), 256).alias("ids_sha256"),
        F.sha2(vocabulary.decode(ids), 256).alias("decoded_sha256"),
    )


@query(
    "op3_ngram_join",
    r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, string_split(trim(regexp_replace(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x20\x09-\x0D]+', ' ', 'g'), ' '), ' ') AS w
        FROM documents
    ), sets AS (
        SELECT doc_id, CASE WHEN w = [''] THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
        FROM words
    ), sized AS (SELECT doc_id, s, len(s) AS n FROM sets), flat AS (SELECT doc_id, n, unnest(s) AS g FROM sized),
    links AS (
        SELECT a.doc_id AS v, b.doc_id AS w FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
    ), reached AS (
        SELECT doc_id AS v, doc_id AS w FROM documents
        UNION SELECT reached.v, links.w FROM reached JOIN links ON links.v = reached.w
    )
    SELECT sized.doc_id, n::BIGINT AS n_shingles, min(w) AS component_id
    FROM sized JOIN reached ON reached.v = sized.doc_id GROUP BY sized.doc_id, n
    """,
)
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_documents(spark, sf_dir))


@query("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    net = quality.train(docs, labels, fold=_fold(5) != 0)
    scored = quality.score(docs, net)
    predicted = F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"), "score", predicted)


@query("op5_language")
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    filters = language.learn(docs.filter(_fold(4) != 2))
    held_out = F.coalesce(_fold(4) == 2, F.lit(False)).alias("held_out")
    return language.predict(docs, filters).select("doc_id", held_out, "lang_pred", "score")


@query(
    "op6_embedding_dedup",
    """
    WITH RECURSIVE usable AS (
        SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
            AND len(list_filter(embedding, lambda v: v <> 0)) > 0
    ), links AS (
        SELECT a.vec_id AS v, b.vec_id AS w FROM usable a JOIN usable b
            ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
        WHERE list_cosine_similarity(a.x, b.x) >= 0.98
    ), reached AS (
        SELECT vec_id AS v, vec_id AS w FROM embeddings
        UNION SELECT reached.v, links.w FROM reached JOIN links ON links.v = reached.w
    ), lowest AS (SELECT v, min(w) AS component_id FROM reached GROUP BY v),
    counted AS (SELECT v, count(*) AS n FROM links GROUP BY v)
    SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
    FROM embeddings e JOIN lowest ON lowest.v = e.vec_id LEFT JOIN counted ON counted.v = e.vec_id
    """,
)
def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op7_attention_lm")
def op7_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    ranks = packing.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    scored = attention_lm.score(docs, docs.filter(_fold(10) != 0), ranks, public_tokenizers.PATTERN)
    held_out = F.coalesce(_fold(10) == 0, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op8_pii")
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_documents(spark, sf_dir))
    return found.select("doc_id", *spans.columns(found["found"], pii.KINDS))


@query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        _documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


@query("op10_secret_scan")
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find(_documents(spark, sf_dir))
    return found.select("doc_id", *spans.columns(found["found"], secret_scan.BASE_KINDS))


def _centroid_sql(k: int, rounds: int, size: int) -> str:
    """Whole-number k-means, one round after the other."""
    difference = "(v[i] - c[i]) * (v[i] - c[i])"
    distance = f"list_sum(list_transform(range(1, {size + 1}), lambda i: {difference}))::BIGINT"
    steps = [
        f"""start AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({centroids.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE len(embedding) = {size}
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), whole AS MATERIALIZED (SELECT row_number() OVER () AS r, * FROM start),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h, v) - 1 AS n, v AS c
            FROM (SELECT sha256('{centroids.SEED}:' || vec_id) AS h, v FROM whole WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {k})
        )"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
            SELECT r, min(struct_pack(d := {distance}, n := n)) AS best FROM whole CROSS JOIN c{i} GROUP BY r
        )"""
        )
        if i < rounds:
            steps.append(
                f"""m{i} AS MATERIALIZED (
            SELECT n, list(CAST((s - ((s % t + t) % t)) // t AS BIGINT) ORDER BY place) AS c FROM (
                SELECT best.n AS n, place, sum(v[place])::BIGINT AS s, count(*) AS t
                FROM whole JOIN a{i} USING (r), range(1, {size + 1}) AS places(place) GROUP BY best.n, place
            ) GROUP BY n
        ), c{i + 1} AS MATERIALIZED (SELECT c{i}.n, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (n))"""
            )
    return f"""WITH {", ".join(steps)}
        SELECT vec_id, CAST(n AS INTEGER) AS cluster, best.d AS distance,
            CAST(sum(best.d) OVER (PARTITION BY n) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
            sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM whole JOIN a{rounds} USING (r) JOIN c{rounds} ON c{rounds}.n = best.n"""


@query("op11_centroids", _centroid_sql(centroids.K, centroids.ROUNDS, centroids.SIZE))
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, final = centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return centroids.with_inertia(assigned.drop("compared"), final)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest() if text else ""


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = token_alignment.ByteVocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    second = token_alignment.PieceVocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    found = token_alignment.align(_documents(spark, sf_dir), first, second, digest=_sha)
    return found.withColumnRenamed("groups", "groups_sha256")


@query(
    "op13_line_dedup",
    r"""
    WITH split AS (
        SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
    ), lines AS (
        SELECT r, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS n FROM split
    ), keyed AS (
        SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM lines
    ), owners AS (
        SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10
        GROUP BY key HAVING count(DISTINCT doc_id) > 1
    ), marked AS (
        SELECT r, keyed.doc_id, line, n, coalesce(owner <> keyed.doc_id, false) AS dropped
        FROM keyed LEFT JOIN owners ON owners.key = keyed.key
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT dropped), '')) AS kept_sha256
    FROM marked GROUP BY r, doc_id
    """,
)
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.drop_shared(_documents(spark, sf_dir))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
