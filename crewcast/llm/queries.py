"""The registered queries: each operator on its whole table with production settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crewcast.llm import (decontaminate, exact_dedup, hard_negatives, html_text, language_id, near_dedup, neighbours, packing, quality, secrets, sharding,
                          toxicity, whitening)
from crewcast.llm.registry import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]

SHARDS = 40
SEQUENCE = 1024


def pack_documents(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), SEQUENCE, end_id=2)


def remainder(divisor: int) -> Column:
    """crc32 of the document id as text, modulo ``divisor``; the folds that training must not see."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def toxicity_model(spark: SparkSession, folder: str) -> toxicity.Model:
    """Learned from documents and labels outside the held-out fold alone; its labels do not count towards the toxic share either."""
    seen = table(spark, folder, "documents").select("doc_id", "text").filter(remainder(4) != 2)
    return toxicity.learn(seen, table(spark, folder, "labels").select("doc_id", "toxic").filter(remainder(4) != 2))


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return toxicity.predict(docs, toxicity_model(spark, folder), held_out=remainder(4) == 2)


@query("op2_html_extraction")
def op2_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query("op6_quality_classifier")
def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.learn(docs.filter(remainder(4) != 2), table(spark, folder, "labels").select("doc_id", "quality"))
    return quality.predict(docs, model, held_out=remainder(4) == 2)


@query("op4_language_id")
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language_id.learn(docs.filter(remainder(3) != 1))
    return language_id.predict(docs, model, held_out=remainder(3) == 1)


@query("op3_best_fit_packing")
def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents").select("doc_id", "text"))


def _spans_sql(rules: tuple[secrets.Rule, ...]) -> str:
    """Spans of every rule by splitting the text at its matches; offsets are sums of the parts before."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    per_kind = " UNION ALL ".join(f"""
        SELECT doc_id, row_id, {number} AS kind_order, '{r.kind}' AS kind, regexp_extract_all(text, {quoted(r.pattern)}) AS hits,
            regexp_extract_all(text, {quoted(r.pattern)}, {r.group}) AS tested, string_split_regex(text, {quoted(r.pattern)}) AS gaps, {r.least} AS least
        FROM texts""" for number, r in enumerate(rules))
    return f"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS row_id FROM documents
), matched AS ({per_kind}
), numbered AS (
    SELECT doc_id, row_id, kind_order, kind, hits, tested, gaps, least, unnest(range(1, len(hits) + 1)) AS n FROM matched
), placed AS (
    SELECT row_id, kind_order, kind, list_sum(list_transform(gaps[1:n], lambda g: length(g)))
        + coalesce(list_sum(list_transform(hits[1:n - 1], lambda h: length(h))), 0) AS start, length(hits[n]) AS size
    FROM numbered WHERE length(tested[n]) >= least
), joined AS (
    SELECT row_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + size AS BIGINT), ',' ORDER BY start, kind_order) AS spans,
        string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + size AS BIGINT), ',' ORDER BY start, kind_order) FILTER (kind_order < 3) AS base
    FROM placed GROUP BY row_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN joined USING (row_id)"""


@query("op7_secret_scan", _spans_sql(secrets.RULES))
def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    rules = secrets.RULES
    found = secrets.scan(table(spark, folder, "documents").select("doc_id", "text"), rules)
    base = F.concat(*[F.col(f"spans_{r.kind}") for r in secrets.BASE_RULES])
    everything = F.concat(*[F.col(f"spans_{r.kind}") for r in rules])
    counts = [F.size(f"spans_{r.kind}").cast("long").alias(f"n_{r.kind}") for r in secrets.BASE_RULES]
    return found.select("doc_id", *counts, F.sha2(secrets.as_text(base, rules), 256).alias("base_sha256"),
                        secrets.as_text(everything, rules).alias("spans"))


@query("op8_sharding", f"""
WITH byte_table AS (
    SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)), lambda c, step:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), sized AS (
    SELECT doc_id, coalesce(text, '') AS text, coalesce(CAST(doc_id AS VARCHAR), '') AS key FROM documents
), summed AS (
    SELECT doc_id, key, strlen(text) + 16 AS size, hex(encode(text)) AS digits FROM sized
), checked AS (
    SELECT doc_id, key, size, xor(4294967295, list_reduce(
        list_concat([4294967295], list_transform(range(1, len(digits), 2), lambda i: ('0x' || substr(digits, i, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) AS text_crc32
    FROM summed, byte_table
), scores AS (
    SELECT doc_id, key, size, text_crc32, s AS shard,
        -1.0 / ln((('0x' || substr(md5(key || ':' || s), 1, 13))::BIGINT + 0.5) / 4503599627370496) AS score
    FROM checked, range({SHARDS + 1}) AS shards(s)
), won AS (
    SELECT doc_id, key, size, text_crc32, arg_max(shard, score) FILTER (shard < {SHARDS}) AS shard, arg_max(shard, score) AS grown_shard
    FROM scores GROUP BY ALL
)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
    row_number() OVER (PARTITION BY shard ORDER BY md5(key), key, size, text_crc32) - 1 AS slot, CAST(grown_shard AS INTEGER) AS grown_shard
FROM won""")
def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    rows = sharding.assign(table(spark, folder, "documents"), [1.0] * SHARDS)
    return rows.withColumn("law", F.lit("key")).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@query("op9_exact_dedup", """
SELECT doc_id, max(doc_id) OVER copies AS keep_id, count(*) OVER copies AS group_size,
    doc_id = max(doc_id) OVER copies AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW copies AS (PARTITION BY coalesce(text, ''))""")
def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return exact_dedup.label_copies(docs, keep="largest").select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op5_near_dedup")
def op5_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.label_groups(table(spark, folder, "documents"), shingle=2, percent=80)


@query("op10_benchmark_decontamination")
def op10_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def every_hundredth(key: Column) -> Column:
    """The stated query set of the searches over ``embeddings``."""
    return F.pmod(key, F.lit(100)) == 0


@query("op11_hard_negatives", """
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
    FROM whole a JOIN whole b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER best <= 10""")
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    label = F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda c: F.floor(256 * c.cast("double")))
    return hard_negatives.mine(rows.select("vec_id", label.alias("label"), whole.alias("embedding")), every_hundredth)


@query("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = whitening.whiten(table(spark, folder, "embeddings"), entry=lambda c: F.floor(1024 * c) + 100_000)
    return rows.withColumnRenamed("id", "vec_id")


@query("op13_nearest_neighbours")
def op13_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(table(spark, folder, "embeddings"), every_hundredth)
