"""Shards by rendezvous hashing.

Every (record key, shard) pair has a hash; a record goes to the shard with the best weighted score. A
record's place depends on nothing but its key and the shards, and a new shard takes only the records it
wins. Scores are compared row by row inside the scan, so assigning moves no data.

The running number inside a shard is counted in two steps: rows per (shard, slice of the key hash), then
rows inside a slice. No task holds a whole shard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from crewcast.llm.storage import stored

#: Rows that one slice of one shard holds at most on average.
SLICE_ROWS = 50_000


def record_key(value: Column) -> Column:
    """Text form of a key; a null key is the empty text."""
    return F.coalesce(value.cast("string"), F.lit(""))


def score(key: Column, shard: Column, weight: Column) -> Column:
    """-weight / ln(u), where u in (0, 1) comes from 52 bits of the md5 of key and shard."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(":"), shard.cast("string"))), 1, 13), 16, 10).cast("double")
    return -weight / F.log((bits + F.lit(0.5)) / F.lit(float(2**52)))


def best_shard(key: Column, weights: Sequence[float]) -> Column:
    """Struct of the best score and its shard number; equal scores go to the greater number."""
    shards = F.array(*[F.struct(F.lit(i).alias("shard"), F.lit(float(w)).alias("weight")) for i, w in enumerate(weights) if w > 0])
    return F.array_max(F.transform(shards, lambda s: F.struct(score(key, s["shard"], s["weight"]).alias("score"), s["shard"].alias("shard"))))


def assign(docs: DataFrame, weights: Sequence[float], new_weight: float = 1.0, key_col: str = "doc_id", text_col: str = "text",
           overhead: int = 16) -> DataFrame:
    """One row per document: key, size, text_crc32, shard, slot, grown_shard (with one more shard of ``new_weight``).

    ``size`` is the text's UTF-8 length plus ``overhead``; a null text has no bytes. Slots count from 0 in
    each shard, by md5 of the key, then key, size and checksum. Rows with a null key share one shard; equal
    rows have different slots. Other columns are not looked at. A shard of weight 0 gets nothing.
    """
    key = record_key(F.col("key"))
    text = F.coalesce(docs[text_col], F.lit("")).cast("binary")
    rows = docs.select(docs[key_col].alias("key"), (F.octet_length(text) + overhead).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    rows = rows.withColumn("best", best_shard(key, weights))
    grown = score(key, F.lit(len(weights)), F.lit(float(new_weight))) >= F.col("best.score")
    rows = stored(rows.select("key", "size", "text_crc32", F.col("best.shard").alias("shard"),
                              F.when(grown, len(weights)).otherwise(F.col("best.shard")).cast("int").alias("grown_shard"),
                              F.md5(key).alias("key_hash")))

    digits = 0
    while rows.count() > SLICE_ROWS * len(weights) * 16**digits:
        digits += 1
    rows = rows.withColumn("slice", F.substring("key_hash", 1, digits))
    counts = rows.groupBy("shard", "slice").count()
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "slice").orderBy("key_hash", "key", "size", "text_crc32")
    placed = rows.withColumn("at", F.row_number().over(inside) - 1).join(starts, ["shard", "slice"])
    return placed.select(F.col("key").alias(key_col), "size", "text_crc32", "shard", (F.col("start") + F.col("at")).cast("long").alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, weights: Sequence[float], key_col: str = "doc_id") -> None:
    """Documents as files in one folder per shard; large shards get several files."""
    rows = docs.withColumn("shard", best_shard(record_key(docs[key_col]), weights)["shard"])
    rows.hint("rebalance", "shard").write.mode("overwrite").partitionBy("shard").parquet(path)
