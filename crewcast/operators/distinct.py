"""Distinct counts that add up: exact bitmaps of numbered keys.

A count of distinct orders belongs to its row of a fact and cannot be summed. Kept next to the fact, a bitmap per fact key
and block of order numbers can: a coarser count is the number of bits in the union of the bitmaps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from crewcast.session import shared_folder
from crewcast.sources.tables import written


def numbered_keys(rows: DataFrame, key: str, near: Sequence[Column] = ()) -> DataFrame:
    """(key, number from 0) of every distinct key that is not null, in the order of the smallest ``near`` of each.

    Keys of one fact row should get numbers near each other, as a bitmap covers a block of numbers: order them by the fact's
    leading columns. Keys are range-partitioned and sorted; a key's number is its place in its partition plus the keys
    of the partitions before.
    """
    order = [f"_near{i}" for i in range(len(near))]
    keys = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), *[F.min(c).alias(n) for c, n in zip(near, order)])
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = keys.repartitionByRange(parts, *order, key).sortWithinPartitions(*order, key).select(key, F.monotonically_increasing_id().alias("_at"))
    placed = written(placed, shared_folder(rows.sparkSession)).withColumn("_part", F.shiftright("_at", 33))
    totals = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    low = F.lit(2**33 - 1).cast("long")
    return placed.join(F.broadcast(starts), "_part").select(key, (F.col("_before") + F.col("_at").bitwiseAND(low)).alias("number"))


def key_bitmaps(rows: DataFrame, by: Sequence[str], key: str, numbers: DataFrame) -> DataFrame:
    """(``by``, block, bitmap): which numbered keys occur in each group. Null keys are in none."""
    at = rows.select(*by, key).join(numbers, key)
    position = F.bitmap_bit_position(F.col("number") + 1)
    return at.groupBy(*by, F.bitmap_bucket_number(F.col("number") + 1).alias("block")).agg(F.bitmap_construct_agg(position).alias("bitmap"))


def distinct_keys(bitmaps: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Exact distinct keys per coarser group: a union of bitmaps per block, then the sum of their bits."""
    blocks = bitmaps.groupBy(*by, "block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return blocks.groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias(name))
