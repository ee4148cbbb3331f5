"""Intermediate tables in the cluster's shared folder, and how finely work is dealt out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from crewcast.session import shared_folder
from crewcast.sources.tables import written


def stored(rows: DataFrame) -> DataFrame:
    """Rows that several steps read: computed once, then read from the shared folder."""
    return written(rows, shared_folder(rows.sparkSession))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Estimated bytes that may be broadcast.
BROADCAST_BYTES = 32_000_000


def _bytes(name: str, kind: T.DataType) -> Column:
    """Estimated size of a value: 8 bytes a number and 16 a container, besides what it holds."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.lit(16) + F.coalesce(F.octet_length(name), F.lit(0))
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.NumericType):
            return F.lit(16) + 8 * F.greatest(F.size(name), F.lit(0))
        return F.lit(16) + F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0))
    return F.lit(16 if isinstance(kind, T.NumericType) else 64)


def small(rows: DataFrame) -> DataFrame:
    """Marked for broadcast if its measured bytes allow that; joined by shuffle otherwise. ``rows`` should be stored."""
    each = sum((_bytes(f.name, f.dataType) for f in rows.schema.fields), F.lit(0))
    total = rows.agg(F.sum(each.cast("long"))).first()[0] or 0
    return F.broadcast(rows) if total <= BROADCAST_BYTES else rows


def numbered(rows: DataFrame) -> DataFrame:
    """Stored rows with ``index``: 0, 1, 2 and on. No row is moved: a row's place in its task and the rows of the tasks before add up."""
    whole = stored(rows.withColumn("_number", F.monotonically_increasing_id()))
    low = F.lit(2**33 - 1).cast("long")
    whole = whole.withColumn("_task", F.shiftright("_number", 33)).withColumn("_at", F.col("_number").bitwiseAND(low))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = whole.groupBy("_task").count().select("_task", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))  # one row a task
    return whole.join(F.broadcast(starts), "_task").withColumn("index", F.col("_before") + F.col("_at")).drop("_number", "_task", "_at", "_before")
