"""Exact duplicates by sorting whole texts.

Rows are range-partitioned by content: Spark samples splitters over the first characters of the
normalised text and its hash, so that texts with one beginning still spread. Inside a partition an
external sort puts equal texts next to each other, and the window over the *whole* text compares
neighbours in full; only the parts of a text that was split, see below, know each other by a hash.

A text with very many copies would fill one partition. Texts that hold more than a stated share of
the rows (there are fewer of them than four times the partitions) get a salt as second sort key, and
the few local results of their salts are combined afterwards, by the SHA-256 of the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from crewcast.llm.storage import partitions, stored

#: A text with fewer copies than this is never split.
LEAST_SPLIT = 64


def _ordered(keep: str, value: Column) -> Column:
    return value.asc_nulls_last() if keep == "smallest" else value.desc_nulls_last()


def _sorted(rows: DataFrame, text: Callable[[], Column], keep: str, *salt: str) -> DataFrame:
    """Rows with content, place, first identifier and number in the group of equal (content, salt).

    The range partitioning already brings a group together, so the window adds neither a shuffle nor a sort.
    """
    order = Window.partitionBy("start", "hash", *salt, "content").orderBy(_ordered(keep, F.col("id")))
    spread = rows.repartitionByRange("start", "hash", *salt).withColumn("content", text())
    return (
        spread.withColumn("place", F.row_number().over(order))
        .withColumn("first_id", F.first("id").over(order))
        .withColumn("copies", F.count(F.lit(1)).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )


def label_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
    normalise: Callable[[Column], Column] = lambda text: text,
) -> DataFrame:
    """All rows as ``row`` (a struct of the given columns) with ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``keep`` is ``smallest`` or ``largest``. A null text counts as empty; all empty texts are equal. Of
    rows with one identifier and one text exactly one has ``kept``. A null identifier is last in line.
    The columns of ``docs`` stay inside ``row``, so their names cannot clash. An empty table gives no rows.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be 'smallest' or 'largest'")
    text = lambda: normalise(F.coalesce(F.col("row")[text_col], F.lit("")))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    rows = rows.select("row", F.col("row")[id_col].alias("id"), F.substring(text(), 1, 16).alias("start"), F.xxhash64(text()).alias("hash"))

    parts = partitions(docs.sparkSession)
    limit = max(LEAST_SPLIT, rows.count() // (4 * parts))
    # Fewer than 4 * parts hashes can have more rows than the limit, so both tables below fit a broadcast.
    hot = stored(rows.groupBy("hash").count().filter(F.col("count") > limit)
                 .select("hash", F.ceil(F.col("count") / limit).cast("int").alias("salts")))
    if hot.isEmpty():
        done = _sorted(rows, text, keep)
        keep_id, size, kept = F.col("first_id"), F.col("copies"), F.col("place") == 1
    else:
        salted = rows.join(F.broadcast(hot), "hash", "left")
        salt = F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64("id", "hash"), F.col("salts")).cast("int"))
        salted = salted.withColumn("salt", salt)
        local = _sorted(salted.filter("salts IS NOT NULL"), text, keep, "salt").filter("place = 1")
        group = Window.partitionBy("hash", "content")
        order = group.orderBy(_ordered(keep, F.col("id")), "salt")
        merged = stored(local.select(
            "hash", "salt", F.sha2("content", 256).alias("sha"), F.first("id").over(order).alias("all_id"),
            F.row_number().over(order).alias("all_place"), F.sum("copies").over(group).alias("all_copies"),
        ))
        done = _sorted(salted, text, keep, "salt").withColumn("sha", F.sha2("content", 256))
        done = done.join(F.broadcast(merged), ["hash", "salt", "sha"], "left")
        # A null all_place means that the text was not split.
        split = F.col("all_place").isNotNull()
        keep_id = F.when(split, F.col("all_id")).otherwise(F.col("first_id"))
        size = F.coalesce("all_copies", "copies")
        kept = (F.col("place") == 1) & (F.coalesce("all_place", F.lit(1)) == 1)
    return done.select("row", keep_id.alias("keep_id"), size.cast("long").alias("group_size"), kept.alias("kept"),
                       F.sha2("content", 256).alias("text_sha256"))


def drop_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without copies, columns unchanged; options as in :func:`label_copies`."""
    return label_copies(docs, **options).filter("kept").select("row.*")
