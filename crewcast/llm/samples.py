"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

#: Slices of a label; at most this many times the sample meet in one task.
SLICES = 16


def labelled(docs: DataFrame, labels: DataFrame, per_label: int, most_chars: int, id_col: str, text_col: str, label_col: str) -> list[tuple[int, str]]:
    """(label, text) of at most ``per_label`` distinct texts of each label, chosen by the hash of the text, in a fixed order.

    Null labels, empty texts and texts longer than ``most_chars`` are left out. Copies are one row before places are
    counted. The sample is drawn on ids and hashes; only the texts in it are moved.
    """
    key, text = docs[id_col].alias("id"), docs[text_col]
    label = labels.filter(labels[label_col].isNotNull()).select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("label"))
    usable = docs.filter((F.length(text) > 0) & (F.length(text) <= most_chars)).select(key, F.xxhash64(text).alias("hash"))
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("hash"))
    distinct = usable.join(label, "id").groupBy("label", "hash").agg(F.min("id").alias("id"))
    # The first of every slice hold the first of all, so a frequent label is not brought together.
    first = distinct.withColumn("slice", F.pmod("hash", F.lit(SLICES))).withColumn("place", place("label", "slice")).filter(F.col("place") <= per_label)
    sample = first.withColumn("place", place("label")).filter(F.col("place") <= per_label).drop("place", "slice")
    rows = docs.select(key, text.alias("text"), F.xxhash64(text).alias("hash"))
    found = rows.join(F.broadcast(sample), ["id", "hash"]).groupBy("label", "hash").agg(F.min("text").alias("text")).collect()  # at most per_label rows a label
    return [(r["label"], r["text"]) for r in sorted(found, key=lambda r: (r["label"], r["hash"]))]
