"""Benchmark passages in documents, by SimHash over windows of the items' sizes.

Texts are lower-cased words of letters and digits; a passage is compared by its shingles of five words, as often as
they occur. For every item size, windows of that many shingles are taken from a document, each with a 64-bit
SimHash. Fingerprints are cut into four blocks of 16 bits: two of them within ``radius`` bits agree in some block up to
a quarter of that. Half of a block's differing bits are flipped on each side: two blocks within 4 bits share a value that
is within 2 of both. Items are indexed under all block values within 2 bits, windows ask for all within 2, so that every
pair within the radius meets, and the index holds 548 rows an item. Of the values two blocks share only the one with the
window's lowest differing bits counts, and of the blocks the first, so a pair comes out once. What is found is verified
by the exact similarity, the sum of the smaller weights over that of the larger.

Windows are only taken where they can matter. A window that reaches the threshold for an item can be moved
forward to its first shingle of that item without losing a common one, and holds a least number of benchmark shingles.
So windows start at a shingle of some item of their size and are left out if they hold fewer; which item a window is
compared with is for the fingerprints to say. On the check tool's 0.51 GB that leaves 29,632 windows of 256,410 texts.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from crewcast.llm.storage import partitions, small, stored

SHINGLE = 5
BLOCK_BITS = 16
BLOCKS = 4


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def with_shingles(rows: DataFrame, text: str, name: str) -> DataFrame:
    """Hashes of the runs of five words in order; fewer words are one run, none give an empty array.

    The words are a column of their own, as an expression inside a lambda is computed anew for each element. For the
    same reason nothing that follows may filter on the hashes before they are exploded or stored, and they are
    exploded with the outer form, which adds no such filter.
    """
    words = F.col("_words")
    runs = F.transform(F.sequence(F.lit(0), F.size(words) - SHINGLE), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]))
    hashes = F.when(F.size(words) >= SHINGLE, runs).when(F.size(words) > 0, F.array(F.xxhash64(F.concat_ws(" ", words)))).otherwise(
        F.array().cast("array<bigint>"))
    return rows.withColumn("_words", tokens(F.col(text))).withColumn(name, hashes).drop("_words")


def simhash(hashes: Column) -> Column:
    """64 majority bits of a window's hashes, each as often as it occurs."""
    shift = lambda way, value, by: F.call_function(way, value, by)
    count = lambda bit: F.aggregate(hashes, F.lit(0), lambda n, h: n + shift("shiftright", h, bit).bitwiseAND(F.lit(1).cast("long")).cast("int"))
    bits = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda bit: F.when(
        2 * count(bit) > F.size(hashes), shift("shiftleft", F.lit(1).cast("long"), bit)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def _blocks(fingerprint: Column) -> Column:
    """Structs (block, value) of a fingerprint."""
    low = F.lit(2**BLOCK_BITS - 1).cast("long")
    return F.array(*[F.struct(F.lit(k).alias("block"), F.call_function("shiftrightunsigned", fingerprint, F.lit(BLOCK_BITS * k)).bitwiseAND(low).alias("value"))
                     for k in range(BLOCKS)])


def _masks(most: int) -> list[int]:
    """All block masks of up to ``most`` bits."""
    return [sum(1 << b for b in bits) for n in range(most + 1) for bits in combinations(range(BLOCK_BITS), n)]


def _lowest(value: Column, count: int) -> Column:
    """The lowest ``count`` set bits of a number."""
    found, rest = F.lit(0).cast("long"), value
    for _ in range(count):
        bit = rest.bitwiseAND(-rest)
        found, rest = found.bitwiseOR(bit), rest.bitwiseXOR(bit)
    return found


def with_counted(rows: DataFrame, hashes: str, name: str) -> DataFrame:
    """One number per occurrence: a hash and how many equal ones came before it."""
    ordered = F.col("_ordered")
    numbers = F.transform(ordered, lambda h, i: F.xxhash64(h, i - F.array_position(ordered, h)))
    return rows.withColumn("_ordered", F.array_sort(hashes)).withColumn(name, numbers).drop("_ordered")


def find(docs: DataFrame, benchmark: DataFrame, percent: int = 80, radius: int = 19, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per (document id, item) with a passage at least ``percent`` similar: similarity, first_word, words.

    Of several passages the most similar, then the first, is given. Texts and items without words match nothing; a document
    shorter than an item is one window. Rows with one id are searched each and reported under it; a null id is reported
    as null. A pair further apart than ``radius`` of 64 bits is not found: for items of 18 to 90 shingles that is, at
    similarity 0.8, three to seven in ten thousand, at 0.85 at most six in a hundred thousand, at 0.9 less than one in a
    million, and never an exact copy. Other columns are not looked at.
    """
    least = lambda have, size: F.ceil((have + size) * percent / (100 + percent))  # noqa: E731  common shingles a match needs
    items = with_shingles(benchmark.select(F.col(item_col).alias("item"), F.col(item_text).alias("text")), "text", "hashes")
    items = with_counted(items.select("item", "hashes", F.size("hashes").alias("size"), simhash(F.col("hashes")).alias("print")), "hashes", "counted")
    # Rows of one item and equal shingles are one; an item id may be null or stand for several texts.
    items = items.withColumn("item_key", F.xxhash64(F.coalesce(F.col("item").cast("string"), F.lit("null")), "hashes")).dropDuplicates(["item_key"])
    items = stored(items).filter("size > 0")
    known = stored(items.select(F.explode("hashes").alias("hash"), "size").distinct())

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    # A null id must meet itself below, so a document is known by the hash of id and text.
    rows = rows.withColumn("key", F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("null")), "text"))
    places = with_shingles(rows, "text", "held").select("key", F.size("held").alias("total"), F.posexplode_outer("held").alias("place", "hash")).join(small(known), "hash")
    places = places.groupBy("key", "size", "total").agg(F.sort_array(F.collect_set("place")).alias("places"))
    places = places.filter(F.size("places") >= least(F.least(F.lit(1), "total"), F.col("size")))

    def starts(row: Column) -> Column:
        """Places from which the window of this size holds enough benchmark shingles."""
        def enough(i: Column) -> Column:
            start = F.get(F.col("places"), i)
            have = F.least(F.col("size"), F.col("total") - start)
            return F.get(F.col("places"), (i + least(have, F.col("size")) - 1).cast("int")) < start + F.col("size")
        return F.transform(F.filter(row, enough), lambda i: F.get(F.col("places"), i))

    open_starts = places.select("key", "size", starts(F.sequence(F.lit(0), F.size("places") - 1)).alias("starts"))
    open_starts = stored(open_starts.filter(F.size("starts") > 0))
    windows = with_shingles(rows.join(small(open_starts), "key"), "text", "held").select("id", "key", "size", "held", F.explode_outer("starts").alias("start"))
    windows = windows.select("id", "key", "size", "start", F.slice("held", F.col("start") + 1, F.col("size")).alias("window"))
    windows = stored(windows.withColumn("print", simhash(F.col("window"))))

    # Bits that differ in a block: up to ``here`` are flipped on the window's side and up to ``there`` on the item's.
    most = radius // BLOCKS
    here, there = most // 2, most - most // 2
    flipped = lambda count: F.explode(F.array(*[F.lit(m).cast("long") for m in _masks(count)]))
    index = items.select("item_key", "size", F.col("print").alias("item_print"), F.explode(_blocks(F.col("print"))).alias("at"))
    index = index.select("item_key", "size", "item_print", "at.block", F.col("at.value").alias("item_value"), flipped(there).alias("mask"))
    index = stored(index.select("item_key", "size", "item_print", "block", F.col("item_value").bitwiseXOR(F.col("mask")).alias("value")))
    # Few bytes become 548 rows each, so they are dealt out before that.
    asked = windows.select("key", "size", "start", "print").repartition(partitions(docs.sparkSession), "key", "start").distinct().select("key", "size", "start", "print", F.explode(_blocks(F.col("print"))).alias("at"))
    asked = asked.select("key", "size", "start", "print", "at.block", F.col("at.value").alias("own"), flipped(here).alias("flip"))
    asked = asked.withColumn("value", F.col("own").bitwiseXOR(F.col("flip")))
    apart = F.col("print").bitwiseXOR(F.col("item_print"))
    bits = F.call_function("shiftrightunsigned", apart, F.col("block") * BLOCK_BITS).bitwiseAND(F.lit(2**BLOCK_BITS - 1).cast("long"))
    close = F.filter(_blocks(apart), lambda b: F.bit_count(b["value"]) <= most)
    near = asked.join(small(index), ["size", "block", "value"]).filter((F.bit_count(apart) <= radius) & (F.col("flip") == _lowest(bits, here)))
    near = near.filter(F.get(close, F.lit(0))["block"] == F.col("block")).select("key", "size", "start", "item_key")
    near = small(stored(near)).join(windows, ["key", "size", "start"])
    near = near.join(small(items.select("item_key", "item", "counted")), "item_key")

    near = with_counted(near, "window", "found")
    common = F.size(F.array_intersect("found", "counted"))
    checked = near.withColumn("similarity", common / (F.size("found") + F.col("size") - common))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), (F.size("window") + SHINGLE - 1).alias("words")))
    return checked.groupBy("id", "item").agg(best.alias("best")).filter(F.col("best.similarity") * 100 >= percent).select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), "best.similarity", (-F.col("best.back")).cast("long").alias("first_word"),
        F.col("best.words").cast("long").alias("words"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose id has no benchmark passage, columns unchanged; options as in :func:`find`."""
    found = find(docs, benchmark, id_col=id_col, **options).select(F.col(id_col).alias("leak_id")).distinct()
    return docs.join(found, docs[id_col].eqNullSafe(found["leak_id"]), "left_anti")
