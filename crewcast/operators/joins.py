"""Joins that recur in the fact build and the published tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def resolve_hierarchy(members: DataFrame, default_company: str) -> DataFrame:
    """Each worker with manager and manager's manager; a worker without a company gets the default."""
    full_name = F.concat(F.col("preferred_given_name"), F.lit(" "), F.col("family_name"))
    worker = members.select(
        "team_member_id",
        F.col("manager_team_member_id").alias("_manager"),
        full_name.alias("TECHNICIAN"),
        F.coalesce("contracting_company_nm", F.lit(default_company)).alias("COMPANY"),
    )
    manager = members.select(
        F.col("team_member_id").alias("MGR_TID"),
        F.col("manager_team_member_id").alias("_head"),
        full_name.alias("FIELD_MGR"),
    )
    head = members.select(F.col("team_member_id").alias("OPS_TID"), full_name.alias("OPS_MGR"))
    return (
        worker.join(manager, F.col("_manager") == F.col("MGR_TID"), "left")
        .join(head, F.col("_head") == F.col("OPS_TID"), "left")
        .select("OPS_TID", "OPS_MGR", "MGR_TID", "FIELD_MGR", "team_member_id", "TECHNICIAN", "COMPANY")
    )


def lookup(
    rows: DataFrame, dimension: DataFrame, on: Mapping[str, str], value: str, name: str, default: str | None = None
) -> DataFrame:
    """Add ``dimension.value`` as ``name`` where all keys are equal; ``on`` maps row to dimension columns.

    The dimension is not hinted: Spark broadcasts it when its measured size allows and shuffles
    both sides otherwise. Of a key that the dimension lists twice the smallest value holds, so no row is repeated.
    """
    keys = {left: f"_dim_{i}" for i, left in enumerate(on)}
    side = dimension.select(
        *[F.col(on[left]).alias(k) for left, k in keys.items()], F.col(value).alias("_dim_value")
    ).groupBy(*keys.values()).agg(F.min("_dim_value").alias("_dim_value"))
    condition = reduce(lambda a, b: a & b, [F.col(left) == F.col(k) for left, k in keys.items()])
    found = F.col("_dim_value") if default is None else F.coalesce("_dim_value", F.lit(default))
    return rows.join(side, condition, "left").withColumn(name, found).drop(*keys.values(), "_dim_value")


def two_key_group(
    rows: DataFrame, rules: DataFrame, product: str, in_home_region: Column, name: str, default: str
) -> DataFrame:
    """Group by product and region side.

    ``rules`` has (product, in_home_region, product_group). A rule without a side holds for all
    rows of its product. Rows whose side is unknown match only such rules.
    """
    everywhere = F.array(F.lit(True), F.lit(False), F.lit(None).cast("boolean"))
    side = rules.select(
        F.col("product").alias("_product"),
        F.explode(
            F.when(F.col("in_home_region").isNull(), everywhere).otherwise(F.array("in_home_region"))
        ).alias("_side"),
        F.col("product_group").alias("_group"),
    )
    condition = (F.col(product) == F.col("_product")) & F.col("_row_side").eqNullSafe(F.col("_side"))
    return (
        rows.withColumn("_row_side", in_home_region)
        .join(side, condition, "left")
        .withColumn(name, F.coalesce("_group", F.lit(default)))
        .drop("_row_side", "_product", "_side", "_group")
    )


def with_each(rows: DataFrame, others: DataFrame) -> DataFrame:
    """Each row once per row of ``others``, for outputs that are defined as such a grid.

    Every row of the large side ``rows`` has one of as many numbers as there are shuffle partitions, and the small side
    ``others`` is repeated once per number, so the pairing is an ordinary equi-join that moves each large row once.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = [f.name for f in rows.schema if not isinstance(f.dataType, T.MapType)]
    left = rows.withColumn("_part", F.pmod(F.xxhash64(*plain), F.lit(parts)).cast("int"))
    right = others.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return left.join(right, "_part").drop("_part")


def matching_keys(rows: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys occur in ``others``; no row is repeated."""
    return rows.join(others.select(*keys), list(keys), "left_semi")


#: Estimated bytes of keys that may be broadcast.
KEY_BYTES = 32_000_000
#: Keys that share a word of 64 bits where they are too many to be listed; a word is a row of some 32 bytes.
WORD_KEYS, WORD_BYTES = 8, 32


def near_keys(others: DataFrame, key: str, limit: int = KEY_BYTES) -> Callable[[DataFrame], DataFrame]:
    """A cut of other frames to the values of ``key`` in ``others``, for joins by that key which leave the rest out anyway.

    ``others`` should be stored. Its keys are measured: up to ``limit`` bytes they are broadcast, so that nothing is moved for the
    cut. Of more keys a bit by their hash is, which takes a sixth of that; one in eight of the other rows then passes as well.
    Beyond that too, and for keys of another type, the frames stay whole.
    """
    kind = others.schema[key].dataType
    keys = others.select(key).filter(F.col(key).isNotNull()).distinct()
    count, size = keys.agg(F.count(key), F.coalesce(F.sum(F.octet_length(F.col(key).cast("string")) + 16), F.lit(0))).first()
    if size <= limit:
        return lambda rows: rows.join(F.broadcast(keys), key, "left_semi")
    words = -(-count // WORD_KEYS)
    # Equal values must have equal hashes, so keys of both sides have one type, in which equal values are the same.
    if words * WORD_BYTES > limit or not (isinstance(kind, T.IntegralType) or kind == T.StringType()):
        return lambda rows: rows
    place = F.pmod(F.xxhash64(key), F.lit(64 * words))
    word, bit = F.shiftright(place, 6), place.bitwiseAND(F.lit(63)).cast("int")
    marked = keys.select(word.alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("_bit"))
    marked = marked.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))

    def cut(rows: DataFrame) -> DataFrame:
        if rows.schema[key].dataType != kind:
            return rows
        return rows.join(F.broadcast(marked), word == F.col("_word")).filter(F.getbit("_bits", bit) == 1).select(*rows.columns)

    return cut


def interval_join(left: DataFrame, right: DataFrame, left_span: tuple[str, str], right_span: tuple[str, str], days: int = 31) -> DataFrame:
    """Pairs of rows whose spans of days overlap, both ends included. A null end is open; a span that ends before it starts holds no day.

    Time is cut into bins of ``days``. A row is listed under every bin that it touches, rows meet by bin, and a pair counts in
    the bin where its overlap starts, so that it comes out once. Open ends reach to the outermost day of either side.
    ``days`` should be near the usual length of the longer spans: a row is repeated once for each bin it touches.
    """
    ends = [F.col(c).cast("date") for c in left_span], [F.col(c).cast("date") for c in right_span]
    sides = [rows.select(*[c.alias(f"_d{i}") for i, c in enumerate(span)]) for rows, span in ((left, ends[0]), (right, ends[1]))]
    every = sides[0].unionByName(sides[1])
    outermost = every.agg(F.min(F.least("_d0", "_d1")).alias("first"), F.max(F.greatest("_d0", "_d1")).alias("last"))
    first, last = (F.coalesce(outermost.select(c).scalar(), F.lit("1970-01-01").cast("date")) for c in ("first", "last"))
    bin_of = lambda day: F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / days)

    def listed(rows: DataFrame, span: list[Column], name: str) -> DataFrame:
        begin, end = F.coalesce(span[0], first), F.coalesce(span[1], last)
        spread = rows.withColumns({f"_{name}0": begin, f"_{name}1": end}).filter(F.col(f"_{name}0") <= F.col(f"_{name}1"))
        return spread.withColumn("_bin", F.explode(F.sequence(bin_of(F.col(f"_{name}0")), bin_of(F.col(f"_{name}1")))))

    both = listed(left, ends[0], "l").join(listed(right, ends[1], "r"), "_bin")
    starts = F.greatest("_l0", "_r0")
    return both.filter((starts <= F.least("_l1", "_r1")) & (bin_of(starts) == F.col("_bin"))).drop("_bin", "_l0", "_l1", "_r0", "_r1")
