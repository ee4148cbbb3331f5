"""Approximate nearest neighbours along shifted Hilbert curves.

1. Every curve projects the vectors on some random directions, shifts them and orders them by their place on a Hilbert
   curve through the cells of a grid. Vectors that are near in space are mostly near on some curve.
2. Rows are range-partitioned by (curve, key) and sorted, and numbered in that order.
3. A query looks at the rows up to ``window`` places before and after it on each curve, block by block; the nearest of
   each block merge into the nearest of all, by exact distance of the original vectors.

The window is measured, not set: some rows chosen by hash are compared with all rows, and the least window that finds the
wanted share of their neighbours on at least one curve is taken. Vectors without structure need a window of a large
part of the rows, clustered ones a short one, at every size of the table.

Of equal vectors only as many as can be asked for are candidates, those with the smallest ids; so a vector that
a third of the rows share does not fill the windows around it, and no result changes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from crewcast.llm.storage import partitions, small, stored
from crewcast.llm.vectors import Best, matrix, usable

SCHEMA = "query_id long, rank int, vec_id long, score double"


@dataclass(frozen=True)
class Settings:
    neighbours: int = 10
    curves: int = 4
    #: Directions of a curve and bits of each; their product must be below 64.
    axes: int = 8
    bits: int = 7
    #: Rows by which the grid is laid, and rows whose true neighbours are sought to measure the window.
    sample: int = 10_000
    probes: int = 128
    #: Share of the probes' neighbours that the window must find.
    recall: float = 0.96
    #: Places of a curve in one block, and queries that one task compares with a block.
    block: int = 2_048
    queries: int = 4_096
    seed: int = 13


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of every cell (line of coordinates below 2^bits), by Skilling's transposition."""
    x = cells.astype(np.int64).copy()
    axes = x.shape[1]
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for i in range(axes):
            inside = (x[:, i] & bit) != 0
            swap = np.where(inside, 0, (x[:, 0] ^ x[:, i]) & below)
            x[:, 0] ^= np.where(inside, below, swap)
            x[:, i] ^= swap
    for i in range(1, axes):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[:, -1] >> level) & 1, (1 << level) - 1, 0)
    x ^= turn[:, None]
    key = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << 1) | ((x[:, i] >> level) & 1)
    return key


@dataclass
class Grid:
    """Directions, lower ends, widths and shifts of all curves."""

    directions: np.ndarray
    low: np.ndarray
    width: np.ndarray
    settings: Settings

    @classmethod
    def of(cls, sample: np.ndarray, settings: Settings) -> Grid:
        rng = np.random.default_rng(settings.seed)
        size, wanted = sample.shape[1], settings.curves * settings.axes
        # Directions of one rotation are used up before the next is drawn.
        turns = [np.linalg.qr(rng.normal(size=(size, size)))[0] for _ in range(-(-wanted // size))]
        directions = np.concatenate(turns, 1)[:, :wanted]
        seen = sample @ directions
        span = np.maximum(seen.max(0) - seen.min(0), 1e-300)
        # The grid is twice as wide as the sample; the shift puts the sample somewhere inside.
        return cls(directions, seen.min(0) - span * rng.random(wanted), 2 * span, settings)

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """One line per vector, one key per curve."""
        cells = np.floor((vectors @ self.directions - self.low) / self.width * 2**self.settings.bits)
        cells = np.clip(cells, 0, 2**self.settings.bits - 1).astype(np.int64)
        return np.stack([hilbert(part, self.settings.bits) for part in np.split(cells, self.settings.curves, axis=1)], 1)


def _nearest(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, inside: np.ndarray, best: Best) -> None:
    """Add every query's nearest rows among those ``inside`` (queries x rows); scores are negative distances."""
    if not len(ids) or not len(query_ids):
        return
    # A quick estimate by products, then exact distances of what may be among the nearest.
    square = (queries * queries).sum(1)[:, None] + (rows * rows).sum(1)[None] - 2 * queries @ rows.T
    square = np.where(inside & (query_ids[:, None] != ids[None]), square, np.inf)
    slack = 1e-9 * ((queries * queries).sum(1) + (rows * rows).sum(1).max())
    kth = np.partition(square, best.keep - 1, 1)[:, best.keep - 1] if len(ids) > best.keep else np.full(len(queries), np.inf)
    bound = np.minimum(kth, best.least**2)
    line, at = np.nonzero((square <= (bound + slack)[:, None]) & np.isfinite(square))
    for begin in range(0, len(line), 200_000):
        i, j = line[begin : begin + 200_000], at[begin : begin + 200_000]
        best.add(i, -np.sqrt(((queries[i] - rows[j]) ** 2).sum(1)), ids[j])


def _merged(partial: DataFrame, keep: int) -> DataFrame:
    """One heap of all heaps: (query_id, rank, vec_id, score)."""
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return partial.withColumn("rank", F.dense_rank().over(order)).filter(F.col("rank") <= keep).distinct().select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _table(best: Best, query_ids: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"query_id": query_ids[best.line], "vec_id": best.id, "score": -best.score})


def brute_force(rows: DataFrame, query_ids: np.ndarray, queries: np.ndarray, keep: int) -> DataFrame:
    """Nearest of all ``rows`` (id, vector) for a bounded number of queries."""
    shared = rows.sparkSession.sparkContext.broadcast((query_ids, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, asked = shared.value
        best = Best(len(ids), keep, np.float64)
        for batch in batches:
            for part in (batch.slice(i, 2_048) for i in range(0, batch.num_rows, 2_048)):
                keys = part.column(0).to_numpy(zero_copy_only=False)
                _nearest(asked, ids, matrix(part.column(1)), keys, np.ones((1, len(keys)), bool), best)
        yield pa.RecordBatch.from_pandas(_table(best, ids), preserve_index=False)

    return _merged(rows.select("id", "vector").mapInArrow(run, "query_id long, vec_id long, score double"), keep)


def _first_copies(rows: DataFrame, keep: int) -> DataFrame:
    """``near``: whether a row is among the first ``keep`` ids of its vector. Only vectors with more copies are gathered, in slices first."""
    rows = rows.withColumn("hash", F.xxhash64("vector"))
    hot = small(stored(rows.groupBy("hash").count().filter(F.col("count") > keep).select("hash")))
    frequent = rows.join(hot, "hash", "left_semi").select("vector", "id").distinct().withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(64)))
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("id"))
    first = frequent.withColumn("at", place("vector", "slice")).filter(F.col("at") <= keep)
    first = first.withColumn("at", place("vector")).filter(F.col("at") <= keep).select("id", "vector", F.lit(True).alias("first"))
    usual = rows.join(hot, "hash", "left_anti").withColumn("near", F.lit(True))
    often = rows.join(hot, "hash", "left_semi").join(small(stored(first)), ["id", "vector"], "left").withColumn("near", F.coalesce("first", F.lit(False)))
    return usual.drop("hash").unionByName(often.drop("hash", "first"))


def _ordered(rows: DataFrame, grid: Grid) -> DataFrame:
    """Rows once per curve with their place on it: curve, place, id, vector, near, query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = grid.keys(matrix(batch.column(1))) if batch.num_rows else np.zeros((0, grid.settings.curves), np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(keys), pa.list_(pa.int64()))], [*batch.schema.names, "keys"])

    kind = rows.schema["vector"].dataType.simpleString()
    keyed = rows.select("id", "vector", "near", "query").mapInArrow(run, f"id long, vector {kind}, near boolean, query boolean, keys array<long>")
    along = keyed.select("id", "vector", "near", "query", F.posexplode("keys").alias("curve", "key"))
    order = ["curve", "key", "id", "vector"]
    spread = along.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    whole = stored(spread.withColumn("number", F.monotonically_increasing_id()).drop("key"))
    # The number holds the task above 33 bits and the row in it below.
    whole = whole.withColumn("task", F.shiftright("number", 33))
    parts = whole.groupBy("curve", "task").agg(F.count("*").alias("count"), F.min("number").alias("first"))
    before = Window.partitionBy("curve").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")  # a row per curve and task
    placed = whole.join(F.broadcast(parts), ["curve", "task"])
    return placed.withColumn("place", F.col("before") + F.col("number") - F.col("first")).drop("task", "number", "first", "before")


def measured_window(ordered: DataFrame, truth: pd.DataFrame, recall: float) -> int:
    """Least distance on the best curve that reaches ``recall`` of the pairs (query_id, vec_id) in ``truth``."""
    wanted = sorted({*truth["query_id"], *truth["vec_id"]})
    spark = ordered.sparkSession
    ids = F.broadcast(spark.createDataFrame([(int(i),) for i in wanted], "id long"))
    found = ordered.join(ids, "id").groupBy("id", "curve").agg(F.min("place").alias("place")).toPandas()  # a few thousand ids a curve
    at = found.pivot(index="id", columns="curve", values="place")
    apart = np.abs(at.loc[truth["query_id"]].to_numpy() - at.loc[truth["vec_id"]].to_numpy()).min(1)
    return int(np.sort(apart)[min(len(apart) - 1, int(np.ceil(recall * len(apart))))])


def search(rows: DataFrame, is_query: Callable[[Column], Column], id_col: str = "vec_id", vector_col: str = "embedding",
           settings: Settings = Settings()) -> DataFrame:
    """Nearest rows of every query: query_id, rank from 1, vec_id, score (Euclidean distance in double precision).

    ``is_query`` says of the id column which rows are queries; each is compared with all rows but those of its own id.
    Equal distances go by the smaller id; a repeated row counts once. Rows with a null id, and vectors that are null, zero
    or incomplete (see :func:`vectors.usable`), take no part. Fewer rows than asked for are all returned; an empty
    table gives no rows. Other columns are not looked at.
    """
    spark, keep = rows.sparkSession, settings.neighbours
    named = rows.filter(rows[id_col].isNotNull())
    base = usable(named, vector_col, id=named[id_col].cast("long")).filter(F.exists("vector", lambda c: c != 0))
    base = stored(base.withColumn("query", is_query(F.col("id"))))
    drawn = base.select("id", "vector", F.xxhash64("id", "vector").alias("draw")).orderBy("draw", "id").limit(settings.sample).toArrow()
    if not drawn.num_rows:
        return spark.createDataFrame([], SCHEMA)
    sample = matrix(drawn["vector"])
    # One more than asked for, as a query's own row may be among its copies.
    ordered = stored(_ordered(_first_copies(base, keep + 1), Grid.of(sample, settings)))
    probes = drawn["id"].to_numpy()[: settings.probes]
    truth = brute_force(base, probes, sample[: settings.probes], keep).toPandas()
    window = measured_window(ordered, truth, settings.recall) if len(truth) else 0

    block = lambda place: F.floor(place / settings.block)
    last = F.max("place")
    ends = ordered.groupBy("curve").agg(last.alias("last"))  # a row per curve
    asked = ordered.filter("query").join(F.broadcast(ends), "curve")
    asked = asked.withColumn("block", F.explode(F.sequence(block(F.greatest(F.lit(0), F.col("place") - window)),
                                                           block(F.least("last", F.col("place") + window)))))
    chunks = small(stored(asked.groupBy("curve", "block").agg(F.ceil(F.count("*") / settings.queries).alias("chunks"))))
    columns = lambda end: [F.col(c).alias(c + end) for c in ("curve", "block", "chunk", "id", "place", "vector")]
    held = ordered.filter("near").withColumn("block", block(F.col("place"))).join(chunks, ["curve", "block"])
    held = held.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).select(columns(""))
    asked = asked.join(chunks, ["curve", "block"]).withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks"))).select(columns("_q"))

    def compare(queries: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(near):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        queries = queries.rename(columns=lambda c: c.removesuffix("_q"))
        ids, places = near["id"].to_numpy(), near["place"].to_numpy()
        vectors = np.stack(near["vector"].to_numpy()).astype(np.float64)
        found = []
        for begin in range(0, len(queries), 512):
            part = queries.iloc[begin : begin + 512]
            own = part["id"].to_numpy()
            best = Best(len(part), keep, np.float64)
            inside = np.abs(part["place"].to_numpy()[:, None] - places[None]) <= window
            _nearest(np.stack(part["vector"].to_numpy()).astype(np.float64), own, vectors, ids, inside, best)
            found.append(_table(best, own))
        return pd.concat(found)

    partial = asked.groupBy("curve_q", "block_q", "chunk_q").cogroup(held.groupBy("curve", "block", "chunk")).applyInPandas(
        compare, "query_id long, vec_id long, score double")
    return _merged(partial, keep)
