"""Hard negatives: of each anchor and positive, the best-scoring rows of other labels within a window of scores.

Scores are integer inner products. Anchors and candidates are dealt in tiles, and a tile of scores is one matrix product
by Strassen's recursion: odd sides get a line of zeros, a product is seven products of half the size, and below a leaf
size it is a plain one. Only sums, differences and products of integers occur, so scores are exact.

1. A bounded number of anchors is taken at once and broadcast. Every task goes over its candidates tile by tile and keeps a
   heap of the best positives of each anchor; the heaps of all tasks merge into one.
2. With the positives, each anchor has a window of scores for each of them. A second pass keeps a heap of the best
   negatives for each window, merged in the same way.

A heap is as long as the number asked for, whatever the data, and no label is brought together: a frequent label is
spread over the tasks as its rows are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from crewcast.llm.storage import stored
from crewcast.llm.vectors import Best, matrix, usable

SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass(frozen=True)
class Settings:
    positives: int = 5
    negatives: int = 10
    #: A negative's score lies between these percentages of the positive's.
    low: int = 30
    high: int = 90
    #: Anchors broadcast at once, on average; more are taken in further passes.
    anchors: int = 16_384
    #: Anchors and candidates of a tile.
    tile: tuple[int, int] = (512, 2_048)
    #: Products with a side of at most this are not divided.
    leaf: int = 32


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = 32) -> np.ndarray:
    """Exact product of integer matrices (modulo 2^64 for int64, so exact wherever the result fits)."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    a, b = (np.pad(x, [(0, s % 2) for s in x.shape]) if any(s % 2 for s in x.shape) else x for x in (a, b))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * l), p1.dtype)
    out[:i, :l], out[:i, l:] = p1 + p4 - p5 + p7, p3 + p5
    out[i:, :l], out[i:, l:] = p2 + p4, p1 - p2 + p3 + p6
    return out[:m, :n]


def _tiles(batches: Iterator[pa.RecordBatch], anchors: np.ndarray, settings: Settings) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchors, candidate ids, candidate labels, scores) of every tile of a task's candidates."""
    for batch in batches:
        for part in (batch.slice(i, settings.tile[1]) for i in range(0, batch.num_rows, settings.tile[1])):
            ids, labels = (part.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
            across = np.ascontiguousarray(matrix(part.column("vector"), np.int64).T)
            for begin in range(0, len(anchors), settings.tile[0]):
                lines = slice(begin, min(begin + settings.tile[0], len(anchors)))
                yield lines, ids, labels, strassen(anchors[lines], across, settings.leaf)


def _partial(best: Best) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(best.line), pa.array(best.score), pa.array(best.id)], ["line", "score", "id"])


def _merged(partial: DataFrame, keep: int) -> DataFrame:
    """One heap of all tasks' heaps: (line, rank, score, id)."""
    order = Window.partitionBy("line").orderBy(F.desc("score"), "id")
    return partial.withColumn("rank", F.dense_rank().over(order)).filter(F.col("rank") <= keep).distinct()


def _positives(rows: DataFrame, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, settings: Settings) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast((ids, labels, vectors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_ids, own_labels, anchors = shared.value
        best = Best(len(anchors), settings.positives)
        for lines, keys, kinds, scores in _tiles(batches, anchors, settings):
            fits = (own_labels[lines, None] == kinds[None]) & (own_ids[lines, None] != keys[None]) & (scores >= best.least[lines, None])
            line, at = np.nonzero(fits)
            best.add(line + lines.start, scores[line, at], keys[at])
        yield _partial(best)

    return _merged(rows.mapInArrow(run, "line long, score long, id long"), settings.positives)


def _negatives(rows: DataFrame, labels: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray, settings: Settings) -> DataFrame:
    """``low`` and ``high``: score windows, one line per anchor and one column per positive; a line is anchor * columns + column."""
    shared = rows.sparkSession.sparkContext.broadcast((labels, vectors, low, high))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_labels, anchors, least, most = shared.value
        columns = least.shape[1]
        best = Best(least.size, settings.negatives)
        for lines, keys, kinds, scores in _tiles(batches, anchors, settings):
            other = own_labels[lines, None] != kinds[None]
            found = []
            for c in range(columns):
                floor = np.maximum(least[lines, c], best.least.reshape(-1, columns)[lines, c])
                line, at = np.nonzero(other & (scores >= floor[:, None]) & (scores <= most[lines, c, None]))
                found.append(((line + lines.start) * columns + c, scores[line, at], keys[at]))
            best.add(*(np.concatenate(x) for x in zip(*found)))
        yield _partial(best)

    return _merged(rows.mapInArrow(run, "line long, score long, id long"), settings.negatives)


def mine(rows: DataFrame, is_anchor: Callable[[Column], Column], id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
         settings: Settings = Settings()) -> DataFrame:
    """Per anchor and positive, the first negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` hold whole numbers as vectors and labels; ``is_anchor`` says of the id column which ids are anchors. An
    anchor's positives are the first rows of its label with another id, by falling score and then rising id; its
    negatives the first rows of other labels whose score lies within the window of the positive. Fewer rows are given
    where fewer exist, none for an empty table. Rows with a null id, label or vector, or an incomplete vector (see
    :func:`vectors.usable`), take no part. A row that is repeated counts once; rows with one id and different vectors are
    rows of their own. Other columns are not looked at. Vectors whose scores might exceed 64 bits raise ValueError.
    """
    label = rows[label_col].cast("long")
    named = rows.filter(rows[id_col].isNotNull() & label.isNotNull())
    base = stored(usable(named, vector_col, id=named[id_col].cast("long"), label=label).withColumn("vector", F.col("vector").cast("array<long>")))
    facts = base.agg(F.max(F.size("vector")).alias("size"), F.max(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))).alias("most"),
                     F.count_if(is_anchor(F.col("id"))).alias("anchors")).first()
    if not facts["anchors"]:
        return rows.sparkSession.createDataFrame([], SCHEMA)
    if facts["size"] * facts["most"] ** 2 * 100 >= 2.0**63:
        raise ValueError(f"scores of {facts['size']} components up to {facts['most']:.0f} do not fit 64 bits")
    spark = rows.sparkSession
    passes = -(-facts["anchors"] // settings.anchors)
    # One heap per task: as many tasks as can run a few times over, not one per small file.
    candidates = base.coalesce(2 * spark.sparkContext.defaultParallelism)
    anchors = base.filter(is_anchor(F.col("id"))).withColumn("pass", F.pmod(F.xxhash64("id"), F.lit(passes)))
    results = []
    for number in range(passes):
        taken = anchors.filter(F.col("pass") == number).select("id", "label", "vector").dropDuplicates().orderBy("id").toArrow()  # about settings.anchors rows
        if not taken.num_rows:
            continue
        ids, labels, vectors = taken["id"].to_numpy(), taken["label"].to_numpy(), matrix(taken["vector"], np.int64)
        found = _positives(candidates, ids, labels, vectors, settings).toArrow()  # settings.positives rows an anchor
        line, rank = found["line"].to_numpy(), found["rank"].to_numpy() - 1
        score, other = np.zeros((len(ids), settings.positives), np.int64), np.zeros((len(ids), settings.positives), np.int64)
        score[line, rank], other[line, rank] = found["score"].to_numpy(), found["id"].to_numpy()
        low, high = np.ones_like(score), np.zeros_like(score)  # an empty window where a positive lacks
        low[line, rank], high[line, rank] = -(-settings.low * score[line, rank] // 100), settings.high * score[line, rank] // 100
        at = line * settings.positives + rank
        windows = pa.table({"line": at, "anchor_id": ids[line], "positive_id": other[line, rank], "positive_score": score[line, rank]})
        windows = F.broadcast(spark.createDataFrame(windows))  # settings.positives rows an anchor
        best = _negatives(candidates, labels, vectors, low, high, settings)
        results.append(stored(best.join(windows, "line").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"))))
    return reduce(DataFrame.unionByName, results)
