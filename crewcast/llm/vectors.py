"""Rows of embeddings that can be computed with, and heaps of the best entries that merge."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(rows: DataFrame, vector_col: str, **columns: Column) -> DataFrame:
    """``columns`` and ``vector`` of the rows whose vector is complete.

    A vector that is null, empty or holds a null or non-finite component takes no part, nor does one whose length is not that
    of most complete vectors (of equally frequent lengths the greatest counts).
    """
    vector = rows[vector_col]
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    kept = rows.filter(vector.isNotNull() & (F.size(vector) > 0) & finite).select(*[c.alias(n) for n, c in columns.items()], vector.alias("vector"))
    length = kept.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    return kept.filter(F.size("vector") == (length["length"] if length else 0))


def matrix(column: pa.Array, dtype: type = np.float64) -> np.ndarray:
    """One line per row of a column of equally long lists without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return values.reshape(len(column), -1)


class Best:
    """The first ``keep`` entries of each line by falling score, then rising id. An (id, score) counts once.

    Two of them merge by adding the entries of one to the other, in any order.
    """

    def __init__(self, lines: int, keep: int, dtype: type = np.int64):
        self.keep = keep
        self.line, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, dtype), np.zeros(0, np.int64)
        #: An entry below this cannot come in.
        self.least = np.full(lines, np.iinfo(dtype).min if np.issubdtype(dtype, np.integer) else -np.inf, dtype)

    def add(self, line: np.ndarray, score: np.ndarray, key: np.ndarray) -> None:
        if not len(line):
            return
        line, score, key = (np.concatenate(x) for x in ((self.line, line), (self.score, score), (self.id, key)))
        order = np.lexsort((key, -score, line))
        line, score, key = line[order], score[order], key[order]
        fresh = np.ones(len(line), bool)
        fresh[1:] = (line[1:] != line[:-1]) | (score[1:] != score[:-1]) | (key[1:] != key[:-1])
        line, score, key = line[fresh], score[fresh], key[fresh]
        first = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
        rank = np.arange(len(line)) - np.repeat(first, np.diff(np.r_[first, len(line)]))
        last = rank == self.keep - 1
        self.least[line[last]] = score[last]
        self.line, self.score, self.id = (x[rank < self.keep] for x in (line, score, key))
