"""Quality grades by ordinal regression.

The chance that a document's grade is above k is logistic(s - t_k): one score s of hashed text features for all grades,
and ordered thresholds t_k between neighbouring grades. Features are the words of the text, the last three
bytes of each word, and repeats of the word before, hashed into a fixed number of weights; a text's feature values
are log counts of length one. The fit is on a bounded sample of graded documents; prediction reads whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from crewcast.llm.samples import labelled
from crewcast.llm.texts import STEP, chunks, mix, spans, words


@dataclass(frozen=True)
class Settings:
    """Training takes at most ``docs_per_grade`` documents of each grade and ``sample_chars`` characters of each."""

    bits: int = 16
    docs_per_grade: int = 2_000
    sample_chars: int = 20_000
    steps: int = 150
    rate: float = 0.3
    ridge: float = 1e-4
    most_grades: int = 50


def features(column: pa.Array, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, text number, feature number, value) of consecutive rows; each text's values have length one."""
    for row, data, offsets in chunks(column):
        hashes, bounds = words(data, offsets)
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
        starts, ends = spans(data, offsets)
        tails = np.zeros(len(hashes), np.uint64)
        for i in range(3):  # a shorter word has zeros in front
            tails |= np.where(ends - i > starts, data[np.maximum(ends - 1 - i, 0)], 0).astype(np.uint64) << np.uint64(8 * i)
        again = np.zeros(len(hashes), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
        kinds = [hashes, mix(tails * STEP + np.uint64(1)), np.where(again, np.uint64(7), np.uint64(8)) * STEP]
        keys = np.concatenate([(mix(k) >> np.uint64(64 - bits)).astype(np.int64) for k in kinds])
        cells, counts = np.unique(np.tile(owner, len(kinds)) * (1 << bits) + keys, return_counts=True)
        text, feature, value = cells >> bits, cells & ((1 << bits) - 1), np.log1p(counts)
        norm = np.sqrt(np.bincount(text, value * value, minlength=len(offsets) - 1))
        yield row, text, feature, value / norm[text]


@dataclass
class Model:
    grades: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    settings: Settings

    def above(self, scores: np.ndarray) -> np.ndarray:
        """Chances that the grade is above each grade but the last, one line per text; they never increase."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds[None, :], -50, 50)))

    def scores(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
        for (row, text, feature, value), (_, _, offsets) in zip(features(column, self.settings.bits), chunks(column)):
            count = len(offsets) - 1
            yield row, count, np.bincount(text, self.weights[feature] * value, minlength=count)


def fit(grades: list[int], texts: list[str], settings: Settings = Settings()) -> Model:
    """Maximum likelihood with a small ridge, by scaled gradient steps. One grade only gives that grade always."""
    names = np.unique(grades)
    if len(names) > settings.most_grades:
        raise ValueError(f"more than {settings.most_grades} grades")
    place = np.searchsorted(names, grades)
    weights, cuts = np.zeros(1 << settings.bits), len(names) - 1
    if not cuts:
        return Model(names, weights, np.zeros(0), settings)
    parts = [(row + text, feature, value) for row, text, feature, value in features(pa.array(texts, pa.string()), settings.bits)]
    text, feature, value = (np.concatenate(x) for x in zip(*parts))
    share = np.array([(place > k).mean() for k in range(cuts)])
    start = -np.log(share / (1 - share))
    # thresholds = first, then first + sums of exponentials, so their order cannot be lost
    free = np.r_[start[0], np.log(np.maximum(np.diff(start), 1e-3))]
    moved, seen = np.zeros(len(weights)), np.zeros(len(free))
    logistic = lambda x: 1 / (1 + np.exp(-np.clip(x, -50, 50)))
    for _ in range(settings.steps):
        thresholds = free[0] + np.r_[0.0, np.cumsum(np.exp(free[1:]))]
        scores = np.bincount(text, weights[feature] * value, minlength=len(texts))
        edges = np.c_[np.ones(len(texts)), logistic(scores[:, None] - thresholds[None, :]), np.zeros(len(texts))]
        up, down = edges[np.arange(len(texts)), place], edges[np.arange(len(texts)), place + 1]
        chance = np.maximum(up - down, 1e-12)
        slope_up, slope_down = up * (1 - up) / chance, down * (1 - down) / chance
        by_score = (slope_up - slope_down) / len(texts)
        by_cut = np.zeros(cuts + 2)
        np.subtract.at(by_cut, place, slope_up / len(texts))
        np.add.at(by_cut, place + 1, slope_down / len(texts))
        by_cut = by_cut[1:-1]
        by_free = np.r_[by_cut.sum(), np.exp(free[1:]) * np.cumsum(by_cut[::-1])[::-1][1:]]
        step = np.bincount(feature, value * by_score[text], minlength=len(weights)) - settings.ridge * weights
        moved, seen = moved + step * step, seen + by_free * by_free
        weights = weights + settings.rate * step / np.sqrt(moved + 1e-12)
        free = free + settings.rate * by_free / np.sqrt(seen + 1e-12)
    return Model(names, weights, free[0] + np.r_[0.0, np.cumsum(np.exp(free[1:]))], settings)


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
          grade_col: str = "quality") -> Model:
    """Fit on a bounded sample of graded documents. Without any, the only grade is 0 and there are no tails."""
    found = labelled(docs, labels, settings.docs_per_grade, settings.sample_chars, id_col, text_col, grade_col)
    if not found:
        return Model(np.zeros(1, int), np.zeros(1 << settings.bits), np.zeros(0), settings)
    return fit([g for g, _ in found], [t for _, t in found], settings)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", **more: Column) -> DataFrame:
    """One row per row of ``docs``: id, ``more`` columns, score, expected_grade, tails (chance of more than each grade but the last).

    A null, empty or blank text has the score 0, so the thresholds alone decide.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits weights, whatever the data
    rows = docs.select(docs[id_col].alias("id"), *[c.alias(name) for name, c in more.items()], docs[text_col].alias("text"))
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in rows.schema[:-1]] + ["score double", "expected_grade double", "tails array<double>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            for row, count, scores in fitted.scores(batch.column(batch.num_columns - 1)):
                tails = fitted.above(scores)
                expected = fitted.grades[0] + tails @ np.diff(fitted.grades).astype(float)
                part = [c.slice(row, count) for c in batch.columns[:-1]]
                arrays = part + [pa.array(scores), pa.array(expected), pa.array(list(tails), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(arrays, batch.schema.names[:-1] + ["score", "expected_grade", "tails"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
