"""Expanding-window folds for back-testing."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Fold:
    split_index: int
    train_start: date
    train_end: date
    test_start: date
    test_end: date


def expanding_folds(train_start: date, first_train_end: date, horizon: int, count: int = 4) -> list[Fold]:
    """Folds with a common start; each test window begins where the train window stops."""
    starts = [first_train_end + timedelta(days=horizon * k) for k in range(count)]
    return [
        Fold(k, train_start, end, end + timedelta(days=1), end + timedelta(days=horizon))
        for k, end in enumerate(starts, 1)
    ]


def _tagged(series: DataFrame, day: str, windows: list[tuple[int, date, date]]) -> DataFrame:
    def tag(index: int, first: date, last: date) -> Column:
        return F.when(F.col(day).between(F.lit(first), F.lit(last)), F.lit(index))

    tags = F.array_compact(F.array(*[tag(*w) for w in windows]))
    return series.select(*series.columns, F.explode(tags).alias("split_index"))


def train_rows(series: DataFrame, day: str, folds: list[Fold]) -> DataFrame:
    """Each row once per fold that trains on it. The folds are literals, so nothing is shuffled."""
    return _tagged(series, day, [(f.split_index, f.train_start, f.train_end) for f in folds])


def held_out_rows(series: DataFrame, day: str, folds: list[Fold]) -> DataFrame:
    """Each row with the fold that tests on it."""
    return _tagged(series, day, [(f.split_index, f.test_start, f.test_end) for f in folds])


def labelled_rows(series: DataFrame, day: str, folds: list[Fold]) -> DataFrame:
    """Train and test rows of all folds in one pass, told apart by ``dataset_type``."""

    def tag(kind: str, fold: Fold, first: date, last: date) -> Column:
        label = F.struct(F.lit(kind).alias("dataset_type"), F.lit(fold.split_index).alias("split_index"))
        return F.when(F.col(day).between(F.lit(first), F.lit(last)), label)

    tags = [tag("train", f, f.train_start, f.train_end) for f in folds]
    tags += [tag("test", f, f.test_start, f.test_end) for f in folds]
    return series.select(*series.columns, F.inline(F.array_compact(F.array(*tags))))
