"""Wide month columns to rows, and labelled rows to columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from crewcast.functions import parse_month_label

_MONTH_COLUMN = re.compile(
    r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*_\d{4}", re.IGNORECASE
)


def month_columns(frame: DataFrame) -> list[str]:
    """Columns named like ``Jan_2025`` or ``January_2025``, in table order."""
    return [c for c in frame.columns if _MONTH_COLUMN.fullmatch(c)]


def unpivot_months(
    wide: DataFrame, keep: Sequence[str], month: str = "Month", value: str = "Value"
) -> DataFrame:
    """One row per filled month column; empty cells leave no row. ``month`` becomes a DATE."""
    months = month_columns(wide)
    if not months:
        raise ValueError("no month columns found")
    long = wide.select(*keep, *[F.col(c).cast("double") for c in months]).unpivot(
        list(keep), months, "_label", value
    )
    return long.filter(F.col(value).isNotNull()).select(*keep, parse_month_label(F.col("_label")).alias(month), value)


def pivot_labels(
    long: DataFrame, keys: Sequence[str], label: str, labels: Sequence[str], value: str
) -> DataFrame:
    """One column per label, keeping only keys that have all of them."""
    return long.groupBy(*keys).pivot(label, list(labels)).agg(F.first(value, ignorenulls=True)).dropna(subset=list(labels))
