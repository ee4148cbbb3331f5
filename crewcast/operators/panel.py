"""Series panels: monthly and daily sums, gap filling, prediction input."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from crewcast.functions import add_month_steps, month_of, month_sequence, series_identifier


def period_sums(
    facts: DataFrame, keys: Sequence[str], period: Column, name: str, measures: Sequence[str]
) -> DataFrame:
    """Sum of each measure per key and period."""
    return facts.groupBy(*keys, period.alias(name)).agg(*[F.sum(m).alias(m) for m in measures])


def carried_forward(value: str, keys: Sequence[str], order: str) -> Column:
    """The last known value up to each row. A key's rows are its periods, so a window is short."""
    so_far = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.last(value, ignorenulls=True).over(so_far)


def previous_or(value: str, keys: Sequence[str], order: Sequence[str], default: object) -> Column:
    """The preceding row's value; the default where there is none or it is null."""
    return F.coalesce(F.lag(value).over(Window.partitionBy(*keys).orderBy(*order)), F.lit(default))


def fill_periods(
    sums: DataFrame, keys: Sequence[str], period: str, measures: Sequence[str], calendar: Column
) -> DataFrame:
    """Every key on every date of ``calendar``, with 0 where it has no value.

    ``sums`` holds at most one row per key and period, so a key's values form a map no longer than
    the calendar; the calendar is exploded next to it and looked up. No calendar join is needed.
    ``calendar`` may use the columns ``first_period`` and ``last_period`` of the key.
    """
    entry = F.struct(F.col(period), F.struct(*measures))
    filled = sums.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.when(F.col(period).isNotNull(), entry))).alias("_values"),
        F.min(period).alias("first_period"),
        F.max(period).alias("last_period"),
    )
    dated = filled.select(*keys, "_values", F.explode(calendar).alias(period))
    cell = F.try_element_at("_values", F.col(period))
    zero = {m: F.lit(0).cast(sums.schema[m].dataType) for m in measures}
    return dated.select(*keys, period, *[F.coalesce(cell[m], zero[m]).alias(m) for m in measures])


def dense_month_panel(
    facts: DataFrame,
    dims: Sequence[str],
    day: str,
    measures: Sequence[str],
    first_month: date,
    as_of: date,
    month: str = "Appointment_Month",
    identifier: str = "Series_Identifier",
) -> DataFrame:
    """Zero-filled monthly panel of all series, up to the month before ``as_of``."""
    sums = period_sums(facts, dims, month_of(F.col(day)), month, measures)
    calendar = month_sequence(F.lit(first_month), add_month_steps(month_of(F.lit(as_of)), -1))
    panel = fill_periods(sums, dims, month, measures, calendar)
    return panel.select(month, series_identifier(dims).alias(identifier), *dims, *measures)


def daily_series(
    source: DataFrame,
    attributes: Sequence[str],
    day: str,
    target: str,
    cutoff: date,
    identifier: str = "Series_Identifier",
) -> DataFrame:
    """Daily sum of the target per attribute combination, up to and with ``cutoff``."""
    missing = [c for c in (*attributes, day, target) if c not in source.columns]
    if missing:
        raise ValueError(f"unknown columns: {missing}")
    sums = source.filter(F.col(day) <= F.lit(cutoff)).groupBy(day, *attributes).agg(F.sum(target).alias(target))
    return sums.select(series_identifier(attributes).alias(identifier), day, *attributes, target)


def prediction_scaffold(
    panel: DataFrame,
    dims: Sequence[str],
    target: str,
    start: date,
    end: date,
    horizon: int,
    month: str = "Appointment_Month",
    identifier: str = "Series_Identifier",
) -> DataFrame:
    """Input set of the monthly forecast: known months of the window, then ``horizon`` empty ones.

    Only series without a null attribute take part. A series' months fit one short list, so the
    known and the empty months of a series come out of the same group-by.
    """
    known = (F.col(month) >= month_of(F.lit(start))) & (F.col(month) < month_of(F.lit(end)))
    value = panel.schema[target].dataType

    def row(day: Column, amount: Column, label: str) -> Column:
        return F.struct(
            day.alias(month), amount.cast(value).alias(target), F.lit(label).alias(f"{target}_Type")
        )

    past = F.collect_list(F.when(known, row(F.col(month), F.col(target), "actual")))
    ahead = F.transform(
        F.sequence(F.lit(0), F.lit(horizon - 1)),
        lambda i: row(F.add_months(month_of(F.lit(end)), i), F.lit(None), "predicted"),
    )
    series = panel.dropna(subset=list(dims)).groupBy(*dims).agg(past.alias("_past"))
    rows = series.select(*dims, F.explode(F.concat("_past", ahead)).alias("_row"))
    return rows.select(
        series_identifier(dims).alias(identifier), f"_row.{month}", *dims, f"_row.{target}", f"_row.{target}_Type"
    )
