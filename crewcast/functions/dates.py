"""Calendar expressions. Months and days are DATE, instants are zone-less UTC timestamps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from crewcast.fixed_values import FOLDER_UNITS, FOLDERS


def month_of(day: Column) -> Column:
    """First day of the month, as a DATE."""
    return F.trunc(day, "MM")


def add_month_steps(day: Column, steps: Column | int) -> Column:
    """``day`` moved by whole months; a day past the month's end becomes its last day."""
    return F.add_months(day, steps)


def month_sequence(first: Column, last: Column) -> Column:
    """Array of month starts from ``first`` to ``last``; empty when ``last`` comes earlier."""
    first, last = month_of(first), month_of(last)
    return F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month"))).otherwise(
        F.array().cast("array<date>")
    )


def parse_month_label(label: Column) -> Column:
    """``Jan_2025`` or ``January_2025`` to the month's first day; anything else to null."""
    return F.coalesce(
        F.try_to_timestamp(label, F.lit("MMM_yyyy")), F.try_to_timestamp(label, F.lit("MMMM_yyyy"))
    ).cast("date")


def week_ending_monday(day: Column) -> Column:
    """The Monday that closes the week of ``day``; a Monday closes its own week."""
    return F.date_add(day, F.pmod(F.lit(2) - F.dayofweek(day), F.lit(7)))


def local_datetime(instant: Column, zone: Column) -> Column:
    """Wall-clock time of a UTC instant in each row's own zone; null if either is null."""
    return F.convert_timezone(F.lit("UTC"), zone, instant.cast("timestamp_ntz"))


def local_date(instant: Column, zone: Column) -> Column:
    return local_datetime(instant, zone).cast("date")


def folder_of(columns: Sequence[str], name: str) -> tuple[str, str] | None:
    """(folder column, its unit) of a timestamp column, if ``columns`` are those of a stored history that is cut by it."""
    for unit in FOLDER_UNITS:
        folder = f"{FOLDERS.get(name)}_{unit}"
        if folder in columns:
            return folder, unit
    return None
