"""Forecast history: stamped, append-only versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from crewcast.sources.versioned import VersionedTable, schema_text


def stamped(forecasts: DataFrame, stamp: str) -> DataFrame:
    """Forecast rows with their version stamp in front."""
    return forecasts.select(F.lit(stamp).alias("Forecast_Date"), *forecasts.columns)


def append_version(forecasts: DataFrame, history_path: str, stamp: str) -> None:
    """Add one version to the history; running it again with the same stamp changes nothing more."""
    rows = stamped(forecasts, stamp)
    version_table(rows.sparkSession, history_path, schema_text(rows)).put(rows, stamp)


def version_table(spark: SparkSession, path: str, schema: str) -> VersionedTable:
    """The history of forecasts: one slot per stamp."""
    return VersionedTable(spark, path, schema)
