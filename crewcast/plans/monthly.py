"""Monthly jobs: history, panel, prediction input, forecast, published tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from crewcast import fixed_values as fv
from crewcast.operators import efficiency, marketing, panel as panels, publish
from crewcast.operators.correction import corrections
from crewcast.operators.forecast import monthly_global_forecast
from crewcast.operators.latest import nth_latest_version
from crewcast.plans.fact import FactRules, Upstream, service_fact
from crewcast.plans.runs import Run
from crewcast.plans.versions import append_version, stamped, version_table
from crewcast.session import shared_folder
from crewcast.sources import schemas, tables
from crewcast.sources.versioned import VersionedTable

DIMS = list(fv.SERIES_DIMS)


def history_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, schemas.DAILY_FACT, "Appointment_Timestamp")


def load_history(up: Upstream, rules: FactRules, start: date, end: date, path: str) -> int:
    """Load the fact of the local days [start, end) into the history; returns the version.

    A load owns its days: it replaces what earlier loads hold for them, also where it has no rows, and periods may overlap.
    The fact's period test accepts a job by its appointment or its early start. A job whose appointment lies outside
    is a row of another day and belongs to the load that owns that day, so no job counts twice.
    """
    keep = lambda kept: tables.written(kept, shared_folder(kept.sparkSession))
    rows = schemas.conform(service_fact(up, rules, start, end, keep), schemas.DAILY_FACT)
    return history_table(rows.sparkSession, path).load(rows, start, end)


def history(spark: SparkSession, path: str) -> DataFrame:
    return history_table(spark, path).read()


def month_panel(fact: DataFrame, as_of: date, first_month: date = fv.CALENDAR_START) -> DataFrame:
    """Zero-filled monthly series of the history."""
    return panels.dense_month_panel(
        publish.series_facts(fact), DIMS, "Appointment_Timestamp", ["SWT", "AWT"], first_month, as_of
    )


def load_prediction_input(panel: DataFrame, start: date, end: date, path: str, horizon: int = fv.MONTHLY_HORIZON) -> None:
    rows = panels.prediction_scaffold(panel, DIMS, "SWT", start, end, horizon)
    run = F.lit(f"{start:%Y-%m-%d}_{end:%Y-%m-%d}")
    conformed = schemas.conform(rows, schemas.PREDICTION_INPUT).withColumn("Load_Period", run)
    tables.replace_partitions(conformed, path, ["Load_Period"])


def predicted(panel: DataFrame) -> DataFrame:
    """Forecast of all series of a panel in the shape of the forecast history, without its stamp."""
    rows = monthly_global_forecast(panel, DIMS, "Series_Identifier", "Appointment_Month", "SWT")
    shaped = rows.withColumns({
        "Appointment_Month": F.date_format("Appointment_Month", "yyyy-MM-dd"), "SWT_Type": F.lit("predicted"),
        "predicted_SWT": F.struct(F.col("predicted_SWT").alias("value")),
    })
    return schemas.conform(shaped, schemas.FORECAST).drop("Forecast_Date")


def forecast_version(panel: DataFrame, path: str, stamp: str) -> None:
    """Forecast all series and add the result to the forecast history as version ``stamp``."""
    append_version(predicted(panel), path, stamp)


def forecasts(spark: SparkSession, path: str) -> DataFrame:
    return version_table(spark, path, schemas.FORECAST).read()


def published(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a published table: of its last complete refresh."""
    return VersionedTable(spark, path, schema).read()


def publish_cube(
    fact: DataFrame, versions: DataFrame, lookup: DataFrame, projects: DataFrame, as_of: date, path: str
) -> int:
    planned = publish.special_project_hours(projects, lookup)
    cube = publish.display_cube(fact, versions, lookup, planned, as_of)
    return VersionedTable(fact.sparkSession, path, schemas.DISPLAY).replace(schemas.conform(cube, schemas.DISPLAY))


def publish_volumes(sheet: DataFrame, as_of: date, path: str) -> int:
    rows = schemas.conform(marketing.volume_calendar(sheet, as_of), schemas.VOLUMES)
    return VersionedTable(sheet.sparkSession, path, schemas.VOLUMES).replace(rows)


def publish_product_names(spark: SparkSession, path: str, names: Mapping[str, str] = fv.PRODUCT_NAMES) -> int:
    rows = spark.createDataFrame(list(names.items()), schemas.PRODUCT_NAMES).coalesce(1)
    return VersionedTable(spark, path, schemas.PRODUCT_NAMES).replace(rows)


def publish_corrections(fact: DataFrame, versions: DataFrame, volumes: DataFrame, path: str) -> None:
    """Tune on the sixth newest version, correct the newest. Fewer versions are an error.

    The monthly hours per product are read several times, so they are stored first.
    """
    hours = tables.written(marketing.product_hours(fact, versions), shared_folder(fact.sparkSession))
    newest = nth_latest_version(hours, "Forecast_Date", 0).scalar()
    tuning = nth_latest_version(hours, "Forecast_Date", fv.TUNING_VERSIONS_BACK).scalar()
    if nth_latest_version(hours, "Forecast_Date", fv.TUNING_VERSIONS_BACK).isEmpty():
        raise ValueError(f"corrections are tuned on the forecast {fv.TUNING_VERSIONS_BACK} versions before the newest; there are fewer")
    rows = schemas.conform(corrections(hours, volumes, tuning, newest), schemas.CORRECTIONS)
    VersionedTable(fact.sparkSession, path, schemas.CORRECTIONS).put(rows, str(fact.sparkSession.range(1).select(newest).first()[0]))


def panel_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, schemas.PANEL)


def refresh_month(
    spark: SparkSession, fact: Callable[[], DataFrame], period: tuple[date, date], lookup: DataFrame, projects: DataFrame, as_of: date,
    stamp: str, folder: str, name: str, first_month: date = fv.CALENDAR_START, before: Mapping[str, Callable[[], None]] | None = None,
    made: list | None = None
) -> None:
    """The whole monthly job below ``folder``: load the period, panel, forecast version, display cube.

    Run it again under the same name after a lost driver: steps that were committed are read, the others computed.
    ``before`` are calls made ahead of a step that is computed; ``made`` receives (step, whether it was computed).
    """
    run = Run(spark, name, before or {}, made if made is not None else [])
    loaded = run.step("load", history_table(spark, f"{folder}/history"), lambda: schemas.conform(fact(), schemas.DAILY_FACT), period=period)
    panel = run.step("panel", panel_table(spark, f"{folder}/panel"), lambda: month_panel(loaded, as_of, first_month), {"as_of": as_of})
    versions = version_table(spark, f"{folder}/forecast", schemas.FORECAST)
    forecast = run.step("forecast", versions, lambda: schemas.conform(stamped(predicted(panel), stamp), schemas.FORECAST), {"as_of": as_of}, slot=stamp)
    planned = publish.special_project_hours(projects, lookup)
    run.step("cube", VersionedTable(spark, f"{folder}/cube", schemas.DISPLAY), lambda: schemas.conform(
        publish.display_cube(loaded, forecast, lookup, planned, as_of, first_month), schemas.DISPLAY), {"stamp": stamp, "as_of": as_of})


def register_views(fact: DataFrame, versions: DataFrame, rules: DataFrame, lookup: DataFrame, as_of: date) -> None:
    """Named relations over the stored tables for SQL users."""
    panel = month_panel(fact, as_of)
    display = publish.display_union(panel, versions, as_of)
    panel.createOrReplaceTempView("monthly_history")
    display.createOrReplaceTempView("display")
    publish.export_rows(display).createOrReplaceTempView("export")
    efficiency.efficiency_report(rules).createOrReplaceTempView("efficiencies")
    efficiency.efficiency_reductions(rules, lookup, versions).createOrReplaceTempView("efficiency_reductions")
