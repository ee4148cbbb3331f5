"""Published tables: history next to forecasts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from crewcast import fixed_values as fv
from crewcast.functions import add_month_steps, month_of, month_sequence, recode, series_identifier
from crewcast.operators.joins import interval_join, with_each
from crewcast.operators.latest import latest_version_flag
from crewcast.operators.reshape import unpivot_months

DIMS = list(fv.SERIES_DIMS)


def series_facts(fact: DataFrame, dropped_groups: Sequence[str] = fv.SERIES_EXCLUDED_ACTION_GROUPS) -> DataFrame:
    """Fact rows that form series. A null group, work force or product group is dropped too."""
    return fact.filter(
        ~F.col("Work_Order_Action_Grp").isin(*dropped_groups)
        & ~F.col("Work_Force").isin(*fv.DROPPED_WORK_FORCES)
        & ~F.col("Product_Grp").isin(fv.OTHER)
    )


def settled_months(
    panel: DataFrame, as_of: date, settle_days: int = fv.SETTLE_DAYS, first_month: date = fv.CALENDAR_START
) -> DataFrame:
    """Months that closed long enough ago for late bookings to be in."""
    return panel.filter(
        (F.col("Appointment_Month") >= F.lit(first_month))
        & (F.col("Appointment_Month") < month_of(F.date_sub(F.lit(as_of), settle_days)))
    )


def display_union(
    panel: DataFrame,
    forecasts: DataFrame,
    as_of: date,
    tiers: Mapping[str, str] = fv.DISTRICT_TIERS,
    settle_days: int = fv.SETTLE_DAYS,
    first_month: date = fv.CALENDAR_START,
) -> DataFrame:
    """Settled actuals and all predictions in one relation, with tier and newest-version flag."""

    def shaped(rows: DataFrame, month: Column, columns: dict[str, Column]) -> DataFrame:
        return rows.select(
            series_identifier(DIMS).alias("Series_Identifier"), month.alias("Appointment_Month"),
            F.year(month).alias("Year"), F.month(month).alias("Month"), *DIMS,
            recode(F.col("District"), tiers).alias("Region_Type"), *[c.alias(n) for n, c in columns.items()],
        )

    none = F.lit(None).cast("double")
    actual = F.col("SWT").cast("double")
    past = shaped(settled_months(panel, as_of, settle_days, first_month), F.col("Appointment_Month"), {
        "SWT": actual, "Forecast_Date": F.lit("Actual"), "SWT_Type": F.lit("Actual"), "SWT_Actual": actual,
        "AWT": F.col("AWT").cast("double"), "SWT_Predicted": none, "Is_Latest_Forecast": F.lit(False),
    })
    predicted = F.col("predicted_SWT.value")
    ahead = shaped(forecasts, F.col("Appointment_Month").cast("date"), {
        "SWT": predicted, "Forecast_Date": F.col("Forecast_Date").cast("string"), "SWT_Type": F.lit("Predicted"),
        "SWT_Actual": none, "AWT": none, "SWT_Predicted": predicted,
        "Is_Latest_Forecast": latest_version_flag(forecasts, "Forecast_Date"),
    })
    return past.unionByName(ahead)


def export_rows(display: DataFrame) -> DataFrame:
    """The display relation under report names, newest month first."""
    return display.select(
        "Series_Identifier", "Appointment_Month", "Year", "Month", F.col("Region_Type").alias("Region Type"),
        "District", "Product", F.col("Work_Order_Action").alias("Job Type"), F.col("Work_Force").alias("Workforce"),
        "Technology", "SWT", "SWT_Type",
    ).orderBy(F.col("Appointment_Month").desc(), "Series_Identifier")


def district_regions(lookup: DataFrame) -> DataFrame:
    """Distinct (district, province, region_type) of the district lookup."""
    return lookup.select(F.col("district_old").alias("_district"), "province", "region_type").distinct()


def _with_region(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    side = district_regions(lookup).select("_district", F.col("region_type").alias("Region_Type"))
    return rows.join(side, F.col("District") == F.col("_district"), "left").drop("_district")


def cube_dimensions(fact: DataFrame, lookup: DataFrame) -> DataFrame:
    """Distinct dimension rows of the cube."""
    wide = F.col("Product_Grp")
    managed = F.when(wide.like("%Unmanaged%"), "Unmanaged").when(wide.like("%Managed%"), "Managed").otherwise(fv.OTHER)
    rows = series_facts(fact, fv.CUBE_EXCLUDED_ACTION_GROUPS).select(
        *DIMS, "Work_Order_Action_Grp", managed.alias("Product_Grp")
    ).distinct()
    return _with_region(rows, lookup).distinct()


def special_project_hours(wide: DataFrame, lookup: DataFrame, keep_null_notes: bool = False) -> DataFrame:
    """Monthly hours of planned projects, with tier and class."""
    free = ~F.col("Notes").like(fv.PROJECT_EXCLUDING_NOTES)
    kept = wide.filter(free | F.col("Notes").isNull() if keep_null_notes else free)
    long = unpivot_months(kept, ["Product", "Region", "Job_Type"], "Appointment_Month", "_hours")
    sums = long.groupBy(
        "Product", F.col("Region").alias("District"), F.upper("Job_Type").alias("Work_Order_Action"),
        "Appointment_Month",
    ).agg(F.sum("_hours").alias("SWT_Project"))
    label = (
        F.when(F.col("Product").isin(*fv.PROJECT_MANAGED_PRODUCTS), "Managed")
        .when(F.col("Product").isin(*fv.PROJECT_UNMANAGED_PRODUCTS), "Unmanaged")
        .otherwise("Other")
    )
    return _with_region(sums, lookup).withColumns({
        "Product_Grp": label, "Technology": F.lit("N/A"), "Work_Order_Action_Grp": F.lit("PROJECT"),
        "Work_Force": F.lit("N/A"),
    })


def projects_by_version(
    projects: DataFrame,
    versions: DataFrame,
    horizon: int = fv.MONTHLY_HORIZON,
    first_month: date = fv.CALENDAR_START,
) -> DataFrame:
    """Project months with hours, once per version whose window holds their first day.

    The window runs from a month before the version's day, but not before ``first_month``, to ``horizon - 1`` months after it.
    """
    day = F.col("Forecast_Date").cast("date")
    spans = versions.select("Forecast_Date", F.greatest(F.lit(first_month), F.add_months(day, -1)).alias("_from"),
                            F.add_months(day, horizon - 1).alias("_until"))
    planned = projects.filter((F.col("SWT_Project") > 0) & F.col("Appointment_Month").isNotNull())
    return interval_join(planned, spans, ("Appointment_Month", "Appointment_Month"), ("_from", "_until"), 366).drop("_from", "_until")


CUBE_COLUMNS = [
    "Forecast_Date", "Appointment_Month", "District", "Region_Type", "Product", "Product_Grp", "Technology",
    "Work_Order_Action", "Work_Order_Action_Grp", "Work_Force", "AWT_Historical", "SWT_Historical", "SWT_Predicted",
]


def display_cube(
    fact: DataFrame,
    forecasts: DataFrame,
    lookup: DataFrame,
    projects: DataFrame,
    as_of: date,
    first_month: date = fv.CALENDAR_START,
    horizon: int = fv.MONTHLY_HORIZON,
) -> DataFrame:
    """Every dimension row for every version and month, with history and forecast side by side.

    Months are attached last: a dimension row brings its history and a version's forecasts as maps
    from month to values, so the joins move dimension rows and not the month grid. A null dimension matches nothing and stays with empty metrics.
    """
    dims = cube_dimensions(fact, lookup)
    sums = (
        fact.withColumn("_month", month_of(F.col("Appointment_Timestamp")))
        .filter(F.col("_month") < month_of(F.lit(as_of)))
        .groupBy(*DIMS, "_month")
        .agg(F.sum("AWT").cast("double").alias("awt"), F.sum("SWT").cast("double").alias("swt"))
    )
    history = sums.dropna(subset=DIMS).groupBy(*DIMS).agg(
        F.map_from_entries(F.collect_list(F.struct("_month", F.struct("awt", "swt")))).alias("_history")
    )
    month = F.col("Appointment_Month").cast("date").alias("_month")
    predicted = (
        forecasts.dropna(subset=DIMS)
        .groupBy("Forecast_Date", *DIMS, month).agg(F.collect_list("predicted_SWT").alias("_rows"))
        .groupBy("Forecast_Date", *DIMS)
        .agg(F.map_from_entries(F.collect_list(F.struct("_month", "_rows"))).alias("_forecast"))
    )
    versions = forecasts.select("Forecast_Date").distinct()
    rows = with_each(dims.join(history, DIMS, "left"), versions).join(predicted, ["Forecast_Date", *DIMS], "left")
    day = F.col("Forecast_Date").cast("date")
    last = add_month_steps(month_of(day), horizon - 1)
    cells = F.transform(month_sequence(F.lit(first_month), last), lambda m: F.struct(
        m.alias("Appointment_Month"), F.try_element_at("_history", m).alias("_past"),
        F.try_element_at("_forecast", m).alias("_ahead"),
    ))
    # The maps are read before the months are exploded, so the many month rows do not carry them.
    months = rows.select("Forecast_Date", *dims.columns, F.inline(cells))
    grid = months.select("*", F.explode_outer("_ahead").alias("_hit")).select(
        day.alias("Forecast_Date"), *CUBE_COLUMNS[1:10],
        F.col("_past.awt").alias("AWT_Historical"), F.col("_past.swt").alias("SWT_Historical"),
        F.col("_hit.value").cast("double").alias("SWT_Predicted"),
    )
    planned = projects_by_version(projects, versions, horizon, first_month).select(
        day.alias("Forecast_Date"), *CUBE_COLUMNS[1:10], F.lit(None).cast("double").alias("AWT_Historical"),
        F.lit(None).cast("double").alias("SWT_Historical"), F.col("SWT_Project").cast("double").alias("SWT_Predicted"),
    )
    return grid.unionByName(planned)
