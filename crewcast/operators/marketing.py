"""Unit volumes: calendar of past, forecasted and adjusted values per product."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from crewcast.fixed_values import CORRECTED_ACTION, VOLUME_TYPE
from crewcast.functions import month_of
from crewcast.operators.joins import with_each
from crewcast.operators.panel import previous_or


def volume_calendar(sheet: DataFrame, as_of: date, volume_type: str = VOLUME_TYPE) -> DataFrame:
    """Every month of the sheet for every product of the sheet.

    Up to the current month the past volume is the previous listed month's adjusted value; from the
    current month on the forecasted and adjusted values are the sheet's own; everything else is 0.
    """
    months = sheet.select("Year", "Month").distinct()
    grid = with_each(sheet.select("Product").distinct(), months)
    listed = sheet.filter(F.col("RGU_Type") == volume_type).select(
        "Year", "Month", "Product", "Original_Actual", "Adjusted_Actual"
    )
    rows = grid.join(listed, ["Year", "Month", "Product"], "left").withColumn(
        "Appointment_Month", F.make_date(F.col("Year").cast("int"), F.col("Month").cast("int"), F.lit(1))
    )
    now = month_of(F.lit(as_of))
    zero = F.lit(0)
    previous = previous_or("Adjusted_Actual", ["Product"], ["Appointment_Month", "Adjusted_Actual"], 0)
    past, ahead = F.col("Appointment_Month") <= now, F.col("Appointment_Month") >= now
    return rows.select(
        "Appointment_Month", "Product",
        F.when(past, previous).otherwise(zero).cast("bigint").alias("Actual_RGU"),
        F.when(ahead, F.coalesce("Original_Actual", zero)).otherwise(zero).cast("bigint").alias("Forecasted_RGU"),
        F.when(ahead, F.coalesce("Adjusted_Actual", zero)).otherwise(zero).cast("bigint").alias("Adjusted_RGU"),
    )


def product_hours(fact: DataFrame, forecasts: DataFrame, action: str = CORRECTED_ACTION) -> DataFrame:
    """Monthly hours per product of one action: actual, and predicted per version."""
    actual = (
        fact.filter(F.col("Work_Order_Action") == action)
        .groupBy(month_of(F.col("Appointment_Timestamp")).alias("Appointment_Month"), "Product")
        .agg(F.sum("SWT").cast("double").alias("SWT"))
        .select("Appointment_Month", F.lit(None).cast("string").alias("Forecast_Date"), "Product", "SWT",
                F.lit("Actual").alias("SWT_Type"))
    )
    predicted = (
        forecasts.filter(F.col("Work_Order_Action") == action)
        .groupBy(F.col("Appointment_Month").cast("date").alias("Appointment_Month"), "Product",
                 F.col("Forecast_Date").cast("string").alias("Forecast_Date"))
        .agg(F.sum("predicted_SWT.value").cast("double").alias("SWT"))
        .select("Appointment_Month", "Forecast_Date", "Product", "SWT", F.lit("Predicted").alias("SWT_Type"))
    )
    return actual.unionByName(predicted)
