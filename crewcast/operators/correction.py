"""Correction of forecasts by a lagged external driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from crewcast.fixed_values import CORRECTION_ALPHAS, CORRECTION_LAGS
from crewcast.operators.joins import matching_keys

VARIANTS = ("Forecasted", "Adjusted")
_RUN = ("Product", "variant", "lag")


def driver_sums(volumes: DataFrame) -> DataFrame:
    """Monthly driver per product and variant: past volume plus the forecasted or adjusted one."""
    totals = volumes.groupBy("Product", "Appointment_Month").agg(*[
        F.coalesce(F.sum(F.col("Actual_RGU") + F.col(f"{v}_RGU")), F.lit(0)).cast("double").alias(v)
        for v in VARIANTS
    ])
    return totals.unpivot(["Product", "Appointment_Month"], list(VARIANTS), "variant", "rgu_values")


def version_rows(hours: DataFrame, version: str | Column) -> DataFrame:
    """Actual months together with one version's predicted months."""
    chosen = version if isinstance(version, Column) else F.lit(version)
    return hours.filter((F.col("SWT_Type") == "Actual") | (F.col("Forecast_Date") == chosen)).select(
        "Product", "Appointment_Month", F.col("SWT").cast("double").alias("SWT"), "SWT_Type"
    )


def scaled_error(rows: DataFrame, driver: DataFrame) -> DataFrame:
    """Distance of each month from the driver ``lag`` months earlier, in hours.

    ``rows`` carry (Product, variant, lag). Hours and driver are scaled to 0..1 over all months of
    such a run, actual and predicted; a range of zero scales by 1, and a month without a driver
    value has no distance. A run is one product's months, so its window is short.
    """
    run = Window.partitionBy(*_RUN)
    earlier = driver.withColumnRenamed("Appointment_Month", "_driver_month")
    joined = rows.withColumn("_driver_month", F.add_months("Appointment_Month", -F.col("lag"))).join(
        earlier, ["Product", "variant", "_driver_month"], "left"
    )

    def scale(name: str) -> tuple[Column, Column]:
        low = F.min(name).over(run)
        width = F.max(name).over(run) - low
        return low, F.when(width == 0, F.lit(1.0)).otherwise(width)

    hours_low, hours_width = scale("SWT")
    driver_low, driver_width = scale("rgu_values")
    distance = (F.col("SWT") - hours_low) / hours_width - (F.col("rgu_values") - driver_low) / driver_width
    return joined.withColumn("_error", F.coalesce(distance * hours_width, F.lit(0.0)))


def corrected_hours(rows: DataFrame, alpha: Column) -> DataFrame:
    """Move predicted months towards the driver by the share ``alpha``; actual months stay."""
    moved = F.col("SWT") - alpha * F.col("_error")
    return rows.withColumn("SWT_Corrected", F.when(F.col("SWT_Type") == "Predicted", moved).otherwise(F.col("SWT")))


def best_settings(
    hours: DataFrame,
    volumes: DataFrame,
    tuning_version: str | Column,
    lags: Sequence[int] = CORRECTION_LAGS,
    alphas: Sequence[float] = CORRECTION_ALPHAS,
) -> DataFrame:
    """Lag and alpha with the least RMSE per product and driver variant; the first one on a tie.

    Only months with an actual and a predicted value count. The squared error is a parabola in
    alpha, so three sums per lag give the RMSE of every alpha and the grid is never multiplied out.
    """
    driver = driver_sums(volumes)
    rows = matching_keys(version_rows(hours, tuning_version), driver, ["Product"])
    settings = F.array(*[F.struct(F.lit(v).alias("variant"), F.lit(k).alias("lag")) for v in VARIANTS for k in lags])
    runs = rows.withColumn("_s", F.explode(settings)).select("*", "_s.variant", "_s.lag").drop("_s")
    errors = scaled_error(runs, driver)
    pairs = errors.groupBy(*_RUN, "Appointment_Month").agg(
        F.max(F.when(F.col("SWT_Type") == "Actual", F.col("SWT"))).alias("_actual"),
        F.max(F.when(F.col("SWT_Type") == "Predicted", F.struct("SWT", "_error"))).alias("_p"),
    ).select(*_RUN, (F.col("_p.SWT") - F.col("_actual")).alias("_d"), F.col("_p._error").alias("_e")).filter(
        F.col("_d").isNotNull()
    )
    sums = pairs.groupBy(*_RUN).agg(
        F.avg(F.col("_d") * F.col("_d")).alias("_dd"),
        F.avg(F.col("_d") * F.col("_e")).alias("_de"),
        F.avg(F.col("_e") * F.col("_e")).alias("_ee"),
    )

    def option(position: int, alpha: float) -> Column:
        square = F.col("_dd") - 2.0 * alpha * F.col("_de") + alpha * alpha * F.col("_ee")
        rmse = F.sqrt(F.greatest(square, F.lit(0.0)))
        # Equal errors must not be told apart by rounding noise: alpha 0 is the same for every lag.
        return F.struct(
            F.round(rmse, 6).alias("key"), F.col("lag"), F.lit(position).alias("position"),
            F.lit(float(alpha)).alias("alpha"), rmse.alias("rmse"),
        )

    best = F.array_min(F.array(*[option(i, a) for i, a in enumerate(alphas)]))
    return sums.groupBy("Product", "variant").agg(F.min(best).alias("_b")).select(
        "Product", "variant", F.col("_b.lag").alias("lag"), F.col("_b.alpha").alias("alpha"),
        F.col("_b.rmse").alias("rmse"),
    )


def apply_settings(
    hours: DataFrame, volumes: DataFrame, settings: DataFrame, version: str | Column
) -> DataFrame:
    """Corrected hours of one version, with the settings used, one row per product and month.

    Months count where the Forecasted variant has a driver value; the Adjusted one is added where
    it has one too.
    """
    stamp = version if isinstance(version, Column) else F.lit(version)

    def of(name: str, column: str) -> Column:
        return F.max(F.when(F.col("variant") == name, F.col(column)))

    wide = settings.groupBy("Product").agg(*[
        F.struct(F.lit(v).alias("variant"), of(v, "lag").alias("lag"), of(v, "alpha").alias("alpha")).alias(v)
        for v in VARIANTS
    ])
    runs = version_rows(hours, stamp).join(wide, "Product").withColumn("_s", F.explode(F.array(*VARIANTS)))
    errors = scaled_error(runs.select("*", "_s.*").drop("_s"), driver_sums(volumes))
    moved = corrected_hours(errors, F.col("alpha")).filter(
        (F.col("SWT_Type") == "Predicted") & F.col("rgu_values").isNotNull()
    )
    months = moved.groupBy("Product", "Appointment_Month").agg(
        *[of(v, "SWT_Corrected").alias(f"SWT_{v}_RGU") for v in VARIANTS],
        F.count_if(F.col("variant") == VARIANTS[0]).alias("_listed"),
        *[F.first(v).alias(v) for v in VARIANTS],
    )
    return months.filter(F.col("_listed") > 0).select(
        stamp.alias("Forecast_Date"), "Appointment_Month", "Product", *[f"SWT_{v}_RGU" for v in VARIANTS],
        *[c for v in VARIANTS for c in (
            F.col(f"{v}.alpha").alias(f"Alpha_Correction_{v}"),
            F.col(f"{v}.lag").cast("bigint").alias(f"Lag_Correction_{v}"),
        )],
    )


def corrections(
    hours: DataFrame,
    volumes: DataFrame,
    tuning_version: str | Column,
    version: str | Column,
    lags: Sequence[int] = CORRECTION_LAGS,
    alphas: Sequence[float] = CORRECTION_ALPHAS,
) -> DataFrame:
    """Tune on one version, apply to another."""
    settings = best_settings(hours, volumes, tuning_version, lags, alphas)
    return apply_settings(hours, volumes, settings, version)
