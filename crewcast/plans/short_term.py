"""Daily back-test: ingest, folds, profile, forecasts, scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from crewcast import fixed_values as fv
from crewcast.operators import evaluate, folds, forecast, profile
from crewcast.operators.panel import daily_series, fill_periods
from crewcast.functions import recode
from crewcast.operators.publish import series_facts
from crewcast.operators.seasonal import seasonal_order_forecast
from crewcast.sources import tables


@dataclass(frozen=True)
class BackTest:
    train_start: date = fv.CALENDAR_START
    first_train_end: date = fv.FIRST_TRAIN_END
    horizon: int = fv.DAILY_HORIZON
    fold_count: int = fv.FOLD_COUNT
    window: int = fv.MOVING_AVERAGE_WINDOW
    cutoff: date = fv.DAILY_CUTOFF
    attributes: Sequence[str] = fv.DAILY_ATTRIBUTES
    day: str = "Appointment_Day"
    target: str = "SWT"

    @property
    def folds(self) -> list[folds.Fold]:
        return folds.expanding_folds(self.train_start, self.first_train_end, self.horizon, self.fold_count)


def daily_source(fact: DataFrame, dense: bool = False) -> DataFrame:
    """Daily hours per attribute combination, with each district's tier; optionally without gaps."""
    rows = series_facts(fact).withColumn("Region_Type", recode(F.col("District"), fv.DISTRICT_TIERS)).withColumn(
        "Appointment_Day", F.col("Appointment_Timestamp")
    )
    keys = list(fv.DAILY_ATTRIBUTES)
    sums = rows.groupBy(*keys, "Appointment_Day").agg(F.sum("SWT").cast("double").alias("SWT"))
    if not dense:
        return sums
    return fill_periods(sums, keys, "Appointment_Day", ["SWT"], F.sequence("first_period", "last_period"))


def tidy(rows: DataFrame, identifier: str, day: str, target: str) -> DataFrame:
    """Columns as the forecasts expect them."""
    return rows.select(
        F.col(identifier).alias("series_id"), "split_index", F.col(day).alias("ds"), F.col(target).alias("y")
    )


def run(source: DataFrame, folder: str, test: BackTest = BackTest()) -> dict[str, DataFrame]:
    """The whole back-test. Series, forecasts and scores are stored; the rest stays lazy."""
    series = tables.written(
        daily_series(source, test.attributes, test.day, test.target, test.cutoff), f"{folder}/series"
    )
    train = folds.train_rows(series, test.day, test.folds)
    held_out = folds.held_out_rows(series, test.day, test.folds)
    known = tidy(train, "Series_Identifier", test.day, test.target)
    actual = tidy(held_out, "Series_Identifier", test.day, test.target)
    averages = forecast.moving_average_forecast(known, test.window, test.horizon)
    seasonal = forecast.seasonal_regression_forecast(known, test.horizon).select(*averages.columns)
    searched = seasonal_order_forecast(known, test.horizon).select(*averages.columns)
    predicted = tables.written(averages.unionByName(seasonal).unionByName(searched), f"{folder}/forecasts")
    both = folds.labelled_rows(series, test.day, test.folds)
    scores = []
    for model in ("SMA", "SEASONAL_AR", "SEASONAL_ORDER"):
        pairs = evaluate.align_by_date(actual, predicted.filter(F.col("model") == model))
        metrics = evaluate.forecast_metrics(pairs, evaluate.tier_in(F.col("series_id")))
        scores.append(metrics.select(F.lit(model).alias("model"), "*"))
    return {
        "series": series,
        "forecasts": predicted,
        "metrics": tables.written(reduce(DataFrame.unionByName, scores), f"{folder}/metrics"),
        "numeric_profile": profile.numeric_profile(both, test.day, test.target),
        "category_profile": profile.category_profile(both, test.attributes),
        "null_counts": profile.null_counts(both, [test.day, test.target, *test.attributes]),
        "split_counts": profile.split_counts(both),
        "weekly": profile.weekly_sums(profile.last_year(train, test.day), test.day, test.target, ["split_index"]),
    }
