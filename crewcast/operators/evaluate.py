"""Scoring of forecasts against held-out rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from crewcast.fixed_values import SCORED_TIERS, WAPE_EPSILON
from crewcast.functions import first_match
from crewcast.operators.forecast import GROUP


def tier_in(identifier: Column, tiers: Sequence[str] = SCORED_TIERS) -> Column:
    """The first tier whose name occurs in the identifier, else ``Unknown``."""
    return first_match([(identifier.contains(t), t) for t in tiers], "Unknown")


def align_by_date(test: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Actual and forecast of the same series, fold and day."""
    return test.select(*GROUP, "ds", "y").join(forecasts.select(*GROUP, "ds", "yhat"), [*GROUP, "ds"])


def align_by_position(test: DataFrame, forecasts: DataFrame) -> DataFrame:
    """The n-th test row inside the forecast's dates against the n-th step.

    A missing test day moves all later pairs, as in scoring two arrays by position.
    """
    inside = test.select(*GROUP, "ds", "y").join(forecasts.select(*GROUP, "ds"), [*GROUP, "ds"], "left_semi")
    order = Window.partitionBy(*GROUP).orderBy("ds")
    numbered = inside.withColumn("step", F.row_number().over(order))
    return numbered.join(forecasts.select(*GROUP, "step", "yhat"), [*GROUP, "step"]).select(*GROUP, "ds", "y", "yhat")


def forecast_metrics(pairs: DataFrame, tier: Column) -> DataFrame:
    """MAE, WAPE, RMSE and bias per tier and overall, over all pairs in one pass.

    Pairs of an unknown tier count in the overall row only.
    """
    error = F.col("yhat") - F.col("y")
    scored = pairs.select(tier.alias("tier"), F.abs("y").alias("size"), error.alias("e"))
    metrics = scored.groupingSets([["tier"], []], "tier").agg(
        F.avg(F.abs("e")).alias("MAE"),
        (F.sum(F.abs("e")) / (F.sum("size") + F.lit(WAPE_EPSILON))).alias("WAPE"),
        F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("RMSE"),
        F.avg("e").alias("Bias"),
        F.count("e").alias("pairs"),
    )
    named = metrics.withColumn("scope", F.coalesce("tier", F.lit("Overall"))).drop("tier")
    return named.filter((F.col("scope") != "Unknown") & (F.col("pairs") > 0)).select(
        "scope", "MAE", "WAPE", "RMSE", "Bias"
    )
