"""Monthly panels and prediction input."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from crewcast.catalog.base import Tables, doubles, money, query
from crewcast.catalog.inputs import (
    AS_OF, DIMS, FIRST_MONTH, FORECAST_SQL, ORDER_FACTS_SQL, PANEL_SQL, forecast_history, month_facts,
    order_facts,
)
from crewcast.functions import month_of, series_identifier
from crewcast.operators.direct import fit_direct
from crewcast.operators.forecast import monthly_global_forecast
from crewcast.operators.latest import latest_version_flag, nth_latest_version
from crewcast.operators.panel import dense_month_panel, period_sums, prediction_scaffold
from crewcast.operators.publish import series_facts

HELD_OUT = date(2000, 1, 1)


def panel(t: Tables, fact: DataFrame | None = None) -> DataFrame:
    return dense_month_panel(
        series_facts(order_facts(t) if fact is None else fact), DIMS, "Appointment_Timestamp", ["SWT", "AWT"], FIRST_MONTH, AS_OF
    )


@query("dense_month_panel", f"""
WITH {ORDER_FACTS_SQL}, {PANEL_SQL}
SELECT Appointment_Month, Series_Identifier, District, Product, Technology, Work_Order_Action, Work_Force,
  CAST(SWT AS DOUBLE) AS SWT, CAST(AWT AS DOUBLE) AS AWT FROM panel""")
def month_panel(t: Tables) -> DataFrame:
    return panel(t).select("Appointment_Month", "Series_Identifier", *DIMS, *doubles("SWT", "AWT"))


@query("series_identifier", f"""
WITH {ORDER_FACTS_SQL}
SELECT concat_ws(' ', coalesce(District, 'None'), coalesce(Product, 'None'), coalesce(Technology, 'None'),
  coalesce(Work_Order_Action, 'None'), coalesce(Work_Force, 'None')) AS Series_Identifier, CAST(COUNT(*) AS BIGINT) AS n
FROM fact GROUP BY 1""")
def identifiers(t: Tables) -> DataFrame:
    return order_facts(t).groupBy(series_identifier(DIMS).alias("Series_Identifier")).agg(F.count(F.lit(1)).alias("n"))


@query("month_bucket_sum", f"""
WITH {ORDER_FACTS_SQL}
SELECT CAST(date_trunc('month', Appointment_Timestamp) AS DATE) AS month, Product,
  CAST(SUM(SWT) AS DOUBLE) AS SWT, CAST(SUM(AWT) AS DOUBLE) AS AWT FROM fact GROUP BY ALL""")
def month_sums(t: Tables) -> DataFrame:
    sums = period_sums(order_facts(t), ["Product"], month_of(F.col("Appointment_Timestamp")), "month", ["SWT", "AWT"])
    return sums.select("month", "Product", *doubles("SWT", "AWT"))


@query("prediction_scaffold", f"""
WITH {ORDER_FACTS_SQL}, {PANEL_SQL},
complete AS (SELECT DISTINCT District, Product, Technology, Work_Order_Action, Work_Force FROM panel
  WHERE District IS NOT NULL AND Product IS NOT NULL AND Technology IS NOT NULL AND Work_Order_Action IS NOT NULL
    AND Work_Force IS NOT NULL),
both_parts AS (
  SELECT CAST(DATE '2001-05-01' + to_months(CAST(i AS INTEGER)) AS DATE) AS Appointment_Month, c.*,
    CAST(NULL AS DOUBLE) AS SWT, 'predicted' AS SWT_Type
  FROM complete c, (SELECT unnest(generate_series(0, 17)) AS i)
  UNION ALL
  SELECT p.Appointment_Month, p.District, p.Product, p.Technology, p.Work_Order_Action, p.Work_Force,
    CAST(p.SWT AS DOUBLE), 'actual'
  FROM panel p JOIN complete c USING (District, Product, Technology, Work_Order_Action, Work_Force)
  WHERE p.Appointment_Month >= DATE '1999-02-01' AND p.Appointment_Month < DATE '2001-05-01')
SELECT concat_ws(' ', District, Product, Technology, Work_Order_Action, Work_Force) AS Series_Identifier, * FROM both_parts""")
def scaffold(t: Tables) -> DataFrame:
    rows = prediction_scaffold(panel(t), DIMS, "SWT", date(1999, 2, 10), date(2001, 5, 20), 18)
    return rows.select("Series_Identifier", "Appointment_Month", *DIMS, *doubles("SWT"), "SWT_Type")


@query("latest_version_flag", f"""
WITH {ORDER_FACTS_SQL}, {FORECAST_SQL}
SELECT Forecast_Date, Forecast_Date = first_value(Forecast_Date) OVER (ORDER BY Forecast_Date DESC) AS Is_Latest_Forecast,
  CAST(COUNT(*) AS BIGINT) AS n FROM forecast GROUP BY Forecast_Date""")
def newest_flag(t: Tables) -> DataFrame:
    rows = forecast_history(month_facts(t))
    flagged = rows.withColumn("Is_Latest_Forecast", latest_version_flag(rows, "Forecast_Date"))
    return flagged.groupBy("Forecast_Date", "Is_Latest_Forecast").agg(F.count(F.lit(1)).alias("n"))


@query("nth_latest_version", f"""
WITH {ORDER_FACTS_SQL}, {FORECAST_SQL}
SELECT f.Forecast_Date, f.Product, round(SUM(f.predicted_SWT.value), 4) AS SWT
FROM forecast f
WHERE f.Forecast_Date = (SELECT DISTINCT Forecast_Date FROM forecast ORDER BY Forecast_Date DESC LIMIT 1 OFFSET 5)
GROUP BY ALL""")
def sixth_newest(t: Tables) -> DataFrame:
    rows = forecast_history(month_facts(t))
    version = nth_latest_version(rows, "Forecast_Date", 5)
    return rows.join(version, "Forecast_Date").groupBy("Forecast_Date", "Product").agg(
        F.round(F.sum("predicted_SWT.value"), 4).alias("SWT")
    )


@query("direct_monthly_scores")
def direct_scores(t: Tables) -> DataFrame:
    """Share of error per month ahead, on the last 18 months held out: boosted trees over all steps next to the recursive line."""
    keys = ["District", "Product"]
    months = t.stored(dense_month_panel(series_facts(order_facts(t)), keys, "Appointment_Timestamp", ["SWT"], FIRST_MONTH, AS_OF))
    begin = F.lit(HELD_OUT)
    known, truth = months.filter(F.col("Appointment_Month") < begin), months.filter(F.col("Appointment_Month") >= begin)
    named = ("Series_Identifier", "Appointment_Month", "SWT")
    model = fit_direct(known, keys, *named)
    direct = model.forecast(known, *named).select(*named[:2], F.col("predicted_SWT").alias("direct"))
    line = monthly_global_forecast(known.withColumn("SWT", money("SWT")), keys, *named).select(*named[:2], F.col("predicted_SWT").alias("linear"))
    both = truth.join(direct, list(named[:2])).join(line, list(named[:2]))
    step = F.months_between("Appointment_Month", begin).cast("int") + 1
    share = lambda c: F.round(F.sum(F.abs(F.col(c) - F.col("SWT").cast("double"))) / F.sum("SWT").cast("double"), 4).alias(f"WAPE_{c}")
    return both.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), share("direct"), share("linear"))
