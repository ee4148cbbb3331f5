"""Unit volumes and the correction of forecasts by them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from crewcast.catalog.base import Tables, query, rounded
from crewcast.catalog.inputs import (
    FORECAST_SQL, ORDER_FACTS_SQL, SEGMENT_PRODUCTS, VERSION_STAMPS, forecast_history, month_facts,
)
from crewcast.functions import recode
from crewcast.operators import correction
from crewcast.operators.latest import nth_latest_version
from crewcast.operators.marketing import product_hours, volume_calendar

VOLUMES_AS_OF = date(2000, 7, 20)
LAGS, ALPHA = (1, 2), 0.3
TUNING, NEWEST = VERSION_STAMPS[-6], VERSION_STAMPS[-1]


def volume_sheet(t: Tables) -> DataFrame:
    """Order counts per month, product and type."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.year("o_orderdate").cast("bigint").alias("Year"), F.month("o_orderdate").cast("bigint").alias("Month"),
        recode(F.col("c_mktsegment"), SEGMENT_PRODUCTS).alias("Product"),
        F.when(F.col("o_orderstatus") == "F", "Gross Adds").otherwise("Net Adds").alias("RGU_Type"),
        (F.col("o_custkey") % 3).alias("_more"),
    )
    return rows.groupBy("Year", "Month", "Product", "RGU_Type").agg(
        F.count(F.lit(1)).alias("Original_Actual"), (F.count(F.lit(1)) + F.sum("_more")).alias("Adjusted_Actual")
    )


def volumes(t: Tables) -> DataFrame:
    return volume_calendar(volume_sheet(t), VOLUMES_AS_OF)


def hours(t: Tables) -> DataFrame:
    fact = month_facts(t)
    return product_hours(fact, forecast_history(fact))


VOLUMES_SQL = """
sheet AS (
  SELECT year(o_orderdate) AS Year, month(o_orderdate) AS Month, Product, CASE WHEN o_orderstatus = 'F' THEN 'Gross Adds' ELSE 'Net Adds' END AS RGU_Type,
    CAST(COUNT(*) AS BIGINT) AS Original_Actual, CAST(COUNT(*) + SUM(o_custkey % 3) AS BIGINT) AS Adjusted_Actual
  FROM (SELECT *, CASE c_mktsegment WHEN 'BUILDING' THEN 'HSIA' WHEN 'MACHINERY' THEN 'SD WAN' WHEN 'AUTOMOBILE' THEN 'POTS'
      WHEN 'HOUSEHOLD' THEN 'CPS' ELSE 'MANAGED LAN' END AS Product FROM orders JOIN customer ON o_custkey = c_custkey)
  GROUP BY ALL),
gross AS (SELECT make_date(Year, Month, 1) AS month, Product, Original_Actual AS first_count, Adjusted_Actual AS last_count FROM sheet WHERE RGU_Type = 'Gross Adds'),
grid AS (
  SELECT *, CAST(month <= DATE '2000-07-01' AS BIGINT) AS over, CAST(month >= DATE '2000-07-01' AS BIGINT) AS ahead
  FROM (SELECT DISTINCT make_date(Year, Month, 1) AS month FROM sheet), (SELECT DISTINCT Product FROM sheet)),
volumes AS (
  SELECT month AS Appointment_Month, Product, over * coalesce(lag(last_count) OVER (PARTITION BY Product ORDER BY month), 0) AS Actual_RGU,
    ahead * coalesce(first_count, 0) AS Forecasted_RGU, ahead * coalesce(last_count, 0) AS Adjusted_RGU
  FROM grid LEFT JOIN gross USING (month, Product))"""

HOURS_SQL = """
hours AS (
  SELECT CAST(date_trunc('month', Appointment_Timestamp) AS DATE) AS Appointment_Month, NULL AS Forecast_Date, Product,
    CAST(SUM(SWT) AS DOUBLE) AS SWT, 'Actual' AS SWT_Type FROM fact WHERE Work_Order_Action = 'INSTALL' GROUP BY 1, 3
  UNION ALL
  SELECT CAST(Appointment_Month AS DATE), Forecast_Date, Product, SUM(predicted_SWT.value), 'Predicted' FROM forecast
  WHERE Work_Order_Action = 'INSTALL' GROUP BY 1, 2, 3),
driver AS (
  SELECT Product, Appointment_Month, 'Forecasted' AS variant, CAST(SUM(Actual_RGU + Forecasted_RGU) AS DOUBLE) AS rgu FROM volumes GROUP BY 1, 2
  UNION ALL
  SELECT Product, Appointment_Month, 'Adjusted', CAST(SUM(Actual_RGU + Adjusted_RGU) AS DOUBLE) FROM volumes GROUP BY 1, 2)"""


def errors_sql(name: str, version: str) -> str:
    """Scaled distance of every month of one version, per product, variant and lag."""
    return f"""
{name} AS (
  SELECT *, coalesce(((SWT - min(SWT) OVER p) / sw - (rgu - min(rgu) OVER p) / CASE WHEN max(rgu) OVER p = min(rgu) OVER p THEN 1
      ELSE max(rgu) OVER p - min(rgu) OVER p END) * sw, 0) AS e
  FROM (
    SELECT h.Product, v.variant, v.lag, h.Appointment_Month, h.SWT_Type, h.SWT, d.rgu,
      CASE WHEN max(SWT) OVER q = min(SWT) OVER q THEN 1 ELSE max(SWT) OVER q - min(SWT) OVER q END AS sw
    FROM hours h JOIN (VALUES ('Forecasted', 1), ('Adjusted', 1), ('Forecasted', 2), ('Adjusted', 2)) v(variant, lag)
      ON h.SWT_Type = 'Actual' OR h.Forecast_Date = '{version}'
      LEFT JOIN driver d ON d.Product = h.Product AND d.variant = v.variant
        AND h.Appointment_Month = CAST(d.Appointment_Month + to_months(v.lag) AS DATE)
    WHERE h.Product IN (SELECT Product FROM volumes)
    WINDOW q AS (PARTITION BY h.Product, v.variant, v.lag))
  WINDOW p AS (PARTITION BY Product, variant, lag))"""


BASE_SQL = f"{ORDER_FACTS_SQL.strip()}, {FORECAST_SQL.strip()}, {VOLUMES_SQL.strip()}, {HOURS_SQL.strip()}"
BEST_SQL = f"""{errors_sql('tuning', TUNING).strip()},
pairs AS (
  SELECT a.Product, a.variant, a.lag, a.SWT AS actual, p.SWT AS predicted, p.e FROM tuning a
  JOIN tuning p USING (Product, variant, lag, Appointment_Month) WHERE a.SWT_Type = 'Actual' AND p.SWT_Type = 'Predicted'),
best AS (
  SELECT Product, variant, lag, alpha, rmse FROM (
    SELECT Product, variant, lag, k / 10.0::DOUBLE AS alpha, sqrt(avg(power(predicted - k / 10.0::DOUBLE * e - actual, 2))) AS rmse
    FROM pairs, (SELECT unnest(generate_series(0, 9)) AS k) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY Product, variant ORDER BY round(rmse, 6), lag, alpha) = 1)"""


@query("marketing_calendar", f"WITH {VOLUMES_SQL.strip()} SELECT * FROM volumes")
def calendar(t: Tables) -> DataFrame:
    return volumes(t)


@query("rgu_month_sum", f"WITH {BASE_SQL} SELECT Product, Appointment_Month, variant, rgu AS rgu_values FROM driver")
def driver_months(t: Tables) -> DataFrame:
    return correction.driver_sums(volumes(t))


@query("product_hours", f"WITH {BASE_SQL} SELECT Appointment_Month, Forecast_Date, Product, round(SWT, 4) AS SWT, SWT_Type FROM hours")
def hour_months(t: Tables) -> DataFrame:
    return hours(t).select("Appointment_Month", "Forecast_Date", "Product", rounded("SWT", 4), "SWT_Type")


@query("driver_correction", f"""
WITH {BASE_SQL}, {errors_sql('errors', NEWEST).strip()}
SELECT Product, variant, lag, Appointment_Month, SWT_Type, round(SWT, 4) AS SWT,
  round(CASE WHEN SWT_Type = 'Predicted' THEN SWT - 0.3 * e ELSE SWT END, 4) AS SWT_Corrected FROM errors""")
def corrected(t: Tables) -> DataFrame:
    driver = correction.driver_sums(volumes(t))
    settings = F.array(*[
        F.struct(F.lit(v).alias("variant"), F.lit(k).alias("lag")) for v in correction.VARIANTS for k in LAGS
    ])
    runs = correction.version_rows(hours(t), NEWEST).withColumn("_s", F.explode(settings)).select("*", "_s.variant", "_s.lag")
    errors = correction.scaled_error(runs.drop("_s"), driver)
    rows = correction.corrected_hours(errors, F.lit(ALPHA))
    return rows.select("Product", "variant", "lag", "Appointment_Month", "SWT_Type", rounded("SWT", 4), rounded("SWT_Corrected", 4))


@query("correction_grid_best", f"""
WITH {BASE_SQL}, {BEST_SQL} SELECT Product, variant, lag, alpha, round(rmse, 2) AS rmse FROM best""")
def best(t: Tables) -> DataFrame:
    known = t.stored(hours(t))  # the version pick and the grid read it
    tuning = nth_latest_version(known, "Forecast_Date", 5).scalar()
    rows = correction.best_settings(known, volumes(t), tuning, LAGS)
    return rows.select("Product", "variant", "lag", "alpha", rounded("rmse", 2))


@query("correction_output", f"""
WITH {BASE_SQL}, {BEST_SQL}, {errors_sql('errors', NEWEST).strip()},
moved AS (SELECT e.Product, e.variant, e.Appointment_Month, e.SWT - b.alpha * e.e AS SWT, b.alpha, b.lag
  FROM errors e JOIN best b USING (Product, variant, lag) WHERE e.SWT_Type = 'Predicted' AND e.rgu IS NOT NULL)
SELECT '{NEWEST}' AS Forecast_Date, f.Appointment_Month, f.Product, round(f.SWT, 4) AS SWT_Forecasted_RGU, round(a.SWT, 4) AS SWT_Adjusted_RGU,
  f.alpha AS Alpha_Correction_Forecasted, CAST(f.lag AS BIGINT) AS Lag_Correction_Forecasted, b.alpha AS Alpha_Correction_Adjusted,
  CAST(b.lag AS BIGINT) AS Lag_Correction_Adjusted
FROM (SELECT * FROM moved WHERE variant = 'Forecasted') f
  LEFT JOIN (SELECT * FROM moved WHERE variant = 'Adjusted') a USING (Product, Appointment_Month)
  LEFT JOIN (SELECT * FROM best WHERE variant = 'Adjusted') b USING (Product)""")
def output(t: Tables) -> DataFrame:
    known = t.stored(hours(t))
    tuning = nth_latest_version(known, "Forecast_Date", 5).scalar()
    newest = nth_latest_version(known, "Forecast_Date", 0).scalar()
    rows = correction.corrections(known, t.stored(volumes(t)), tuning, newest, LAGS)
    kept = [c for c in rows.columns if not c.startswith("SWT")]
    return rows.select(*kept, rounded("SWT_Forecasted_RGU", 4), rounded("SWT_Adjusted_RGU", 4))
