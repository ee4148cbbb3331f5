"""The given tables in the shape of the service-demand data model, as DataFrames and as SQL.

Orders stand for work orders, line items for components and time entries, customers with their
nations for locations, suppliers for workers and parts for products. Nulls, ties and migrated
names, which the tables lack, are made from expressions over their columns.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from crewcast import fixed_values as fv
from crewcast.catalog.base import Tables, money
from crewcast.functions import first_match, month_of, recode
from crewcast.operators.panel import daily_series
from crewcast.operators.publish import series_facts
from crewcast.plans.fact import product_group

FIRST_MONTH, AS_OF = date(1995, 1, 1), date(2001, 7, 15)
PROVINCES = {0: "QC", 1: "AB", 2: "BC", 3: "ON", 4: "MB"}
SEGMENT_PRODUCTS = {
    "BUILDING": "HSIA", "MACHINERY": "SD WAN", "AUTOMOBILE": "POTS", "HOUSEHOLD": "CPS", "FURNITURE": "MANAGED LAN",
}
VERSION_STAMPS = [f"2000-{m:02d}-15 07:43:15" for m in range(1, 8)]
DIMS = list(fv.SERIES_DIMS)


def province_of(key):
    return F.element_at(F.create_map(*[F.lit(x) for kv in PROVINCES.items() for x in kv]), key)


def order_facts(t: Tables) -> DataFrame:
    """Daily fact rows: one per order."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    rank = F.substring("o_orderpriority", 1, 1)
    action = first_match([
        (F.col("o_orderstatus") == "F", "INSTALL"), (F.col("o_orderstatus") == "O", "REPAIR"), (rank == "5", "PROJECT"),
    ], "CHANGE")
    force = F.element_at(F.array(*[F.lit(v) for v in ("LTS", "Activo", "QX", "CNI")]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    shaped = rows.select(
        F.col("o_orderdate").cast("date").alias("Appointment_Timestamp"),
        F.col("n_name").alias("District"),
        province_of(F.col("n_regionkey")).alias("Province"),
        recode(F.col("c_mktsegment"), SEGMENT_PRODUCTS).alias("Product"),
        recode(rank, {"1": "FIBRE", "2": "COPPER", "3": "WIRELESS", "4": "FIBRE"}).alias("Technology"),
        action.alias("Work_Order_Action"),
        force.alias("Work_Force"),
        money("o_totalprice").alias("SWT"),
        money("c_acctbal").alias("AWT"),
    )
    return shaped.withColumns({
        "Work_Order_Action_Grp": recode(F.col("Work_Order_Action"), fv.ACTION_GROUPS, fv.OTHER),
        "Product_Grp": product_group(F.col("Product"), F.col("Province")),
    })


ORDER_FACTS_SQL = """
fact AS (
  SELECT *,
    CASE WHEN Work_Order_Action = 'INSTALL' THEN 'Install' WHEN Work_Order_Action = 'REPAIR' THEN 'Repair'
         WHEN Work_Order_Action = 'PROJECT' THEN 'PROJECT' ELSE 'MAC & Out' END AS Work_Order_Action_Grp,
    CASE WHEN Product = 'HSIA' OR Product = 'POTS' THEN 'Unmanaged'
         WHEN Product = 'SD WAN' THEN 'Managed WAN' WHEN Product = 'MANAGED LAN' THEN 'Managed Legacy'
         WHEN Product = 'CPS' AND Province = 'QC' THEN 'Managed CPS' ELSE 'OTHER' END AS Product_Grp
  FROM (
    SELECT CAST(o_orderdate AS DATE) AS Appointment_Timestamp, n_name AS District,
      CASE n_regionkey WHEN 0 THEN 'QC' WHEN 1 THEN 'AB' WHEN 2 THEN 'BC' WHEN 3 THEN 'ON' WHEN 4 THEN 'MB' END AS Province,
      CASE c_mktsegment WHEN 'BUILDING' THEN 'HSIA' WHEN 'MACHINERY' THEN 'SD WAN' WHEN 'AUTOMOBILE' THEN 'POTS'
        WHEN 'HOUSEHOLD' THEN 'CPS' WHEN 'FURNITURE' THEN 'MANAGED LAN' END AS Product,
      CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'FIBRE' WHEN '2' THEN 'COPPER' WHEN '3' THEN 'WIRELESS'
        WHEN '4' THEN 'FIBRE' END AS Technology,
      CASE WHEN o_orderstatus = 'F' THEN 'INSTALL' WHEN o_orderstatus = 'O' THEN 'REPAIR'
        WHEN substr(o_orderpriority, 1, 1) = '5' THEN 'PROJECT' ELSE 'CHANGE' END AS Work_Order_Action,
      CASE o_orderkey % 4 WHEN 0 THEN 'LTS' WHEN 1 THEN 'Activo' WHEN 2 THEN 'QX' ELSE 'CNI' END AS Work_Force,
      CAST(o_totalprice AS DECIMAL(18,2)) AS SWT, CAST(c_acctbal AS DECIMAL(18,2)) AS AWT
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)),
series_fact AS (
  SELECT * FROM fact
  WHERE Work_Order_Action_Grp NOT IN ('EXCLUDE', 'PROJECT (EXCLUDE)', 'PROJECT', 'OTHER')
    AND Work_Force NOT IN ('QX', 'Go Sales') AND Product_Grp NOT IN ('OTHER'))"""

NAMED_SQL = ", ".join(f"coalesce({d}, 'None')" for d in DIMS)
DIMS_SQL = ", ".join(DIMS)
PANEL_SQL = f"""
keyed AS (SELECT concat_ws(chr(31), {', '.join(f"coalesce({d}, chr(30))" for d in DIMS)}) AS series, date_trunc('month', Appointment_Timestamp)::DATE AS month, *
  FROM series_fact),
panel AS (
  SELECT month AS Appointment_Month, concat_ws(' ', {NAMED_SQL}) AS Series_Identifier, {DIMS_SQL}, coalesce(booked, 0) AS SWT, coalesce(spent, 0) AS AWT
  FROM (SELECT series, {', '.join(f'any_value({d}) AS {d}' for d in DIMS)} FROM keyed GROUP BY series)
    CROSS JOIN (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-06-01', INTERVAL 1 MONTH))::DATE AS month)
    LEFT JOIN (SELECT series, month, SUM(SWT) AS booked, SUM(AWT) AS spent FROM keyed GROUP BY series, month) USING (series, month))"""


def month_facts(t: Tables) -> DataFrame:
    """The facts summed to months and stored: one pass over the orders serves several consumers."""
    keys = [*DIMS, "Province", "Work_Order_Action_Grp", "Product_Grp"]
    month = month_of(F.col("Appointment_Timestamp")).alias("Appointment_Timestamp")
    return t.stored(order_facts(t).groupBy(month, *keys).agg(F.sum("SWT").alias("SWT"), F.sum("AWT").alias("AWT")))


def forecast_history(fact: DataFrame) -> DataFrame:
    """Seven monthly versions of an 18-month forecast, made from the monthly sums of the facts."""
    stamps = F.array(*[
        F.struct(F.lit(s).alias("stamp"), F.lit(90 + 2 * k).alias("share")) for k, s in enumerate(VERSION_STAMPS)
    ])
    sums = series_facts(fact).groupBy(
        month_of(F.col("Appointment_Timestamp")).alias("_month"), *DIMS
    ).agg(F.sum("SWT").alias("_swt"))
    first = month_of(F.col("_v.stamp").cast("date"))
    rows = sums.withColumn("_v", F.explode(stamps)).filter(F.col("_month").between(first, F.add_months(first, 17)))
    value = (F.col("_swt") * F.col("_v.share")).cast("double") / 100
    return rows.select(
        F.col("_v.stamp").alias("Forecast_Date"), F.date_format("_month", "yyyy-MM-dd").alias("Appointment_Month"),
        *DIMS, F.lit("predicted").alias("SWT_Type"), F.struct(value.alias("value")).alias("predicted_SWT"),
    )


FORECAST_SQL = f"""
forecast AS (
  SELECT v.stamp AS Forecast_Date, strftime(m.month, '%Y-%m-%d') AS Appointment_Month, District, Product, Technology,
    Work_Order_Action, Work_Force, 'predicted' AS SWT_Type,
    {{'value': CAST(m.swt * v.share AS DOUBLE) / 100}} AS predicted_SWT
  FROM (SELECT CAST(date_trunc('month', Appointment_Timestamp) AS DATE) AS month, District, Product, Technology,
          Work_Order_Action, Work_Force, SUM(SWT) AS swt FROM series_fact GROUP BY ALL) m,
    (VALUES {', '.join(f"('{s}', {90 + 2 * k})" for k, s in enumerate(VERSION_STAMPS))}) v(stamp, share)
  WHERE m.month BETWEEN date_trunc('month', CAST(v.stamp AS TIMESTAMP))
    AND date_trunc('month', CAST(v.stamp AS TIMESTAMP)) + INTERVAL 17 MONTH)"""


def district_lookup(t: Tables) -> DataFrame:
    """District sheet from the nations, with tiers and partly migrated names."""
    key = F.col("n_nationkey")
    return t.nation.select(
        province_of(F.col("n_regionkey")).alias("province"),
        F.concat(F.lit("FFB - "), "n_name").alias("district"),
        F.col("n_name").alias("district_old"),
        F.concat(F.lit("A"), key.cast("string")).alias("service_area_clli"),
        F.when(key % 3 == 0, "").when(key % 3 == 1, "Y").alias("migration"),
        F.concat(F.lit("Tier "), (key % 3 + 1).cast("string")).alias("region_type"),
    )


DISTRICTS_SQL = """
districts AS (
  SELECT CASE n_regionkey WHEN 0 THEN 'QC' WHEN 1 THEN 'AB' WHEN 2 THEN 'BC' WHEN 3 THEN 'ON' WHEN 4 THEN 'MB' END AS province,
    'FFB - ' || n_name AS district, n_name AS district_old, 'A' || n_nationkey AS service_area_clli,
    CASE n_nationkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'Y' END AS migration,
    'Tier ' || (n_nationkey % 3 + 1) AS region_type
  FROM nation)"""

# --- Daily series of line items
DAILY_ATTRIBUTES = ["Region_Type", "l_returnflag", "l_linestatus"]
DAILY_CUTOFF, TRAIN_START, FIRST_TRAIN_END, HORIZON = date(2001, 9, 30), date(1995, 1, 1), date(2000, 6, 30), 91


def line_hours(t: Tables) -> DataFrame:
    """Line items with the tier of the supplier's nation; a fourth of the nations has no tier."""
    tier = F.element_at(
        F.array(*[F.lit(v) for v in ("Tier 1", "Tier 2", "Tier 3", "Other")]), (F.col("s_nationkey") % 4 + 1).cast("int")
    )
    return t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_shipdate").cast("date").alias("Appointment_Day"), tier.alias("Region_Type"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("l_returnflag"), "l_linestatus",
        money("l_extendedprice").alias("SWT"),
    )


def daily(t: Tables) -> DataFrame:
    return daily_series(line_hours(t), DAILY_ATTRIBUTES, "Appointment_Day", "SWT", DAILY_CUTOFF)


DAILY_SQL = """
daily AS (
  SELECT concat_ws(' ', coalesce(Region_Type, 'None'), coalesce(l_returnflag, 'None'), coalesce(l_linestatus, 'None')) AS Series_Identifier,
    Appointment_Day, Region_Type, l_returnflag, l_linestatus, SWT
  FROM (
    SELECT CAST(l_shipdate AS DATE) AS Appointment_Day,
      CASE s_nationkey % 4 WHEN 0 THEN 'Tier 1' WHEN 1 THEN 'Tier 2' WHEN 2 THEN 'Tier 3' ELSE 'Other' END AS Region_Type,
      nullif(l_returnflag, 'N') AS l_returnflag, l_linestatus, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS SWT
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    WHERE CAST(l_shipdate AS DATE) <= DATE '2001-09-30'
    GROUP BY ALL)),
folds AS (
  SELECT k AS split_index, DATE '1995-01-01' AS train_start,
    CAST(DATE '2000-06-30' + to_days(CAST(91 * (k - 1) AS INTEGER)) AS DATE) AS train_end,
    CAST(DATE '2000-06-30' + to_days(CAST(91 * (k - 1) + 1 AS INTEGER)) AS DATE) AS test_start,
    CAST(DATE '2000-06-30' + to_days(CAST(91 * k AS INTEGER)) AS DATE) AS test_end
  FROM (VALUES (1), (2), (3), (4)) v(k)),
train AS (SELECT d.*, f.split_index FROM daily d JOIN folds f ON d.Appointment_Day BETWEEN f.train_start AND f.train_end),
test AS (SELECT d.*, f.split_index FROM daily d JOIN folds f ON d.Appointment_Day BETWEEN f.test_start AND f.test_end)"""
