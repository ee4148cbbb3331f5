"""Reading and writing: what is read back equals what was written, also after a repeated run."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from crewcast.catalog.base import Tables, money, query
from crewcast.catalog.inputs import (
    AS_OF, DIMS, FIRST_MONTH, FORECAST_SQL, ORDER_FACTS_SQL, PANEL_SQL, SEGMENT_PRODUCTS, VERSION_STAMPS, district_lookup, forecast_history, order_facts,
)
from crewcast.catalog.correction import volume_sheet
from crewcast import fixed_values as fv
from crewcast.catalog.series import panel
from crewcast.functions import month_of, recode
from crewcast.operators.forecast import monthly_global_forecast
from crewcast.plans import monthly
from crewcast.plans.versions import append_version, version_table
from crewcast.sources import schemas, tables
from crewcast.sources.versioned import VersionedTable


@query("versioned_forecast_append", f"""
WITH {ORDER_FACTS_SQL.strip()}, {FORECAST_SQL.strip()}
SELECT Forecast_Date, Product, CAST(COUNT(*) AS BIGINT) AS n, round(SUM(predicted_SWT.value), 4) AS SWT
FROM forecast GROUP BY ALL""")
def append(t: Tables) -> DataFrame:
    """Every version is stamped and added; a second run of the last one changes nothing."""
    path = t.new_folder()
    versions = t.stored(forecast_history(order_facts(t)))
    for stamp in [*VERSION_STAMPS, VERSION_STAMPS[-1]]:
        append_version(versions.filter(F.col("Forecast_Date") == stamp).drop("Forecast_Date"), path, stamp)
    history = version_table(t.spark, path, "Forecast_Date string, Product string, predicted_SWT struct<value: double>").read()
    return history.groupBy("Forecast_Date", "Product").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("predicted_SWT.value"), 4).alias("SWT")
    )


@query("product_mapping", """
SELECT p_type, CASE p_type WHEN 'ECONOMY' THEN 'Business Connect' WHEN 'SMALL' THEN 'Wi-Fi (Meraki)' WHEN 'STANDARD' THEN 'SD-WAN (MPasS)' END AS unit_name,
  CAST(COUNT(*) AS BIGINT) AS n FROM part GROUP BY ALL""")
def mapping(t: Tables) -> DataFrame:
    """The name mapping is refreshed twice; readers follow its newest commit."""
    table = VersionedTable(t.spark, t.new_folder(), schemas.PRODUCT_NAMES)
    for names in ({"HSIA": "old name"}, fv.PRODUCT_NAMES):
        table.replace(t.spark.createDataFrame(list(names.items()), schemas.PRODUCT_NAMES))
    stored = table.read()
    product = recode(F.col("p_type"), {"ECONOMY": "BUSINESS CONNECT", "SMALL": "SDS WIFI", "STANDARD": "MPAAS"})
    counts = t.part.groupBy("p_type", product.alias("product")).agg(F.count(F.lit(1)).alias("n"))
    named = counts.join(stored, F.col("product") == F.col("work_order_product_name"), "left")
    return named.select("p_type", F.col("RGU_product_name").alias("unit_name"), "n")


@query("append_persist", """
SELECT o_orderstatus, CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM orders GROUP BY 1""")
def append_parts(t: Tables) -> DataFrame:
    """The orders arrive in two appends."""
    path = t.new_folder()
    rows = t.orders.select("o_orderkey", "o_orderstatus", money("o_totalprice").alias("amount"))
    tables.append(rows.filter(F.col("o_orderstatus") == "F"), path)
    tables.append(rows.filter(F.col("o_orderstatus") != "F"), path)
    stored = tables.read_parquet(t.spark, path, "o_orderkey bigint, o_orderstatus string, amount decimal(18,2)")
    return stored.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").cast("double").alias("amount")
    )


@query("period_reload", f"""
WITH {ORDER_FACTS_SQL.strip()}
SELECT CAST(year(Appointment_Timestamp) AS INTEGER) AS period, CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(SWT) AS DOUBLE) AS SWT FROM fact GROUP BY 1""")
def reload(t: Tables) -> DataFrame:
    """The facts are loaded by year, then everything is loaded once more: nothing counts twice."""
    path = t.new_folder()
    fact = order_facts(t).select(F.year("Appointment_Timestamp").alias("period"), "Appointment_Timestamp", "SWT")
    tables.replace_partitions(fact.filter(F.col("period") < 1999), path, ["period"])
    tables.replace_partitions(fact, path, ["period"])
    stored = tables.read_parquet(t.spark, path, "Appointment_Timestamp date, SWT decimal(18,2), period int")
    return stored.groupBy("period").agg(F.count(F.lit(1)).alias("n"), F.sum("SWT").cast("double").alias("SWT"))


@query("overlapping_load", f"""
WITH {ORDER_FACTS_SQL.strip()}
SELECT Product, CAST(year(Appointment_Timestamp) AS INTEGER) AS period, CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(SWT) AS DOUBLE) AS SWT
FROM fact WHERE NOT (Appointment_Timestamp >= DATE '1997-03-10' AND Appointment_Timestamp < DATE '1997-08-20') GROUP BY ALL""")
def overlapping_load(t: Tables) -> DataFrame:
    """Facts loaded in periods that overlap, one inside another and one without rows: each day belongs to its last load."""
    fact = order_facts(t).select("Appointment_Timestamp", "Product", "SWT")
    table = VersionedTable(t.spark, t.new_folder(), "Appointment_Timestamp date, Product string, SWT decimal(18,2)", "Appointment_Timestamp")
    wrong = fact.withColumn("SWT", F.col("SWT") * 2)
    table.load(wrong, date(1990, 1, 1), date(1996, 2, 15))
    table.load(fact, date(1995, 6, 1), date(2003, 1, 1))
    table.load(fact, date(1990, 1, 1), date(1995, 6, 1))
    table.load(wrong, date(1998, 1, 10), date(1998, 4, 20))
    table.load(fact, date(1998, 1, 1), date(1998, 6, 1))
    table.load(fact.limit(0), date(1997, 3, 10), date(1997, 8, 20))
    rows = table.read()
    return rows.groupBy("Product", F.year("Appointment_Timestamp").alias("period")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("SWT").cast("double").alias("SWT"))


@query("resumed_run", f"""
WITH {ORDER_FACTS_SQL.strip()}, {PANEL_SQL.strip()}
SELECT 'load' AS step, CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(SWT) AS DOUBLE) AS hours, 1 AS computed FROM fact
UNION ALL SELECT 'panel', COUNT(*), CAST(SUM(SWT) AS DOUBLE), 1 FROM panel
UNION ALL SELECT 'forecast', 18 * COUNT(DISTINCT Series_Identifier), NULL, 1 FROM panel
UNION ALL SELECT 'cube', COUNT(*), CAST(SUM(history) AS DOUBLE), 1 FROM (
  SELECT m.month, sum(d.SWT) FILTER (d.month = m.month AND m.month <= DATE '2001-06-01') AS history
  FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2002-12-01', INTERVAL 1 MONTH)) AS DATE) AS month) m,
    (SELECT District, Product, Technology, Work_Order_Action, Work_Force, Product_Grp, Work_Order_Action_Grp,
       CAST(date_trunc('month', Appointment_Timestamp) AS DATE) AS month,
       CASE WHEN COUNT(*) FILTER (District IS NULL OR Product IS NULL OR Technology IS NULL OR Work_Order_Action IS NULL OR Work_Force IS NULL) = 0
         THEN SUM(SWT) END AS SWT
     FROM fact
     WHERE Work_Order_Action_Grp NOT IN ('EXCLUDE', 'PROJECT (EXCLUDE)', 'OTHER') AND Work_Force NOT IN ('QX', 'Go Sales') AND Product_Grp <> 'OTHER'
     GROUP BY ALL) d
  GROUP BY m.month, District, Product, Technology, Work_Order_Action, Work_Force, Product_Grp, Work_Order_Action_Grp)""")
def resumed_run(t: Tables) -> DataFrame:
    """The monthly job breaks off after its forecast and is run again: what was committed is read, the cube is computed."""
    folder, made = t.new_folder(), []
    fact = order_facts(t)
    projects = t.spark.createDataFrame([], schemas.SPECIAL_PROJECTS)
    lookup = schemas.conform(district_lookup(t), schemas.DISTRICTS)
    job = dict(period=(date(1990, 1, 1), date(2003, 1, 1)), lookup=lookup, projects=projects, as_of=AS_OF, stamp="2001-07-15 06:00:00", folder=folder,
               name="2001-07", first_month=FIRST_MONTH)

    class Broken(Exception):
        pass

    def broken(*_):
        raise Broken

    try:
        monthly.refresh_month(t.spark, lambda: fact, **{**job, "before": {"cube": broken}, "made": made})
    except Broken:
        pass
    monthly.refresh_month(t.spark, broken, **{**job, "made": made})
    # Each step was computed once, over both runs.
    steps = {"load": (monthly.history_table(t.spark, f"{folder}/history").read(), "SWT"), "panel": (monthly.panel_table(t.spark, f"{folder}/panel").read(), "SWT"),
             "forecast": (monthly.published(t.spark, f"{folder}/forecast", schemas.FORECAST), None),
             "cube": (monthly.published(t.spark, f"{folder}/cube", schemas.DISPLAY), "SWT_Historical")}
    parts = [rows.agg(F.lit(step).alias("step"), F.count(F.lit(1)).alias("n"), (F.sum(money(hours)) if hours else F.lit(None)).cast("double").alias("hours"),
                      F.lit(made.count((step, True))).alias("computed")) for step, (rows, hours) in steps.items()]
    return reduce(DataFrame.unionByName, parts)


@query("declared_sheet_scan", """
SELECT CAST(month(o_orderdate) AS BIGINT) AS Month, CAST(year(o_orderdate) AS BIGINT) AS Year, c_mktsegment AS Product,
  CASE WHEN o_orderstatus = 'F' THEN 'Gross Adds' ELSE 'Net Adds' END AS RGU_Type, CAST(COUNT(*) AS BIGINT) AS Original_Actual,
  CAST(COUNT(*) + SUM(o_custkey % 3) AS BIGINT) AS Adjusted_Actual, CAST(NULL AS VARCHAR) AS Notes
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY ALL""")
def sheet(t: Tables) -> DataFrame:
    """A sheet with a header row, written as CSV and read back under its declared schema."""
    path = t.new_folder()
    tables.write_sheet(schemas.conform(volume_sheet(t), schemas.VOLUME_SHEET), path)
    segments = {product: segment for segment, product in SEGMENT_PRODUCTS.items()}
    stored = tables.read_sheet(t.spark, path, schemas.VOLUME_SHEET)
    return stored.withColumn("Product", recode(F.col("Product"), segments))


@query("checked_sheet_scan", """
WITH cells AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
    CASE WHEN o_custkey % 10 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders)
SELECT 'row' AS kind, CAST(NULL AS VARCHAR) AS fault, CAST(NULL AS VARCHAR) AS cell, CAST(COUNT(*) AS BIGINT) AS n,
  CAST(SUM(TRY_CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM cells WHERE amount <> 'n/a' AND day <> 'soon'
UNION ALL SELECT 'reject', 'amount', amount, COUNT(*), NULL FROM cells WHERE amount = 'n/a' GROUP BY amount
UNION ALL SELECT 'reject', 'day', day, COUNT(*), NULL FROM cells WHERE day = 'soon' GROUP BY day""")
def checked_sheet(t: Tables) -> DataFrame:
    """A sheet with faulty cells: good rows and faults, under a JSON schema."""
    path = t.new_folder()
    amount = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(money("o_totalprice").cast("string"))
    day = F.when(F.col("o_custkey") % 10 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    tables.write_sheet(t.orders.select("o_orderkey", amount.alias("amount"), day.alias("day")), path)
    schema = schemas.from_json('[{"name": "o_orderkey", "type": "INTEGER"}, {"name": "amount", "type": "NUMERIC"}, {"name": "day", "type": "DATE"}]')
    rows, rejects = tables.read_checked_sheet(t.spark, path, schema)
    good = rows.agg(F.lit("row").alias("kind"), F.lit(None).cast("string").alias("fault"), F.lit(None).cast("string").alias("cell"),
                    F.count("day").alias("n"), F.sum("amount").cast("double").alias("amount"))
    bad = rejects.groupBy(F.lit("reject").alias("kind"), F.col("column").alias("fault"), "cell").agg(F.count("line").alias("n"), F.lit(None).cast("double").alias("amount"))
    return good.unionByName(bad)


@query("coerced_dates", """
SELECT CASE WHEN o_orderstatus <> 'P' THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS month, CAST(COUNT(*) AS BIGINT) AS n
FROM orders GROUP BY 1""")
def coerced(t: Tables) -> DataFrame:
    """Dates stored as text in a CSV; text that is no date becomes null."""
    path = t.new_folder()
    text = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    tables.write_sheet(t.orders.select("o_orderkey", text.alias("day")), path)
    stored = tables.read_series(t.spark, path, "o_orderkey bigint, day date", "day")
    return stored.groupBy(month_of(F.col("day")).alias("month")).agg(F.count(F.lit(1)).alias("n"))


LAGS = range(1, fv.MONTHLY_CONTEXT + 1)
FEATURES = ["1", *[f"lag_{k}" for k in LAGS], *[f"CAST(month(m) = {n} AS INTEGER)" for n in range(2, 13)], *[f"effect_{i}" for i in range(len(DIMS))]]
WIDTH = len(FEATURES)


def _weight(feature: int) -> str:
    return f"w[{feature + 1}]"


def _monthly_forecast_sql() -> str:
    """The same normal equations, eliminated by a recursion over lists, and a recursion over the months ahead."""
    effects = "".join(f"""
effects_{i} AS (SELECT {d}, CAST((CAST(SUM(y) AS DOUBLE) + 10 * mean) / (COUNT(*) + 10) - mean AS DECIMAL(18,2)) AS effect_{i}
  FROM training, overall GROUP BY {d}, mean),""" for i, d in enumerate(DIMS))
    product = lambda i, j: f"SUM(CAST({FEATURES[min(i, j)]} AS DOUBLE) * CAST({FEATURES[max(i, j)] if max(i, j) < WIDTH else 'y'} AS DOUBLE))"
    table = ", ".join("[" + ", ".join(product(i, j) for j in range(WIDTH + 1)) + "]" for i in range(WIDTH))
    level = " + ".join([_weight(0), *[f"CAST(effect_{i} AS DOUBLE) * {_weight(WIDTH - len(DIMS) + i)}" for i in range(len(DIMS))]])
    season = "CASE month(m + to_months(step)) WHEN 1 THEN 0.0 " + " ".join(f"WHEN {n} THEN {_weight(len(LAGS) + n - 1)}" for n in range(2, 13)) + " END"
    past = " + ".join(f"state[{len(LAGS) + 1 - k}] * {_weight(k)}" for k in LAGS)
    return f"""
WITH RECURSIVE {ORDER_FACTS_SQL.strip()}, {PANEL_SQL.strip()},
valued AS (
  SELECT Series_Identifier AS id, Appointment_Month AS m, CAST(SWT AS DECIMAL(18,2)) AS y, {', '.join(f"coalesce({d}, 'None') AS {d}" for d in DIMS)} FROM panel),
training AS MATERIALIZED (
  SELECT * FROM (
    SELECT *, {', '.join(f'lag(y, {k}) OVER series AS lag_{k}' for k in LAGS)}, lead(m) OVER series IS NULL AS newest
    FROM valued WINDOW series AS (PARTITION BY id ORDER BY m))
  WHERE lag_{LAGS[-1]} IS NOT NULL),
overall AS (SELECT CAST(SUM(y) AS DOUBLE) / COUNT(*) AS mean FROM training),{effects}
described AS MATERIALIZED (SELECT * FROM training {' '.join(f'JOIN effects_{i} USING ({d})' for i, d in enumerate(DIMS))}),
sums AS (SELECT [{table}] AS a FROM described),
steps AS (
  SELECT 1 AS k, a, list_transform(range(1, {WIDTH + 1}), lambda i: a[i][i]) AS own FROM sums
  UNION ALL
  SELECT k + 1, list_transform(range(1, {WIDTH + 1}), lambda i: CASE
      WHEN i <> k AND a[k][k] > 1e-10 * own[k] THEN list_transform(range(1, {WIDTH + 2}), lambda j: a[i][j] - a[i][k] * (a[k][j] / a[k][k]))
      WHEN i <> k THEN a[i]
      WHEN a[k][k] > 1e-10 * own[k] THEN list_transform(a[k], lambda x: x / a[k][k])
      ELSE list_transform(a[k], lambda x: 0.0::DOUBLE) END), own
  FROM steps WHERE k <= {WIDTH}),
weights AS (SELECT list_transform(a, lambda line: line[{WIDTH + 1}]) AS w FROM steps WHERE k = {WIDTH + 1}),
ahead AS (
  SELECT 1 AS step, id, m, {', '.join(DIMS)}, w, {level} AS level,
    [{', '.join(f'CAST(lag_{k} AS DOUBLE)' for k in reversed(LAGS[:-1]))}, CAST(y AS DOUBLE)] AS state, CAST(NULL AS DOUBLE) AS value
  FROM described, weights WHERE newest
  UNION ALL
  SELECT step + 1, id, m, {', '.join(DIMS)}, w, level, list_append(state[2:], value), value
  FROM (SELECT * REPLACE (level + {season} + {past} AS value) FROM ahead WHERE step <= {fv.MONTHLY_HORIZON}))
SELECT id AS Series_Identifier, CAST(m + to_months(step - 1) AS DATE) AS Appointment_Month, {', '.join(DIMS)}, 'ok' AS status, round(value, 1) AS predicted_SWT
FROM ahead WHERE step > 1"""


@query("global_monthly_forecast", _monthly_forecast_sql())
def global_forecast(t: Tables) -> DataFrame:
    """One least-squares model over all monthly series, 18 months ahead."""
    months = panel(t).withColumn("SWT", money("SWT"))
    rows = monthly_global_forecast(months, DIMS, "Series_Identifier", "Appointment_Month", "SWT")
    return rows.select("Series_Identifier", "Appointment_Month", *DIMS, "status", F.round("predicted_SWT", 1).alias("predicted_SWT"))
