"""Whole chains on the real fact: load, history, panel, folds and back-test."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from crewcast import fixed_values as fv
from crewcast.catalog.base import Tables, doubles, query
from crewcast.catalog.facts import END, FACT_SQL, RULES, START, Views
from crewcast.catalog.inputs import AS_OF, DIMS, FIRST_MONTH, PANEL_SQL
from crewcast.plans import monthly, short_term

TEST = short_term.BackTest(train_start=date(1995, 6, 1), first_train_end=date(2000, 5, 31), cutoff=date(2001, 5, 31))
CHAIN_SQL = f"""
fact AS (SELECT * REPLACE (CAST(SWT AS DECIMAL(18,2)) AS SWT, CAST(AWT AS DECIMAL(18,2)) AS AWT) FROM ({FACT_SQL.strip()})
  WHERE Appointment_Timestamp >= DATE '{START}' AND Appointment_Timestamp < DATE '{END}'),
series_fact AS (SELECT * FROM fact WHERE Work_Order_Action_Grp NOT IN {fv.SERIES_EXCLUDED_ACTION_GROUPS} AND Work_Force NOT IN {fv.DROPPED_WORK_FORCES}
  AND Product_Grp <> '{fv.OTHER}')"""


def loaded(t: Tables) -> DataFrame:
    """The period's fact, loaded into a history and read back."""
    path = t.new_folder()
    monthly.load_history(Views(t).all(), RULES, START, END, path)
    return monthly.history(t.spark, path)


@query("fact_to_panel", f"""
WITH {CHAIN_SQL.strip()}, {PANEL_SQL.strip()}
SELECT Appointment_Month, Series_Identifier, {', '.join(DIMS)}, CAST(SWT AS DOUBLE) AS SWT, CAST(AWT AS DOUBLE) AS AWT FROM panel""")
def fact_to_panel(t: Tables) -> DataFrame:
    panel = monthly.month_panel(loaded(t), AS_OF, FIRST_MONTH)
    return panel.select("Appointment_Month", "Series_Identifier", *DIMS, *doubles("SWT", "AWT"))


ATTRIBUTES = ", ".join(fv.DAILY_ATTRIBUTES)


@query("back_test_job", f"""
WITH {CHAIN_SQL.strip()},
daily AS (SELECT {', '.join(a for a in fv.DAILY_ATTRIBUTES)}, Appointment_Timestamp AS day FROM
  (SELECT *, CAST(NULL AS VARCHAR) AS Region_Type FROM series_fact) GROUP BY ALL),
folds AS (SELECT k, DATE '2000-05-31' + CAST({fv.DAILY_HORIZON} * (k - 1) AS INTEGER) AS train_end FROM range(1, {fv.FOLD_COUNT + 1}) r(k)),
placed AS (SELECT k, {ATTRIBUTES}, day > train_end AS tested FROM daily, folds
  WHERE day >= DATE '1995-06-01' AND day <= DATE '2001-05-31' AND day <= train_end + {fv.DAILY_HORIZON})
SELECT CASE WHEN tested THEN 'test rows' ELSE 'train rows' END AS what, CAST(k AS INTEGER) AS split_index, CAST(COUNT(*) AS BIGINT) AS n FROM placed GROUP BY ALL
UNION ALL SELECT m || ' forecasts', CAST(k AS INTEGER), {fv.DAILY_HORIZON} * COUNT(DISTINCT ({ATTRIBUTES}))
FROM placed, (VALUES ('SMA'), ('SEASONAL_AR'), ('SEASONAL_ORDER')) v(m) WHERE NOT tested GROUP BY ALL""")
def back_test_job(t: Tables) -> DataFrame:
    """The back-test from the loaded fact: rows of every split, and forecasts of every model and split."""
    out = short_term.run(short_term.daily_source(loaded(t)), t.new_folder(), TEST)
    counts = out["split_counts"]
    parts = [counts.select(F.lit(f"{kind} rows").alias("what"), "split_index", F.col(f"{kind}_rows").alias("n")).filter("n > 0") for kind in ("train", "test")]
    forecasts = out["forecasts"].groupBy(F.concat("model", F.lit(" forecasts")).alias("what"), "split_index").agg(F.count("yhat").alias("n"))
    return parts[0].unionByName(parts[1]).unionByName(forecasts)
