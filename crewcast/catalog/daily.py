"""Daily back-test: folds, forecasts, scores and profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crewcast.catalog.base import Tables, doubles, query, rounded
from crewcast.catalog.inputs import (
    DAILY_ATTRIBUTES, DAILY_SQL, FIRST_TRAIN_END, HORIZON, TRAIN_START, daily,
)
from crewcast.operators import evaluate, forecast, profile
from crewcast.operators.folds import expanding_folds, held_out_rows, labelled_rows, train_rows
from crewcast.plans.short_term import tidy

DAY, WINDOW = "Appointment_Day", 183
FOLDS = expanding_folds(TRAIN_START, FIRST_TRAIN_END, HORIZON)
KEPT = ["Series_Identifier", DAY, *DAILY_ATTRIBUTES]
COLUMNS_SQL = "Series_Identifier, Appointment_Day, Region_Type, l_returnflag, l_linestatus, CAST(SWT AS DOUBLE) AS SWT"


def known(series: DataFrame) -> DataFrame:
    return tidy(train_rows(series, DAY, FOLDS), "Series_Identifier", DAY, "SWT")


def averages(series: DataFrame) -> DataFrame:
    return forecast.moving_average_forecast(known(series), WINDOW, HORIZON)


def scored_frames(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Held-out rows and forecasts, both from one stored copy of the daily series."""
    series = t.stored(daily(t))
    rows = tidy(held_out_rows(series, DAY, FOLDS), "Series_Identifier", DAY, "SWT")
    return rows.withColumn("y", F.col("y").cast("double")), averages(series)


@query("daily_ingest", f"WITH {DAILY_SQL.strip()} SELECT {COLUMNS_SQL} FROM daily")
def ingest(t: Tables) -> DataFrame:
    return daily(t).select(*KEPT, *doubles("SWT"))


@query("cv_train", f"WITH {DAILY_SQL.strip()} SELECT {COLUMNS_SQL}, split_index FROM train")
def cv_train(t: Tables) -> DataFrame:
    return train_rows(daily(t), DAY, FOLDS).select(*KEPT, *doubles("SWT"), "split_index")


@query("cv_test", f"WITH {DAILY_SQL.strip()} SELECT {COLUMNS_SQL}, split_index FROM test")
def cv_test(t: Tables) -> DataFrame:
    return held_out_rows(daily(t), DAY, FOLDS).select(*KEPT, *doubles("SWT"), "split_index")


TRAILING_SQL = """
newest_rows AS (SELECT Series_Identifier AS series_id, split_index, Appointment_Day AS ds, CAST(SWT AS DOUBLE) AS y FROM train
  QUALIFY row_number() OVER (PARTITION BY Series_Identifier, split_index ORDER BY Appointment_Day DESC) <= 183)"""


@query("trailing_window", f"WITH {DAILY_SQL.strip()}, {TRAILING_SQL.strip()} SELECT * FROM newest_rows")
def trailing(t: Tables) -> DataFrame:
    return forecast.trailing_window(known(daily(t)), WINDOW).select("series_id", "split_index", "ds", *doubles("y"))


SMA_SQL = f"""{DAILY_SQL.strip()}, {TRAILING_SQL.strip()},
path AS (
  SELECT series_id, split_index, max(ds) AS last, 0 AS step, list(y ORDER BY ds) AS w, CAST(NULL AS DOUBLE) AS yhat
  FROM newest_rows GROUP BY series_id, split_index
  UNION ALL
  SELECT series_id, split_index, last, step + 1, list_concat(w[2:], [list_avg(w)]), list_avg(w) FROM path WHERE step < 91),
sma AS (SELECT 'SMA' AS model, series_id, split_index, CAST(last + to_days(step) AS DATE) AS ds, step, yhat FROM path WHERE step > 0),
actual AS (SELECT Series_Identifier AS series_id, split_index, Appointment_Day AS ds, CAST(SWT AS DOUBLE) AS y FROM test)"""


@query("sma_forecast", f"WITH RECURSIVE {SMA_SQL} SELECT model, series_id, split_index, ds, step, round(yhat, 2) AS yhat FROM sma")
def sma(t: Tables) -> DataFrame:
    return averages(daily(t)).select("model", "series_id", "split_index", "ds", "step", rounded("yhat", 2))


@query("seasonal_ar_forecast", f"""
WITH RECURSIVE {DAILY_SQL.strip()},
lagged AS (
  SELECT series_id, split_index, ds, y, lag(y) OVER w AS a, lag(y, 7) OVER w AS b
  FROM (SELECT Series_Identifier AS series_id, split_index, Appointment_Day AS ds, CAST(SWT AS DOUBLE) AS y FROM train)
  WINDOW w AS (PARTITION BY series_id, split_index ORDER BY ds)),
fits AS (
  SELECT series_id, split_index, max(ds) AS last, avg(y) AS level, CAST(count(b) AS DOUBLE) AS n, list(y ORDER BY ds DESC)[1:7] AS newest,
    avg(y) FILTER (b IS NOT NULL) AS m_y, avg(a) FILTER (b IS NOT NULL) AS m_a, avg(b) AS m_b,
    covar_pop(y, y) FILTER (b IS NOT NULL) AS yy, covar_pop(a, a) FILTER (b IS NOT NULL) AS aa, covar_pop(b, b) AS bb,
    covar_pop(a, b) AS ab, covar_pop(a, y) FILTER (b IS NOT NULL) AS ay, covar_pop(b, y) AS bys
  FROM lagged GROUP BY series_id, split_index),
options AS (
  SELECT series_id, split_index, n, yy, ay, bys, 0 AS r, 'mean' AS orders, 2.0 AS k, 0.0::DOUBLE AS ca, 0.0::DOUBLE AS cb FROM fits
  UNION ALL SELECT series_id, split_index, n, yy, ay, bys, 1, 'lag', 3.0, ay / aa, 0.0 FROM fits WHERE aa > 0
  UNION ALL SELECT series_id, split_index, n, yy, ay, bys, 2, 'season', 3.0, 0.0, bys / bb FROM fits WHERE bb > 0
  UNION ALL SELECT series_id, split_index, n, yy, ay, bys, 3, 'lag+season', 4.0, (bb * ay - ab * bys) / (aa * bb - ab * ab),
    (aa * bys - ab * ay) / (aa * bb - ab * ab) FROM fits WHERE aa * bb - ab * ab > 1e-9 * aa * bb),
best AS (
  SELECT * FROM options WHERE yy > 0
  QUALIFY row_number() OVER (PARTITION BY series_id, split_index
    ORDER BY n * ln(greatest(yy - ca * ay - cb * bys, 1e-12 * yy)) + 2 * k + 2 * k * (k + 1) / (n - k - 1), r) = 1),
path AS (
  SELECT f.series_id, f.split_index, f.last, f.level, CASE WHEN f.n < 28 THEN 'short' WHEN NOT f.yy > 0 THEN 'flat' ELSE 'ok' END AS status,
    b.orders, b.ca, b.cb, f.m_y - b.ca * f.m_a - b.cb * f.m_b AS shift, list_reverse(f.newest) AS tail, 0 AS step, CAST(NULL AS DOUBLE) AS yhat
  FROM fits f LEFT JOIN best b USING (series_id, split_index)
  UNION ALL
  SELECT series_id, split_index, last, level, status, orders, ca, cb, shift,
    CASE WHEN status = 'ok' THEN list_append(tail[2:], shift + ca * tail[7] + cb * tail[1]) ELSE tail END, step + 1,
    CASE WHEN status = 'ok' THEN shift + ca * tail[7] + cb * tail[1] ELSE level END
  FROM path WHERE step < 91)
SELECT 'SEASONAL_AR' AS model, series_id, split_index, CAST(last + to_days(step) AS DATE) AS ds, step, round(yhat, 2) AS yhat,
  CASE WHEN status = 'ok' THEN orders ELSE 'mean' END AS orders, status
FROM path WHERE step > 0""")
def seasonal(t: Tables) -> DataFrame:
    rows = forecast.seasonal_regression_forecast(known(daily(t)), HORIZON)
    return rows.select("model", "series_id", "split_index", "ds", "step", rounded("yhat", 2), "orders", "status")


@query("forecast_counters", f"""
WITH RECURSIVE {SMA_SQL}
SELECT total_combinations, successful_predictions, round(successful_predictions / total_combinations, 6) AS completion_rate FROM (
  SELECT (SELECT COUNT(DISTINCT Series_Identifier) * COUNT(DISTINCT split_index) FROM train) AS total_combinations,
    (SELECT COUNT(*) FROM (SELECT series_id, split_index FROM sma GROUP BY ALL HAVING count(yhat) = count(*))) AS successful_predictions)""")
def counters(t: Tables) -> DataFrame:
    series = t.stored(daily(t))
    return forecast.forecast_counts(known(series), averages(series)).select(
        "total_combinations", "successful_predictions", rounded("completion_rate")
    )


BY_DATE_SQL = "by_date AS (SELECT a.series_id, a.split_index, a.ds, a.y, s.yhat FROM actual a JOIN sma s USING (series_id, split_index, ds))"
PAIRS_SQL = "series_id, split_index, ds, y, round(yhat, 2) AS yhat"


@query("aligned_by_date", f"WITH RECURSIVE {SMA_SQL}, {BY_DATE_SQL} SELECT {PAIRS_SQL} FROM by_date")
def by_date(t: Tables) -> DataFrame:
    pairs = evaluate.align_by_date(*scored_frames(t))
    return pairs.select("series_id", "split_index", "ds", "y", rounded("yhat", 2))


@query("aligned_by_position", f"""
WITH RECURSIVE {SMA_SQL},
numbered AS (SELECT *, row_number() OVER (PARTITION BY series_id, split_index ORDER BY ds) AS step FROM actual
  WHERE EXISTS (SELECT 1 FROM sma s WHERE s.series_id = actual.series_id AND s.split_index = actual.split_index AND s.ds = actual.ds))
SELECT n.series_id, n.split_index, n.ds, n.y, round(s.yhat, 2) AS yhat FROM numbered n
  JOIN sma s ON s.series_id = n.series_id AND s.split_index = n.split_index AND s.step = n.step""")
def by_position(t: Tables) -> DataFrame:
    pairs = evaluate.align_by_position(*scored_frames(t))
    return pairs.select("series_id", "split_index", "ds", "y", rounded("yhat", 2))


@query("forecast_metrics_by_tier", f"""
WITH RECURSIVE {SMA_SQL}, {BY_DATE_SQL},
scored AS (SELECT CASE WHEN series_id LIKE '%Tier 1%' THEN 'Tier 1' WHEN series_id LIKE '%Tier 2%' THEN 'Tier 2'
    WHEN series_id LIKE '%Tier 3%' THEN 'Tier 3' ELSE 'Unknown' END AS tier, y, yhat FROM by_date)
SELECT coalesce(tier, 'Overall') AS scope, round(avg(abs(y - yhat)), 4) AS MAE, round(sum(abs(y - yhat)) / (sum(abs(y)) + 1e-8), 8) AS WAPE,
  round(sqrt(avg((y - yhat) * (y - yhat))), 4) AS RMSE, round(avg(yhat - y), 4) AS Bias
FROM scored GROUP BY GROUPING SETS ((tier), ()) HAVING coalesce(tier, 'Overall') <> 'Unknown'""")
def metrics(t: Tables) -> DataFrame:
    pairs = evaluate.align_by_date(*scored_frames(t))
    scores = evaluate.forecast_metrics(pairs, evaluate.tier_in(F.col("series_id")))
    return scores.select("scope", rounded("MAE", 4), rounded("WAPE", 8), rounded("RMSE", 4), rounded("Bias", 4))


SCOPED_SQL = """
both_sets AS (SELECT 'train' AS dataset_type, * FROM train UNION ALL SELECT 'test', * FROM test),
scoped AS (SELECT dataset_type, split_index AS split_number, * EXCLUDE (dataset_type, split_index) FROM both_sets
  UNION ALL SELECT 'overall', 0, * EXCLUDE (dataset_type, split_index) FROM both_sets)"""


def both_sets(t: Tables, once: bool = False) -> DataFrame:
    """Train and test rows of all folds; the series is stored unless it is read ``once``."""
    return labelled_rows(daily(t) if once else t.stored(daily(t)), DAY, FOLDS)


@query("profile_numeric", f"""
WITH {DAILY_SQL.strip()}, {SCOPED_SQL.strip()}
SELECT dataset_type, split_number, CAST(COUNT(*) AS BIGINT) AS total_rows, min(Appointment_Day) AS start_date, max(Appointment_Day) AS end_date,
  round(avg(CAST(SWT AS DOUBLE)), 4) AS mean, round(quantile_cont(CAST(SWT AS DOUBLE), 0.5), 4) AS median,
  CAST(min(SWT) AS DOUBLE) AS min, CAST(max(SWT) AS DOUBLE) AS max, round(stddev_samp(CAST(SWT AS DOUBLE)), 4) AS std,
  CAST(SUM(SWT) AS DOUBLE) AS total
FROM scoped GROUP BY ALL""")
def numeric(t: Tables) -> DataFrame:
    stats = profile.numeric_profile(both_sets(t), DAY, "SWT")
    return stats.select(
        "dataset_type", "split_number", "total_rows", "start_date", "end_date", rounded("mean", 4), rounded("median", 4),
        "min", "max", rounded("std", 4), "total",
    )


@query("profile_nulls", f"""
WITH {DAILY_SQL.strip()}, {SCOPED_SQL.strip()}
UNPIVOT (SELECT dataset_type, split_number, {', '.join(
    f"CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS {c}" for c in (DAY, "SWT", *DAILY_ATTRIBUTES))} FROM scoped GROUP BY ALL)
ON {', '.join((DAY, "SWT", *DAILY_ATTRIBUTES))} INTO NAME column_name VALUE null_count""")
def nulls(t: Tables) -> DataFrame:
    return profile.null_counts(both_sets(t, once=True), [DAY, "SWT", *DAILY_ATTRIBUTES])


@query("profile_top5", f"""
WITH {DAILY_SQL.strip()}, {SCOPED_SQL.strip()},
named AS ({' UNION ALL '.join(
    f"SELECT dataset_type, split_number, '{c}' AS column_name, {c} AS value FROM scoped" for c in (*DAILY_ATTRIBUTES, "Series_Identifier"))}),
counts AS (SELECT dataset_type, split_number, column_name, value, COUNT(*) AS c FROM named GROUP BY ALL),
totals AS (SELECT dataset_type, split_number, column_name, SUM(c) AS n, COUNT(value) AS u FROM counts GROUP BY ALL)
SELECT dataset_type, split_number, column_name,
  row_number() OVER (PARTITION BY dataset_type, split_number, column_name ORDER BY c DESC, value) AS rank, value,
  CAST(c AS BIGINT) AS value_count, CAST(u AS BIGINT) AS unique_values, round(c * 100.0::DOUBLE / n, 6) AS percentage
FROM counts JOIN totals USING (dataset_type, split_number, column_name) WHERE value IS NOT NULL QUALIFY rank <= 5""")
def top_values(t: Tables) -> DataFrame:
    rows = profile.category_profile(both_sets(t), [*DAILY_ATTRIBUTES, "Series_Identifier"])
    kept = [c for c in rows.columns if c != "percentage"]
    return rows.select(*kept, rounded("percentage"))


COUNTS_SQL = """
counts AS (SELECT split_index, CAST(COUNT(*) FILTER (dataset_type = 'train') AS BIGINT) AS train_rows,
  CAST(COUNT(*) FILTER (dataset_type = 'test') AS BIGINT) AS test_rows FROM both_sets GROUP BY 1)"""


@query("split_counts", f"WITH {DAILY_SQL.strip()}, {SCOPED_SQL.strip()}, {COUNTS_SQL.strip()} SELECT * FROM counts")
def counts(t: Tables) -> DataFrame:
    return profile.split_counts(both_sets(t, once=True))


@query("profile_documents", f"""
WITH {DAILY_SQL.strip()}, {SCOPED_SQL.strip()}, {COUNTS_SQL.strip()}
SELECT split_index, CAST(to_json({{'split_index': split_index, 'train_rows': train_rows, 'test_rows': test_rows}}) AS VARCHAR) AS document
FROM counts""")
def documents(t: Tables) -> DataFrame:
    return profile.as_documents(profile.split_counts(both_sets(t, once=True)), ["split_index"])


LAST_YEAR_SQL = """
last_year AS (SELECT * FROM train WHERE split_index = 4
  AND Appointment_Day >= (SELECT max(Appointment_Day) FROM train WHERE split_index = 4) - 365)"""


def newest_fold(t: Tables) -> DataFrame:
    return train_rows(t.stored(daily(t)), DAY, FOLDS[-1:])


@query("trailing_year", f"""
WITH {DAILY_SQL.strip()}, {LAST_YEAR_SQL.strip()} SELECT {COLUMNS_SQL}, split_index FROM last_year""")
def last_year(t: Tables) -> DataFrame:
    return profile.last_year(newest_fold(t), DAY).select(*KEPT, *doubles("SWT"), "split_index")


@query("weekly_sum", f"""
WITH {DAILY_SQL.strip()}, {LAST_YEAR_SQL.strip()},
sums AS (SELECT CAST(Appointment_Day + ((8 - isodow(Appointment_Day)) % 7)::INT AS DATE) AS week, SUM(SWT) AS s
  FROM last_year GROUP BY 1)
SELECT w.week, CAST(coalesce(s, 0) AS DOUBLE) AS SWT
FROM (SELECT CAST(unnest(generate_series((SELECT min(week) FROM sums), (SELECT max(week) FROM sums), INTERVAL 7 DAY)) AS DATE) AS week) w
LEFT JOIN sums USING (week)""")
def weekly(t: Tables) -> DataFrame:
    """Weeks ending on Monday."""
    return profile.weekly_sums(profile.last_year(newest_fold(t), DAY), DAY, "SWT").select("week", *doubles("SWT"))


@query("log_target", f"""
WITH {DAILY_SQL.strip()} SELECT Series_Identifier, Appointment_Day, round(ln(1 + CAST(SWT AS DOUBLE)), 6) AS log_SWT FROM daily""")
def logs(t: Tables) -> DataFrame:
    return profile.log_target(daily(t), "SWT").select("Series_Identifier", DAY, rounded("log_SWT"))
