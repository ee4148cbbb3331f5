"""The seasonal order search on the daily series, and the same search in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame

from crewcast.catalog.base import Tables, query, rounded
from crewcast.catalog.daily import known
from crewcast.catalog.inputs import DAILY_SQL, HORIZON, daily
from crewcast.operators import seasonal

SEASON = 7
KEYS = "series_id, split_index"
BOTH = f"WINDOW s AS (PARTITION BY {KEYS}), o AS (PARTITION BY {KEYS} ORDER BY ds)"
TERMS = [("w", 1), ("w", 2), ("w", SEASON), ("w", SEASON + 1), ("e", 1), ("e", 2), ("e", SEASON), ("e", SEASON + 1)]
NAMES = [*[f"{kind}_{k}" for kind, k in TERMS], "w"]


def _eliminated(name: str, source: str, columns: str, size: str) -> str:
    """Recursion that solves the list of rows ``a`` of every row of ``source``; ``x`` are the weights."""
    return f"""
{name}_steps AS (
  SELECT {columns}, {size} AS size, a, list_transform(range(1, {size} + 1), lambda i: a[i][i]) AS own, 1 AS k FROM {source}
  UNION ALL
  SELECT {columns}, size, list_transform(range(1, size + 1), lambda i: CASE
      WHEN a[k][k] > {seasonal.COLLINEAR} * own[k] THEN CASE WHEN i = k THEN list_transform(a[k], lambda x: x / a[k][k])
        ELSE list_transform(range(1, size + 2), lambda j: a[i][j] - a[i][k] * (a[k][j] / a[k][k])) END
      WHEN i = k THEN list_transform(a[k], lambda x: 0.0::DOUBLE) ELSE a[i] END), own, k + 1
  FROM {name}_steps WHERE k <= size),
{name} AS (SELECT {columns}, list_transform(a, lambda line: line[size + 1]) AS x FROM {name}_steps WHERE k = size + 1)"""


def _search_sql() -> str:
    long, reach = seasonal.LONG, SEASON + 1
    variance = " + ".join(f"2 * greatest(0, 1 - {j} / (least({seasonal.KPSS_LAGS}, floor(4 * pow(size / 100.0, 0.25))) + 1)) * coalesce(sum(u * u{j}) OVER s, 0)"
                          for j in range(1, seasonal.KPSS_LAGS + 1))
    cells = ", ".join("[" + ", ".join(f"coalesce(sum({a} * {b}) FILTER (e_{reach} IS NOT NULL AND w IS NOT NULL), 0.0)" for b in NAMES) + "]" for a in NAMES)
    options = ", ".join("({}, '({},d,{})({},D,{})', {}::INTEGER[])".format(i, *o, [t + 1 for t in seasonal.places(*o)]) for i, o in enumerate(seasonal.ORDERS))
    side = lambda name: "[" + ", ".join([*[f"lag({name}, {j}) OVER o" for j in range(reach - 1, 0, -1)], name]) + "]"
    step = " + ".join(f"c[{i + 1}] * coalesce({kind}_tail[len({kind}_tail) + 1 - {k}], 0)" for i, (kind, k) in enumerate(TERMS))
    return f"""
WITH RECURSIVE {DAILY_SQL.strip()},
given AS (SELECT Series_Identifier AS series_id, split_index, Appointment_Day AS ds, CAST(SWT AS DOUBLE) AS y FROM train),
changes AS (SELECT *, count(*) OVER s AS n, avg(y) OVER s AS level, lag(y, {SEASON}) OVER o AS before, y - lag(y) OVER o AS raw_change FROM given {BOTH}),
centred AS (SELECT *, raw_change - avg(raw_change) OVER s AS change FROM changes {BOTH}),
paired AS (SELECT *, lag(change, {SEASON}) OVER o AS change_before FROM centred {BOTH}),
seasonal_choice AS (SELECT *, CASE WHEN sum(change * change) OVER s > 0
    AND coalesce(sum(change * change_before) OVER s, 0) >= {seasonal.REPEATS} * sum(change * change) OVER s THEN 1 ELSE 0 END AS d_season FROM paired {BOTH}),
first_difference AS (SELECT *, CASE WHEN d_season = 1 THEN y - before ELSE y END AS z FROM seasonal_choice),
level_free AS (SELECT *, count(z) OVER s AS size, z - avg(z) OVER s AS u, lag(z) OVER o AS z_before FROM first_difference {BOTH}),
walked AS (SELECT *, CASE WHEN u IS NOT NULL THEN sum(u) OVER o END AS path, {', '.join(f'lag(u, {j}) OVER o AS u{j}' for j in range(1, seasonal.KPSS_LAGS + 1))}
  FROM level_free {BOTH}),
tested AS (SELECT *, (sum(path * path) OVER s) / (size * size) AS statistic, (sum(u * u) OVER s + {variance}) / size AS long_run FROM walked {BOTH}),
plain_choice AS (SELECT *, CASE WHEN long_run > 0 AND statistic > {seasonal.KPSS_5_PERCENT} * long_run THEN 1 ELSE 0 END AS d_plain FROM tested),
second_difference AS (SELECT *, CASE WHEN d_plain = 1 THEN z - z_before ELSE z END AS raw FROM plain_choice),
drift AS (SELECT *, CASE WHEN d_plain + d_season < 2 THEN coalesce(avg(raw) OVER s, 0) ELSE 0 END AS mean FROM second_difference {BOTH}),
stationary AS (SELECT {KEYS}, ds, y, n, level, d_plain, d_season, z, mean, raw - mean AS w FROM drift),
lagged AS MATERIALIZED (SELECT *, {', '.join(f'lag(w, {j}) OVER o AS w{j}' for j in range(1, long + 1))} FROM stationary {BOTH}),
gammas AS (SELECT {KEYS}, [{', '.join(f"coalesce(sum(w * {f'w{j}' if j else 'w'}), 0)" for j in range(long + 1))}] AS g FROM lagged GROUP BY ALL),
toeplitz AS (SELECT {KEYS}, list_transform(range({long}), lambda i: list_append(list_transform(range({long}), lambda j: g[abs(i - j) + 1]), g[i + 2])) AS a FROM gammas),
{_eliminated('autoregression', 'toeplitz', KEYS, str(long)).strip()},
innovations AS (SELECT lagged.*, w - ({' + '.join(f'x[{j}] * w{j}' for j in range(1, long + 1))}) AS e FROM lagged JOIN autoregression USING ({KEYS})),
regressors AS MATERIALIZED (SELECT *, {', '.join(f'lag({kind}, {k}) OVER o AS {kind}_{k}' for kind, k in TERMS)}, {side('w')} AS w_tail, {side('e')} AS e_tail,
    [{', '.join(f'lag(y, {j}) OVER o' for j in range(SEASON - 1, 0, -1))}, y] AS y_tail, lead(ds) OVER o IS NULL AS newest FROM innovations {BOTH}),
moments AS MATERIALIZED (SELECT {KEYS}, CAST(count(*) FILTER (e_{reach} IS NOT NULL AND w IS NOT NULL) AS DOUBLE) AS used, [{cells}] AS m FROM regressors GROUP BY ALL),
options(rank, orders, terms) AS (VALUES {options}),
systems AS (SELECT {KEYS}, rank, terms, list_transform(terms, lambda i: list_append(list_transform(terms, lambda j: m[i][j]), m[i][{len(NAMES)}])) AS a
  FROM moments, options WHERE len(terms) > 0),
{_eliminated('fitted', 'systems', f'{KEYS}, rank, terms', 'len(terms)').replace('len(terms) AS size', 'CAST(len(terms) AS INTEGER) AS size').strip()},
judged AS (
  SELECT {KEYS}, rank, terms, coalesce(x, []) AS x, orders, used, m[{len(NAMES)}][{len(NAMES)}] AS yy,
    coalesce(list_sum(list_transform(range(1, len(x) + 1), lambda i: x[i] * m[terms[i]][{len(NAMES)}])), 0) AS explained,
    coalesce(list_sum(list_transform(range(1, len(x) + 1), lambda i: CASE WHEN terms[i] <= 4 THEN abs(x[i]) ELSE 0 END)), 0) AS own, CAST(len(terms) + 1 AS DOUBLE) AS k
  FROM moments CROSS JOIN options
    LEFT JOIN (SELECT {KEYS}, rank, x FROM fitted) USING ({KEYS}, rank)),
best AS (SELECT * FROM judged WHERE yy > 0 AND own < 1
  QUALIFY row_number() OVER (PARTITION BY {KEYS} ORDER BY used * ln(greatest(yy - explained, 1e-12 * yy) / used) + k * ln(used), rank) = 1),
started AS (
  SELECT r.series_id, r.split_index, r.ds AS last, r.level, r.mean, r.d_plain, r.d_season, r.w_tail, r.e_tail, r.y_tail, r.z,
    CASE WHEN r.n < 60 THEN 'short' WHEN NOT m.m[{len(NAMES)}][{len(NAMES)}] > 0 THEN 'flat' ELSE 'ok' END AS status, b.orders,
    list_transform(range(1, {len(TERMS) + 1}), lambda i: CASE WHEN list_contains(b.terms, i) THEN b.x[list_position(b.terms, i)] ELSE 0 END) AS c
  FROM regressors r JOIN moments m USING ({KEYS}) LEFT JOIN best b USING ({KEYS}) WHERE newest),
ready AS (SELECT * REPLACE (CASE WHEN status = 'ok' THEN c ELSE list_transform(range({len(TERMS)}), lambda i: 0.0::DOUBLE) END AS c,
    CASE WHEN status = 'short' THEN 'mean' ELSE replace(replace(CASE WHEN status = 'ok' THEN orders ELSE '(0,d,0)(0,D,0)' END || '{SEASON}', 'd', d_plain::VARCHAR), 'D', d_season::VARCHAR) END AS orders)
  FROM started),
ahead AS (
  SELECT *, 0 AS step, CAST(NULL AS DOUBLE) AS yhat FROM ready
  UNION ALL
  SELECT series_id, split_index, last, level, mean, d_plain, d_season, list_append(w_tail, add), list_append(e_tail, 0.0), list_append(y_tail, value), total,
    status, orders, c, step + 1, CASE WHEN status = 'short' THEN level ELSE value END
  FROM (SELECT *, total + CASE WHEN d_season = 1 THEN y_tail[len(y_tail) + 1 - {SEASON}] ELSE 0 END AS value
    FROM (SELECT *, add + mean + CASE WHEN d_plain = 1 THEN z ELSE 0 END AS total FROM (SELECT *, {step} AS add FROM ahead WHERE step < {HORIZON}))))
SELECT 'SEASONAL_ORDER' AS model, series_id, split_index, CAST(last + to_days(step) AS DATE) AS ds, step, round(yhat, 2) AS yhat, orders, status
FROM ahead WHERE step > 0"""


@query("seasonal_order_forecast", _search_sql())
def search(t: Tables) -> DataFrame:
    rows = seasonal.seasonal_order_forecast(known(daily(t)), HORIZON, SEASON)
    return rows.select("model", "series_id", "split_index", "ds", "step", rounded("yhat", 2), "orders", "status")
