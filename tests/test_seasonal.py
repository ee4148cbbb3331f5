"""The seasonal order search on simulated series, and its solver."""

from datetime import date, timedelta

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from crewcast.operators.seasonal import ORDERS, places, seasonal_order_forecast, solved

SCHEMA = "series_id string, split_index int, ds date, y double"
HORIZON = 14


def simulated(seed: int, count: int, ar=0.0, ma=0.0, seasonal_ma=0.0, plain=0, seasonal=0) -> np.ndarray:
    rng, burn = np.random.default_rng(seed), 200
    e, w = rng.normal(size=count + burn), np.zeros(count + burn)
    for t in range(8, len(w)):
        w[t] = ar * w[t - 1] + e[t] + ma * e[t - 1] + seasonal_ma * e[t - 7] + ma * seasonal_ma * e[t - 8]
    if plain:
        w = np.cumsum(w)
    if seasonal:
        for t in range(7, len(w)):
            w[t] += w[t - 7]
    return w[burn:]


@pytest.fixture(scope="module")
def found(spark):
    weekly = [5.0, 6, 7, 8, 9, 1, 2]
    series = {f"sarima{k}": simulated(100 + k, 1500, 0.5, 0.4, -0.6, 1, 1) for k in range(5)}
    series |= {"arma": simulated(1, 1500, 0.6, 0.3), "season": simulated(2, 1500, seasonal_ma=0.7), "walk": simulated(3, 1000, plain=1),
               "weekly": np.tile(weekly, 100), "constant": np.full(200, 3.0), "short": simulated(4, 40)}
    rows = [(k, 1, date(2020, 1, 1) + timedelta(days=i), float(v)) for k, y in series.items() for i, v in enumerate(y[: -HORIZON])]
    rows.append(("arma", 1, date(2030, 1, 1), None))
    forecasts = {}
    for r in seasonal_order_forecast(spark.createDataFrame(rows, SCHEMA), HORIZON).orderBy("step").collect():
        forecasts.setdefault(r["series_id"], []).append(r)
    return series, forecasts


def test_orders_of_simulated_series(found):
    _, forecasts = found
    orders = {k: rows[0]["orders"] for k, rows in forecasts.items()}
    assert [orders[f"sarima{k}"] for k in range(5)].count("(1,1,1)(0,1,1)7") >= 3
    assert all(orders[f"sarima{k}"][3] == orders[f"sarima{k}"][10] == "1" for k in range(5))  # both differences, every time
    assert orders["arma"] == "(1,0,1)(0,0,0)7" and orders["season"] == "(0,0,0)(0,0,1)7" and orders["walk"] == "(0,1,0)(0,0,0)7"


def test_paths_and_statuses(found):
    series, forecasts = found
    assert all([r["step"] for r in rows] == list(range(1, HORIZON + 1)) for rows in forecasts.values())
    path = lambda k: [r["yhat"] for r in forecasts[k]]
    assert path("weekly") == pytest.approx(series["weekly"][-HORIZON:]) and path("constant") == [3.0] * HORIZON
    assert path("short") == pytest.approx([series["short"][:-HORIZON].mean()] * HORIZON)
    assert {k: rows[0]["status"] for k, rows in forecasts.items() if rows[0]["status"] != "ok"} == {"weekly": "flat", "constant": "flat", "short": "short"}
    # Better than repeating the last week, and than the last value for a walk's levels.
    error = lambda k, guess: float(np.mean([np.abs(np.array(guess(series[f"{k}{i}"][:-HORIZON])) - series[f"{k}{i}"][-HORIZON:]).mean() for i in range(5)]))
    own = float(np.mean([np.abs(np.array(path(f"sarima{i}")) - series[f"sarima{i}"][-HORIZON:]).mean() for i in range(5)]))
    assert own < error("sarima", lambda y: list(y[-7:]) * 2)


def test_candidates_hold_the_cross_terms():
    assert len(set(map(tuple, map(lambda o: places(*o), ORDERS)))) == len(ORDERS)
    assert places(1, 1, 0, 1) == [0, 4, 6, 7] and places(0, 0, 0, 0) == [] and places(2, 0, 1, 0) == [0, 1, 2, 3]


@settings(max_examples=15, deadline=None)
@given(st.integers(1, 6), st.integers(0, 10_000))
def test_elimination_is_least_squares(spark, size, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(40, size))
    if size > 2:
        x[:, 2] = 2 * x[:, 0]  # explained by an earlier column: weight 0
    y = rng.normal(size=40)
    table = [[*map(float, x.T[i] @ x), float(x.T[i] @ y)] for i in range(size)]
    got = spark.createDataFrame([(table,)], "t array<array<double>>").select(solved(F.col("t"))).first()[0]
    free = [i for i in range(size) if not (size > 2 and i == 2)]
    want = np.zeros(size)
    want[free] = np.linalg.lstsq(x[:, free], y, rcond=None)[0]
    assert got == pytest.approx(want, abs=1e-8)
