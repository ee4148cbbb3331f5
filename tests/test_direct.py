"""The direct monthly model: accuracy next to the line, equal runs, short series."""

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from crewcast.operators.direct import fit_direct
from crewcast.operators.forecast import monthly_global_forecast

NAMED = ("id", "month", "y")


def months(n):
    return [date(2018 + i // 12, i % 12 + 1, 1) for i in range(n)]


@pytest.fixture(scope="module")
def panel(spark):
    """Series whose season depends on an attribute and whose year-end doubles: no line over lags has that."""
    rng = np.random.default_rng(2)
    rows = []
    for s in range(24):
        kind, level = "ab"[s % 2], 50.0 * (1 + s % 5)
        for i, m in enumerate(months(72)):
            season = (2.0 if m.month == 12 else 1.0) if kind == "a" else (0.4 if m.month in (6, 7) else 1.0)
            rows.append((f"s{s:02d}", m, kind, round(level * season * float(rng.lognormal(0, 0.1)), 2)))
    rows += [("new", m, "a", 7.0) for m in months(72)[-5:]]
    return spark.createDataFrame(rows, "id string, month date, kind string, y double")


def test_direct_model_is_not_worse_than_the_line(panel):
    cut = date(2022, 7, 1)
    known, truth = panel.filter(F.col("month") < cut), panel.filter((F.col("month") >= cut) & (F.col("id") != "new"))
    model = fit_direct(known, ["kind"], *NAMED)
    direct = model.forecast(known, *NAMED)
    line = monthly_global_forecast(known, ["kind"], *NAMED)
    share = lambda rows: rows.join(truth, ["id", "month"]).agg(F.sum(F.abs(F.col("predicted_y") - F.col("y"))) / F.sum("y")).first()[0]
    assert direct.count() == 24 * 18 and share(direct) < 0.15 and share(direct) <= share(line)
    again = fit_direct(known, ["kind"], *NAMED).forecast(known, *NAMED)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, direct.collect()))


def test_short_series_and_no_rows(panel):
    model = fit_direct(panel, ["kind"], *NAMED)
    new = model.forecast(panel.filter("id = 'new'"), *NAMED).orderBy("step").collect()
    assert [(r["status"], r["predicted_y"]) for r in new] == [("short", 7.0)] * 18 and new[0]["month"] == date(2024, 1, 1)
    assert fit_direct(panel.limit(0), ["kind"], *NAMED) is None
