"""Operators on small fixtures with their edge rows, and properties that must always hold."""

import math
import statistics
from datetime import date, timedelta

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from crewcast import fixed_values as fv
from crewcast.functions import (
    any_like, child_or_parent, first_match, flag_to_int, guarded_ratio, mentions, month_sequence, parse_month_label,
    renamed_key, repaired, row_fingerprint, series_identifier, week_ending_monday,
)
from crewcast.operators import correction, efficiency, evaluate, forecast, marketing, panel, profile, publish, reshape
from crewcast.operators.folds import expanding_folds, held_out_rows, labelled_rows, train_rows
from crewcast.operators.joins import lookup, matching_keys, two_key_group, with_each
from crewcast.operators.latest import latest_version_flag, nth_latest_version

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
DIMS = list(fv.SERIES_DIMS)


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


# --- functions

def test_month_labels(frame):
    df = frame([("Jan_2025",), ("May_2025",), ("December_2024",), ("nonsense",), (None,)], "s string")
    assert one(df, parse_month_label(F.col("s"))) == [date(2025, 1, 1), date(2025, 5, 1), date(2024, 12, 1), None, None]


def test_weeks_end_on_monday(frame):
    df = frame([(date(2024, 1, 1),), (date(2024, 1, 2),), (date(2024, 1, 7),)], "d date")
    assert one(df, week_ending_monday(F.col("d"))) == [date(2024, 1, 1), date(2024, 1, 8), date(2024, 1, 8)]


def test_month_sequence_may_be_empty(frame):
    df = frame([(date(2024, 1, 20), date(2024, 3, 2)), (date(2024, 3, 2), date(2024, 1, 20))], "a date, b date")
    assert one(df, F.size(month_sequence(F.col("a"), F.col("b")))) == [3, 0]


def test_text_and_value_helpers(frame):
    df = frame([("a_b", None, "1"), ("axb", "", "x"), (None, "Y", None)], "s string, flag string, n string")
    assert one(df, any_like(F.col("s"), ["a_b"])) == [True, True, None]
    assert one(df, mentions(F.col("s"), "_B")) == [True, False, None]
    assert one(df, flag_to_int(F.col("n"))) == [1, None, 0]
    assert one(df, renamed_key(F.col("flag"), F.lit("new"), F.lit("old"))) == ["old", "new", "old"]
    assert one(df, series_identifier(["s", "flag"])) == ["a_b None", "axb ", "None Y"]
    assert one(df, child_or_parent(F.col("s"), F.col("flag"), F.lit("p"))) == [None, "", "p"]
    assert one(df, repaired(F.col("s"), {"axb": "fine"})) == ["a_b", "fine", None]
    assert one(df, first_match([(F.col("s") == "axb", "hit"), (F.lit(True), "rest")])) == ["rest", "hit", "rest"]
    assert one(df, guarded_ratio(F.lit(1.0), F.col("n").try_cast("double") - 1)) == [None, None, None]


def test_fingerprint_tells_nulls_from_text(frame):
    df = frame([("a", None), ("a", "null"), ("a", None)], "x string, y string")
    first, second, third = one(df, row_fingerprint(["x", "y"]))
    assert first == third != second


# --- joins

def test_lookup_null_half_and_default(frame, values):
    rows = frame([("a", "x"), ("a", None), ("q", "x")], "k string, l string")
    dim = frame([("a", "x", "hit")], "k string, m string, v string")
    assert values(lookup(rows, dim, {"k": "k", "l": "m"}, "v", "out", "OTHER").select("out")) == [("OTHER",), ("OTHER",), ("hit",)]


def test_two_key_rules(frame, values):
    rows = frame([("p", "QC"), ("p", "ON"), ("p", None), ("w", None), ("z", "QC")], "product string, province string")
    rules = frame([("p", True, "in"), ("p", False, "out"), ("w", None, "any")], "product string, in_home_region boolean, product_group string")
    got = two_key_group(rows, rules, "product", F.col("province") == "QC", "g", "OTHER").select("product", "province", "g")
    assert values(got) == sorted([("p", "QC", "in"), ("p", "ON", "out"), ("p", None, "OTHER"), ("w", None, "any"), ("z", "QC", "OTHER")], key=repr)


def test_with_each_pairs_everything_once(frame, spark):
    left, right = spark.range(13).toDF("a"), spark.range(7).toDF("b")
    pairs = {tuple(r) for r in with_each(left, right).collect()}
    assert len(pairs) == 13 * 7 == with_each(left, right).count()


def test_semi_join_never_repeats(frame):
    rows, keys = frame([(1,), (2,), (None,)], "k int"), frame([(1,), (1,), (None,)], "k int")
    assert one(matching_keys(rows, keys, ["k"]), "k") == [1]


# --- versions

def test_version_flag_and_position(frame, values):
    df = frame([("2024-01", 1), ("2024-02", 2), ("2024-02", 3), (None, 4)], "v string, x int")
    assert values(df.select("x", latest_version_flag(df, "v"))) == [(1, False), (2, True), (3, True), (4, False)]
    assert one(nth_latest_version(df, "v", 1), "v") == ["2024-01"]
    assert nth_latest_version(df, "v", 2).count() == 0


# --- panel

FACTS = [
    (date(2022, 1, 5), "d", "p", None, "INSTALL", "w", 2.0), (date(2022, 1, 9), "d", "p", None, "INSTALL", "w", 3.0),
    (date(2022, 3, 1), "d", "p", "t", "INSTALL", "w", 4.0), (date(2021, 12, 1), "old", "p", "t", "INSTALL", "w", 9.0),
]
FACT_SCHEMA = "day date, " + ", ".join(f"{d} string" for d in DIMS) + ", SWT double"


def test_panel_is_months_times_series(frame):
    out = panel.dense_month_panel(frame(FACTS, FACT_SCHEMA), DIMS, "day", ["SWT"], date(2022, 1, 1), date(2022, 4, 20))
    got = {(r.Series_Identifier, r.Appointment_Month.month): r.SWT for r in out.collect()}
    assert len(got) == 3 * 3 == out.count()
    assert got[("d p None INSTALL w", 1)] == 5 and got[("d p t INSTALL w", 3)] == 4 and got[("old p t INSTALL w", 1)] == 0


def test_scaffold_skips_incomplete_series(frame, values):
    full = panel.dense_month_panel(frame(FACTS, FACT_SCHEMA), DIMS, "day", ["SWT"], date(2022, 1, 1), date(2022, 4, 20))
    out = panel.prediction_scaffold(full, DIMS, "SWT", date(2022, 2, 10), date(2022, 3, 20), 18)
    rows = [r for r in out.collect() if r.District == "d"]
    assert {r.Series_Identifier for r in rows} == {"d p t INSTALL w"}
    assert [(r.Appointment_Month, r.SWT) for r in rows if r.SWT_Type == "actual"] == [(date(2022, 2, 1), 0.0)]
    ahead = sorted(r.Appointment_Month for r in rows if r.SWT_Type == "predicted")
    assert (ahead[0], ahead[-1], len(ahead)) == (date(2022, 3, 1), date(2023, 8, 1), 18)
    assert {r.SWT for r in rows if r.SWT_Type == "predicted"} == {None}


def test_daily_series_sums_and_checks_names(frame):
    df = frame([("a", date(2024, 1, 1), 1.0), ("a", date(2024, 1, 1), 2.0), (None, date(2024, 1, 2), 4.0), ("a", date(2024, 1, 3), 8.0)],
               "k string, day date, y double")
    got = {(r.Series_Identifier, r.day): r.y for r in panel.daily_series(df, ["k"], "day", "y", date(2024, 1, 2)).collect()}
    assert got == {("a", date(2024, 1, 1)): 3.0, ("None", date(2024, 1, 2)): 4.0}
    with pytest.raises(ValueError):
        panel.daily_series(df, ["nope"], "day", "y", date(2024, 1, 2))


def test_forward_fill_twice_changes_nothing(frame):
    df = frame([("k", 1, None), ("k", 2, 5.0), ("k", 3, None), ("k", 4, 7.0), ("k", 5, None)], "k string, o int, v double")
    once = df.withColumn("v", panel.carried_forward("v", ["k"], "o"))
    twice = once.withColumn("v", panel.carried_forward("v", ["k"], "o"))
    assert one(once.orderBy("o"), "v") == one(twice.orderBy("o"), "v") == [None, 5.0, 5.0, 7.0, 7.0]


# --- reshape

def test_unpivot_drops_empty_cells_and_pivot_undoes_it(frame, values):
    wide = frame([("a", 1.0, None), ("b", None, None), ("c", 0.0, 4.0)], "k string, Jan_2025 double, February_2025 double")
    long = reshape.unpivot_months(wide, ["k"])
    assert values(long) == [("a", date(2025, 1, 1), 1.0), ("c", date(2025, 1, 1), 0.0), ("c", date(2025, 2, 1), 4.0)]
    labelled = long.withColumn("m", F.date_format("Month", "MMM_yyyy"))
    assert values(reshape.pivot_labels(labelled, ["k"], "m", ["Jan_2025", "Feb_2025"], "Value")) == [("c", 0.0, 4.0)]
    with pytest.raises(ValueError):
        reshape.unpivot_months(wide.select("k"), ["k"])


# --- folds

@FEW
@given(st.integers(1, 60), st.integers(1, 5), st.integers(0, 400))
def test_folds_tile_time(horizon, count, offset):
    folds = expanding_folds(date(2022, 1, 1), date(2022, 6, 1) + timedelta(days=offset), horizon, count)
    for fold in folds:
        assert fold.train_end + timedelta(days=1) == fold.test_start
        assert (fold.test_end - fold.test_start).days == horizon - 1
    for a, b in zip(folds, folds[1:]):
        assert a.test_end == b.train_end


def test_reference_folds_end_as_published():
    assert expanding_folds(fv.CALENDAR_START, fv.FIRST_TRAIN_END, fv.DAILY_HORIZON)[-1].test_end == date(2025, 3, 30)


def test_fold_rows_on_the_boundaries(frame, values):
    folds = expanding_folds(date(2024, 1, 1), date(2024, 1, 10), 5, 2)
    days = [date(2023, 12, 31)] + [date(2024, 1, d) for d in (1, 10, 11, 15, 16, 20, 21)]
    df = frame([(d,) for d in days], "d date")
    train, test = train_rows(df, "d", folds), held_out_rows(df, "d", folds)
    assert values(test) == [(date(2024, 1, 11), 1), (date(2024, 1, 15), 1), (date(2024, 1, 16), 2), (date(2024, 1, 20), 2)]
    assert values(train) == sorted([(date(2024, 1, d), k) for k, last in ((1, 10), (2, 15)) for d in (1, 10, 11, 15) if d <= last], key=repr)
    both = labelled_rows(df, "d", folds)
    assert values(both.filter("dataset_type = 'test'").drop("dataset_type")) == values(test)
    assert values(both.filter("dataset_type = 'train'").drop("dataset_type")) == values(train)


# --- forecasts

def series(frame, values, name="s", start=date(2024, 1, 1)):
    rows = [(name, 1, start + timedelta(days=i), v) for i, v in enumerate(values)]
    return frame(rows, "series_id string, split_index int, ds date, y double")


def recursive_mean(values, window, horizon):
    state, out = list(values[-window:]), []
    for _ in range(horizon):
        out.append(sum(state) / len(state))
        state = state[1:] + [out[-1]]
    return out


@FEW
@given(st.lists(st.floats(0, 1000), min_size=1, max_size=12), st.integers(1, 8), st.integers(1, 15))
def test_moving_average_against_plain_python(frame, values, window, horizon):
    out = forecast.moving_average_forecast(series(frame, values), window, horizon).orderBy("step").collect()
    assert [r.yhat for r in out] == pytest.approx(recursive_mean(values, window, horizon), abs=1e-6)
    last = date(2024, 1, 1) + timedelta(days=len(values) - 1)
    assert [r.ds for r in out] == [last + timedelta(days=i) for i in range(1, horizon + 1)]


def test_moving_average_nulls(frame):
    df = series(frame, [1.0, None, 3.0])
    assert set(one(forecast.moving_average_forecast(df, 3, 2), "yhat")) == {None}
    assert one(forecast.moving_average_forecast(df, 3, 2, "skip"), "yhat") == [2.0, 2.5]
    assert one(forecast.moving_average_forecast(df, 1, 2), "yhat") == [3.0, 3.0]


def least_squares(y, horizon, season=7):
    """The same candidates fitted with numpy."""
    y = np.array(y)
    target, a, b = y[season:], y[season - 1:-1], y[:-season]
    best = None
    for name, columns in (("mean", []), ("lag", [a]), ("season", [b]), ("lag+season", [a, b])):
        x = np.column_stack([np.ones(len(target)), *columns])
        beta, *_ = np.linalg.lstsq(x, target, rcond=None)
        n, k = len(target), len(beta) + 1
        score = n * math.log(np.mean((target - x @ beta) ** 2)) + 2 * k + 2 * k * (k + 1) / (n - k - 1)
        if best is None or score < best[0]:
            best = (score, name, beta)
    _, name, beta = best
    state = list(y[-season:])
    for _ in range(horizon):
        lags = {"mean": [], "lag": [state[-1]], "season": [state[-season]], "lag+season": [state[-1], state[-season]]}[name]
        state.append(beta[0] + sum(w * v for w, v in zip(beta[1:], lags)))
    return name, state[season:]


@pytest.mark.parametrize("seed, ar, seasonal", [(1, 0.0, 0.0), (2, 0.8, 0.0), (3, 0.0, 0.9), (4, 0.5, 0.4)])
def test_seasonal_regression_against_numpy(frame, seed, ar, seasonal):
    rng = np.random.default_rng(seed)
    y = [float(v) for v in rng.normal(100, 10, 7)]
    for i in range(150):
        y.append(float(100 * (1 - ar - seasonal) + ar * y[-1] + seasonal * y[-7] + rng.normal(0, 3)))
    out = forecast.seasonal_regression_forecast(series(frame, y), 20).orderBy("step").collect()
    name, path = least_squares(y, 20)
    assert out[0].orders == name and out[0].status == "ok"
    assert [r.yhat for r in out] == pytest.approx(path, rel=1e-6)


def test_seasonal_regression_short_and_flat(frame):
    short = forecast.seasonal_regression_forecast(series(frame, [1.0, 2.0, 3.0]), 2).collect()
    flat = forecast.seasonal_regression_forecast(series(frame, [5.0] * 60), 2).collect()
    assert [(r.status, r.yhat) for r in short] == [("short", 2.0)] * 2
    assert [(r.status, r.yhat) for r in flat] == [("flat", 5.0)] * 2


def test_global_forecast_recovers_a_shared_rule(frame):
    """Swinging series that follow one rule of two months are continued exactly; a short one stays at its mean."""
    rows, truth = [], {}
    for k in range(6):
        y = [10.0 * k + 3, 25.0 - k]
        while len(y) < 45:
            y.append(1.2 * y[-1] - y[-2] + 4.0)
        rows += [(f"s{k}", date(2020 + i // 12, i % 12 + 1, 1), "d" if k else None, v) for i, v in enumerate(y[:42])]
        truth |= {(f"s{k}", date(2023, 7 + i, 1)): v for i, v in enumerate(y[42:])}
    rows += [("brief", date(2023, m, 1), "e", float(m)) for m in (4, 5, 6)]
    df = frame(rows, "id string, m date, District string, y double")
    out = forecast.monthly_global_forecast(df, ["District"], "id", "m", "y", horizon=3, context=4).collect()
    assert {(r.id, r.m): r.predicted_y for r in out if r.status == "ok"} == pytest.approx(truth, abs=1e-6)
    assert [(r.id, r.predicted_y, r.status) for r in out if r.id == "brief"] == [("brief", 5.0, "short")] * 3
    assert forecast.monthly_global_forecast(df.limit(0), ["District"], "id", "m", "y").collect() == []


def test_collinear_features_get_no_weight():
    assert forecast.solved([[2.0, 4.0, 0.0], [4.0, 8.0, 0.0], [0.0, 0.0, 0.0]], [6.0, 12.0, 0.0]) == [3.0, 0.0, 0.0]


def test_forecast_counts(frame):
    train = series(frame, [1.0, 2.0]).union(series(frame, [None, 3.0], "bad"))
    out = forecast.forecast_counts(train, forecast.moving_average_forecast(train, 5, 2)).collect()[0]
    assert tuple(out) == (2, 1, 0.5)


# --- scores

def test_metrics_by_tier(frame):
    pairs = frame([("a Tier 1", 1, 10.0, 12.0), ("a Tier 1", 1, 0.0, 0.0), ("b Tier 2 x", 1, 0.0, 3.0), ("z", 1, 5.0, 1.0)],
                  "series_id string, split_index int, y double, yhat double")
    got = {r.scope: r for r in evaluate.forecast_metrics(pairs, evaluate.tier_in(F.col("series_id"))).collect()}
    assert set(got) == {"Tier 1", "Tier 2", "Overall"}
    assert (got["Tier 1"].MAE, got["Tier 1"].Bias) == (1.0, 1.0) and got["Tier 1"].RMSE == pytest.approx(math.sqrt(2))
    assert got["Tier 2"].WAPE == pytest.approx(3 / 1e-8)
    assert got["Overall"].MAE == pytest.approx(9 / 4) and got["Overall"].WAPE == pytest.approx(9 / 15)


def test_alignment_with_a_missing_day(frame, values):
    known = series(frame, [1.0, 2.0, 4.0])
    ahead = forecast.moving_average_forecast(known, 3, 4)
    test = series(frame, [10.0, 20.0, 30.0], start=date(2024, 1, 4)).filter(F.col("ds") != date(2024, 1, 5)).union(
        series(frame, [99.0], start=date(2024, 3, 1)))
    means = [r.yhat for r in ahead.orderBy("step").collect()]
    assert values(evaluate.align_by_date(test, ahead).select("y", "yhat")) == [(10.0, means[0]), (30.0, means[2])]
    assert values(evaluate.align_by_position(test, ahead).select("y", "yhat")) == [(10.0, means[0]), (30.0, means[1])]


# --- profile

@FEW
@given(st.lists(st.integers(-40, 40), min_size=1, max_size=60))
def test_exact_median_of_small_sets(frame, numbers):
    df = frame([("g", float(n)) for n in numbers] + [("g", None), ("empty", None)], "g string, v double")
    assert {r.g: r.median for r in profile.exact_median(df, ["g"], "v").collect()} == {"g": statistics.median(numbers)}


@pytest.mark.parametrize("size", [9_999, 20_000])
def test_exact_median_with_a_coarse_sketch_and_a_hot_value(spark, size):
    """A sketch of accuracy 50 forces a wide bracket; a third of the rows share one value."""
    df = spark.range(size).select(
        (F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 9 < 3, F.lit(0.5)).otherwise(F.pmod(F.xxhash64("id"), F.lit(100_003)) / 1000.0).alias("v"),
    )
    by_group = {}
    for row in df.collect():
        by_group.setdefault(row.g, []).append(row.v)
    got = {r.g: r.median for r in profile.exact_median(df, ["g"], "v", accuracy=50).collect()}
    assert got == {g: statistics.median(v) for g, v in by_group.items()}


def split(frame, rows):
    return frame(rows, "dataset_type string, split_index int, d date, y double, c string")


def test_profiles(frame, values):
    day = date(2024, 1, 1)
    rows = split(frame, [("train", 1, day, 1.0, "a"), ("train", 1, day, 4.0, "a"), ("train", 1, day, None, None), ("test", 1, day, 9.0, "b")])
    stats = {(r.dataset_type, r.split_number): r for r in profile.numeric_profile(rows, "d", "y").collect()}
    assert stats[("train", 1)].median == 2.5 and stats[("train", 1)].total_rows == 3
    assert stats[("test", 1)].std is None and stats[("overall", 0)].median == 4.0 and stats[("overall", 0)].total == 14.0
    assert ("train", 1, "c", 1) in values(profile.null_counts(rows, ["y", "c"]))
    assert values(profile.split_counts(rows)) == [(1, 3, 1)]
    tops = [tuple(r) for r in profile.category_profile(rows, ["c"]).filter("dataset_type = 'overall'").orderBy("rank").collect()]
    assert tops == [("overall", 0, "c", 1, "a", 2, 2, 50.0), ("overall", 0, "c", 2, "b", 1, 2, 25.0)]


def test_top_values_break_ties_by_value(frame):
    rows = split(frame, [("train", 1, None, 0.0, v) for v in "gfedcba"])
    tops = profile.category_profile(rows, ["c"]).filter("dataset_type = 'train'").orderBy("rank")
    assert one(tops, "value") == list("abcde")


def test_empty_weeks_are_zero(frame, values):
    df = frame([(date(2024, 1, 1), 1.0), (date(2024, 1, 2), 2.0), (date(2024, 1, 22), 4.0)], "d date, y double")
    assert dict(values(profile.weekly_sums(df, "d", "y"))) == {
        date(2024, 1, 1): 1.0, date(2024, 1, 8): 2.0, date(2024, 1, 15): 0.0, date(2024, 1, 22): 4.0}


# --- unit volumes

def test_volume_calendar_edges(frame):
    sheet = frame([(1, 2024, "a", "Gross Adds", 10, 11, None), (2, 2024, "a", "Gross Adds", 20, 22, None),
                   (3, 2024, "a", "Gross Adds", 30, 33, None), (1, 2024, "b", "Net Adds", 5, 5, None)],
                  "Month bigint, Year bigint, Product string, RGU_Type string, Original_Actual bigint, Adjusted_Actual bigint, Notes string")
    got = {(r.Product, r.Appointment_Month.month): (r.Actual_RGU, r.Forecasted_RGU, r.Adjusted_RGU)
           for r in marketing.volume_calendar(sheet, date(2024, 2, 20)).collect()}
    assert got == {("a", 1): (0, 0, 0), ("a", 2): (11, 20, 22), ("a", 3): (0, 30, 33),
                   ("b", 1): (0, 0, 0), ("b", 2): (0, 0, 0), ("b", 3): (0, 0, 0)}


# --- correction

def hours(frame, actual, predicted, product="p", version="v"):
    month = lambda i: date(2024 + i // 12, i % 12 + 1, 1)
    rows = [(month(i), None, product, float(v), "Actual") for i, v in enumerate(actual)]
    rows += [(month(i), version, product, float(v), "Predicted") for i, v in predicted.items()]
    return frame(rows, "Appointment_Month date, Forecast_Date string, Product string, SWT double, SWT_Type string")


def volumes(frame, numbers, product="p"):
    rows = [(date(2024 + i // 12, i % 12 + 1, 1), product, 0, n, n + (i % 2)) for i, n in numbers.items()]
    return frame(rows, "Appointment_Month date, Product string, Actual_RGU bigint, Forecasted_RGU bigint, Adjusted_RGU bigint")


def by_hand(actual, predicted, driver, lag, alpha):
    """Corrected prediction per month, written out with plain loops."""
    rows = [(i, v, "A") for i, v in enumerate(actual)] + [(i, v, "P") for i, v in predicted.items()]
    shifted = {i + lag: n for i, n in driver.items()}
    low, high = min(v for _, v, _ in rows), max(v for _, v, _ in rows)
    width = (high - low) or 1.0
    seen = [shifted[i] for i, _, _ in rows if i in shifted]
    r_low, r_width = (min(seen), (max(seen) - min(seen)) or 1.0) if seen else (0, 1.0)
    out = {}
    for i, v, kind in rows:
        if kind == "P":
            scaled = (v - low) / width
            error = scaled - (shifted[i] - r_low) / r_width if i in shifted else 0.0
            out[i] = (scaled - alpha * error) * width + low
    return out


ACTUAL, PREDICTED, DRIVER = [10, 12, 9, 15, 11, 13], {3: 18.0, 4: 9.0, 5: 16.0, 6: 14.0, 7: 20.0}, {0: 5, 2: 9, 3: 4, 4: 8, 5: 6}


def test_grid_and_application_against_plain_loops(frame):
    df, vol = hours(frame, ACTUAL, PREDICTED), volumes(frame, DRIVER)
    best = {r.variant: r for r in correction.best_settings(df, vol, "v", lags=(1, 2)).collect()}
    for variant, driver in (("Forecasted", DRIVER), ("Adjusted", {i: n + (i % 2) for i, n in DRIVER.items()})):
        options = []
        for lag in (1, 2):
            for alpha in fv.CORRECTION_ALPHAS:
                fixed = by_hand(ACTUAL, PREDICTED, driver, lag, alpha)
                rmse = math.sqrt(statistics.mean((fixed[i] - ACTUAL[i]) ** 2 for i in (3, 4, 5)))
                options.append((rmse, lag, alpha))
        rmse, lag, alpha = min(options)
        assert (best[variant].lag, best[variant].alpha) == (lag, alpha) and best[variant].rmse == pytest.approx(rmse)
    out = {r.Appointment_Month: r for r in correction.corrections(df, vol, "v", "v", (1, 2)).collect()}
    f, a = best["Forecasted"], best["Adjusted"]
    expected = by_hand(ACTUAL, PREDICTED, DRIVER, f.lag, f.alpha)
    listed = {i for i in PREDICTED if i - f.lag in DRIVER}
    assert {m.month - 1 for m in out} == listed
    for month, row in out.items():
        assert row.SWT_Forecasted_RGU == pytest.approx(expected[month.month - 1])
        assert (row.Lag_Correction_Adjusted, row.Alpha_Correction_Adjusted, row.Forecast_Date) == (a.lag, a.alpha, "v")
        assert (row.SWT_Adjusted_RGU is None) == (month.month - 1 - a.lag not in DRIVER)


def test_correction_identities(frame):
    df = hours(frame, [7, 7], {0: 7.0, 1: 7.0})
    runs = correction.version_rows(df, "v").withColumns({"variant": F.lit("Forecasted"), "lag": F.lit(1)})
    flat = correction.scaled_error(runs, correction.driver_sums(volumes(frame, {0: 3})))
    rows = {(r.SWT_Type, r.Appointment_Month.month): r.SWT_Corrected for r in correction.corrected_hours(flat, F.lit(0.5)).collect()}
    assert rows == {("Actual", 1): 7.0, ("Actual", 2): 7.0, ("Predicted", 1): 7.0, ("Predicted", 2): 7.0}
    df = hours(frame, ACTUAL, PREDICTED)
    runs = correction.version_rows(df, "v").withColumns({"variant": F.lit("Adjusted"), "lag": F.lit(1)})
    same = correction.corrected_hours(correction.scaled_error(runs, correction.driver_sums(volumes(frame, DRIVER))), F.lit(0.0))
    assert same.filter("SWT != SWT_Corrected").count() == 0


def test_first_of_equal_settings_wins_and_other_products_drop(frame, values):
    """No driver value falls on a predicted month, so every alpha gives the same error."""
    df = hours(frame, [1, 2, 3], {1: 5.0, 2: 6.0}).union(hours(frame, [1], {0: 2.0}, "unlisted"))
    got = correction.best_settings(df, volumes(frame, {7: 3}), "v", lags=(1, 2))
    assert values(got.select("Product", "variant", "lag", "alpha")) == [("p", "Adjusted", 1, 0.0), ("p", "Forecasted", 1, 0.0)]


def test_driver_with_missing_part_counts_as_zero(frame, values):
    vol = frame([(date(2024, 1, 1), "p", None, 4, 5)], "Appointment_Month date, Product string, Actual_RGU bigint, Forecasted_RGU bigint, Adjusted_RGU bigint")
    assert values(correction.driver_sums(vol).select("variant", "rgu_values")) == [("Adjusted", 0.0), ("Forecasted", 0.0)]


# --- efficiency rules

DISTRICTS = [("d1", "Tier 1", "QC"), ("d2", "Tier 2", "ON"), ("d3", "Tier 2", "NU"), ("d4", None, None), ("two", "Tier 1", "AB"), ("two", "Tier 1", "BC")]


def rules(frame, spec, extra=""):
    return efficiency.with_rule_key(frame(spec, "Products_Impacted string, Job_Types_Impacted string, Region_Impacted string" + extra))


@pytest.mark.parametrize("region, expected", [
    ("All", ["d1", "d2", "d3", "d4", "two", "two"]), ("Tier 2", ["d2", "d3"]), ("QC", ["d1"]), ("NU & NT", ["d3"]),
    ("d4", ["d4"]), ("nowhere", []), ("NU", []), ("two", ["two", "two"]),
])
def test_rule_scopes(frame, region, expected):
    known = frame(DISTRICTS, "district string, region_type string, province string")
    assert sorted(one(efficiency.rule_districts(rules(frame, [("POTS", "Install", region)]), known), "district")) == expected


def test_rule_targets(frame):
    known = frame(DISTRICTS, "district string, region_type string, province string")
    def targets(*rule):
        return sorted(tuple(r) for r in efficiency.rule_targets(rules(frame, [rule]), known).select("product", "job_type", "district").collect())
    assert targets("POTS", "Install", "d2") == [("POTS", "INSTALL", "d2")]
    assert len(targets("Managed", fv.ALL_JOB_TYPES_RULE, "d1")) == len(fv.MANAGED_HOME) * 8
    assert targets("Unmanaged", "Repair", "d1") == sorted((p, "REPAIR", "d1") for p in fv.UNMANAGED_HOME)
    assert len(targets("All", "Repair", "d4")) == 22 and targets("OTHER", "Repair", "d1") == []
    assert targets("Managed", "Repair", "d4") == [("Managed", "REPAIR", "d4")]  # province unknown
    assert len(targets("POTS", "Repair", "two")) == 4  # two listings, matched on the name alone


def test_reductions(frame):
    lookup_rows = frame([("ON", "d2", "Tier 2"), ("QC", "d1", "Tier 1")], "province string, district_old string, region_type string")
    plan = frame([("POTS", "Install", "d2", "50 %", 0.5, None, 0.7, 0.9), ("POTS", "Install", "d1", "Hours", 10.0, 6.0, 3.0, None)],
                 "Products_Impacted string, Job_Types_Impacted string, Region_Impacted string, Type_of_Reduction string, "
                 "Jan_2025 double, Feb_2025 double, Mar_2025 double, Apr_2025 double")
    ahead = frame([("2025-02-15 10:00:00", m, d, "POTS", "INSTALL", "Predicted" if d == "d2" else "predicted", (v,))
                   for m, d, v in [("2025-01-01", "d2", 5.0), ("2025-03-01", "d2", 5.0), ("2025-02-01", "d1", 8.0), ("2025-02-01", "d1", 4.0),
                                   ("2025-03-01", "d1", 0.0)]],
                  "Forecast_Date string, Appointment_Month string, District string, Product string, Work_Order_Action string, SWT_Type string, predicted_SWT struct<value: double>")
    got = sorted((r.district, r.appointment_month.month, r.efficiency_reduction)
                 for r in efficiency.efficiency_reductions(plan, lookup_rows, ahead).collect())
    assert got == [("d1", 2, 0.5), ("d1", 3, 0.5), ("d2", 3, 0.7)]


def test_identical_rules_stay_apart(frame):
    keyed = rules(frame, [("POTS", "Install", "d2")] * 2)
    assert len(set(one(keyed, "efficiency_uid"))) == 2


# --- published tables

LOOKUP = [("QC", "d1", "Tier 1"), ("ON", "d2", "Tier 2")]
LOOKUP_SCHEMA = "province string, district_old string, region_type string"
AHEAD_SCHEMA = "Forecast_Date string, Appointment_Month string, " + ", ".join(f"{d} string" for d in DIMS) + ", predicted_SWT struct<value: double>"


def cube_facts(frame):
    rows = [(date(2022, 1, 10), "d1", "POTS", "t", "INSTALL", "w", "Install", "Unmanaged", 2.0, 1.0), (date(2022, 1, 20), "d1", "POTS", "t", "INSTALL", "w", "Install", "Unmanaged", 3.0, 1.0),
            (date(2022, 3, 5), "d1", "POTS", "t", "INSTALL", "w", "Install", "Unmanaged", 9.0, 9.0), (date(2022, 1, 5), "d9", "POTS", None, "PROJECT", "w", "PROJECT", "Managed BI", 7.0, 7.0),
            (date(2022, 1, 5), "d1", "POTS", "t", "OTHER", "w", "OTHER", "Unmanaged", 7.0, 7.0), (date(2022, 1, 5), "d1", "POTS", "t", "INSTALL", "QX", "Install", "Unmanaged", 7.0, 7.0)]
    return frame(rows, "Appointment_Timestamp date, " + ", ".join(f"{d} string" for d in DIMS) + ", Work_Order_Action_Grp string, Product_Grp string, SWT double, AWT double")


def test_display_cube(frame):
    ahead = frame([("2022-02-10 08:00:00", "2022-02-01", "d1", "POTS", "t", "INSTALL", "w", (5.0,)), ("2022-02-10 08:00:00", "2022-03-01", "d1", "POTS", "t", "INSTALL", "w", (6.0,)),
                   ("2022-03-10 08:00:00", "2022-03-01", "d1", "POTS", "t", "INSTALL", "w", (8.0,)), ("2022-03-10 08:00:00", "2022-03-01", "d1", "POTS", "t", "INSTALL", "w", (8.5,))], AHEAD_SCHEMA)
    wide = frame([("POTS", "Install", "d2", "ok", 4.0, 0.0, None, 9.0), ("POTS", "Install", "d2", "to EXCLUDE", 1.0, 1.0, 1.0, 1.0), ("CPS", "Repair", "zz", None, 1.0, 1.0, 1.0, 1.0)],
                 "Product string, Job_Type string, Region string, Notes string, March_2022 double, April_2022 double, May_2022 double, December_2024 double")
    lookup_rows = frame(LOOKUP, LOOKUP_SCHEMA)
    planned = publish.special_project_hours(wide, lookup_rows)
    cube = publish.display_cube(cube_facts(frame), ahead, lookup_rows, planned, date(2022, 3, 20))
    rows = cube.collect()
    assert cube.columns == publish.CUBE_COLUMNS
    mine = {(r.Forecast_Date, r.Appointment_Month): r for r in rows if r.District == "d1"}
    first, second = date(2022, 2, 10), date(2022, 3, 10)
    assert len([m for v, m in mine if v == first]) == 19 and len([m for v, m in mine if v == second]) == 20
    january = mine[(first, date(2022, 1, 1))]
    assert (january.SWT_Historical, january.AWT_Historical, january.SWT_Predicted, january.Region_Type, january.Product_Grp) == (5.0, 2.0, None, "Tier 1", "Unmanaged")
    march = mine[(first, date(2022, 3, 1))]
    assert (march.SWT_Historical, march.SWT_Predicted) == (None, 6.0)  # March is not over yet
    assert sorted(r.SWT_Predicted for r in rows if (r.District, r.Forecast_Date, r.Appointment_Month) == ("d1", second, date(2022, 3, 1))) == [8.0, 8.5]
    lone = [r for r in rows if r.District == "d9"]
    assert len(lone) == 39 and {(r.SWT_Historical, r.SWT_Predicted) for r in lone} == {(None, None)} and lone[0].Product_Grp == "Managed"
    projects = sorted((r.Forecast_Date, r.Appointment_Month, r.SWT_Predicted, r.Region_Type, r.Work_Order_Action) for r in rows if r.District == "d2")
    assert projects == [(first, date(2022, 3, 1), 4.0, "Tier 2", "INSTALL"), (second, date(2022, 3, 1), 4.0, "Tier 2", "INSTALL")]
    assert publish.special_project_hours(wide, lookup_rows, keep_null_notes=True).filter("District = 'zz'").count() == 4


def test_project_window_starts_a_month_before_the_version_day(frame):
    projects = frame([(date(2024, m, 1), 1.0) for m in (1, 2, 3)], "Appointment_Month date, SWT_Project double")
    versions = frame([("2024-03-01 00:00:00",), ("2024-03-02 00:00:00",)], "Forecast_Date string")
    got = sorted((r.Forecast_Date[:10], r.Appointment_Month.month) for r in publish.projects_by_version(projects, versions).collect())
    assert got == [("2024-03-01", 2), ("2024-03-01", 3), ("2024-03-02", 3)]


def test_display_union_and_export(frame):
    month_rows = panel.dense_month_panel(publish.series_facts(cube_facts(frame)), DIMS, "Appointment_Timestamp", ["SWT", "AWT"], date(2022, 1, 1), date(2022, 4, 5))
    ahead = frame([(v, "2022-04-01", "FFB - Calgary", "POTS", None, "INSTALL", "w", (5.0,)) for v in ("2022-03-01", "2022-04-01")], AHEAD_SCHEMA)
    rows = publish.display_union(month_rows, ahead, date(2022, 4, 5)).collect()
    actual = sorted(r.Appointment_Month for r in rows if r.SWT_Type == "Actual")
    assert actual == [date(2022, 1, 1), date(2022, 2, 1)]  # March settles only eleven days after its end
    ahead_rows = {r.Forecast_Date: r for r in rows if r.SWT_Type == "Predicted"}
    assert {v: r.Is_Latest_Forecast for v, r in ahead_rows.items()} == {"2022-03-01": False, "2022-04-01": True}
    assert ahead_rows["2022-04-01"].Region_Type == "Tier 1" and ahead_rows["2022-04-01"].Series_Identifier == "FFB - Calgary POTS None INSTALL w"
    export = publish.export_rows(publish.display_union(month_rows, ahead, date(2022, 4, 5)))
    months = [r.Appointment_Month for r in export.collect()]
    assert months == sorted(months, reverse=True) and "Job Type" in export.columns
