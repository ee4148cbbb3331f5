"""Forecasts per series and fold.

Input frames hold one row per series, fold and day, so a group is never longer than the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from crewcast.fixed_values import MONTHLY_CONTEXT, MONTHLY_HORIZON
from crewcast.session import shared_folder
from crewcast.sources.tables import written

GROUP = ("series_id", "split_index")


def trailing_window(train: DataFrame, window: int, day: str = "ds", target: str = "y") -> DataFrame:
    """The last ``window`` rows of each series and fold.

    Spark drops rows beyond the limit before the shuffle as well as after it.
    """
    order = Window.partitionBy(*GROUP).orderBy(F.col(day).desc(), F.col(target).desc())
    return train.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= window).drop("_rank")


def forecast_rows(groups: DataFrame, model: str, extra: Sequence[str] = ()) -> DataFrame:
    """One row per step from an array column ``_path``, dated from the day after ``_last``.

    The plain ``posexplode`` would test the path for rows first, in a filter that computes the whole recursion once more.
    """
    steps = groups.select(*GROUP, "_last", *extra, F.posexplode_outer("_path").alias("_pos", "yhat")).filter(F.col("_pos").isNotNull())
    step = F.col("_pos") + 1
    return steps.select(
        F.lit(model).alias("model"), *GROUP, F.date_add("_last", step).alias("ds"), step.alias("step"), "yhat", *extra
    )


def moving_average_forecast(train: DataFrame, window: int, horizon: int, nulls: str = "propagate") -> DataFrame:
    """Recursive moving average: each forecast is the mean of the window and then joins it.

    A series shorter than ``window`` uses all its values. With ``nulls="propagate"`` a null in the
    window makes that forecast null; ``"skip"`` leaves null rows out. The state of the recursion is
    the running sum and the path so far, all inside one expression.
    """
    if nulls not in ("propagate", "skip"):
        raise ValueError(nulls)
    source = train.filter(F.col("y").isNotNull()) if nulls == "skip" else train
    groups = trailing_window(source, window).groupBy(*GROUP).agg(
        F.max("ds").alias("_last"),
        F.sort_array(F.collect_list(F.struct("ds", F.col("y").cast("double").alias("y")))).alias("_pairs"),
    )
    groups = groups.withColumn("_w", F.col("_pairs")["y"]).withColumn("_n", F.size("_w"))
    total = F.aggregate("_w", F.lit(0.0), lambda acc, x: acc + x)
    start = F.struct(total.alias("total"), F.array().cast("array<double>").alias("path"))

    def advance(state: Column, step: Column) -> Column:
        forecast = state["total"] / F.col("_n")
        leaving = F.when(step <= F.col("_n"), F.get("_w", step - 1)).otherwise(
            F.get(state["path"], step - 1 - F.col("_n"))
        )
        return F.struct(
            (state["total"] - leaving + forecast).alias("total"),
            F.concat(state["path"], F.array(forecast)).alias("path"),
        )

    path = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, advance, lambda state: state["path"])
    return forecast_rows(groups.withColumn("_path", path), "SMA")


def seasonal_regression_forecast(
    train: DataFrame, horizon: int, season: int = 7, min_rows: int = 28
) -> DataFrame:
    """Seasonal autoregression with automatic order choice.

    Candidates regress a value on nothing, on the previous one, on the one a season back, or on
    both; all are fitted by least squares on the same rows, and the lowest corrected information
    criterion (AICc) wins, the smaller model on a tie. Fitting needs only means and covariances per
    series and fold, which Spark aggregates; the chosen recursion is then unrolled in one
    expression. ``status`` is ``short`` or ``flat`` for groups that get their mean instead.
    """
    c = F.col
    by_day = Window.partitionBy(*GROUP).orderBy("ds")
    lagged = train.filter(c("y").isNotNull()).select(
        *GROUP, "ds", c("y").cast("double").alias("y")
    ).select(
        *GROUP, "ds", "y", F.lag("y", 1).over(by_day).alias("a"), F.lag("y", season).over(by_day).alias("b"),
        F.array(*[F.lag("y", i).over(by_day) for i in range(season - 1, 0, -1)], "y").alias("recent"),
    )
    used = c("b").isNotNull()

    def mean(name: str) -> Column:
        return F.avg(F.when(used, c(name))).alias(f"m_{name}")

    def covariance(left: str, right: str) -> Column:
        return F.covar_pop(F.when(used, c(left)), F.when(used, c(right))).alias(f"{left}{right}")

    fits = lagged.groupBy(*GROUP).agg(
        F.max("ds").alias("_last"),
        F.avg("y").alias("level"),
        F.count("b").cast("double").alias("n"),
        F.max_by("recent", "ds").alias("tail"),
        mean("y"), mean("a"), mean("b"),
        *[covariance(*pair) for pair in ("yy", "aa", "bb", "ab", "ay", "by")],
    )
    det = c("aa") * c("bb") - c("ab") * c("ab")
    solvable = det > 1e-9 * c("aa") * c("bb")
    zero = F.lit(0.0)
    candidates = [
        ("mean", 1, zero, zero),
        ("lag", 2, F.when(c("aa") > 0, c("ay") / c("aa")), zero),
        ("season", 2, zero, F.when(c("bb") > 0, c("by") / c("bb"))),
        (
            "lag+season", 3,
            F.when(solvable, (c("bb") * c("ay") - c("ab") * c("by")) / det),
            F.when(solvable, (c("aa") * c("by") - c("ab") * c("ay")) / det),
        ),
    ]

    def scored(rank: int, name: str, terms: int, a: Column, b: Column) -> Column:
        # A perfect fit leaves rounding noise only; the floor lets the smallest such model win.
        spread = F.greatest(c("yy") - a * c("ay") - b * c("by"), 1e-12 * c("yy"))
        k = terms + 1
        score = c("n") * F.log(spread) + 2.0 * k + 2.0 * k * (k + 1) / (c("n") - k - 1)
        fit = F.struct(
            score.alias("score"), F.lit(rank).alias("rank"), F.lit(name).alias("orders"), a.alias("a"), b.alias("b")
        )
        return F.when(a.isNotNull() & b.isNotNull(), fit)

    best = F.array_min(F.array_compact(F.array(*[scored(i, *cand) for i, cand in enumerate(candidates)])))
    status = F.when(c("n") < min_rows, "short").when(~(c("yy") > 0), "flat").otherwise("ok")
    fits = fits.withColumn("status", status).withColumn("best", F.when(c("status") == "ok", best))
    fits = fits.withColumn("orders", F.coalesce("best.orders", F.lit("mean")))
    shift = c("m_y") - c("best.a") * c("m_a") - c("best.b") * c("m_b")

    def advance(state: Column, _: Column) -> Column:
        ahead = shift + c("best.a") * F.element_at(state, -1) + c("best.b") * F.element_at(state, -season)
        return F.concat(state, F.array(ahead))

    fitted = F.slice(
        F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), c("tail"), advance), season + 1, horizon
    )
    path = F.when(c("status") == "ok", fitted).otherwise(F.array_repeat("level", horizon))
    return forecast_rows(fits.withColumn("_path", path), "SEASONAL_AR", ("orders", "status"))


#: A feature whose remaining sum of squares is at most this share of its own is explained by those before it.
COLLINEAR = 1e-10
#: Rows by which an attribute value's mean is pulled to the overall mean.
SMOOTHING = 10


def solved(sums: list[list[float]], right: list[float]) -> list[float]:
    """Least-squares weights from sums of products, by elimination in the order of the features; a collinear one gets 0."""
    own = [sums[i][i] for i in range(len(right))]
    table = [[*row, r] for row, r in zip(sums, right)]
    for k, size in enumerate(own):
        pivot = table[k][k]
        if pivot > COLLINEAR * size:
            line = [x / pivot for x in table[k]]
            table = [line if i == k else [x - row[k] * y for x, y in zip(row, line)] for i, row in enumerate(table)]
        else:
            table[k] = [0.0] * len(table[k])
    return [row[-1] for row in table]


def monthly_global_forecast(
    panel: DataFrame,
    attributes: Sequence[str],
    identifier: str,
    month: str,
    target: str,
    horizon: int = MONTHLY_HORIZON,
    context: int = MONTHLY_CONTEXT,
) -> DataFrame:
    """One least-squares model over all series: last ``context`` months, season and attributes.

    Squared error is pooled over all series. An attribute enters as the smoothed deviation of its value's mean, joined
    by value, so a wide attribute costs no more than a narrow one. Fitting is one aggregation of products of features;
    only those sums, whose number does not depend on the data, reach the driver. Effects of a decimal target are
    rounded to its scale. Every series is then unrolled ``horizon`` months in one expression. A series without ``context`` full months
    before its last one continues at its mean with the status ``short``. ``panel`` must be dense.
    """
    spark, kind = panel.sparkSession, panel.schema[target].dataType
    number = kind.simpleString() if isinstance(kind, T.DecimalType) else "double"
    by_month = Window.partitionBy("id").orderBy("month")
    names = [f"attribute_{i}" for i in range(len(attributes))]
    rows = panel.select(
        F.col(identifier).alias("id"), F.col(month).alias("month"), F.col(target).cast(number).alias("label"),
        *[F.coalesce(F.col(a), F.lit("None")).alias(n) for a, n in zip(attributes, names)],
    )
    lags = [f"lag_{k}" for k in range(1, context + 1)]
    rows = rows.select("*", *[F.lag("label", k).over(by_month).cast("double").alias(n) for k, n in enumerate(lags, 1)],
                       F.lead("month").over(by_month).isNull().alias("newest"),
                       F.avg(F.col("label").cast("double")).over(Window.partitionBy("id")).alias("level"))
    whole = F.col("label").isNotNull()
    for n in lags:
        whole = whole & F.col(n).isNotNull()
    kept = rows.withColumn("whole", whole).filter("whole OR newest")
    kept = written(kept, shared_folder(spark))
    training = kept.filter("whole")

    mean = training.agg(F.sum("label").cast("double") / F.count("label")).scalar()
    effects = []
    for i, n in enumerate(names):
        smooth = (F.sum("label").cast("double") + SMOOTHING * mean) / (F.count("label") + SMOOTHING) - mean
        effect = training.groupBy(n).agg(smooth.cast(number).cast("double").alias(f"effect_{i}"))
        kept = kept.join(effect, n, "left")
        effects.append(f"effect_{i}")
    kept = kept.withColumn("label", F.col("label").cast("double")).select(
        "*", F.lit(1.0).alias("one"), *[(F.month("month") == m).cast("double").alias(f"season_{m}") for m in range(2, 13)])
    features = ["one", *lags, *[f"season_{m}" for m in range(2, 13)], *effects]
    pairs = [(a, b) for i, a in enumerate(features) for b in [*features[i:], "label"]]
    found = kept.filter("whole").agg(*[F.expr(f"sum({a} * {b})").alias(f"{a}:{b}") for a, b in pairs]).first()
    sums = {pair: float(found[f"{pair[0]}:{pair[1]}"] or 0) for pair in pairs}
    weights = dict(zip(features, solved(
        [[sums[(a, b) if (a, b) in sums else (b, a)] for b in features] for a in features], [sums[(a, "label")] for a in features])))

    level = F.lit(weights["one"])
    for n in effects:
        level = level + F.col(n) * F.lit(weights[n])
    season = F.array(F.lit(0.0), *[F.lit(weights[f"season_{m}"]) for m in range(2, 13)])

    def advance(state: Column, step: Column) -> Column:
        ahead = level + F.element_at(season, F.month(F.add_months("month", step)))
        for back, n in enumerate(lags, 1):
            ahead = ahead + F.element_at(state, -back) * F.lit(weights[n])
        return F.concat(state, F.array(ahead))

    known = F.array(*reversed(lags[:-1]), "label")
    path = F.slice(F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), known, advance), context + 1, horizon)
    path = F.when(F.col("whole"), path).otherwise(F.array_repeat("level", horizon))
    ahead = kept.filter("newest").select(
        F.col("id").alias(identifier), "month", *[F.col(n).alias(a) for n, a in zip(names, attributes)],
        F.when(F.col("whole"), "ok").otherwise("short").alias("status"), F.posexplode(path).alias("_pos", f"predicted_{target}"))
    return ahead.withColumn("month", F.add_months("month", F.col("_pos") + 1)).drop("_pos").withColumnRenamed("month", month)


def forecast_counts(train: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Number of series-by-fold combinations, how many got a full forecast, and the share."""
    folds = train.select("split_index").distinct().agg(F.count(F.lit(1)).alias("folds"))
    series = train.agg(F.countDistinct("series_id").alias("series"))
    per_group = forecasts.groupBy(*GROUP).agg(F.count("yhat").alias("filled"), F.count(F.lit(1)).alias("steps"))
    return per_group.agg(
        F.coalesce(F.count_if(F.col("filled") == F.col("steps")), F.lit(0)).alias("successful_predictions")
    ).select(
        (series.scalar() * folds.scalar()).alias("total_combinations"), "successful_predictions"
    ).withColumn("completion_rate", F.col("successful_predictions") / F.col("total_combinations"))
