"""Seasonal models whose differences and orders are chosen per series and fold, by two stages of least squares.

1. Differences. A seasonal one is taken if the day-to-day changes repeat after a season, their autocorrelation at that lag
   being at least ``REPEATS``; then a plain one if the KPSS statistic of what is left exceeds its 5 % value.
2. A long autoregression of the differenced series, from its autocovariances, estimates the innovations.
3. Every candidate regresses the series on its own lags and on lagged innovations. All candidates are solved from one table
   of sums of products per group, and the Bayesian information criterion picks one, the smaller on a tie.
4. The chosen recursion runs ahead and is integrated back.

All of it is windows, aggregations and expressions over arrays. A group is a series and fold and never longer than the
calendar; what is solved is a table of at most 16 x 16 numbers.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from crewcast.operators.forecast import GROUP, forecast_rows
from crewcast.session import shared_folder
from crewcast.sources.tables import written

REPEATS = 0.64
KPSS_5_PERCENT = 0.463
#: Lags of the long autoregression, and the most of the KPSS statistic's variance.
LONG, KPSS_LAGS = 15, 10
#: A pivot below this share of its own diagonal entry is taken as explained; its weight is 0.
COLLINEAR = 1e-9
ORDERS = [(p, q, sp, sq) for p in range(3) for q in range(3) for sp in range(2) for sq in range(2)]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def solved(table: Column) -> Column:
    """Weights of least squares from rows ``[sums of products, right side]``, by elimination in the order of the rows."""

    def eliminated(rows: Column, own: Column) -> Column:
        def without(state: Column, k: Column) -> Column:
            def by_line(line: Column) -> Column:
                return F.transform(state, lambda row, i: F.when(i + 1 == k, line).otherwise(
                    let(F.element_at(row, k), lambda share: F.zip_with(row, line, lambda x, y: x - share * y))))

            sound = lambda pivot: pivot > COLLINEAR * F.element_at(own, k)
            scaled = lambda row: let(F.element_at(row, k), lambda pivot: F.transform(row, lambda x: F.when(sound(pivot), x / pivot).otherwise(0.0)))
            return let(let(F.element_at(state, k), scaled), by_line)

        return F.transform(F.aggregate(F.sequence(F.lit(1), F.size(rows)), rows, without), lambda row: F.element_at(row, -1))

    by_rows = lambda rows: let(F.transform(rows, lambda row, i: F.get(row, i)), lambda own: eliminated(rows, own))
    return F.when(F.size(table) > 0, let(table, by_rows)).otherwise(F.array().cast("array<double>"))


def _terms(season: int) -> list[tuple[str, int]]:
    """Regressors: own lags ``w`` and innovations ``e``, with the products of the plain and the seasonal lag."""
    lags = [1, 2, season, season + 1]
    return [("w", k) for k in lags] + [("e", k) for k in lags]


def places(p: int, q: int, sp: int, sq: int) -> list[int]:
    """Places of a candidate's regressors among :func:`_terms`."""
    def side(plain: int, seasonal: int, first: int) -> list[int]:
        return [first + i for i in range(plain)] + ([first + 2] if seasonal else []) + ([first + 3] if seasonal and plain else [])
    return side(p, sp, 0) + side(q, sq, 4)


def _differenced(train: DataFrame, season: int) -> DataFrame:
    """Rows with ``w``, the differenced series less its mean, and what of it is needed to go back."""
    c = F.col
    group = Window.partitionBy(*GROUP)
    order = group.orderBy("ds")
    rows = train.filter(c("y").isNotNull()).select(*GROUP, "ds", c("y").cast("double").alias("y"))
    rows = rows.select("*", F.count("y").over(group).alias("n"), F.avg("y").over(group).alias("level"), F.lag("y", season).over(order).alias("before"),
                       (c("y") - F.lag("y").over(order)).alias("change"))
    rows = rows.withColumn("change", c("change") - F.avg("change").over(group)).withColumn("change_before", F.lag("change", season).over(order))
    total = lambda x: F.sum(x).over(group)
    repeats = F.coalesce(total(c("change") * c("change_before")), F.lit(0.0)) >= REPEATS * total(c("change") * c("change"))
    rows = rows.withColumn("d_season", F.when(repeats & (total(c("change") * c("change")) > 0), 1).otherwise(0))
    rows = rows.withColumn("z", F.when(c("d_season") == 1, c("y") - c("before")).otherwise(c("y")))

    rows = rows.withColumn("size", F.count("z").over(group).cast("double")).withColumn("u", c("z") - F.avg("z").over(group))
    rows = rows.select("*", F.when(c("u").isNotNull(), F.sum("u").over(order)).alias("path"),
                       *[F.lag("u", j).over(order).alias(f"u{j}") for j in range(1, KPSS_LAGS + 1)], F.lag("z").over(order).alias("z_before"))
    reach = F.least(F.lit(KPSS_LAGS), F.floor(4 * F.pow(c("size") / 100, F.lit(0.25))))
    long_run = total(c("u") * c("u")) / c("size")
    for j in range(1, KPSS_LAGS + 1):
        long_run = long_run + 2 * F.greatest(F.lit(0.0), 1 - j / (reach + 1)) * F.coalesce(total(c("u") * c(f"u{j}")), F.lit(0.0)) / c("size")
    rows = rows.withColumn("numerator", total(c("path") * c("path")) / (c("size") * c("size"))).withColumn("long_run", long_run)
    rows = rows.withColumn("d_plain", F.when((c("long_run") > 0) & (c("numerator") > KPSS_5_PERCENT * c("long_run")), 1).otherwise(0))
    rows = rows.withColumn("raw", F.when(c("d_plain") == 1, c("z") - c("z_before")).otherwise(c("z")))
    # A twice differenced series has no drift.
    rows = rows.withColumn("mean", F.when(c("d_plain") + c("d_season") < 2, F.coalesce(F.avg("raw").over(group), F.lit(0.0))).otherwise(0.0))
    return rows.select(*GROUP, "ds", "y", "n", "level", "d_plain", "d_season", "z", "mean", (c("raw") - c("mean")).alias("w"))


def seasonal_order_forecast(train: DataFrame, horizon: int, season: int = 7, min_rows: int = 60) -> DataFrame:
    """``horizon`` days per series and fold with ``orders`` such as ``(1,1,1)(0,1,1)7`` and ``status``.

    A group with fewer than ``min_rows`` values gets its mean and the status ``short``; one that its differences leave
    without any variation goes on by them alone, with the status ``flat``. A candidate whose weights of own lags add up,
    without sign, to 1 or more might run away and is not taken. Rows with a null value are left out; equal days of one group
    are taken in any order.
    """
    c = F.col
    group = Window.partitionBy(*GROUP)
    order = group.orderBy("ds")
    total = lambda x: F.sum(x).over(group)
    rows = _differenced(train, season)
    rows = rows.select("*", *[F.lag("w", j).over(order).alias(f"w{j}") for j in range(1, LONG + 1)])
    rows = rows.withColumn("gamma", F.array(*[F.coalesce(total(c("w") * c(f"w{j}" if j else "w")), F.lit(0.0)) for j in range(LONG + 1)]))
    # The long autoregression is the same for all rows of a group; it is solved once per group.
    weights = rows.groupBy(*GROUP).agg(F.first("gamma").alias("gamma"))
    table = F.transform(F.sequence(F.lit(0), F.lit(LONG - 1)), lambda i: F.concat(
        F.transform(F.sequence(F.lit(0), F.lit(LONG - 1)), lambda j: F.get("gamma", F.abs(i - j))), F.array(F.get("gamma", i + 1))))
    weights = weights.select(*GROUP, solved(table).alias("long"))
    rows = rows.drop("gamma").join(weights, list(GROUP))
    fitted = reduce(lambda a, b: a + b, [F.get("long", F.lit(j - 1)) * c(f"w{j}") for j in range(1, LONG + 1)])
    rows = rows.withColumn("e", c("w") - fitted)

    terms = _terms(season)
    reach = season + 1
    last = F.lead("ds").over(order).isNull()
    tail = lambda name, size: F.array(*[F.lag(name, j).over(order) for j in range(size - 1, 0, -1)], c(name))
    rows = rows.select(
        *GROUP, "ds", "n", "level", "d_plain", "d_season", "z", "mean", c("w").alias("t"), *[F.lag(kind, k).over(order).alias(f"{kind}_{k}") for kind, k in terms],
        F.when(last, tail("y", season)).alias("y_tail"), F.when(last, tail("w", reach)).alias("w_tail"), F.when(last, tail("e", reach)).alias("e_tail"))
    names = [f"{kind}_{k}" for kind, k in terms] + ["t"]
    used = c(f"e_{reach}").isNotNull() & c("t").isNotNull()
    sums = {(a, b): F.coalesce(F.sum(F.when(used, c(a) * c(b))), F.lit(0.0)) for i, a in enumerate(names) for b in names[i:]}
    fits = rows.groupBy(*GROUP).agg(
        F.max("ds").alias("_last"), *[F.first(x).alias(x) for x in ("n", "level", "d_plain", "d_season", "mean")], F.max_by("z", "ds").alias("z_last"),
        *[F.max_by(f"{x}_tail", "ds").alias(f"{x}_tail") for x in "ywe"], F.sum(F.when(used, 1.0).otherwise(0.0)).alias("used"),
        F.array(*[F.array(*[sums[min((i, a), (j, b))[1], max((i, a), (j, b))[1]] for j, b in enumerate(names)]) for i, a in enumerate(names)]).alias("sums"))

    # One row a group. Stored, as every candidate reads the sums and a plan would write them out anew for each reading.
    fits = written(fits, shared_folder(train.sparkSession))
    candidates = F.array(*[F.struct(F.lit(i).alias("rank"), F.array(*[F.lit(x) for x in places(*o)]).cast("array<int>").alias("terms"),
                                    F.lit("({},d,{})({},D,{})".format(*o)).alias("orders")) for i, o in enumerate(ORDERS)])
    target = len(terms)
    cell = lambda i, j: F.get(F.get("sums", i), j)

    def scored(candidate: Column) -> Column:
        picked = candidate["terms"]
        system = F.transform(picked, lambda i: F.concat(F.transform(picked, lambda j: cell(i, j)), F.array(cell(i, F.lit(target)))))
        return F.struct(candidate["rank"].alias("rank"), candidate["orders"].alias("orders"), picked.alias("terms"),
                        solved(system).alias("weights"))

    def valued(fit: Column) -> Column:
        pairs = F.arrays_zip(fit["terms"], fit["weights"])
        explained = F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x["weights"] * cell(x["terms"], F.lit(target)))
        own = F.aggregate(pairs, F.lit(0.0), lambda a, x: a + F.when(x["terms"] < 4, F.abs(x["weights"])).otherwise(0.0))
        left = F.greatest(cell(F.lit(target), F.lit(target)) - explained, 1e-12 * cell(F.lit(target), F.lit(target)))
        k = F.size(fit["terms"]) + 1.0
        score = c("used") * F.log(left / c("used")) + k * F.log("used")
        return F.when(own < 1, F.struct(score.alias("score"), fit["rank"].alias("rank"), fit["orders"].alias("orders"), fit["terms"].alias("terms"),
                                        fit["weights"].alias("weights")))

    best = F.array_min(F.array_compact(F.transform(F.transform(candidates, scored), valued)))
    varied = cell(F.lit(target), F.lit(target)) > 0
    status = F.when(c("n") < min_rows, "short").when(~varied, "flat").otherwise("ok")
    fits = fits.withColumn("status", status).withColumn("best", F.when(c("status") == "ok", best))
    weight = F.when(c("best").isNotNull(), F.map_from_arrays("best.terms", "best.weights"))
    fits = fits.withColumn("coefficients", F.array(*[F.coalesce(F.try_element_at(weight, F.lit(i)), F.lit(0.0)) for i in range(target)]))
    orders = F.concat(F.coalesce("best.orders", F.lit("(0,d,0)(0,D,0)")), F.lit(str(season)))
    for letter, name in (("d", "d_plain"), ("D", "d_season")):
        orders = F.replace(orders, F.lit(letter), c(name).cast("string"))
    fits = fits.withColumn("orders", F.when(c("status") != "short", orders).otherwise("mean"))
    path = F.when(c("status") == "short", F.array_repeat("level", horizon)).otherwise(_ahead(terms, horizon, season))
    return forecast_rows(fits.withColumn("_path", path), "SEASONAL_ORDER", ("orders", "status"))


def _ahead(terms: list[tuple[str, int]], horizon: int, season: int) -> Column:
    """The recursion: the differenced series ahead, innovations 0, integrated plainly and by season."""
    c = F.col
    empty = F.array_repeat(F.lit(0.0), season + 1)
    start = F.struct(F.coalesce("w_tail", empty).alias("w"), F.coalesce("e_tail", empty).alias("e"), c("z_last").alias("z"), c("y_tail").alias("y"))

    def advance(state: Column, _: Column) -> Column:
        step = reduce(lambda a, b: a + b, [F.get("coefficients", F.lit(i)) * F.coalesce(F.element_at(state[kind], -k), F.lit(0.0))
                                           for i, (kind, k) in enumerate(terms)])
        z = step + c("mean") + F.when(c("d_plain") == 1, state["z"]).otherwise(0.0)
        y = z + F.when(c("d_season") == 1, F.element_at(state["y"], -season)).otherwise(0.0)
        return F.struct(F.concat(state["w"], F.array(step)).alias("w"), F.concat(state["e"], F.array(F.lit(0.0))).alias("e"), z.alias("z"),
                        F.concat(state["y"], F.array(y)).alias("y"))

    return F.slice(F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, advance, lambda s: s["y"]), season + 1, horizon)
