"""Data profile per split and overall, and the tables behind the charts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from crewcast.functions import week_ending_monday
from crewcast.operators.panel import fill_periods, period_sums
from crewcast.session import shared_folder
from crewcast.sources.tables import written

SCOPE = ("dataset_type", "split_number")


def _scoped(rows: DataFrame) -> DataFrame:
    """Each row under its own split and under ``overall``; partial aggregation absorbs the copy."""
    scopes = F.array(
        F.struct(F.col("dataset_type").alias("d"), F.col("split_index").alias("s")),
        F.struct(F.lit("overall").alias("d"), F.lit(0).alias("s")),
    )
    kept = [c for c in rows.columns if c not in ("dataset_type", "split_index")]
    return rows.select(*kept, F.explode(scopes).alias("_s")).select(
        *kept, F.col("_s.d").alias("dataset_type"), F.col("_s.s").alias("split_number")
    )


def exact_median(rows: DataFrame, by: Sequence[str], value: str, accuracy: int = 10_000) -> DataFrame:
    """Exact interpolated median per group without bringing a group together.

    A mergeable quantile sketch brackets the middle ranks; its rank error is at most 1/accuracy, so
    the bracket surely holds them. Rows below the bracket are only counted, rows inside are counted
    per distinct value. Those counts are dealt out by ranges of values: the totals of the ranges say which range holds a
    middle rank, and the running count is taken inside that range alone.
    """
    slack, group = 2.0 / accuracy, list(by)
    same = lambda other: reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{other}{k}")) for k in group])
    named = lambda other: [F.col(k).alias(f"{other}{k}") for k in group]
    filled = rows.filter(F.col(value).isNotNull()).select(*group, F.col(value).cast("double").alias("_v"))
    brackets = filled.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_v", [0.5 - slack, 0.5 + slack], accuracy).alias("_range"),
    ).select(*named("_b_"), "_n", F.col("_range")[0].alias("_lo"), F.col("_range")[1].alias("_hi"))
    placed = filled.join(brackets, same("_b_")).filter(F.col("_v") <= F.col("_hi"))
    # Null stands for everything below the bracket.
    spot = F.when(F.col("_v") >= F.col("_lo"), F.col("_v"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = placed.groupBy(*group, "_n", spot.alias("_spot")).agg(F.count(F.lit(1)).alias("_c"))
    dealt = counts.repartitionByRange(parts, *group, "_spot").withColumn("_part", F.when(F.col("_spot").isNull(), -1).otherwise(F.spark_partition_id()))
    dealt = written(dealt, shared_folder(rows.sparkSession))

    totals = dealt.groupBy(*group, "_n", "_part").agg(F.sum("_c").alias("_t"))
    ranges = totals.groupBy(*group, "_n").agg(F.sort_array(F.collect_list(F.struct("_part", "_t"))).alias("_ranges"))  # one entry a partition
    ranks = F.array(F.floor((F.col("_n") + 1) / 2), F.floor((F.col("_n") + 2) / 2))
    wanted = ranges.select(*named("_w_"), "_ranges", F.posexplode(ranks).alias("_which", "_rank"))
    start = F.struct(F.lit(0).cast("long").alias("before"), F.lit(None).cast("int").alias("part"))
    found = F.aggregate("_ranges", start, lambda state, r: F.when(
        state["part"].isNull() & (state["before"] + r["_t"] < F.col("_rank")),
        F.struct((state["before"] + r["_t"]).alias("before"), F.lit(None).cast("int").alias("part"))).otherwise(
        F.struct(state["before"].alias("before"), F.coalesce(state["part"], r["_part"]).alias("part"))))
    wanted = wanted.withColumn("_at", found).select(*[f"_w_{k}" for k in group], "_which", F.col("_at.part").alias("_w_part"),
                                                    (F.col("_rank") - F.col("_at.before")).alias("_need"))
    inside = dealt.join(wanted, same("_w_") & (F.col("_part") == F.col("_w_part")))
    upto = F.sum("_c").over(Window.partitionBy(*group, "_which", "_part").orderBy("_spot"))
    hit = inside.withColumn("_upto", upto).filter((F.col("_upto") >= F.col("_need")) & (F.col("_upto") - F.col("_c") < F.col("_need")))
    return hit.groupBy(*group).agg(F.avg("_spot").alias("median"))


def numeric_profile(rows: DataFrame, day: str, target: str) -> DataFrame:
    """Rows, date range, mean, median, extremes, sample deviation and total per split and overall."""
    scoped = _scoped(rows.select("dataset_type", "split_index", day, target))
    value = F.col(target).cast("double")
    base = scoped.groupBy(*SCOPE).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min(day).alias("start_date"), F.max(day).alias("end_date"),
        F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.stddev_samp(value).alias("std"), F.sum(target).cast("double").alias("total"),
    )
    return base.join(exact_median(scoped, SCOPE, target), list(SCOPE), "left")


def null_counts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of nulls per column, split and overall, as one row each."""
    scoped = _scoped(rows.select("dataset_type", "split_index", *columns))
    wide = scoped.groupBy(*SCOPE).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot(list(SCOPE), list(columns), "column_name", "null_count")


def category_profile(rows: DataFrame, columns: Sequence[str], top: int = 5) -> DataFrame:
    """The ``top`` most frequent values of each column with count, share of all rows and distinct count.

    Equal counts are ordered by value. Shares are taken over all rows, null ones included.
    """
    scoped = _scoped(rows.select("dataset_type", "split_index", *[F.col(c).cast("string") for c in columns]))
    counts = scoped.unpivot(list(SCOPE), list(columns), "column_name", "value").groupBy(
        *SCOPE, "column_name", "value"
    ).agg(F.count(F.lit(1)).alias("value_count"))
    keys = [*SCOPE, "column_name"]
    totals = counts.groupBy(*keys).agg(
        F.sum("value_count").alias("_all"), F.count("value").alias("unique_values")
    )
    order = Window.partitionBy(*keys).orderBy(F.col("value_count").desc(), F.col("value").asc())
    best = counts.filter(F.col("value").isNotNull()).withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= top
    )
    return best.join(totals, keys).select(
        *keys, "rank", "value", "value_count", "unique_values",
        (F.col("value_count") * 100.0 / F.col("_all")).alias("percentage"),
    )


def split_counts(rows: DataFrame) -> DataFrame:
    """Train and test rows per split."""
    return rows.groupBy("split_index").agg(
        F.count_if(F.col("dataset_type") == "train").alias("train_rows"),
        F.count_if(F.col("dataset_type") == "test").alias("test_rows"),
    )


def as_documents(stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One JSON text per row, next to its keys."""
    return stats.select(*keys, F.to_json(F.struct(*stats.columns)).alias("document"))


def last_year(rows: DataFrame, day: str, days: int = 365) -> DataFrame:
    """Rows not older than ``days`` before the newest row."""
    return rows.filter(F.col(day) >= F.date_sub(rows.agg(F.max(day)).scalar(), days))


def weekly_sums(rows: DataFrame, day: str, target: str, keys: Sequence[str] = ()) -> DataFrame:
    """Sums per week ending on Monday, from the first to the last week, 0 where nothing happened."""
    sums = period_sums(rows, keys, week_ending_monday(F.col(day)), "week", [target])
    weeks = F.sequence("first_period", "last_period", F.expr("interval 7 days"))
    return fill_periods(sums, keys, "week", [target], weeks)


def log_target(rows: DataFrame, target: str) -> DataFrame:
    """Adds ``log(1 + target)``."""
    return rows.withColumn(f"log_{target}", F.log1p(F.col(target).cast("double")))
