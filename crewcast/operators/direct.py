"""One model over all monthly series that predicts every month ahead directly, by boosted trees.

A training row is a series, an origin month and a step: what was known at the origin, how many months ahead, and the value
there. Trees cannot continue a level, so values are shares of the series' own level at the origin, and rows weigh as much
as that level. Attributes are hashed, so that new values need no new model. Fitting is Spark ML's, over rows that lie in
the cluster; the driver holds the trees.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Window, functions as F

from crewcast.fixed_values import MONTHLY_CONTEXT, MONTHLY_HORIZON
from crewcast.session import shared_folder
from crewcast.sources.tables import written

HASHED = 32
YEAR = 12


def _origins(panel: DataFrame, attributes: Sequence[str], identifier: str, month: str, target: str, context: int) -> DataFrame:
    """Every month of every series that has ``context`` months up to it: id, origin, level, past (shares, newest first), attributes."""
    order = Window.partitionBy("id").orderBy("origin")
    rows = panel.select(F.col(identifier).alias("id"), F.col(month).alias("origin"), F.col(target).cast("double").alias("y"),
                        *[F.coalesce(F.col(a).cast("string"), F.lit("None")).alias(f"attribute_{i}") for i, a in enumerate(attributes)])
    past = F.array(*[F.lag("y", k).over(order) if k else F.col("y") for k in range(context)])
    rows = rows.withColumn("past", past).filter(F.forall("past", lambda x: x.isNotNull()))
    level = F.aggregate("past", F.lit(0.0), lambda a, x: a + x) / context
    return rows.withColumn("level", level)


def _examples(origins: DataFrame, horizon: int, context: int) -> DataFrame:
    """One row per origin and step, with the features of both."""
    share = lambda x: F.when(F.col("level") > 0, x / F.col("level")).otherwise(0.0)
    rows = origins.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    # The newest known value a whole number of years before the month that is predicted.
    back = F.ceil(F.col("step") / YEAR) * YEAR - F.col("step")
    return rows.withColumn("ahead", F.add_months("origin", F.col("step"))).select(
        "id", "origin", "step", "ahead", "level", *[c for c in origins.columns if c.startswith("attribute_")],
        F.month("ahead").cast("double").alias("season"), F.log1p(F.greatest("level", F.lit(0.0))).alias("size"),
        share(F.coalesce(F.get("past", back.cast("int")), F.col("level"))).alias("year_ago"),
        share((F.get("past", F.lit(0)) + F.get("past", F.lit(1)) + F.get("past", F.lit(2))) / 3).alias("recent"),
        *[share(F.get("past", F.lit(k))).alias(f"past_{k}") for k in range(context)])


class DirectModel:
    """Fitted trees and what their rows are made of."""

    def __init__(self, fitted: PipelineModel, attributes: Sequence[str], horizon: int, context: int):
        self.fitted, self.attributes, self.horizon, self.context = fitted, list(attributes), horizon, context

    def forecast(self, panel: DataFrame, identifier: str, month: str, target: str) -> DataFrame:
        """``horizon`` months from the last month of every series: identifier, month, step, predicted value and status.

        A series with fewer than ``context`` months goes on at its mean, with the status ``short``. ``panel`` must be dense.
        """
        newest = Window.partitionBy("id").orderBy(F.desc("origin"))
        origins = _origins(panel, self.attributes, identifier, month, target, self.context)
        last = origins.withColumn("_place", F.row_number().over(newest)).filter("_place = 1").drop("_place")
        rows = self.fitted.transform(_examples(last, self.horizon, self.context))
        value = F.greatest(F.lit(0.0), F.col("prediction") * F.col("level"))
        full = rows.select(F.col("id").alias(identifier), F.col("ahead").alias(month), "step", value.alias(f"predicted_{target}"), F.lit("ok").alias("status"))
        ends = panel.groupBy(F.col(identifier).alias("id")).agg(F.max(month).alias("end"), F.avg(F.col(target).cast("double")).alias("mean"))
        rest = ends.join(last.select("id").distinct(), "id", "left_anti").select("*", F.explode(F.sequence(F.lit(1), F.lit(self.horizon))).alias("step"))
        return full.unionByName(rest.select(F.col("id").alias(identifier), F.add_months("end", F.col("step")).alias(month), "step",
                                            F.col("mean").alias(f"predicted_{target}"), F.lit("short").alias("status")))


def fit_direct(panel: DataFrame, attributes: Sequence[str], identifier: str, month: str, target: str, horizon: int = MONTHLY_HORIZON,
               context: int = MONTHLY_CONTEXT, trees: int = 20, depth: int = 3, seed: int = 11) -> DirectModel | None:
    """Trees over every origin and step whose month is known; none if there is no such row.

    Rows are stored in an order that depends on them alone, and no row is sampled, so equal panels and seeds give equal trees.
    """
    origins = _origins(panel, attributes, identifier, month, target, context)
    known = panel.select(F.col(identifier).alias("id"), F.col(month).alias("ahead"), F.col(target).cast("double").alias("truth"))
    rows = _examples(origins, horizon, context).join(known.filter(F.col("truth").isNotNull()), ["id", "ahead"]).filter("level > 0")
    rows = rows.withColumn("label", F.col("truth") / F.col("level"))
    parts = int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = written(rows.repartition(parts, "id", "origin").sortWithinPartitions("id", "origin", "step"), shared_folder(panel.sparkSession))
    if rows.isEmpty():
        return None
    named = [c for c in rows.columns if c.startswith("attribute_")]
    numbers = ["step", "season", "size", "year_ago", "recent", *[f"past_{k}" for k in range(context)]]
    steps = [FeatureHasher(numFeatures=HASHED, inputCols=named, outputCol="hashed")] if named else []
    steps.append(VectorAssembler(inputCols=numbers + ["hashed"] * bool(named), outputCol="features"))
    steps.append(GBTRegressor(featuresCol="features", labelCol="label", weightCol="level", maxIter=trees, maxDepth=depth, stepSize=0.1, minInstancesPerNode=20, seed=seed))
    return DirectModel(Pipeline(stages=steps).fit(rows), attributes, horizon, context)
