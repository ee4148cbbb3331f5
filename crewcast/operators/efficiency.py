"""Planned efficiency rules: scope expansion and monthly reductions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from crewcast import fixed_values as fv
from crewcast.functions import guarded_ratio, mentions, month_of, row_fingerprint
from crewcast.operators.panel import carried_forward
from crewcast.operators.reshape import month_columns, unpivot_months


def with_rule_key(rules: DataFrame, name: str = "efficiency_uid") -> DataFrame:
    """A key made from the rule's own values; the n-th copy of an identical rule gets its own key."""
    print_ = rules.withColumn("_print", row_fingerprint(rules.columns))
    copy = F.row_number().over(Window.partitionBy("_print").orderBy("_print"))
    return print_.withColumn(name, F.concat_ws("-", "_print", copy)).drop("_print")


def district_scopes(districts: DataFrame) -> DataFrame:
    """(district, province, scope, value): every scope a rule can name that the district belongs to."""
    scope = [
        F.struct(F.lit("all").alias("scope"), F.lit(fv.SCOPE_ALL).alias("value")),
        F.struct(F.lit("tier").alias("scope"), F.col("region_type").alias("value")),
        F.struct(F.lit("province").alias("scope"), F.col("province").alias("value")),
        F.struct(F.lit("district").alias("scope"), F.col("district").alias("value")),
        F.when(
            F.col("province").isin(*fv.TERRITORIES),
            F.struct(F.lit("territories").alias("scope"), F.lit(fv.SCOPE_TERRITORIES).alias("value")),
        ),
    ]
    return districts.select("district", "province", F.explode(F.array_compact(F.array(*scope))).alias("_s")).select(
        "district", "province", "_s.scope", "_s.value"
    )


def known_districts(lookup: DataFrame) -> DataFrame:
    """Distinct (district, region_type, province) of the district lookup."""
    return lookup.filter(F.col("district_old").isNotNull()).select(
        F.col("district_old").alias("district"), "region_type", "province"
    ).distinct()


def rule_districts(rules: DataFrame, districts: DataFrame) -> DataFrame:
    """Districts each rule covers, by equi-join on the kind of scope and its value."""
    region = F.col("Region_Impacted")
    scope = (
        F.when(region == fv.SCOPE_ALL, "all")
        .when(region.like(fv.SCOPE_TIER_PATTERN), "tier")
        .when(region.isin(*fv.SCOPE_PROVINCES), "province")
        .when(region == fv.SCOPE_TERRITORIES, "territories")
        .otherwise("district")
    )
    named = rules.select(
        "efficiency_uid", "Products_Impacted", "Job_Types_Impacted", scope.alias("scope"), region.alias("value")
    )
    return named.join(district_scopes(districts), ["scope", "value"]).select(
        "efficiency_uid", "Products_Impacted", "Job_Types_Impacted", "district"
    )


def _texts(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def family_products(product: Column, province: Column) -> Column:
    """Products behind a rule's product entry, which is a family, all, or one product."""
    home, away = province == fv.HOME_PROVINCE, province != fv.HOME_PROVINCE
    return (
        F.when((product == "Managed") & away, _texts(fv.MANAGED_AWAY))
        .when((product == "Managed") & home, _texts(fv.MANAGED_HOME))
        .when((product == "Unmanaged") & away, _texts(fv.UNMANAGED_AWAY))
        .when((product == "Unmanaged") & home, _texts(fv.UNMANAGED_HOME))
        .when(product == "All", _texts(fv.ALL_PRODUCTS))
        .otherwise(F.array(product))
    )


def rule_targets(rules: DataFrame, districts: DataFrame) -> DataFrame:
    """(efficiency_uid, product, job_type, district) that each rule applies to.

    A district listed under several provinces counts once per listing.
    """
    covered = rule_districts(rules, districts).join(districts.select("district", "province"), "district")
    products = covered.select(
        "efficiency_uid", "Job_Types_Impacted", "district",
        F.explode(family_products(F.col("Products_Impacted"), F.col("province"))).alias("product"),
    ).filter(F.col("product") != fv.OTHER)
    jobs = F.when(F.col("Job_Types_Impacted") == fv.ALL_JOB_TYPES_RULE, _texts(fv.ALL_JOB_TYPES)).otherwise(
        F.array("Job_Types_Impacted")
    )
    return products.select("efficiency_uid", "product", F.explode(jobs).alias("_job"), "district").select(
        "efficiency_uid", "product", F.upper("_job").alias("job_type"), "district"
    )


def rule_totals(targets: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Predicted hours each rule touches, per version and month.

    Forecast rows are first summed to the grain of the targets, so the join moves as little as
    possible however many technologies and work forces a version has.
    """
    hours = (
        forecasts.filter(F.lower("SWT_Type") == "predicted")
        .groupBy("Forecast_Date", F.col("Appointment_Month").cast("date").alias("appointment_month"),
                 F.col("District").alias("district"), F.col("Product").alias("product"),
                 F.col("Work_Order_Action").alias("job_type"))
        .agg(F.sum("predicted_SWT.value").alias("_hours"))
    )
    return targets.join(hours, ["district", "product", "job_type"]).groupBy(
        "Forecast_Date", "efficiency_uid", "appointment_month"
    ).agg(F.sum("_hours").alias("total_value"))


def efficiency_reductions(rules: DataFrame, lookup: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Cumulative reduction per version, month, product, action and district.

    A rule in percent is used as it is; a rule in hours is divided by the predicted hours it
    touches. Months where that is impossible keep the last known value.
    """
    keyed = with_rule_key(rules)
    districts = known_districts(lookup)
    targets = rule_targets(keyed, districts)
    planned = unpivot_months(
        keyed, ["efficiency_uid", "Type_of_Reduction"], "appointment_month", "reduction_value"
    )
    merged = planned.join(rule_totals(targets, forecasts), ["efficiency_uid", "appointment_month"]).withColumn(
        "reduction_value",
        F.when(mentions(F.col("Type_of_Reduction"), "%"), F.col("reduction_value")).otherwise(
            guarded_ratio(F.col("reduction_value"), F.col("total_value"))
        ),
    )
    started = month_of(F.col("appointment_month")) >= month_of(F.col("Forecast_Date").cast("date"))
    cumulative = merged.filter(started).withColumn(
        "efficiency_reduction",
        carried_forward("reduction_value", ["Forecast_Date", "efficiency_uid"], "appointment_month"),
    )
    return cumulative.join(targets, "efficiency_uid").select(
        "Forecast_Date", "appointment_month", "product", F.col("job_type").alias("Work_Order_Action"), "district",
        "efficiency_reduction",
    )


def efficiency_report(rules: DataFrame) -> DataFrame:
    """The rules with one row per filled month."""
    keep = [
        "Program_Name", "Initiative_Name", "Owner", "Start_Date", "Products_Impacted", "Job_Types_Impacted",
        "Region_Impacted", "Type_of_Reduction",
    ]
    if not month_columns(rules):
        raise ValueError("no month columns found")
    return unpivot_months(rules, keep).withColumn("Month", F.date_format("Month", "yyyy-MM"))
