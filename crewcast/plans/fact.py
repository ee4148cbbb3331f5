"""Build of the daily hours-of-work fact from the upstream history tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from crewcast import fixed_values as fv
from crewcast.functions import (
    any_like, child_or_parent, first_match, flag_to_int, folder_of, joined_parts, local_date, recode, renamed_key, repaired,
)
from crewcast.operators.joins import lookup, matching_keys, near_keys, resolve_hierarchy
from crewcast.operators.latest import Latest, latest_counts, latest_pivot, latest_rows, open_rows


@dataclass(frozen=True)
class Upstream:
    """The upstream tables the fact is built from."""

    work_order: DataFrame
    component: DataFrame
    job: DataFrame
    assignment: DataFrame
    work_order_status: DataFrame
    job_status: DataFrame
    location: DataFrame
    work_order_attribute: DataFrame
    job_attribute: DataFrame
    processing_state: DataFrame
    assignment_status: DataFrame
    service: DataFrame
    party: DataFrame
    time_entry: DataFrame
    team_member: DataFrame
    districts: DataFrame
    product_keys: DataFrame


@dataclass(frozen=True)
class FactRules:
    """What an installation decides: its own company's name and the manager whose projects are normal work."""

    own_company: str
    project_manager: str = ""
    categories: Sequence[str] = fv.WORK_ORDER_CATEGORIES
    source_district_patterns: Sequence[str] = fv.SOURCE_DISTRICT_PATTERNS
    source_districts: Sequence[str] = fv.SOURCE_DISTRICTS
    district_patterns: Sequence[str] = fv.DISTRICT_PATTERNS
    districts: Sequence[str] = fv.DISTRICTS
    home_province: str = fv.HOME_PROVINCE
    western_provinces: Sequence[str] = fv.WESTERN_PROVINCES
    away_contractors: Sequence[str] = fv.AWAY_KEPT_CONTRACTORS
    region_repairs: dict = field(default_factory=lambda: dict(fv.REGION_REPAIRS))


def navigation_location(location: DataFrame, districts: DataFrame, rules: FactRules) -> DataFrame:
    """Current navigation row per work order with repaired region and looked-up district; ties stay."""
    wanted = any_like(F.col("district_nm"), rules.source_district_patterns) | F.col("district_nm").isin(
        *rules.source_districts
    )
    rows = open_rows(location).filter((F.col("work_order_location_usage_cd") == fv.NAVIGATION_USAGE) & wanted)
    names = districts.select("service_area_clli", "migration", "district", "district_old")
    latest = latest_rows(rows.filter(F.col("work_order_id").isNotNull()), ["work_order_id"], "src_last_updt_ts", named=True).drop("district_nm")
    return latest.join(names, F.col("service_area_clli_cd") == F.col("service_area_clli"), "left").select(
        "work_order_id",
        F.col("province_cd").alias("province"),
        repaired(F.col("region_nm"), rules.region_repairs).alias("region"),
        renamed_key(F.col("migration"), F.col("district"), F.col("district_old")).alias("district_name"),
        F.col("common_area_text").alias("zone"),
    )


def dispatch_location(location: DataFrame) -> DataFrame:
    """Current dispatch row per work order: address and coordinates; ties stay."""
    rows = open_rows(location).filter(F.col("work_order_location_usage_cd") == fv.DISPATCH_USAGE)
    parts = {
        name: joined_parts([F.col(c) for c in columns])
        for name, columns in (("service", fv.SERVICE_ADDRESS), ("civic", fv.CIVIC_ADDRESS))
    }
    address = F.when(F.col("municipality_nm").isNull(), parts["service"]).otherwise(parts["civic"])
    return latest_rows(rows, ["work_order_id"], "src_last_updt_ts").select(
        "work_order_id", address.alias("PARTY_ADDRESS"), F.col("lattitude").alias("DISPATCH_LATITUDE"),
        F.col("longitude").alias("DISPATCH_LONGITUDE"),
    )


def work_order_attributes(rows: DataFrame, codes: Sequence[str] = fv.WORK_ORDER_ATTRIBUTES) -> DataFrame:
    outputs = {code: Latest([code], "work_order_attribute_value_txt") for code in codes}
    return latest_pivot(rows, "work_order_id", "work_order_attribute_cd", "work_order_attribute_value_id", outputs)


def processing_states(rows: DataFrame) -> DataFrame:
    """Latest text of each processing state, and since when the job is ready for dispatch."""
    outputs = {code: Latest([code], "job_processing_state_desc") for code in fv.PROCESSING_STATES}
    outputs["READY_FOR_DISPATCH_SINCE"] = Latest(["READY_FOR_DISPATCH"], "effective_start_ts")
    return latest_pivot(rows, "job_id", "job_processing_state_cd", "job_processing_state_desc", outputs)


def assist_flags(rows: DataFrame) -> DataFrame:
    """The one state of :func:`processing_states` that the fact reads."""
    outputs = {"IS_ASSIST": Latest(["IS_ASSIST"], "job_processing_state_desc")}
    return latest_pivot(rows, "job_id", "job_processing_state_cd", "job_processing_state_desc", outputs)


def job_attributes(rows: DataFrame) -> DataFrame:
    """Latest job attributes; the rebook indicator becomes ``1`` or ``0``."""
    outputs = {code: Latest([code], "job_attribute_value_txt") for code in fv.JOB_ATTRIBUTES}
    wide = latest_pivot(rows, "job_id", "job_attribute_cd", "job_attribute_value_txt", outputs)
    rebook = F.col("REBOOKREQ_IND")
    return wide.withColumn("REBOOKREQ_IND", F.when(rebook == "true", "1").when(rebook.isNotNull(), "0"))


def group_demand(attributes: DataFrame, jobs: DataFrame) -> DataFrame:
    """Latest demand type of each job group."""
    rows = attributes.filter(F.col("job_attribute_cd") == "DEMANDTYPE").join(
        jobs.select("job_id", "external_job_grouping_id"), "job_id"
    )
    return latest_pivot(
        rows, "external_job_grouping_id", "job_attribute_cd", "job_attribute_value_txt",
        {"DEMAND_TYPE": Latest(["DEMANDTYPE"], "job_attribute_value_txt")},
    )


def assignment_statuses(rows: DataFrame) -> DataFrame:
    """Time of each status, and time, code and reason of the closing one.

    The closing code is the alphabetically last of an assignment's closing codes.
    """
    outputs = {f"{code}_DT": Latest([code], "actual_status_dt") for code in fv.ASSIGNMENT_STATUSES}
    outputs["CLOSE_DT"] = Latest(fv.CLOSING_STATUSES, "actual_status_dt")
    outputs["JOB_ASSIGNMENT_STATUS_CD"] = Latest(fv.CLOSING_STATUSES, "job_assignment_status_cd")
    outputs["JOB_ASSIGNMENT_STATUS_RSN"] = Latest(fv.CLOSING_STATUSES, "job_assignment_status_rsn_cd")
    return latest_pivot(rows, "job_assignment_id", "job_assignment_status_cd", "actual_status_dt", outputs)


def closing_codes(rows: DataFrame) -> DataFrame:
    """The closing code of :func:`assignment_statuses`, of closed assignments alone."""
    outputs = {"JOB_ASSIGNMENT_STATUS_CD": Latest(fv.CLOSING_STATUSES, "job_assignment_status_cd")}
    return latest_pivot(rows, "job_assignment_id", "job_assignment_status_cd", "actual_status_dt", outputs)


def service_names(rows: DataFrame) -> DataFrame:
    """Upper-case account, else circuit, else phone of each work order."""
    outputs = {code: Latest([code], "service_identification") for code in fv.SERVICE_TYPES}
    wide = latest_pivot(rows, "work_order_id", "service_type_cd", "service_identification", outputs)
    return wide.select("work_order_id", F.upper(F.coalesce(*fv.SERVICE_TYPES)).alias("service_name"))


def booked_hours(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hours per (job, component) and per job, each by one aggregation of the open entries."""
    entries = open_rows(entries).filter(F.col("job_id").isNotNull())
    hours = F.sum("number_of_hours")
    return entries.groupBy("job_id", "work_order_component_id").agg(hours.alias("component_hours")), entries.groupBy("job_id").agg(hours.alias("job_hours"))


def near_period(day: Column, start: date, end: date) -> Column:
    """Zone-free bound around a local period; unlike the exact test it reaches the file scan."""
    return (day >= F.lit(start - timedelta(days=1)).cast("timestamp_ntz")) & (
        day < F.lit(end + timedelta(days=1)).cast("timestamp_ntz")
    )


def period_jobs(job: DataFrame, instants: Sequence[str], start: date, end: date) -> DataFrame:
    """Jobs near the period by one of their instants; of stored jobs only the folders around it are opened."""
    near = [near_period(F.col(c), start, end) for c in instants]
    for i, c in enumerate(instants):
        folder = folder_of(job.columns, c)
        if folder:
            first = F.trunc(F.lit(start - timedelta(days=1)), folder[1])
            near[i] = near[i] & (F.col(folder[0]) >= first) & (F.col(folder[0]) <= F.lit(end + timedelta(days=1)))
    return job.filter(reduce(lambda a, b: a | b, near))


def in_local_period(instants: Sequence[Column], zone: Column, start: date, end: date) -> Column:
    """True when one of the instants falls on a local day in [start, end)."""
    hits = None
    for instant in instants:
        day = local_date(instant, zone)
        hit = (day >= F.lit(start)) & (day < F.lit(end))
        hits = hit if hits is None else hits | hit
    return hits


def work_class(service_name: Column) -> Column:
    return first_match([(service_name.like(p), label) for p, label in fv.WORK_CLASS_PATTERNS], fv.DEFAULT_WORK_CLASS)


def work_order_action(rules: FactRules) -> Column:
    """Action label of a row; the first rule that holds decides."""
    project = F.upper("special_project")
    company, code, job_type = F.col("work_force"), F.col("action_code"), F.col("job_type")
    home = F.col("province") == rules.home_province
    ladder = [
        (company.isin(*fv.HOME_EXCLUDED_COMPANIES) & home, "EXCLUDE"),
        (project.isin(*fv.PROJECT_NAMES) | any_like(project, fv.PROJECT_PATTERNS), "PROJECT"),
        (project.like(fv.MANAGED_PROJECT_PATTERN) & (F.col("MGR_TID") != rules.project_manager), "PROJECT"),
        ((project == fv.COMPANY_PROJECT) & (company == rules.own_company), "PROJECT"),
        ((project == fv.COMPANY_PROJECT) & (company != rules.own_company), "PROJECT (EXCLUDE)"),
        (project.like(fv.EXCLUDED_PROJECT_PATTERN), "PROJECT (EXCLUDE)"),
        (F.col("work_class") == fv.PRESTAGE_CLASS, "PRESTAGE"),
        *[(job_type.like(pattern), label) for pattern, label in fv.ACTION_JOB_TYPES],
        *[(code.isin(*codes), label) for label, codes in fv.ACTION_CODES],
        ((F.col("classification") == fv.TROUBLE) & code.isNull(), "REPAIR"),
    ]
    return first_match(ladder, fv.OTHER)


def product_group(product: Column, province: Column, home: str = fv.HOME_PROVINCE, anywhere: Sequence[str] = ()) -> Column:
    """Product group by product and side of the home province.

    Products in ``anywhere`` take their outside group in every province, also in an unknown one.
    """
    away = recode(product, fv.PRODUCT_GROUPS_AWAY)
    inside = recode(product, fv.PRODUCT_GROUPS_HOME)
    group = F.when(province != home, away).when(province == home, inside)
    if anywhere:
        group = F.when(product.isin(*anywhere), away).otherwise(group)
    return F.coalesce(group, F.lit(fv.OTHER))


#: The attributes of a work order that its rows carry.
READ_ATTRIBUTES = ("PRODUCT_CATEGORY", "TECHNOLOGY", "SPECIAL_PROJECT")


def work_rows(up: Upstream, rules: FactRules, start: date | None = None, end: date | None = None, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row per work order, component, job, assignment and location tie, with the values to add up.

    Without ``start`` and ``end`` it holds the rows of all periods, with both instants and their local days.

    Tables that only repeat rows (open work order statuses, job statuses, dispatch rows, parties)
    are counted per key first and enter as the factor ``copies``. Of a history only the codes that the rows need are
    read. It is aggregated by the key of its join, with a step before the shuffle, so that a row per key is sorted
    and joined instead of the whole history; only histories that lie by their key are first cut to the work orders, jobs
    and assignments of the period. The main rows are joined key by key: first what may drop them, of the job, the
    assignment and its worker, and of the work order; then everything else of the work order, where they lie by it already, then the hours.

    ``keep`` stores the rows in between and gives them back. The other histories are then cut to the keys
    that are left before anything is moved, as long as these, or a bit for each, may be broadcast.
    """
    def copies(rows: DataFrame, key: str, name: str) -> DataFrame:
        return rows.groupBy(key).agg(F.count(F.lit(1)).alias(name))

    instants = ["appointment_start_datetime", "early_start_time"]
    jobs = up.job if start is None else period_jobs(up.job, instants, start, end)
    job = jobs.select(
        "job_id", "work_order_id", *instants,
        F.col("estimated_duration").alias("job_estimate"), F.col("job_type_cd").alias("job_job_type"),
    )

    stored = folder_of(up.job.columns, instants[0]) is not None

    def cut(rows: DataFrame, others: DataFrame, key: str) -> DataFrame:
        """Rows of the period's keys where that moves no history; elsewhere the join by this key below leaves them out."""
        return matching_keys(rows, others, [key]) if stored else rows

    def of_order(rows: DataFrame) -> DataFrame:
        return cut(rows, job, "work_order_id")

    def of_job(rows: DataFrame) -> DataFrame:
        return cut(rows, job, "job_id")

    assignment = open_rows(of_job(up.assignment)).select("job_id", "job_assignment_id", "team_member_id")
    order = up.work_order.filter(F.col("work_order_category_cd").isin(*rules.categories)).select(
        "work_order_id", "orig_system_id", F.col("work_order_classification_cd").alias("classification"),
        F.col("work_order_action_cd").alias("order_action"),
    )
    status = closing_codes(cut(up.assignment_status, assignment, "job_assignment_id")).filter(F.col("JOB_ASSIGNMENT_STATUS_CD") != fv.REJECTED).select(
        "job_assignment_id", F.col("JOB_ASSIGNMENT_STATUS_CD").alias("assignment_status")
    )
    alive = copies(open_rows(of_job(up.job_status)).filter(F.col("job_status_cd") != fv.CANCELLED), "job_id", "_status_rows")
    district = F.col("district_name")
    people = resolve_hierarchy(up.team_member, rules.own_company).select(
        "team_member_id", "MGR_TID", "TECHNICIAN", "COMPANY"
    )
    rows = (
        job.join(alive, "job_id")
        .join(assist_flags(of_job(up.processing_state)), "job_id", "left")
        .join(assignment, "job_id")
        .join(status, "job_assignment_id")
        .join(people, "team_member_id")  # a row without a worker's company is dropped below
        .join(order, "work_order_id")
        .filter((flag_to_int(F.col("IS_ASSIST")) == 0) | (F.col("orig_system_id") == fv.ASSIST_SOURCE_SYSTEM))
        .join(navigation_location(of_order(up.location), up.districts, rules), "work_order_id")
        .filter(F.lit(True) if start is None else in_local_period([F.col(c) for c in instants], F.col("zone"), start, end))
        .filter(any_like(district, rules.district_patterns) | district.isin(*rules.districts))
    )
    if keep is not None:
        rows = keep(rows)
        of_order, of_job = near_keys(rows, "work_order_id"), near_keys(rows, "job_id")
    dispatch = open_rows(of_order(up.location)).filter(F.col("work_order_location_usage_cd") == fv.DISPATCH_USAGE).select(
        "work_order_id", "src_last_updt_ts"
    )
    component = of_order(up.component).select(
        "work_order_id", F.col("work_order_component_id").alias("component_id"),
        F.col("estimated_duration_amt").alias("component_estimate"),
        F.col("work_order_action_cd").alias("component_action"), F.col("job_type_cd").alias("component_job_type"),
        F.col("product_category_cd").alias("component_product"), F.col("technology_cd").alias("component_technology"),
    )
    fine, coarse = booked_hours(of_job(up.time_entry))
    rows = (
        rows.join(service_names(of_order(up.service)), "work_order_id", "left")
        .join(work_order_attributes(of_order(up.work_order_attribute), READ_ATTRIBUTES), "work_order_id", "left")
        .join(copies(open_rows(of_order(up.work_order_status)), "work_order_id", "_order_rows"), "work_order_id", "left")
        .join(latest_counts(dispatch, "work_order_id", "src_last_updt_ts", "_dispatch_rows"), "work_order_id", "left")
        .join(copies(open_rows(of_order(up.party)), "work_order_id", "_party_rows"), "work_order_id", "left")
        .join(component, "work_order_id", "left")
        .join(coarse, "job_id", "left")
        .join(fine.withColumnRenamed("work_order_component_id", "component_id"), ["job_id", "component_id"], "left")
    )
    one = F.lit(1)
    company_east = (
        (F.col("COMPANY") == fv.EASTERN_SPLIT_COMPANY)
        & ~F.col("province").isin(*rules.western_provinces)
        & ~F.col("TECHNICIAN").like(fv.EASTERN_SPLIT_EXEMPT)
    )

    def pick(child: str, parent: str) -> Column:
        return child_or_parent(F.col("component_id"), F.col(child), F.col(parent))

    moments = [] if start is not None else [
        *instants, local_date(F.col(instants[0]), F.col("zone")).alias("appointment_day"), local_date(F.col(instants[1]), F.col("zone")).alias("early_day")]
    return rows.select(
        *moments, "work_order_id", "job_id", "province", "region", "district_name", "assignment_status", "classification",
        "MGR_TID", "TECHNICIAN",
        local_date(F.coalesce(*instants), F.col("zone")).alias("day"),
        F.when(company_east, fv.EASTERN_SPLIT_LABEL).otherwise(F.col("COMPANY")).alias("work_force"),
        work_class(F.col("service_name")).alias("work_class"),
        F.col("SPECIAL_PROJECT").alias("special_project"),
        pick("component_action", "order_action").alias("action_code"),
        pick("component_job_type", "job_job_type").alias("job_type"),
        pick("component_product", "PRODUCT_CATEGORY").alias("product_category"),
        pick("component_technology", "TECHNOLOGY").alias("technology"),
        pick("component_estimate", "job_estimate").alias("swt"),
        F.coalesce(pick("component_hours", "job_hours"), F.lit(0)).alias("awt"),
        (F.col("_status_rows") * F.coalesce("_order_rows", one) * F.coalesce("_dispatch_rows", one)
         * F.coalesce("_party_rows", one)).alias("copies"),
    )


def kept_rows(rows: DataFrame, rules: FactRules) -> DataFrame:
    """Drop special work classes, companies outside the region's list and contractor sub-teams in the west."""
    province, company = F.col("province"), F.col("work_force")
    home, west = province == rules.home_province, province.isin(*rules.western_provinces)
    return rows.filter(
        ~F.col("work_class").isin(*fv.DROPPED_WORK_CLASSES)
        & (
            (home & ~company.isin(*fv.HOME_DROPPED_COMPANIES))
            | ((province != rules.home_province) & company.isin(rules.own_company, *rules.away_contractors))
        )
        & ((~F.col("TECHNICIAN").like(fv.WESTERN_DROPPED_TECHNICIANS) & west) | ~west)
    )


def labelled_work(up: Upstream, rules: FactRules, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The kept rows of all periods with action, product and groups, before they are added up; ``keep`` as in :func:`work_rows`."""
    rows = kept_rows(work_rows(up, rules, keep=keep), rules).withColumn("action", work_order_action(rules))
    rows = rows.withColumn("product_key", F.concat("job_type", "product_category"))
    named = lookup(rows, up.product_keys, {"product_key": "product_key"}, "product", "product", fv.OTHER)
    return named.withColumns({
        "action_group": recode(F.col("action"), fv.ACTION_GROUPS, fv.OTHER),
        "product_group": product_group(F.col("product"), F.col("province"), rules.home_province, fv.PRODUCT_GROUPS_ANYWHERE_IN_FACT),
    })


def service_fact(up: Upstream, rules: FactRules, start: date, end: date, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Daily hours of work for local appointment days in [start, end); ``keep`` as in :func:`work_rows`.

    The distinct work order count belongs to its row alone and must not be added up.
    """
    rows = kept_rows(work_rows(up, rules, start, end, keep), rules).withColumn("action", work_order_action(rules))
    sums = rows.groupBy(
        F.col("day").alias("Appointment_Timestamp"), F.col("work_force").alias("Work_Force"),
        F.col("assignment_status").alias("Job_Assignment_Status"), F.col("job_type").alias("Job_Type_Cd"),
        F.col("product_category").alias("Product_Category"), F.col("special_project").alias("Special_Project"),
        F.col("technology").alias("Technology"), F.col("action").alias("Work_Order_Action"),
        F.col("district_name").alias("District"), F.col("province").alias("Province"),
    ).agg(
        F.sum(F.col("swt") * F.col("copies")).alias("SWT"),
        F.sum(F.col("awt") * F.col("copies")).alias("AWT"),
        F.sum("copies").alias("JobCount"),
        F.countDistinct("work_order_id").alias("WorkOrderCount"),
    ).withColumn("Product_Key", F.concat("Job_Type_Cd", "Product_Category"))
    named = lookup(sums, up.product_keys, {"Product_Key": "product_key"}, "product", "Product", fv.OTHER)
    return named.select(
        "Appointment_Timestamp", "Work_Force", "Job_Assignment_Status", "Job_Type_Cd", "Product_Category",
        "Special_Project", "Technology", "Work_Order_Action",
        recode(F.col("Work_Order_Action"), fv.ACTION_GROUPS, fv.OTHER).alias("Work_Order_Action_Grp"),
        "District", "Province", "Product_Key", "Product",
        product_group(F.col("Product"), F.col("Province"), rules.home_province,
                      fv.PRODUCT_GROUPS_ANYWHERE_IN_FACT).alias("Product_Grp"),
        "SWT", "AWT", "JobCount", "WorkOrderCount",
    )
