"""What the plans must not contain, and what must reach the scan."""

import re

import pytest
from pyspark.sql import functions as F

from crewcast.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"
FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")

#: Jobs and fits that run when they are asked for; the plans of their parts are those of other queries.
WHOLE_JOBS = {"global_monthly_forecast", "resumed_run", "direct_monthly_scores", "back_test_job", "fact_to_panel"}


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WHOLE_JOBS))
def test_no_pairwise_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert not [word for word in FORBIDDEN if word in text]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WHOLE_JOBS))
def test_scans_read_only_needed_columns(spark, name):
    """No scan of the line items or orders reads every column."""
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan(QUERIES[name](spark, FOLDER))):
        columns = schema.split(",")
        if columns[0].startswith("l_"):
            assert len(columns) < 11
        if columns[0].startswith("o_"):
            assert len(columns) <= 6


def test_pivot_is_one_aggregation_without_window(spark):
    text = plan(QUERIES["latest_attribute_pivot"](spark, FOLDER))
    assert text.count("Exchange hashpartitioning") == 1 and "Window" not in text


def test_trailing_rows_are_cut_before_the_shuffle(spark):
    text = plan(QUERIES["trailing_window"](spark, FOLDER))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_folds_add_no_shuffle(spark):
    plain, tagged = (plan(QUERIES[n](spark, FOLDER)).count("Exchange") for n in ("daily_ingest", "cv_train"))
    assert plain == tagged


def test_month_grid_adds_no_join(spark):
    text = plan(QUERIES["dense_month_panel"](spark, FOLDER))
    assert text.count("Join") == 2  # customer and nation, nothing for the calendar


def test_period_bound_reaches_the_scan(spark, tmp_path):
    from datetime import date

    from pyspark.sql import functions as F

    from crewcast.plans.fact import near_period

    path = str(tmp_path / "jobs")
    spark.sql("SELECT timestamp_ntz'2024-03-01 10:00:00' AS ts, 1 AS x").write.parquet(path)
    jobs = spark.read.parquet(path).filter(near_period(F.col("ts"), date(2024, 1, 1), date(2024, 2, 1)))
    text = plan(jobs)
    assert "GreaterThanOrEqual(ts,2023-12-31" in text and "LessThan(ts,2024-02-02" in text


def test_stored_histories_are_read_by_folder_and_joined_where_they_lie(spark):
    from datetime import date

    from crewcast.catalog.base import Tables
    from crewcast.catalog.facts import RULES, Views
    from crewcast.plans.fact import service_fact
    from crewcast.session import shared_folder
    from crewcast.sources import histories

    views = Views(Tables(spark, FOLDER)).all()
    stored = histories.store_all(views, "plan_test", shared_folder(spark), 4, "year")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        # The district sheet is the only table that may still be broadcast.
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20kb")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        loose, lying = (plan(service_fact(up, RULES, date(1996, 1, 1), date(1996, 2, 1))) for up in (views, stored))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    moved = lambda text: len(re.findall(r"(?<!Reused)Exchange hashpartitioning\(work_order_id", text))
    assert moved(loose) > 8
    assert moved(lying) <= 2  # the period's rows, never a history
    filters = set(re.findall(r"PartitionFilters: \[([^\]]*)\]", lying))
    assert any("effective_year" in f and "9999-01-01" in f for f in filters)
    assert any("appointment_year" in f and "early_year" in f for f in filters)
    # Under an exchange by work order there is no scan of a history, but what came through earlier joins.
    assert len(re.findall("Bucketed: true", lying)) >= 10
    for name in histories.LAYOUTS:
        spark.sql(f"DROP TABLE plan_test_{name}")


def test_a_load_of_stored_histories_opens_few_files(spark):
    from datetime import date

    from crewcast.catalog.base import Tables
    from crewcast.catalog.facts import Views
    from crewcast.plans.fact import period_jobs
    from crewcast.session import shared_folder
    from crewcast.sources import histories

    jobs = Views(Tables(spark, FOLDER)).job
    stored = histories.store(jobs, "few_files", shared_folder(spark), histories.LAYOUTS["job"], 2)
    instants = ["appointment_start_datetime", "early_start_time"]
    near = [period_jobs(rows, instants, date(1996, 1, 1), date(1996, 2, 1)).select("job_id") for rows in (jobs, stored)]
    assert near[0].count() == near[1].count() > 0 and near[0].exceptAll(near[1]).isEmpty()
    opened = period_jobs(stored, instants, date(1996, 1, 1), date(1996, 2, 1))
    files = len(opened.select(F.input_file_name()).distinct().collect())
    assert 0 < files < 0.1 * stored.select(F.input_file_name()).distinct().count()
    spark.sql("DROP TABLE few_files")


def test_the_median_looks_into_one_range_of_values(spark):
    text = plan(QUERIES["profile_numeric"](spark, FOLDER))
    windows = re.findall(r"Window \[[^\]]*\], \[([^\]]*)\]", text)
    assert windows and all("_part" in w for w in windows)


def test_a_table_functions_dates_reach_the_scan(spark, tmp_path):
    from crewcast.catalog.base import Tables
    from crewcast.catalog.facts import RULES, Views
    from crewcast.plans.sql_functions import register_all

    from dataclasses import replace

    views = Views(Tables(spark, FOLDER)).all()
    views.job.write.parquet(f"{tmp_path}/job")
    register_all(replace(views, job=spark.read.parquet(f"{tmp_path}/job")), RULES, "plan_")
    rows = spark.sql("SELECT District, sum(SWT) AS hours FROM plan_period_fact(DATE'1996-01-01', DATE'1996-02-01') GROUP BY District")
    pushed = [f for f in re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan(rows)) if "early_start_time" in f]
    assert pushed and all("1995-12-31" in f and "1996-02-02" in f for f in pushed)
    found = spark.sql("SELECT (SELECT product_group FROM plan_product_group_of('QC', 'MPAAS')) AS a, "
                      "(SELECT product_group FROM plan_product_group_of(NULL, 'MPAAS')) AS b, (SELECT product FROM plan_product_of('no', NULL)) AS c").first()
    assert tuple(found) == ("Managed MPAAS", "OTHER", "OTHER")
