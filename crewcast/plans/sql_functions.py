"""Table functions for SQL users: the period fact, the two product lookups and the worker table.

They are temporary SQL functions over temporary views, so Catalyst sees their bodies: a filter on a function's rows reaches
the scan below, and a lookup called with LATERAL becomes a join.

    SELECT * FROM period_fact(DATE'2025-01-01', DATE'2025-02-01')
    SELECT o.*, p.product FROM orders o, LATERAL product_of(o.job_type, o.category) p
    SELECT r.*, g.product_group FROM rows r, LATERAL product_group_of(r.province, r.product) g
    SELECT * FROM workers()
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from crewcast import fixed_values as fv
from crewcast.operators.joins import resolve_hierarchy
from crewcast.plans.fact import FactRules, Upstream, labelled_work

MEASURES = "SWT decimal(38,9), AWT decimal(38,9), JobCount bigint, WorkOrderCount bigint"


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _create(spark: SparkSession, name: str, arguments: str, columns: str, body: str) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE ({columns}) RETURN {body}")


def register_workers(members: DataFrame, rules: FactRules, prefix: str = "") -> None:
    """``workers()``: every worker with manager and manager's manager."""
    rows = resolve_hierarchy(members, rules.own_company)
    rows.createOrReplaceTempView(f"{prefix}worker_rows")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    _create(rows.sparkSession, f"{prefix}workers", "", columns, f"SELECT {', '.join(rows.columns)} FROM {prefix}worker_rows")


def register_product_of(product_keys: DataFrame, prefix: str = "") -> None:
    """``product_of(job_type, category)``: one row with the product of the key, ``OTHER`` without one."""
    product_keys.createOrReplaceTempView(f"{prefix}product_key_rows")
    _create(product_keys.sparkSession, f"{prefix}product_of", "job_type STRING, category STRING", "product STRING",
            f"SELECT coalesce(min(k.product), '{fv.OTHER}') FROM {prefix}product_key_rows k WHERE k.product_key = concat(job_type, category)")


def register_product_group_of(spark: SparkSession, rules: FactRules, anywhere: Sequence[str] = (), prefix: str = "") -> None:
    """``product_group_of(province, product)``: one row with the group, ``OTHER`` without one or in an unknown province."""
    sides = [(False, fv.PRODUCT_GROUPS_AWAY), (True, fv.PRODUCT_GROUPS_HOME)]
    listed = [(product, home, group) for home, groups in sides for product, group in groups.items() if product not in anywhere]
    listed += [(product, home, fv.PRODUCT_GROUPS_AWAY[product]) for product in anywhere for home in (False, True, None)]
    values = ", ".join(f"({_quoted(p)}, {'NULL' if home is None else str(home).lower()}, {_quoted(g)})" for p, home, g in listed)
    _create(spark, f"{prefix}product_group_of", "province STRING, product STRING", "product_group STRING",
            f"SELECT coalesce(min(r.g), '{fv.OTHER}') FROM VALUES {values} AS r(p, home, g) "
            f"WHERE r.p = product AND r.home <=> (province = {_quoted(rules.home_province)})")


def register_period_fact(up: Upstream, rules: FactRules, prefix: str = "", keep: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """``period_fact(first, until)``: the daily fact of the local days [first, until).

    The view below holds the rows of all periods; the function's dates bound the jobs' instants as well, which reaches
    the job scan. With ``keep``, which stores rows and gives them back, the rows of all periods are built once, now, from histories
    that are cut as in :func:`work_rows`; calls then read the days they ask for from what is stored, as of now.
    """
    rows = labelled_work(up, rules, keep)
    rows = rows if keep is None else keep(rows)
    rows.createOrReplaceTempView(f"{prefix}work_rows")
    keys = {
        "Appointment_Timestamp": "day", "Work_Force": "work_force", "Job_Assignment_Status": "assignment_status", "Job_Type_Cd": "job_type",
        "Product_Category": "product_category", "Special_Project": "special_project", "Technology": "technology", "Work_Order_Action": "action",
        "Work_Order_Action_Grp": "action_group", "District": "district_name", "Province": "province", "Product_Key": "product_key",
        "Product": "product", "Product_Grp": "product_group",
    }
    columns = ", ".join(f"{out} {rows.schema[own].dataType.simpleString()}" for out, own in keys.items())
    near = " OR ".join(f"({c} >= CAST(first AS TIMESTAMP_NTZ) - INTERVAL 1 DAY AND {c} < CAST(until AS TIMESTAMP_NTZ) + INTERVAL 1 DAY)"
                       for c in ("appointment_start_datetime", "early_start_time"))
    inside = " OR ".join(f"({c} >= first AND {c} < until)" for c in ("appointment_day", "early_day"))
    _create(rows.sparkSession, f"{prefix}period_fact", "first DATE, until DATE", f"{columns}, {MEASURES}", f"""
        SELECT {', '.join(keys.values())}, CAST(sum(swt * copies) AS DECIMAL(38,9)), CAST(sum(awt * copies) AS DECIMAL(38,9)), sum(copies),
          count(DISTINCT work_order_id)
        FROM {prefix}work_rows WHERE ({near}) AND ({inside}) GROUP BY {', '.join(keys.values())}""")


def register_all(up: Upstream, rules: FactRules, prefix: str = "", keep: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """All four, ``keep`` as in :func:`register_period_fact`; the stand-alone group lookup knows no product that holds everywhere."""
    register_workers(up.team_member, rules, prefix)
    register_product_of(up.product_keys, prefix)
    register_product_group_of(up.job.sparkSession, rules, prefix=prefix)
    register_period_fact(up, rules, prefix, keep)
