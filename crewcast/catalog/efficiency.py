"""Efficiency rules on the order facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crewcast import fixed_values as fv
from crewcast.catalog.base import Tables, money, query
from crewcast.catalog.inputs import (
    DISTRICTS_SQL, FORECAST_SQL, ORDER_FACTS_SQL, district_lookup, forecast_history, order_facts,
)
from crewcast.catalog.wide import month_case
from crewcast.operators import efficiency
from crewcast.sources.schemas import month_range

MONTHS = month_range(2000, 1, 24)
RULE_COLUMNS = """
  CASE c_mktsegment WHEN 'BUILDING' THEN 'HSIA' WHEN 'MACHINERY' THEN 'Managed' WHEN 'AUTOMOBILE' THEN 'Unmanaged'
    WHEN 'HOUSEHOLD' THEN 'All' ELSE 'MANAGED LAN' END AS Products_Impacted,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'All (Excluding Projects)' WHEN 'MACHINERY' THEN 'Repair' ELSE 'Install' END AS Job_Types_Impacted,
  CASE n_nationkey % 5 WHEN 0 THEN 'All' WHEN 1 THEN 'Tier 2' WHEN 2 THEN 'BC' WHEN 3 THEN n_name ELSE 'NU & NT' END AS Region_Impacted,
  CASE n_nationkey % 2 WHEN 0 THEN '% of hours' ELSE 'Hours' END AS Type_of_Reduction,
  n_name AS Owner"""
GROUPS = "c_mktsegment, n_nationkey, n_name"


def rules(t: Tables) -> DataFrame:
    """One rule per nation and segment: order amounts as planned hours, one column per month."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    amounts = [F.sum(F.when(F.expr(month_case(m, "o_orderdate")), money("o_totalprice"))).cast("double").alias(m) for m in MONTHS]
    keys = [F.expr(e.strip()) for e in _split(RULE_COLUMNS)]
    return t.stored(rows.groupBy(*GROUPS.split(", ")).agg(*amounts).select(*keys, *MONTHS))


def _split(columns: str) -> list[str]:
    """The listed expressions; each ends at its line's closing comma."""
    return [e for e in columns.strip().split(",\n")]


RULES_SQL = f"""
rules AS (
  SELECT {RULE_COLUMNS.strip()}, row_number() OVER (ORDER BY c_mktsegment, n_nationkey) AS uid, {', '.join(MONTHS)}
  FROM (SELECT {GROUPS}, {', '.join(
      f"CAST(SUM(CASE WHEN {month_case(m, 'o_orderdate')} THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS {m}" for m in MONTHS)}
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY {GROUPS})),
{DISTRICTS_SQL.strip()},
all_districts AS (SELECT DISTINCT district_old AS district, region_type, province FROM districts WHERE district_old IS NOT NULL),
covered AS (
  SELECT r.uid, r.Products_Impacted, r.Job_Types_Impacted, d.district FROM rules r, all_districts d
  WHERE CASE WHEN r.Region_Impacted = 'All' THEN true WHEN r.Region_Impacted LIKE 'Tier%' THEN d.region_type = r.Region_Impacted
    WHEN r.Region_Impacted IN {fv.SCOPE_PROVINCES} THEN d.province = r.Region_Impacted
    WHEN r.Region_Impacted = 'NU & NT' THEN d.province IN ('NT', 'NU') ELSE d.district = r.Region_Impacted END),
targets AS (
  SELECT uid, product, upper(unnest(CASE WHEN Job_Types_Impacted = 'All (Excluding Projects)' THEN {list(fv.ALL_JOB_TYPES)}
      ELSE [Job_Types_Impacted] END)) AS job_type, district
  FROM (SELECT c.uid, c.Job_Types_Impacted, c.district, unnest(CASE
      WHEN c.Products_Impacted = 'Managed' AND d.province <> 'QC' THEN {list(fv.MANAGED_AWAY)}
      WHEN c.Products_Impacted = 'Managed' AND d.province = 'QC' THEN {list(fv.MANAGED_HOME)}
      WHEN c.Products_Impacted = 'Unmanaged' AND d.province <> 'QC' THEN {list(fv.UNMANAGED_AWAY)}
      WHEN c.Products_Impacted = 'Unmanaged' AND d.province = 'QC' THEN {list(fv.UNMANAGED_HOME)}
      WHEN c.Products_Impacted = 'All' THEN {list(fv.ALL_PRODUCTS)} ELSE [c.Products_Impacted] END) AS product
    FROM covered c JOIN all_districts d ON c.district = d.district) WHERE product <> 'OTHER')"""


@query("scope_expand", f"""
WITH {RULES_SQL.strip()}
SELECT r.Owner, c.Products_Impacted, c.Job_Types_Impacted, c.district FROM covered c JOIN rules r USING (uid)""")
def scopes(t: Tables) -> DataFrame:
    keyed = efficiency.with_rule_key(rules(t))
    covered = efficiency.rule_districts(keyed, efficiency.known_districts(district_lookup(t))).select("efficiency_uid", "district")
    return covered.join(keyed, "efficiency_uid").select("Owner", "Products_Impacted", "Job_Types_Impacted", "district")


@query("family_explode", f"""
WITH {RULES_SQL.strip()}
SELECT r.Owner, r.Products_Impacted, t.product, t.job_type, t.district FROM targets t JOIN rules r USING (uid)""")
def families(t: Tables) -> DataFrame:
    keyed = efficiency.with_rule_key(rules(t))
    targets = efficiency.rule_targets(keyed, efficiency.known_districts(district_lookup(t))).select("efficiency_uid", "product", "job_type", "district")
    return targets.join(keyed, "efficiency_uid").select("Owner", "Products_Impacted", "product", "job_type", "district")


@query("efficiency_reduction", f"""
WITH {ORDER_FACTS_SQL.strip()}, {FORECAST_SQL.strip()}, {RULES_SQL.strip()},
totals AS (
  SELECT f.Forecast_Date, t.uid, CAST(f.Appointment_Month AS DATE) AS month, SUM(f.predicted_SWT.value) AS total
  FROM targets t JOIN forecast f ON f.District = t.district AND f.Product = t.product AND f.Work_Order_Action = t.job_type
  WHERE f.SWT_Type = 'predicted' GROUP BY ALL),
long AS (SELECT uid, Type_of_Reduction, CAST(strptime(label, '%b_%Y') AS DATE) AS month, v FROM rules UNPIVOT (v FOR label IN ({', '.join(MONTHS)}))),
merged AS (
  SELECT t.Forecast_Date, l.month, l.uid, CASE WHEN contains(l.Type_of_Reduction, '%') THEN l.v WHEN t.total > 0 THEN l.v / t.total END AS r
  FROM long l JOIN totals t ON l.uid = t.uid AND l.month = t.month
  WHERE l.month >= date_trunc('month', CAST(t.Forecast_Date AS TIMESTAMP))),
filled AS (SELECT *, last_value(r IGNORE NULLS) OVER (PARTITION BY Forecast_Date, uid ORDER BY month
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c FROM merged)
SELECT f.Forecast_Date, f.month AS appointment_month, t.product, t.job_type AS Work_Order_Action, t.district, round(f.c, 6) AS efficiency_reduction
FROM filled f JOIN targets t ON f.uid = t.uid""")
def reductions(t: Tables) -> DataFrame:
    rows = efficiency.efficiency_reductions(rules(t), district_lookup(t), forecast_history(order_facts(t)))
    return rows.withColumn("efficiency_reduction", F.round("efficiency_reduction", 6))
