"""Latest values, joins and ordered windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crewcast.catalog.base import Tables, doubles, money, query
from crewcast.functions import child_or_parent, month_of, month_sequence
from crewcast.operators.joins import matching_keys
from crewcast.operators.latest import Latest, latest_pivot, latest_rows
from crewcast.operators.panel import carried_forward, period_sums, previous_or


def event_days(t: Tables) -> DataFrame:
    """Events with the day as order, so that an entity has ties, and with null values."""
    return t.events.selectExpr(
        "event_id", "user_id", "event_type", "date(ts) AS day", "nullif(props, '{\"k\": 0}') AS props", "value"
    )


EVENT_DAYS_SQL = """
event_days AS (
  SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day, nullif(props, '{"k": 0}') AS props, value FROM events)"""


@query("latest_attribute_pivot", f"""
WITH {EVENT_DAYS_SQL.strip()}
SELECT user_id, max(CASE WHEN event_type = 'click' THEN props END) AS click,
  max(CASE WHEN event_type = 'purchase' THEN props END) AS purchase,
  max(CASE WHEN event_type = 'purchase' THEN value END) AS purchase_value,
  max(CASE WHEN event_type IN ('signup', 'view') THEN props END) AS visit
FROM (SELECT * FROM event_days WHERE event_type <> 'error'
  QUALIFY rank() OVER (PARTITION BY user_id, event_type ORDER BY day DESC) = 1)
GROUP BY user_id""")
def latest_attributes(t: Tables) -> DataFrame:
    return latest_pivot(event_days(t), "user_id", "event_type", "day", {
        "click": Latest(["click"], "props"), "purchase": Latest(["purchase"], "props"),
        "purchase_value": Latest(["purchase"], "value"), "visit": Latest(["signup", "view"], "props"),
    })


@query("latest_with_ties", f"""
WITH {EVENT_DAYS_SQL.strip()}
SELECT * FROM event_days QUALIFY rank() OVER (PARTITION BY user_id, event_type ORDER BY day DESC) = 1""")
def latest_ties(t: Tables) -> DataFrame:
    return latest_rows(event_days(t), ["user_id", "event_type"], "day")


@query("star_fact", """
SELECT r_name, c_mktsegment, p_type, coalesce(s_nationkey, -1) AS worker_nation, CAST(COUNT(*) AS BIGINT) AS n,
  CAST(SUM(CAST(coalesce(l_extendedprice, o_totalprice) AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM orders
  LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag <> 'N') l ON o_orderkey = l.l_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
GROUP BY ALL""")
def star(t: Tables) -> DataFrame:
    parts = t.lineitem.filter(F.col("l_returnflag") != "N")
    rows = (
        t.orders.join(parts, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    )
    amount = F.coalesce("l_extendedprice", "o_totalprice").cast("decimal(18,2)")
    return rows.groupBy(
        "r_name", "c_mktsegment", "p_type", F.coalesce("s_nationkey", F.lit(-1)).alias("worker_nation")
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(amount).cast("double").alias("amount"))


@query("child_or_parent_switch", """
SELECT o_orderstatus, o_orderpriority, CAST(COUNT(*) AS BIGINT) AS n, CAST(COUNT(v) AS BIGINT) AS filled, CAST(SUM(v) AS DOUBLE) AS total
FROM (SELECT o_orderstatus, o_orderpriority, CASE WHEN l_partkey IS NOT NULL THEN CAST(nullif(l_tax, 0) AS DECIMAL(18,2))
    ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS v
  FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') l ON o_orderkey = l_orderkey)
GROUP BY ALL""")
def child_switch(t: Tables) -> DataFrame:
    children = t.lineitem.filter(F.col("l_returnflag") == "R")
    rows = t.orders.join(children, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    tax = F.nullif(F.col("l_tax"), F.lit(0.0)).cast("decimal(18,2)")
    value = child_or_parent(F.col("l_partkey"), tax, money("o_totalprice"))
    return rows.select("o_orderstatus", "o_orderpriority", value.alias("v")).groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.count("v").alias("filled"), F.sum("v").cast("double").alias("total")
    )


@query("residual_outer_join", """
SELECT c_custkey, CAST(COUNT(o_orderkey) AS BIGINT) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F' AND o_totalprice > 250000
GROUP BY c_custkey""")
def residual(t: Tables) -> DataFrame:
    """The condition on the right side is applied before the join, and the right side is summed first."""
    sums = t.orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 250000)).groupBy("o_custkey").agg(
        F.count("o_orderkey").alias("_n"), F.sum(money("o_totalprice")).cast("double").alias("total")
    )
    rows = t.customer.select("c_custkey").join(sums, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.select("c_custkey", F.coalesce("_n", F.lit(0)).alias("n"), "total")


@query("semi_membership", """
SELECT o_orderstatus, CAST(COUNT(*) AS BIGINT) AS n FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY 1""")
def membership(t: Tables) -> DataFrame:
    members = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    return matching_keys(t.orders, members, ["o_custkey"]).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


SERIES = ["o_orderstatus", "o_orderpriority", "c_nationkey"]
STATUS_MONTHS_SQL = f"""
sums AS (
  SELECT {', '.join(SERIES)}, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS amount
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
months AS (
  SELECT * FROM (SELECT DISTINCT {', '.join(SERIES)} FROM sums)
  CROSS JOIN (SELECT CAST(unnest(generate_series((SELECT min(month) FROM sums), (SELECT max(month) FROM sums), INTERVAL 1 MONTH)) AS DATE) AS month)
  LEFT JOIN sums USING ({', '.join(SERIES)}, month))"""


def status_months(t: Tables) -> DataFrame:
    """Monthly amounts of all orders per status, priority and nation on one calendar; a month without orders has no amount."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        *SERIES, F.col("o_orderdate").cast("date").alias("day"), money("o_totalprice").alias("amount"))
    sums = period_sums(rows, SERIES, month_of(F.col("day")), "month", ["amount"])
    ends = t.orders.agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    first, last = (ends.select(month_of(F.col(c).cast("date"))).scalar() for c in ("first", "last"))
    held = sums.groupBy(*SERIES).agg(F.map_from_entries(F.collect_list(F.struct("month", "amount"))).alias("_held"))
    grid = held.select("*", F.explode(month_sequence(first, last)).alias("month"))
    return grid.select(*SERIES, "month", F.try_element_at("_held", F.col("month")).alias("amount"))


@query("forward_fill", f"""
WITH {STATUS_MONTHS_SQL.strip()}
SELECT {', '.join(SERIES)}, month, CAST(amount AS DOUBLE) AS amount, CAST(last_value(amount IGNORE NULLS) OVER (
    PARTITION BY {', '.join(SERIES)} ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS filled
FROM months""")
def forward_fill(t: Tables) -> DataFrame:
    rows = status_months(t).withColumn("filled", carried_forward("amount", SERIES, "month"))
    return rows.select(*SERIES, "month", *doubles("amount", "filled"))


@query("lag_default", f"""
WITH {STATUS_MONTHS_SQL.strip()}
SELECT {', '.join(SERIES)}, month, CAST(coalesce(lag(amount) OVER (PARTITION BY {', '.join(SERIES)} ORDER BY month), 0) AS DOUBLE) AS previous
FROM months""")
def lag_default(t: Tables) -> DataFrame:
    rows = status_months(t).withColumn("previous", previous_or("amount", SERIES, ["month"], 0))
    return rows.select(*SERIES, "month", *doubles("previous"))
