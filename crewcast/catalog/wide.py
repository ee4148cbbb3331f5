"""Month columns to rows and back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from crewcast.catalog.base import Tables, money, query
from crewcast.functions import month_of
from crewcast.operators.efficiency import efficiency_report
from crewcast.operators.reshape import pivot_labels, unpivot_months
from crewcast.sources.schemas import month_range

#: From the first to the last month of the line items.
MONTHS = month_range(1995, 1, 84)


def month_case(name: str, label: str = "l_shipdate") -> str:
    """SQL for the amount that falls into the month a column is named after; it runs on both engines."""
    short = {m: i for i, m in enumerate("Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split(), 1)}
    month, year = name.split("_")
    return f"year({label}) = {year} AND month({label}) = {short[month[:3]]}"


WIDE_SQL = f"""
wide AS (
  SELECT p_type, p_brand, nullif(p_type, 'LARGE') AS notes, {', '.join(
      f"CAST(SUM(CASE WHEN {month_case(m)} THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS {m}" for m in MONTHS)}
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)"""


def wide_months(t: Tables) -> DataFrame:
    """Amount per part type and brand with one column per month: summed by month once, then read from a map as long as the calendar."""
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).filter(F.col("l_shipdate").isNotNull())
    sums = rows.groupBy("p_type", "p_brand", month_of(F.col("l_shipdate").cast("date")).alias("month")).agg(F.sum(money("l_extendedprice")).alias("amount"))
    maps = sums.groupBy("p_type", "p_brand").agg(F.map_from_entries(F.collect_list(F.struct("month", "amount"))).alias("amounts"))
    cells = [F.try_element_at("amounts", F.lit(date(1995 + i // 12, i % 12 + 1, 1))).cast("double").alias(m) for i, m in enumerate(MONTHS)]
    return maps.select("p_type", "p_brand", *cells, F.nullif(F.col("p_type"), F.lit("LARGE")).alias("notes"))


UNPIVOT_SQL = f"""
long AS (SELECT p_type, p_brand, notes, CAST(strptime(label, '%b_%Y') AS DATE) AS month, amount
  FROM wide UNPIVOT (amount FOR label IN ({', '.join(MONTHS)})))"""


@query("unpivot_months", f"""
WITH {WIDE_SQL.strip()}, {UNPIVOT_SQL.strip()} SELECT p_type, p_brand, month, amount FROM long""")
def unpivoted(t: Tables) -> DataFrame:
    return unpivot_months(wide_months(t), ["p_type", "p_brand"], "month", "amount")


@query("unpivot_reaggregate", f"""
WITH {WIDE_SQL.strip()}, {UNPIVOT_SQL.strip()}
SELECT upper(p_type) AS kind, month, CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM long WHERE notes NOT LIKE '%PROMO%' GROUP BY ALL""")
def reaggregated(t: Tables) -> DataFrame:
    free = wide_months(t).filter(~F.col("notes").like("%PROMO%"))
    long = unpivot_months(free, ["p_type"], "month", "amount")
    return long.groupBy(F.upper("p_type").alias("kind"), "month").agg(
        F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("amount")
    )


@query("pivot_actual_predicted", """
SELECT * FROM (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_suppkey,
    CAST(SUM(CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS Actual,
    CAST(SUM(CASE WHEN l_linestatus = 'O' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS Predicted
  FROM lineitem GROUP BY ALL)
WHERE Actual IS NOT NULL AND Predicted IS NOT NULL""")
def pivoted(t: Tables) -> DataFrame:
    long = t.lineitem.groupBy(
        F.trunc("l_shipdate", "MM").alias("month"), "l_suppkey",
        F.when(F.col("l_linestatus") == "F", "Actual").otherwise("Predicted").alias("kind"),
    ).agg(F.sum(money("l_extendedprice")).cast("double").alias("amount"))
    return pivot_labels(long, ["month", "l_suppkey"], "kind", ["Actual", "Predicted"], "amount")


@query("efficiency_long", f"""
WITH {WIDE_SQL.strip()}, {UNPIVOT_SQL.strip()}
SELECT p_brand AS Program_Name, p_type AS Initiative_Name, notes AS Owner, DATE '1995-01-01' AS Start_Date, p_type AS Products_Impacted,
  'All' AS Job_Types_Impacted, 'All' AS Region_Impacted, 'hours' AS Type_of_Reduction, strftime(month, '%Y-%m') AS Month, amount AS Value
FROM long""")
def report(t: Tables) -> DataFrame:
    rules = wide_months(t).selectExpr(
        "p_brand AS Program_Name", "p_type AS Initiative_Name", "notes AS Owner", "date'1995-01-01' AS Start_Date",
        "p_type AS Products_Impacted", "'All' AS Job_Types_Impacted", "'All' AS Region_Impacted",
        "'hours' AS Type_of_Reduction", *MONTHS,
    )
    return efficiency_report(rules)
