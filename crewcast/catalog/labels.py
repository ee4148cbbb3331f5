"""Recoding by lookups and rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crewcast import fixed_values as fv
from crewcast.catalog.base import Tables, query
from crewcast.catalog.inputs import DISTRICTS_SQL, district_lookup
from crewcast.functions import any_like, first_match, mentions, recode, renamed_key, repaired
from crewcast.operators.joins import lookup, two_key_group
from crewcast.plans.fact import FactRules, product_group
from crewcast.plans.sql_functions import register_product_group_of

PRODUCTS = [*fv.ALL_PRODUCTS, "MODEM", None]
LISTED = ", ".join("NULL" if p is None else f"'{p}'" for p in PRODUCTS)
SIDES_SQL = f"""
sides AS (SELECT [{LISTED}][CAST(p_partkey % {len(PRODUCTS)} + 1 AS INTEGER)] AS product, ['QC', 'ON', NULL][p_size % 3 + 1] AS province FROM part)"""
RULES_SQL = ", ".join(f"('{product}', {home}, '{group}')" for home, groups in (("false", fv.PRODUCT_GROUPS_AWAY), ("true", fv.PRODUCT_GROUPS_HOME))
                      for product, group in groups.items())


def sides(t: Tables) -> DataFrame:
    """Parts as (product, province): all products, one unknown and none; the sizes give home, other and unknown provinces."""
    return t.part.selectExpr(f"array({LISTED})[int(p_partkey % {len(PRODUCTS)})] AS product", "array('QC', 'ON', NULL)[p_size % 3] AS province")


RECODE_SQL = f"""
WITH {SIDES_SQL.strip()}, rules(product, home, product_group) AS (VALUES {RULES_SQL})
SELECT product, province, coalesce(product_group, '{fv.OTHER}') AS product_group, CAST(COUNT(*) AS BIGINT) AS n
FROM (SELECT *, province = '{fv.HOME_PROVINCE}' AS home FROM sides) LEFT JOIN rules USING (product, home) GROUP BY ALL"""


@query("two_key_recode", RECODE_SQL)
def groups(t: Tables) -> DataFrame:
    group = product_group(F.col("product"), F.col("province"))
    return sides(t).groupBy("product", "province", group.alias("product_group")).agg(F.count(F.lit(1)).alias("n"))


@query("sql_product_group_of", RECODE_SQL)
def sql_groups(t: Tables) -> DataFrame:
    """The same recode, by the SQL table function called with LATERAL."""
    register_product_group_of(t.spark, FactRules(own_company=""), prefix="label_")
    sides(t).createOrReplaceTempView("label_sides")
    return t.spark.sql("""SELECT s.product, s.province, product_group, count(*) AS n
        FROM label_sides s, LATERAL label_product_group_of(s.province, s.product) GROUP BY ALL""")


@query("two_key_lookup", f"""
WITH {SIDES_SQL.strip()}, rules(p, side, g) AS (VALUES ('MPAAS', true, 'inside'), ('MPAAS', false, 'outside'),
  ('SDS WIFI', NULL, 'anywhere'), ('WAVELENGTH', false, 'outside'))
SELECT product, province, coalesce(g, 'OTHER') AS product_group, CAST(COUNT(*) AS BIGINT) AS n
FROM sides LEFT JOIN rules ON product = p AND (side IS NULL OR side = (province = 'QC')) GROUP BY ALL""")
def rule_table(t: Tables) -> DataFrame:
    """The same recode with the rules as a table; one rule holds in every province."""
    rules = t.spark.createDataFrame(
        [("MPAAS", True, "inside"), ("MPAAS", False, "outside"), ("SDS WIFI", None, "anywhere"), ("WAVELENGTH", False, "outside")],
        "product string, in_home_region boolean, product_group string",
    )
    grouped = two_key_group(sides(t), rules, "product", F.col("province") == fv.HOME_PROVINCE, "product_group", fv.OTHER)
    return grouped.groupBy("product", "province", "product_group").agg(F.count(F.lit(1)).alias("n"))


@query("composite_key_lookup", """
WITH keys AS (SELECT p_type, p_brand, min(p_name) AS label FROM part GROUP BY ALL)
SELECT coalesce(k.label, 'OTHER') AS product, CAST(COUNT(*) AS BIGINT) AS n,
  CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM lineitem JOIN part p ON l_partkey = p_partkey LEFT JOIN keys k
  ON nullif(p.p_type, 'LARGE') = k.p_type AND p.p_brand = k.p_brand GROUP BY 1""")
def composite(t: Tables) -> DataFrame:
    """Label by type and brand from a mapping table; a null half of the key never matches."""
    keys = t.part.groupBy("p_type", "p_brand").agg(F.min("p_name").alias("label"))
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.nullif(F.col("p_type"), F.lit("LARGE")).alias("type"), F.col("p_brand").alias("brand"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
    )
    # Rows with the same key share their label, so they are added up before the lookup.
    sums = rows.groupBy("type", "brand").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))
    named = lookup(sums, keys, {"type": "p_type", "brand": "p_brand"}, "label", "product", fv.OTHER)
    return named.groupBy("product").agg(F.sum("n").alias("n"), F.sum("amount").cast("double").alias("amount"))


@query("group_recode", """
SELECT CASE WHEN a IN ('INSTALL', 'RISER') THEN 'Install' WHEN a IN ('MOVE', 'CHANGE') THEN 'MAC & Out'
    WHEN a = 'REPAIR' THEN 'Repair' ELSE 'OTHER' END AS action_group, CAST(COUNT(*) AS BIGINT) AS n
FROM (SELECT ['INSTALL', 'RISER', 'MOVE', 'CHANGE', 'REPAIR', 'SURVEY', NULL][l_linenumber] AS a FROM lineitem) GROUP BY 1""")
def action_groups(t: Tables) -> DataFrame:
    actions = "array('INSTALL', 'RISER', 'MOVE', 'CHANGE', 'REPAIR', 'SURVEY', NULL)[l_linenumber - 1]"
    rows = t.lineitem.select(F.expr(actions).alias("a"))
    return rows.groupBy(recode(F.col("a"), fv.ACTION_GROUPS, fv.OTHER).alias("action_group")).agg(F.count(F.lit(1)).alias("n"))


@query("tier_lookup_nullable", """
SELECT tier, CAST(COUNT(*) AS BIGINT) AS n FROM (
  SELECT CASE d WHEN 'FFB - Calgary' THEN 'Tier 1' WHEN 'FFB - Ontario' THEN 'Tier 2' WHEN 'FFB - Yukon' THEN 'Tier 3' END AS tier
  FROM (SELECT ['FFB - Calgary', 'FFB - Ontario', 'FFB - Yukon', 'FFB - Atlantis', NULL][c_nationkey % 5 + 1] AS d FROM customer))
GROUP BY 1""")
def tiers(t: Tables) -> DataFrame:
    names = "array('FFB - Calgary', 'FFB - Ontario', 'FFB - Yukon', 'FFB - Atlantis', NULL)[c_nationkey % 5]"
    rows = t.customer.select(F.expr(names).alias("d"))
    return rows.groupBy(recode(F.col("d"), fv.DISTRICT_TIERS).alias("tier")).agg(F.count(F.lit(1)).alias("n"))


@query("text_repair", """
SELECT CASE r WHEN 'RÃ©seau - Affaire QuÃ©bec' THEN 'Réseau - Affaire Québec' ELSE r END AS region, CAST(COUNT(*) AS BIGINT) AS n
FROM (SELECT CASE WHEN n_regionkey = 0 THEN 'RÃ©seau - Affaire QuÃ©bec' WHEN n_regionkey = 1 THEN NULL ELSE n_name END AS r
  FROM customer JOIN nation ON c_nationkey = n_nationkey) GROUP BY 1""")
def repair(t: Tables) -> DataFrame:
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.when(F.col("n_regionkey") == 0, "RÃ©seau - Affaire QuÃ©bec").when(F.col("n_regionkey") != 1, F.col("n_name")).alias("r")
    )
    return rows.groupBy(repaired(F.col("r"), fv.REGION_REPAIRS).alias("region")).agg(F.count(F.lit(1)).alias("n"))


@query("migrated_key", f"""
WITH {DISTRICTS_SQL.strip()}
SELECT if(coalesce(migration, '-') = '', district, district_old) AS name, CAST(COUNT(*) AS BIGINT) AS n
FROM customer LEFT JOIN districts ON service_area_clli = 'A' || c_nationkey GROUP BY 1""")
def migrated(t: Tables) -> DataFrame:
    counts = t.customer.groupBy(F.concat(F.lit("A"), F.col("c_nationkey").cast("string")).alias("area")).agg(
        F.count(F.lit(1)).alias("n")
    )
    rows = counts.join(district_lookup(t), F.col("area") == F.col("service_area_clli"), "left")
    name = renamed_key(F.col("migration"), F.col("district"), F.col("district_old"))
    return rows.groupBy(name.alias("name")).agg(F.sum("n").alias("n"))


@query("pattern_predicates", """
SELECT p_name LIKE '%bolt%' OR p_name LIKE 'h_t%' AS wildcard, upper(p_name) LIKE '%RING' AS folded,
  contains(lower(p_brand), '#1') AS literal, CASE WHEN p_name LIKE 'red%' THEN 'red' WHEN p_name LIKE '%gear' THEN 'gear' END AS label,
  CAST(COUNT(*) AS BIGINT) AS n
FROM part GROUP BY ALL""")
def patterns(t: Tables) -> DataFrame:
    name = F.col("p_name")
    return t.part.groupBy(
        any_like(name, ["%bolt%", "h_t%"]).alias("wildcard"), F.upper(name).like("%RING").alias("folded"),
        mentions(F.col("p_brand"), "#1").alias("literal"),
        first_match([(name.like("red%"), "red"), (name.like("%gear"), "gear")]).alias("label"),
    ).agg(F.count(F.lit(1)).alias("n"))
