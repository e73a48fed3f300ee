"""Queries for the integrity rules.

The driver tables are clean (no NULLs, no orphans, unique single keys), so
faults are planted by value rules that both Spark and the SQL oracle apply to
every row; nothing is sampled or dropped.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tillroll.operators import quality
from tillroll.plans.registry import query
from tillroll.sources.tables import read_table


@query("q_pk_check", "A17", """
SELECT l_orderkey, l_linenumber, count(*) AS n
FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL
""")
def q_pk_check(spark: SparkSession, sf: str):
    li = read_table(spark, sf, "lineitem")
    return quality.check_primary_key(li, ["l_orderkey", "l_linenumber"])


_PART_NAMES = """
SELECT p_partkey, CASE WHEN p_brand = 'Brand#7' THEN NULL ELSE p_name END AS p_name FROM part
"""


def _part_names(spark, sf):
    return read_table(spark, sf, "part").select(
        "p_partkey",
        F.when(F.col("p_brand") == "Brand#7", F.lit(None)).otherwise(F.col("p_name")).alias("p_name"),
    )


@query("q_unique_check", "A18", f"""
WITH p AS ({_PART_NAMES})
SELECT p_name, count(*) AS n FROM p WHERE p_name IS NOT NULL
GROUP BY p_name HAVING count(*) > 1
""")
def q_unique_check(spark: SparkSession, sf: str):
    """Unique names; brand 7 loses its name and NULLs must not collide."""
    return quality.check_unique(_part_names(spark, sf), ["p_name"])


_ORDERS_WITH_NULLS = """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN NULL ELSE o_custkey END AS o_custkey,
       o_orderstatus,
       CASE WHEN o_totalprice < 5000 THEN NULL ELSE o_totalprice END AS o_totalprice,
       o_orderdate,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END
         AS o_orderpriority
FROM orders
"""


def _orders_with_nulls(spark, sf):
    o = read_table(spark, sf, "orders")
    c, p, s = F.col("o_custkey"), F.col("o_orderpriority"), F.col("o_orderstatus")
    return o.select(
        "o_orderkey",
        F.when((s == "O") & (p == "1-URGENT"), F.lit(None)).otherwise(c).alias("o_custkey"),
        "o_orderstatus",
        F.when(F.col("o_totalprice") < 5000, F.lit(None)).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        F.when((s == "P") & (p == "5-LOW"), F.lit(None)).otherwise(p).alias("o_orderpriority"),
    )


_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("q_notnull_check", "A19", f"""
WITH o AS ({_ORDERS_WITH_NULLS})
SELECT 'orders' AS table_name, 'not_null' AS rule, c.column_name, c.violations
FROM (
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS violations FROM o"
    for c in _ORDER_COLS
) + ") AS c")
def q_notnull_check(spark: SparkSession, sf: str):
    """All six not-null rules of the header table in one scan."""
    o = _orders_with_nulls(spark, sf)
    return quality.row_rule_report(o, "orders", quality.not_null_rules(_ORDER_COLS))


@query("q_fk_orphans", "A20", f"""
WITH o AS ({_ORDERS_WITH_NULLS}),
     c AS (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'HOUSEHOLD')
SELECT o.* FROM o
WHERE o.o_custkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM c WHERE c.c_custkey = o.o_custkey)
""")
def q_fk_orphans(spark: SparkSession, sf: str):
    """Orders whose customer is missing. The parent table is the customers
    outside one market segment; orders with a NULL customer pass."""
    o = _orders_with_nulls(spark, sf)
    parent = read_table(spark, sf, "customer").filter(F.col("c_mktsegment") != "HOUSEHOLD")
    return quality.check_foreign_key(o, parent, ["o_custkey"], ["c_custkey"])


@query("q_domain_check", "A21", """
SELECT p_partkey, 'max_length_10' AS rule, 'p_name' AS column_name
FROM part WHERE length(p_name) > 10
UNION ALL
SELECT p_partkey, 'numeric_10_2' AS rule, 'scaled_price' AS column_name
FROM part WHERE TRY_CAST(p_retailprice * 105000 AS DECIMAL(10,2)) IS NULL
""")
def q_domain_check(spark: SparkSession, sf: str):
    """Names longer than VARCHAR(10) and scaled prices outside NUMERIC(10,2),
    both rules in one scan of the table."""
    part = read_table(spark, sf, "part")
    rules = [
        quality.max_length_rule("p_name", 10),
        quality.decimal_fits_rule(F.col("p_retailprice") * 105000, "scaled_price"),
    ]
    return quality.offending_rows(part, rules, ["p_partkey"])


@query("q_rule_report", "A17,A19,A21", f"""
WITH o AS ({_ORDERS_WITH_NULLS})
SELECT 'orders' AS table_name, 'not_null' AS rule, 'o_custkey' AS column_name,
       count(*) FILTER (WHERE o_custkey IS NULL) AS violations FROM o
UNION ALL
SELECT 'orders', 'money_range', 'o_totalprice',
       count(*) FILTER (WHERE abs(o_totalprice) >= 100000000) FROM o
UNION ALL
SELECT 'orders', 'numeric_10_2', 'o_totalprice',
       count(*) FILTER (WHERE o_totalprice IS NOT NULL
                          AND TRY_CAST(o_totalprice AS DECIMAL(10,2)) IS NULL) FROM o
UNION ALL
SELECT 'orders', 'primary_key', 'o_orderkey', CAST(coalesce(sum(n), 0) AS BIGINT) FROM (
  SELECT count(*) AS n FROM o GROUP BY o_orderkey
  HAVING count(*) > 1 OR o_orderkey IS NULL)
""")
def q_rule_report(spark: SparkSession, sf: str):
    """One report for a table: row rules share a scan; the key rule adds one
    grouped count."""
    o = _orders_with_nulls(spark, sf)
    rows = quality.row_rule_report(o, "orders", [
        quality.RowRule("not_null", "o_custkey", F.col("o_custkey").isNull()),
        quality.money_range_rule("o_totalprice"),
        quality.decimal_fits_rule("o_totalprice", "o_totalprice"),
    ])
    return rows.unionByName(quality.key_report(o, "orders", ["o_orderkey"], primary=True))
