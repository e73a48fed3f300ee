"""Queries for the DataFrame basics: A1-A9 over the driver tables.

Role mapping used throughout: product -> ``part`` (category -> ``p_type``,
price -> ``p_retailprice``, stock -> ``p_size``), customer -> ``customer``,
order header -> ``orders``, order item -> ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tillroll.operators import profile, transform
from tillroll.plans.registry import query
from tillroll.sources.inline import inline_rows
from tillroll.sources.tables import read_table

# The category lookup for the six part types in the driver
# tables, as (id, type, display name).
PART_CATEGORIES = [
    (1, "ECONOMY", "Economy"),
    (2, "LARGE", "Large"),
    (3, "MEDIUM", "Medium"),
    (4, "PROMO", "Promotion"),
    (5, "SMALL", "Small"),
    (6, "STANDARD", "Standard"),
]
CATEGORY_SCHEMA = StructType([
    StructField("categoria_id", IntegerType(), False),
    StructField("p_type", StringType(), False),
    StructField("categoria", StringType(), False),
])


@query("q_group_mean", "A8", """
SELECT p_type, round(avg(p_retailprice), 4) AS avg_price
FROM part GROUP BY p_type
""")
def q_group_mean(spark: SparkSession, sf: str):
    part = read_table(spark, sf, "part")
    return profile.group_mean(part, "p_type", "p_retailprice", "avg_price").select(
        "p_type", F.round("avg_price", 4).alias("avg_price")
    )


@query("q_group_mean_nulls", "A8", """
WITH p AS (
  SELECT CASE WHEN p_brand = 'Brand#13' THEN NULL ELSE p_type END AS p_type,
         CASE WHEN p_size = 50 THEN 'NaN'::DOUBLE ELSE p_retailprice END AS price
  FROM part)
SELECT p_type, round(avg(price) FILTER (WHERE NOT isnan(price)), 4) AS avg_price
FROM p WHERE p_type IS NOT NULL GROUP BY p_type
""")
def q_group_mean_nulls(spark: SparkSession, sf: str):
    """pandas-form mean: NULL keys dropped, NaN values skipped. Faults are
    planted by value rules (brand 13 loses its type, size 50 its price)."""
    part = read_table(spark, sf, "part").select(
        F.when(F.col("p_brand") == "Brand#13", F.lit(None)).otherwise(F.col("p_type")).alias("p_type"),
        F.when(F.col("p_size") == 50, F.lit(float("nan"))).otherwise(F.col("p_retailprice")).alias("price"),
    )
    return profile.group_mean(part, "p_type", "price", "avg_price",
                              drop_null_keys=True, skip_nan=True).select(
        "p_type", F.round("avg_price", 4).alias("avg_price")
    )


@query("q_inline_rows", "A1,A7,A9", """
SELECT p.p_partkey, p.p_type, c.categoria_id, c.categoria,
       round(p.p_retailprice * p.p_size, 2) AS stock_value
FROM part p LEFT JOIN (VALUES
  (1, 'ECONOMY', 'Economy'), (2, 'LARGE', 'Large'), (3, 'MEDIUM', 'Medium'),
  (4, 'PROMO', 'Promotion'), (5, 'SMALL', 'Small'), (6, 'STANDARD', 'Standard')
) AS c(categoria_id, p_type, categoria) ON p.p_type = c.p_type
""")
def q_inline_rows(spark: SparkSession, sf: str):
    """An inline lookup (6 rows, a proven bound, so broadcast) joined to every
    part, plus the computed stock value (price x stock)."""
    cats = inline_rows(spark, PART_CATEGORIES, CATEGORY_SCHEMA)
    part = read_table(spark, sf, "part")
    valued = transform.add_product(part, "stock_value", "p_retailprice", "p_size")
    return valued.join(F.broadcast(cats), "p_type", "left").select(
        "p_partkey", "p_type", "categoria_id", "categoria",
        F.round("stock_value", 2).alias("stock_value"),
    )


def _schema_report_sql() -> str:
    cols = [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"),
            ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double")]
    parts = [
        f"SELECT {i + 1}::INTEGER AS position, '{c}' AS column_name, '{t}' AS data_type, "
        f"count({c}) AS non_null, count(*) AS row_count FROM part"
        for i, (c, t) in enumerate(cols)
    ]
    return "\nUNION ALL\n".join(parts)


@query("q_schema_report", "A2", _schema_report_sql())
def q_schema_report(spark: SparkSession, sf: str):
    return profile.schema_report(read_table(spark, sf, "part"))


@query("q_preview", "A3", """
SELECT * FROM orders ORDER BY o_orderkey LIMIT 20
""")
def q_preview(spark: SparkSession, sf: str):
    return transform.preview(read_table(spark, sf, "orders"), "o_orderkey", 20)


def _describe_sql(table: str, cols: list[str]) -> str:
    values = "\n  UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS v FROM {table}" for c in cols
    )
    return f"""
WITH s AS (
  {values}),
m AS (
  SELECT column_name, CAST(count(v) AS DOUBLE) AS c, avg(v) AS mean, stddev_samp(v) AS std,
         min(v) AS mn, max(v) AS mx, quantile_cont(v, 0.25) AS q1,
         quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3
  FROM s GROUP BY column_name)
SELECT column_name, 'count' AS stat, round(c, 4) AS value FROM m
UNION ALL SELECT column_name, 'mean', round(mean, 4) FROM m
UNION ALL SELECT column_name, 'std', round(std, 4) FROM m
UNION ALL SELECT column_name, 'min', round(mn, 4) FROM m
UNION ALL SELECT column_name, '25%', round(q1, 4) FROM m
UNION ALL SELECT column_name, '50%', round(q2, 4) FROM m
UNION ALL SELECT column_name, '75%', round(q3, 4) FROM m
UNION ALL SELECT column_name, 'max', round(mx, 4) FROM m
"""


DESCRIBE_PART = ["p_size", "p_retailprice"]
DESCRIBE_ITEMS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("q_describe", "A4", _describe_sql("part", DESCRIBE_PART))
def q_describe(spark: SparkSession, sf: str):
    part = read_table(spark, sf, "part")
    return profile.describe_numeric(part, DESCRIBE_PART).select(
        "column_name", "stat", F.round("value", 4).alias("value")
    )


@query("q_describe_items", "A4", _describe_sql("lineitem", DESCRIBE_ITEMS))
def q_describe_items(spark: SparkSession, sf: str):
    """The largest table: quartile brackets are narrowed by sketch rounds before
    the exact pass."""
    items = read_table(spark, sf, "lineitem")
    return profile.describe_numeric(items, DESCRIBE_ITEMS).select(
        "column_name", "stat", F.round("value", 4).alias("value")
    )


@query("q_describe_nulls", "A4", _describe_sql("""(
  SELECT CASE WHEN p_size = 50 THEN NULL ELSE p_retailprice END AS price,
         CAST(NULL AS DOUBLE) AS discount FROM part)""", ["price", "discount"]))
def q_describe_nulls(spark: SparkSession, sf: str):
    """The pandas form: size 50 has a NaN price, which is skipped, and a column
    without any value is reported with count 0."""
    part = read_table(spark, sf, "part").select(
        F.when(F.col("p_size") == 50, F.lit(float("nan"))).otherwise(F.col("p_retailprice")).alias("price"),
        F.lit(None).cast("double").alias("discount"))
    return profile.describe_numeric(part, skip_nan=True).select(
        "column_name", "stat", F.round("value", 4).alias("value")
    )


@query("q_project", "A5,A9", """
SELECT p_partkey AS produto_id, p_name AS produto FROM part
""")
def q_project(spark: SparkSession, sf: str):
    part = read_table(spark, sf, "part")
    return transform.rename(transform.project(part, ["p_partkey", "p_name"]),
                            {"p_partkey": "produto_id", "p_name": "produto"})


@query("q_filter_eq", "A6", """
SELECT * FROM part WHERE p_type = 'ECONOMY'
""")
def q_filter_eq(spark: SparkSession, sf: str):
    return transform.filter_eq(read_table(spark, sf, "part"), "p_type", "ECONOMY")


@query("q_with_column", "A7", """
SELECT *, round(p_retailprice * p_size, 2) AS stock_value FROM part
""")
def q_with_column(spark: SparkSession, sf: str):
    part = read_table(spark, sf, "part")
    out = transform.add_product(part, "stock_value", "p_retailprice", "p_size")
    return out.withColumn("stock_value", F.round("stock_value", 2))
