"""Queries for nested data (B2-B7) over documents that Spark derives from
the driver tables: order documents with an item array, customer documents
in an envelope, tag lists, JSON properties and ISO-8601 text times."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tillroll.functions import timefmt
from tillroll.operators import model, nested, transform
from tillroll.plans.registry import query
from tillroll.sources.tables import read_table

LINE_COLS = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


# ------------------------------------------------------------------ B3
@query("q_explode_items", "B3", """
SELECT * FROM lineitem
""")
def q_explode_items(spark: SparkSession, sf: str):
    """Round trip: line items nested into one document per order (split when
    an order is huge), then exploded back to one row per item."""
    li = read_table(spark, sf, "lineitem")
    docs = nested.nest(li, ["l_orderkey"], "itens", LINE_COLS, max_items=1000)
    return nested.explode_rows(docs, "itens", ["l_orderkey"])


@query("q_nest_sizes", "B3,B5", """
SELECT l_orderkey, count(*) AS n_items,
       CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS total_qty
FROM lineitem GROUP BY l_orderkey
""")
def q_nest_sizes(spark: SparkSession, sf: str):
    """Per order document: array size and an in-array sum (``aggregate``),
    re-combined over the (rare) split documents of a huge order."""
    li = read_table(spark, sf, "lineitem")
    docs = nested.nest(li, ["l_orderkey"], "itens", ["l_quantity"], max_items=1000)
    per_doc = docs.select(
        "l_orderkey",
        F.size("itens").alias("n"),
        F.aggregate("itens", F.lit(0).cast("decimal(18,2)"),
                    lambda acc, x: (acc + x["l_quantity"].cast("decimal(12,2)")).cast("decimal(18,2)")).alias("q"),
    )
    return per_doc.groupBy("l_orderkey").agg(
        F.sum("n").cast("bigint").alias("n_items"),
        F.sum("q").cast("decimal(18,2)").alias("total_qty"),
    )


@query("q_nest_hot_key", "B3", """
SELECT l_returnflag, CAST(l_linenumber AS INTEGER) AS l_linenumber, l_linestatus, count(*) AS n_items,
       true AS bounded
FROM lineitem GROUP BY ALL
""")
def q_nest_hot_key(spark: SparkSession, sf: str):
    """Line items nested by return flag (three keys, one with about half of all
    rows) into documents of few distinct items, then exploded and counted;
    ``bounded``: no document holds more than twice the bound."""
    li = read_table(spark, sf, "lineitem")
    docs = nested.nest(li, ["l_returnflag"], "itens", ["l_linenumber", "l_linestatus"], max_items=1000)
    within = docs.withColumn("bounded", F.size("itens") <= 2 * 1000)
    items = nested.explode_rows(within, "itens", ["l_returnflag", "bounded"])
    return items.groupBy("l_returnflag", F.col("l_linenumber").cast("int").alias("l_linenumber"), "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_items"), F.bool_and("bounded").alias("bounded"))


# ------------------------------------------------------------------ B2, B4
API_VERSION = "v1"


@query("q_flatten", "B2,B4", f"""
SELECT '{API_VERSION}' AS api_version, c.c_mktsegment AS segmento,
       c.c_custkey AS cliente_id, c.c_name AS cliente_nome, c.c_acctbal AS cliente_saldo,
       n.n_name AS endereco_nacao, r.r_name AS endereco_regiao_nome
FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def q_flatten(spark: SparkSession, sf: str):
    """Customer documents (nested ``cliente`` and ``endereco.regiao``) packed
    into envelopes per market segment, then unwrapped and flattened."""
    cust = read_table(spark, sf, "customer")
    geo = model.lookup(cust, read_table(spark, sf, "nation"), ("c_nationkey", "n_nationkey"),
                       required=False, dim_cols=["n_name", "n_regionkey"])
    geo = model.lookup(geo, read_table(spark, sf, "region"), ("n_regionkey", "r_regionkey"),
                       required=False, dim_cols=["r_name"])
    docs = geo.select(
        "c_mktsegment", F.col("c_custkey").alias("_row"),
        F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("nome"),
                 F.col("c_acctbal").alias("saldo")).alias("cliente"),
        F.struct(F.col("n_name").alias("nacao"),
                 F.struct(F.col("r_name").alias("nome")).alias("regiao")).alias("endereco"),
    )
    envelopes = nested.nest(docs, ["c_mktsegment"], "clientes", ["cliente", "endereco"], max_items=100,
                            spread=["_row"])
    envelopes = envelopes.select(F.lit(API_VERSION).alias("api_version"),
                                 F.col("c_mktsegment").alias("segmento"), "clientes")
    rows = nested.unwrap(envelopes, "clientes", ["api_version", "segmento"])
    return nested.flatten(rows)


# ------------------------------------------------------------------ B5
_TAGS_SQL = """
SELECT p_partkey,
       CASE WHEN p_brand = 'Brand#7' THEN NULL
            WHEN p_size <= 2 THEN CAST([] AS VARCHAR[])
            ELSE string_split(p_name, ' ') END AS tags
FROM part
"""


def _tags(spark, sf):
    """Tag lists from product names; brand 7 has none (NULL), the smallest
    sizes an empty list."""
    part = read_table(spark, sf, "part")
    tags = (F.when(F.col("p_brand") == "Brand#7", F.lit(None).cast("array<string>"))
            .when(F.col("p_size") <= 2, F.array().cast("array<string>"))
            .otherwise(F.split("p_name", " ")))
    return part.select("p_partkey", tags.alias("tags"))


@query("q_tags_inner", "B5", f"""
WITH t AS ({_TAGS_SQL})
SELECT p_partkey, unnest(tags) AS tag FROM t
""")
def q_tags_inner(spark: SparkSession, sf: str):
    return nested.explode_scalars(_tags(spark, sf), "tags", ["p_partkey"], "tag")


@query("q_tags_outer", "B5", f"""
WITH t AS ({_TAGS_SQL})
SELECT t.p_partkey, u.tag FROM t LEFT JOIN LATERAL (SELECT unnest(t.tags) AS tag) u ON true
""")
def q_tags_outer(spark: SparkSession, sf: str):
    return nested.explode_scalars(_tags(spark, sf), "tags", ["p_partkey"], "tag", outer=True)


@query("q_tag_counts", "B5", f"""
WITH t AS ({_TAGS_SQL})
SELECT tag, count(*) AS n FROM (SELECT unnest(tags) AS tag FROM t) GROUP BY tag
""")
def q_tag_counts(spark: SparkSession, sf: str):
    tags = nested.explode_scalars(_tags(spark, sf), "tags", ["p_partkey"], "tag")
    return nested.value_counts(tags, "tag")


@query("q_tag_sizes", "B5", f"""
WITH t AS ({_TAGS_SQL})
SELECT p_partkey, CAST(len(tags) AS INTEGER) AS n_tags FROM t
""")
def q_tag_sizes(spark: SparkSession, sf: str):
    """Array size: 0 for an empty list, NULL for a missing one."""
    return _tags(spark, sf).select("p_partkey", F.size("tags").alias("n_tags"))


# ------------------------------------------------------------------ B6
PROPS_SCHEMA = StructType([
    StructField("k", LongType()),
    StructField("nota", StringType()),  # never present: must come back NULL
])


@query("q_json_field", "B6", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       json_extract_string(props, '$.nota') AS nota
FROM events
""")
def q_json_field(spark: SparkSession, sf: str):
    """JSON text parsed with an explicit schema; a field absent from every
    record is NULL rather than missing from the schema."""
    ev = read_table(spark, sf, "events")
    parsed = ev.select("event_id", F.from_json("props", PROPS_SCHEMA).alias("p"))
    return parsed.select("event_id", "p.k", "p.nota")


@query("q_presence", "B6", """
SELECT 'k' AS field, count(json_extract(props, '$.k')) AS present, count(*) AS row_count FROM events
UNION ALL
SELECT 'nota', count(json_extract(props, '$.nota')), count(*) FROM events
""")
def q_presence(spark: SparkSession, sf: str):
    ev = read_table(spark, sf, "events")
    parsed = ev.select(F.from_json("props", PROPS_SCHEMA).alias("p"))
    return nested.presence_report(parsed, ["p.k", "p.nota"]).withColumn(
        "field", F.regexp_replace("field", r"^p\.", "")
    )


# ------------------------------------------------------------------ B7
PERIOD_START = "2024-01-05T00:00:00Z"
PERIOD_END = "2024-01-11T23:59:59Z"


@query("q_period", "B7", f"""
WITH e AS (SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS data FROM events),
p AS (SELECT event_id, data, strptime(data, '%Y-%m-%dT%H:%M:%S.%fZ') AS data_ts FROM e)
SELECT event_id, data, data_ts FROM p
WHERE data_ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-11 23:59:59'
""")
def q_period(spark: SparkSession, sf: str):
    """Transactions carried as ISO-8601 UTC text, parsed back and kept when
    inside the statement period (both bounds inclusive)."""
    ev = read_table(spark, sf, "events").select(
        "event_id", timefmt.format_iso("ts").alias("data")
    )
    parsed = ev.withColumn("data_ts", timefmt.parse_iso_wall("data"))
    return transform.within_period(parsed, "data_ts",
                                   timefmt.parse_iso_wall(F.lit(PERIOD_START)),
                                   timefmt.parse_iso_wall(F.lit(PERIOD_END)))
