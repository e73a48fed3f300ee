"""Queries for sources and sinks.

Each builder writes what it needs under the shared folder
(``spark.checkpoint.dir``), in a fresh sub-folder per call, then returns a
lazy DataFrame that reads the written data back. The written data is the
whole driver table, never a sample.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DecimalType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampNTZType,
)

from tillroll.operators import nested, quality
from tillroll.plans import jobs
from tillroll.plans.registry import query
from tillroll.session import shared_path
from tillroll.sinks import files, tables
from tillroll.sources import documents, objects
from tillroll.sources.tables import read_table


def _table_name(stem: str) -> str:
    return f"tillroll_{stem}_{uuid.uuid4().hex[:10]}"


# ------------------------------------------------------------------ A23
@query("q_reload", "A23", """
SELECT * FROM orders
""")
def q_reload(spark: SparkSession, sf: str):
    """Reload the same data twice: the table ends up with one copy."""
    orders = read_table(spark, sf, "orders")
    t = _table_name("orders")
    tables.reload(orders, t)
    tables.reload(orders, t)
    return spark.table(t)


# ------------------------------------------------------------------ A15, A16
CUSTOMER_TARGET = StructType([
    StructField("c_custkey", LongType(), False),
    StructField("c_name", StringType()),
    StructField("c_acctbal", DoubleType()),
    StructField("c_mktsegment", StringType()),
    StructField("is_deleted", BooleanType(), False),
    StructField("data_cadastro", TimestampNTZType()),
])
DEFAULT_STAMP = "2025-01-01 00:00:00"


@query("q_defaults", "A15,A16", f"""
SELECT c_custkey, c_name, c_acctbal, c_mktsegment, c_acctbal < 0 AS is_deleted,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE TIMESTAMP '2024-06-01 00:00:00' END AS data_cadastro
FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING')
UNION ALL
SELECT c_custkey, c_name, c_acctbal, c_mktsegment, false, TIMESTAMP '{DEFAULT_STAMP}'
FROM customer WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING')
""")
def q_defaults(spark: SparkSession, sf: str):
    """Two insert batches into one table: the first names every column (with
    explicit NULL stamps that must stay NULL), the second omits the flag and
    the stamp and lists its columns in another order; defaults fill only
    what is absent, columns are matched by name."""
    cust = read_table(spark, sf, "customer")
    first_segments = ["AUTOMOBILE", "BUILDING"]
    batch1 = cust.filter(F.col("c_mktsegment").isin(first_segments)).select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment",
        (F.col("c_acctbal") < 0).alias("is_deleted"),
        F.when(F.col("c_acctbal") < 0, F.lit(None))
        .otherwise(F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")).alias("data_cadastro"),
    )
    batch2 = cust.filter(~F.col("c_mktsegment").isin(first_segments)).select(
        "c_mktsegment", "c_acctbal", "c_name", "c_custkey",
    )
    t = _table_name("customer")
    empty = spark.createDataFrame([], CUSTOMER_TARGET)
    tables.reload(empty, t)
    defaults = {
        "is_deleted": F.lit(False),
        "data_cadastro": F.lit(DEFAULT_STAMP).cast("timestamp_ntz"),
    }
    tables.append_by_name(batch1, t, defaults)
    tables.append_by_name(batch2, t, defaults)
    return spark.table(t)


# ------------------------------------------------------------------ B13
@query("q_backup", "B13", """
SELECT * FROM orders
""")
def q_backup(spark: SparkSession, sf: str):
    """Partitioned backup of the order headers, verified (count + hash),
    read back in full."""
    orders = read_table(spark, sf, "orders")
    path = shared_path(spark, "backup", "orders", unique=True)
    jobs.table_to_backup(orders, path, ["o_orderstatus"])
    return spark.read.schema(orders.schema).parquet(path).select(*orders.columns)


@query("q_backup_partition", "B13", """
SELECT * FROM orders WHERE o_orderstatus = 'F'
""")
def q_backup_partition(spark: SparkSession, sf: str):
    """Reading one status from the backup touches only its directory
    (``PartitionFilters`` in the scan)."""
    orders = read_table(spark, sf, "orders")
    path = shared_path(spark, "backup", "orders", unique=True)
    jobs.table_to_backup(orders, path, ["o_orderstatus"], verify=False)
    back = spark.read.schema(orders.schema).parquet(path)
    return back.filter(F.col("o_orderstatus") == "F").select(*orders.columns)


# ------------------------------------------------------------------ A11
_LINE_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


_LINE_FIELDS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                ("o_orderpriority", "string")]


def _parse_lines(raw):
    return files.parse_delimited(raw, _LINE_FIELDS)


def _parse_checked(raw):
    return files.parse_delimited(raw, _LINE_FIELDS, checked=True)


@query("q_text_roundtrip", "A11", """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'a|b' || chr(10) || 'c%0A' || chr(13)
                            WHEN '2-HIGH' THEN '' WHEN '5-LOW' THEN NULL WHEN '3-MEDIUM' THEN '%N'
                            ELSE o_orderpriority END AS o_orderpriority
FROM orders
""")
def q_text_roundtrip(spark: SparkSession, sf: str):
    """Order headers written as text objects ('|'-separated lines) and read
    back. Priorities are planted with separators, line breaks, percent codes,
    empty text and NULL: rows round-trip, not file names or byte layout."""
    p = F.col("o_orderpriority")
    orders = read_table(spark, sf, "orders").withColumn("o_orderpriority", (
        F.when(p == "1-URGENT", F.lit("a|b\nc%0A\r")).when(p == "2-HIGH", F.lit(""))
        .when(p == "5-LOW", F.lit(None)).when(p == "3-MEDIUM", F.lit("%N")).otherwise(p)))
    path = shared_path(spark, "objects", "orders-text", unique=True)
    files.write_text(orders.select(files.delimited_line(_LINE_COLS).alias("line")), path)
    return _parse_lines(spark.read.text(path))


# ------------------------------------------------------------------ A12
@query("q_listing", "A12", """
SELECT o_orderstatus,
       CAST(sum(strlen(CAST(o_orderkey AS VARCHAR) || '|' || CAST(o_custkey AS VARCHAR) || '|'
                       || o_orderpriority) + 1) AS BIGINT) AS bytes
FROM orders GROUP BY o_orderstatus
""")
def q_listing(spark: SparkSession, sf: str):
    """Text objects written per status directory, then listed (names and
    sizes only, no bytes read); bytes per directory = sum of line lengths."""
    orders = read_table(spark, sf, "orders")
    path = shared_path(spark, "objects", "orders-by-status", unique=True)
    line = files.delimited_line(["o_orderkey", "o_custkey", "o_orderpriority"]).alias("line")
    files.write_text(orders.select(line, "o_orderstatus"), path, "line", partition_by=["o_orderstatus"])
    listing = objects.list_objects(spark, path, glob="*.txt")
    status = F.regexp_extract("name", r"^o_orderstatus=([^/]+)/", 1)
    return listing.groupBy(status.alias("o_orderstatus")).agg(F.sum("length").cast("bigint").alias("bytes"))


@query("q_inventory", "A12", """
SELECT o_orderstatus, count(*) AS objects, CAST(sum(strlen(o_orderpriority)) AS BIGINT) AS bytes,
       max(o_orderdate) AS last_change
FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY o_orderstatus
""")
def q_inventory(spark: SparkSession, sf: str):
    """A store's inventory table (one object per order), listed below a prefix
    without any file status on the driver."""
    orders = read_table(spark, sf, "orders")
    prefix = F.when(F.col("o_orderkey") % 3 != 0, F.lit("shop/")).otherwise(F.lit("old/"))
    key = F.concat(prefix, F.lit("o_orderstatus="), "o_orderstatus", F.lit("/"), F.col("o_orderkey").cast("string"), F.lit(".txt"))
    inventory = orders.select(key.alias("key"), F.length("o_orderpriority").alias("size"), F.col("o_orderdate").alias("modified"))
    listing = objects.from_inventory(inventory, "key", "size", "modified", prefix="shop/")
    status = F.regexp_extract("name", r"^o_orderstatus=([^/]+)/", 1)
    return listing.groupBy(status.alias("o_orderstatus")).agg(
        F.count(F.lit(1)).alias("objects"), F.sum("length").cast("bigint").alias("bytes"),
        F.max("modificationTime").cast("timestamp_ntz").alias("last_change"))


# ------------------------------------------------------------------ A13
@query("q_manifest_missing", "A13", """
SELECT DISTINCT 'o_orderstatus=' || o_orderstatus AS name FROM orders
EXCEPT
SELECT DISTINCT 'o_orderstatus=' || o_orderstatus FROM orders WHERE o_orderstatus <> 'P'
""")
def q_manifest_missing(spark: SparkSession, sf: str):
    """The expected folders (one per status in the table) against what an
    export that left out pending orders actually wrote."""
    orders = read_table(spark, sf, "orders")
    path = shared_path(spark, "objects", "orders-export", unique=True)
    exported = orders.filter(~F.col("o_orderstatus").eqNullSafe("P"))
    line = files.delimited_line(["o_orderkey", "o_custkey"]).alias("line")
    files.write_text(exported.select(line, "o_orderstatus"), path, "line", partition_by=["o_orderstatus"])
    folders = objects.list_objects(spark, path, glob="*.txt").select(
        F.regexp_extract("name", r"^([^/]+)/", 1).alias("name")
    )
    expected = orders.select(F.concat(F.lit("o_orderstatus="), F.col("o_orderstatus")).alias("name")).distinct()
    return quality.missing_objects(expected, folders, "name")


# ------------------------------------------------------------------ B1
ORDER_FILE_DOC = StructType([
    StructField("id_pedido", LongType()),
    StructField("status", StringType()),
    StructField("total_pedido", DecimalType(10, 2)),
    StructField("itens", ArrayType(StructType([
        StructField("l_linenumber", IntegerType()),
        StructField("l_quantity", DecimalType(12, 2)),
    ]))),
])
DOCS_PER_FILE = 1_000


_ORDER_SUMS_SQL = """
SELECT o.o_orderkey AS id_pedido, o.o_orderstatus AS status,
       CAST(o.o_totalprice AS DECIMAL(18,2)) AS total_pedido,
       coalesce(li.n, 0) AS n_itens, CAST(coalesce(li.q, 0) AS DECIMAL(18,2)) AS qtd_total
FROM orders o LEFT JOIN (
  SELECT l_orderkey, count(*) AS n, sum(CAST(l_quantity AS DECIMAL(12,2))) AS q
  FROM lineitem GROUP BY l_orderkey) li ON o.o_orderkey = li.l_orderkey
"""


def _order_documents(spark, sf, stage_heavy=False):
    """One document per order, with its items as an array; ``chunk`` numbers
    the documents of an order of more than 1,000 items."""
    orders = read_table(spark, sf, "orders")
    li = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("decimal(12,2)").alias("l_quantity")
    )
    docs = nested.nest(li, ["l_orderkey"], "itens", ["l_linenumber", "l_quantity"], max_items=1000, stage_heavy=stage_heavy)
    return orders.join(docs, orders.o_orderkey == docs.l_orderkey, "left").select(
        F.col("o_orderkey").alias("id_pedido"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("total_pedido"),
        F.coalesce("itens", F.array().cast(ORDER_FILE_DOC["itens"].dataType)).alias("itens"),
        F.coalesce(F.col("chunk"), F.lit(0)).alias("chunk"),
    )


def _order_sums(docs):
    per_doc = docs.select(
        "id_pedido", "status", "total_pedido",
        F.size("itens").alias("n"),
        F.aggregate("itens", F.lit(0).cast("decimal(18,2)"),
                    lambda acc, x: (acc + x["l_quantity"]).cast("decimal(18,2)")).alias("q"),
    )
    return per_doc.groupBy("id_pedido", "status", "total_pedido").agg(
        F.sum("n").cast("bigint").alias("n_itens"),
        F.sum("q").cast("decimal(18,2)").alias("qtd_total"),
    ).select("id_pedido", "status", F.col("total_pedido").cast("decimal(18,2)").alias("total_pedido"),
             "n_itens", "qtd_total")


@query("q_multiline_json", "B1,B3", _ORDER_SUMS_SQL)
def q_multiline_json(spark: SparkSession, sf: str):
    """Order documents (header + item array) written as pretty-printed JSON
    files (array root, a bounded number of documents per file), read back
    with ``multiLine`` and an explicit schema, and summed per order."""
    docs = _order_documents(spark, sf)
    file_id = F.concat_ws("-", F.floor(F.col("id_pedido") / DOCS_PER_FILE).cast("string"), F.col("chunk").cast("string"))
    path = shared_path(spark, "documents", "orders-json", unique=True)
    files.write_json_documents(docs.withColumn("file_id", file_id).drop("chunk"), path, "file_id")
    return _order_sums(documents.read_json(spark, path, ORDER_FILE_DOC, multi_line=True))


@query("q_json_lines", "B1,B3", _ORDER_SUMS_SQL)
def q_json_lines(spark: SparkSession, sf: str):
    """The same documents one a line: no shuffle before the write, files that
    readers can split."""
    path = shared_path(spark, "documents", "orders-ndjson", unique=True)
    files.write_json_lines(_order_documents(spark, sf).drop("chunk"), path)
    return _order_sums(documents.read_json(spark, path, ORDER_FILE_DOC, multi_line=False))


# ------------------------------------------------------------------ B12
@query("q_objects_to_table", "B12,A17", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders
""")
def q_objects_to_table(spark: SparkSession, sf: str):
    """Object store -> Spark -> table: landed text objects are parsed, their
    key checked, and loaded into a catalog table (the JDBC target takes the
    same DataFrame through a staging table). Garbled lines among them stay out."""
    from tillroll.plans.q_versions import dirty_lines, line_rules

    path = shared_path(spark, "objects", "orders-landing", unique=True)
    files.write_text(dirty_lines(read_table(spark, sf, "orders")), path)

    t = _table_name("orders_loaded")
    jobs.objects_to_table(spark.read.text(path), _parse_checked, ["o_orderkey"], jobs.load_catalog_table(t),
                          rules=line_rules(), columns=[n for n, _ in _LINE_FIELDS])
    return spark.table(t)


# ------------------------------------------------------------------ B12 incremental
@query("q_stream_ingest", "B12,A19", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders
""")
def q_stream_ingest(spark: SparkSession, sf: str):
    """Objects land in two waves (finished+open orders, then pending ones, with
    garbled lines among them); an ``availableNow`` streaming run after each wave, plus a third
    run with nothing new, loads every good row exactly once."""
    from tillroll.plans.q_versions import dirty_lines, line_rules
    from tillroll.streaming.ingest import loaded, run_ingestion

    orders = read_table(spark, sf, "orders")
    base = shared_path(spark, "stream", "orders", unique=True)
    landing, target = f"{base}/landing", f"{base}/table"
    checkpoint = f"{base}/_checkpoint"
    rules = [*line_rules(), *quality.not_null_rules(["o_custkey"])]
    pending = F.col("o_orderstatus").eqNullSafe("P")
    waves = [~pending, pending]
    for i, wave in enumerate(waves):
        files.write_text(dirty_lines(orders.filter(wave)), f"{landing}/wave={i}")
        run_ingestion(spark, landing, _parse_checked, rules, target, checkpoint, glob="*.txt")
    run_ingestion(spark, landing, _parse_checked, rules, target, checkpoint, glob="*.txt")
    return loaded(spark, target).select(*[n for n, _ in _LINE_FIELDS])
