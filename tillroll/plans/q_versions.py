"""Queries on variant documents, array files in splits, versions of files, bag
differences, levels of totals, distinct counts, SQL functions and dirty input."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tillroll.functions import catalog
from tillroll.operators import differences, levels, quality, variants
from tillroll.plans import jobs, q_io
from tillroll.plans.registry import query
from tillroll.session import shared_path
from tillroll.sinks import files, versions
from tillroll.sources import split_json
from tillroll.sources.tables import read_table


# ------------------------------------------------------------------ B6
def _documents(spark, sf):
    """Event documents whose field ``avaliacoes`` is absent, null, a list or an object, and some that are no JSON."""
    k, i = F.get_json_object("props", "$.k"), F.col("event_id")
    field = (F.when(i % 4 == 0, F.lit("")).when(i % 4 == 1, F.lit(', "avaliacoes": null'))
             .when(i % 4 == 2, F.concat(F.lit(', "avaliacoes": {"nota": '), k, F.lit("}"))).otherwise(F.lit(', "avaliacoes": []')))
    text = F.concat(F.lit('{"k": '), k, field, F.when(i % 23 == 0, F.lit("")).otherwise(F.lit("}")))
    events = read_table(spark, sf, "events").select("event_id", "event_type", text.alias("text"))
    return variants.to_variant(events, "text")


@query("q_field_states", "B6", """
WITH s AS (
  SELECT event_type, event_id % 4 AS r, event_id % 23 = 0 AS bad FROM events)
SELECT event_type, path, state, count(*) AS n FROM (
  SELECT event_type, '$.avaliacoes' AS path, CASE WHEN bad THEN 'malformed' WHEN r = 0 THEN 'absent' WHEN r = 1 THEN 'null' ELSE 'present' END AS state FROM s
  UNION ALL SELECT event_type, '$.avaliacoes.nota', CASE WHEN bad THEN 'malformed' WHEN r = 2 THEN 'present' ELSE 'absent' END FROM s
  UNION ALL SELECT event_type, '$.k', CASE WHEN bad THEN 'malformed' ELSE 'present' END FROM s)
GROUP BY ALL
""")
def q_field_states(spark: SparkSession, sf: str):
    """How many documents have a field absent, null or present, told apart."""
    return variants.field_states(_documents(spark, sf), "document", ["$.k", "$.avaliacoes", "$.avaliacoes.nota"], ["event_type"])


@query("q_variant_fields", "B6", """
SELECT event_id, CASE WHEN event_id % 23 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
       CASE WHEN event_id % 4 = 2 AND event_id % 23 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS nota,
       CAST(NULL AS BIGINT) AS lista
FROM events
""")
def q_variant_fields(spark: SparkSession, sf: str):
    """Typed fields of variant documents; another type or none gives NULL."""
    found = variants.fields(_documents(spark, sf), "document", {
        "k": ("$.k", "bigint"), "nota": ("$.avaliacoes.nota", "bigint"), "lista": ("$.avaliacoes", "bigint")})
    return found.select("event_id", "k", "nota", "lista")


# ------------------------------------------------------------------ B1
ORDERS_A_FILE = 1_000_000  # at most about so many documents in one array file


@query("q_split_json", "B1,B3", q_io._ORDER_SUMS_SQL)
def q_split_json(spark: SparkSession, sf: str):
    """Order documents in a few large array files, each read by many tasks. Texts are planted with
    quotes, brackets, commas and backslashes."""
    docs = q_io._order_documents(spark, sf, stage_heavy=True)
    # files by status; of many orders, several a status, as one task writes a file
    n_files = 1 + read_table(spark, sf, "orders").count() // ORDERS_A_FILE
    number = F.pmod(F.xxhash64("id_pedido", "chunk"), F.lit(n_files)).cast("string")
    docs = docs.withColumn("file", F.concat_ws("-", "status", number)).drop("chunk")
    odd = F.when(F.col("id_pedido") % 3 == 0, F.lit('a"],\\{"b, \\\\')).otherwise(F.lit("]}, "))
    docs = docs.withColumn("nota", odd)
    path = shared_path(spark, "documents", "orders-arrays", unique=True)
    split_json.write_json_arrays(docs, path, "file")
    schema = StructType([*q_io.ORDER_FILE_DOC.fields, StructField("nota", StringType())])
    back = split_json.read_json_array(spark, path, schema, split_bytes=1 << 20)
    known = F.when(F.col("id_pedido") % 3 == 0, F.lit('a"],\\{"b, \\\\')).otherwise(F.lit("]}, "))
    return q_io._order_sums(back.filter(F.col("nota") == known))


# ------------------------------------------------------------------ A22
@query("q_update_files", "A22", """
SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN hit THEN o_totalprice + 10 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, CASE WHEN hit THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       CASE WHEN hit THEN TIMESTAMP '2025-06-01 12:00:00' ELSE o_orderdate END AS o_updated_at,
       o_orderkey >= (SELECT CAST(max(o_orderkey) * 0.9 AS BIGINT) FROM orders) AS rewritten
FROM (SELECT *, o_orderkey >= (SELECT CAST(max(o_orderkey) * 0.9 AS BIGINT) FROM orders) AND o_orderstatus = 'P' AS hit FROM orders)
""")
def q_update_files(spark: SparkSession, sf: str):
    """Late pending orders updated in a table of files by key range: only the
    files that hold them are written anew (``rewritten``: in the folder of the new version)."""
    orders = read_table(spark, sf, "orders").withColumn("o_updated_at", F.col("o_orderdate"))
    late = orders.agg((F.max("o_orderkey") * F.lit(0.9)).cast("decimal(38,1)")).first()[0]
    edge = int(late.to_integral_value(rounding="ROUND_HALF_UP")) if late is not None else 0
    root = shared_path(spark, "versions", "orders", unique=True)
    # files of early and of late keys
    early, late = orders.filter(F.col("o_orderkey") < edge), orders.filter(F.col("o_orderkey") >= edge)
    versions.create(early.unionByName(late), root)
    batch = orders.filter((F.col("o_orderkey") >= edge) & (F.col("o_orderstatus") == "P")).select(
        "o_orderkey", (F.col("o_totalprice") + 10).alias("o_totalprice"), F.lit(None).cast("string").alias("o_orderpriority"))
    versions.update(spark, root, orders.schema, batch, "o_orderkey", "o_updated_at",
                    F.lit("2025-06-01 12:00:00").cast("timestamp_ntz"))
    back = versions.read(spark, root, orders.schema)
    return back.select("*", F.col("_metadata.file_path").contains("/v=1/").alias("rewritten"))


# ------------------------------------------------------------------ B13
@query("q_bag_difference", "B13", """
WITH c AS (
  SELECT l_returnflag, l_linestatus, l_partkey, l_quantity FROM lineitem WHERE NOT (l_returnflag = 'R' AND l_partkey % 10 = 0)
  UNION ALL
  SELECT l_returnflag, l_linestatus, l_partkey, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_partkey % 10 = 1),
s AS (SELECT l_returnflag, l_linestatus, l_partkey, l_quantity, count(*) AS n FROM lineitem GROUP BY ALL),
k AS (SELECT l_returnflag, l_linestatus, l_partkey, l_quantity, count(*) AS m FROM c GROUP BY ALL)
SELECT l_returnflag, l_linestatus, l_partkey, l_quantity, greatest(coalesce(n, 0) - coalesce(m, 0), 0) AS missing,
       greatest(coalesce(m, 0) - coalesce(n, 0), 0) AS surplus
FROM s FULL JOIN k USING (l_returnflag, l_linestatus, l_partkey, l_quantity)
WHERE coalesce(n, 0) <> coalesce(m, 0)
""")
def q_bag_difference(spark: SparkSession, sf: str):
    """What a faulty copy lacks and has too much, by how often; only returned
    items differ, so only their partitions are compared row by row."""
    cols = ["l_returnflag", "l_linestatus", "l_partkey", "l_quantity"]
    source = read_table(spark, sf, "lineitem").select(*cols)
    lost = (F.col("l_returnflag") == "R") & (F.col("l_partkey") % 10 == 0)
    twice = (F.col("l_returnflag") == "R") & (F.col("l_partkey") % 10 == 1)
    copy = source.filter(~lost).unionByName(source.filter(twice))
    return differences.bag_difference(source, copy, ["l_returnflag", "l_linestatus"])


# ------------------------------------------------------------------ B9
@query("q_total_levels", "B9", """
WITH e AS (SELECT CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS kind, CAST(ts AS DATE) AS day, CAST(value AS DECIMAL(10,2)) AS value FROM events)
SELECT kind, day, CAST(CASE grouping(kind, day) WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END AS INTEGER) AS level,
       count(*) AS n, CAST(sum(value) AS DECIMAL(18,2)) AS total
FROM e GROUP BY GROUPING SETS ((kind, day), (kind), (day), ())
""")
def q_total_levels(spark: SparkSession, sf: str):
    """Totals by kind and day, kind, day and of all; some kinds are NULL."""
    kind = F.when(F.col("event_id") % 7 != 0, F.col("event_type"))
    events = read_table(spark, sf, "events").select(kind.alias("kind"), F.col("ts").cast("date").alias("day"),
                                                    F.col("value").cast("decimal(10,2)").alias("value"))
    found = levels.grouped_levels(events, ["kind", "day"], [["kind", "day"], ["kind"], ["day"], []],
                                  F.count(F.lit(1)).alias("n"), F.sum("value").cast("decimal(18,2)").alias("total"))
    return found.select("kind", "day", "level", "n", "total")


@query("q_distinct_counts", "A2,A8", """
SELECT event_type, count(DISTINCT user_id) AS n_user_id, count(DISTINCT CAST(value AS DECIMAL(10,2))) AS n_value,
       true AS sketch_within_5_percent
FROM events GROUP BY event_type
""")
def q_distinct_counts(spark: SparkSession, sf: str):
    """Distinct accounts and values by kind, exactly, next to stored daily
    sketches of the values merged to kinds (held to 5 %)."""
    events = read_table(spark, sf, "events").select(
        "event_type", "user_id", F.col("value").cast("decimal(10,2)").alias("value"), F.col("ts").cast("date").alias("day"))
    exact = levels.distinct_counts(events, ["event_type"], ["user_id", "value"])
    path = shared_path(spark, "sketches", "values", unique=True)
    text = events.withColumn("value", F.col("value").cast("string"))
    levels.distinct_sketches(text, ["event_type", "day"], "value").write.partitionBy("day").parquet(path)
    merged = levels.merged_sketches(spark.read.parquet(path), ["event_type"])
    close = F.abs(levels.estimate(F.col("sketch")) - F.col("n_value")) <= F.col("n_value") * F.lit(0.05)
    return exact.join(merged, "event_type").select("event_type", "n_user_id", "n_value", close.alias("sketch_within_5_percent"))


# ------------------------------------------------------------------ SQL functions
ITEMS_A_TASK = 500_000  # rows that a task sorts and groups


@query("q_sql_functions", "A7,B7", """
SELECT l_orderkey, CAST(sum(CAST(l_quantity AS DECIMAL(10,2)) * CAST(l_extendedprice AS DECIMAL(10,2))) AS DECIMAL(30,2)) AS total,
       count(DISTINCT CAST(l_shipdate AS DATE)) AS ship_days, max(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) + 1) AS most_days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey
""")
def q_sql_functions(spark: SparkSession, sf: str):
    """Item totals by a catalog SQL function, and days by a table function."""
    catalog.register(spark)
    lineitem, orders = read_table(spark, sf, "lineitem"), read_table(spark, sf, "orders")
    # the counts come from the files' footers; more rows make more tasks, not larger ones
    parts = max(spark.sparkContext.defaultParallelism, 1 + (lineitem.count() + orders.count()) // ITEMS_A_TASK)
    li = lineitem.select(
        "l_orderkey", F.col("l_shipdate").cast("date").alias("shipped"),
        F.expr("shop_item_total(cast(l_quantity as decimal(10,2)), cast(l_extendedprice as decimal(10,2)))").alias("total")).repartition(parts, "l_orderkey")
    orders = orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("ordered")).repartition(parts, "o_orderkey")
    items = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    # the table function gives the days of the whole calendar once
    span = items.agg(F.min("ordered").alias("a"), F.max("shipped").alias("b")).first()
    days = spark.sql(f"SELECT day FROM shop_days(DATE '{span['a'] or '2000-01-01'}', DATE '{span['b'] or '2000-01-01'}')")
    known = items.join(days, items["shipped"] == days["day"])
    return known.groupBy("l_orderkey").agg(
        F.sum("total").cast("decimal(30,2)").alias("total"), F.count_distinct("day").alias("ship_days"),
        F.max(F.date_diff("day", "ordered") + 1).cast("bigint").alias("most_days"))


# ------------------------------------------------------------------ B12
def dirty_lines(orders):
    """The lines of all orders, and garbled copies of some: text for a number, a
    field too few, one too many, an empty line."""
    line = files.delimited_line(q_io._LINE_COLS)
    k = F.col("o_orderkey")
    garbled = (F.when(k % 4 == 0, F.concat(F.lit("x"), line)).when(k % 4 == 1, F.concat_ws("|", k.cast("string"), F.col("o_custkey").cast("string")))
               .when(k % 4 == 2, F.concat(line, F.lit("|extra"))).otherwise(F.lit("")))
    some = orders.filter(F.col("o_orderstatus") == "P")
    return orders.select(line.alias("line")).unionByName(some.select(garbled.alias("line")))


def line_rules():
    return [*quality.line_rules(q_io._LINE_FIELDS), *quality.not_null_rules(["o_orderkey"])]


@query("q_quarantined_lines", "B12,A19", """
SELECT line, violations, count(*) AS n FROM (
  SELECT CASE o_orderkey % 4 WHEN 0 THEN 'x' || o_orderkey || '|' || o_custkey || '|' || o_orderstatus || '|' || o_orderpriority
           WHEN 1 THEN o_orderkey || '|' || o_custkey
           WHEN 2 THEN o_orderkey || '|' || o_custkey || '|' || o_orderstatus || '|' || o_orderpriority || '|extra' ELSE '' END AS line,
         CASE o_orderkey % 4 WHEN 0 THEN 'bad_type:o_orderkey,not_null:o_orderkey' WHEN 1 THEN 'field_count:line' WHEN 2 THEN 'field_count:line'
           ELSE 'bad_type:o_orderkey,field_count:line,not_null:o_orderkey' END AS violations
  FROM orders WHERE o_orderstatus = 'P')
GROUP BY ALL
""")
def q_quarantined_lines(spark: SparkSession, sf: str):
    """Garbled lines among the orders: none is loaded, each is kept with its
    text and the rules that it breaks."""
    path = shared_path(spark, "objects", "orders-dirty", unique=True)
    files.write_text(dirty_lines(read_table(spark, sf, "orders")), path)
    parse = lambda raw: files.parse_delimited(raw, q_io._LINE_FIELDS, checked=True)
    t = q_io._table_name("orders_dirty")
    names = [n for n, _ in q_io._LINE_FIELDS]
    good = jobs.objects_to_table(spark.read.text(path), parse, ["o_orderkey"], jobs.load_catalog_table(t), rules=line_rules(), columns=names)
    bad = jobs.quarantined(spark, good, StructType([StructField("line", StringType()), StructField("violations", ArrayType(StringType()))]))
    return bad.groupBy("line", F.array_join("violations", ",").alias("violations")).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ B12 with state
@query("q_stream_once", "B12,A18", """
WITH w AS (SELECT max(ts) - INTERVAL 10 DAY AS wm FROM events WHERE event_id % 3 <> 0)
SELECT event_id, load_state, count(*) AS n FROM (
  SELECT event_id, 'valid' AS load_state FROM events WHERE event_id % 3 <> 0
  UNION ALL SELECT event_id, 'repeated' FROM events WHERE event_id % 6 = 1
  UNION ALL SELECT event_id, CASE WHEN ts < wm THEN 'late' ELSE 'valid' END FROM events, w WHERE event_id % 3 = 0
  UNION ALL SELECT event_id, CASE WHEN ts < wm THEN 'late' ELSE 'repeated' END FROM events, w WHERE event_id % 6 = 2)
GROUP BY ALL
""")
def q_stream_once(spark: SparkSession, sf: str):
    """Events land in two waves with repeats inside and across them; each is loaded
    once, and rows older than the watermark are set aside."""
    from tillroll.streaming import once

    cols = [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("event_type", "string")]
    events = read_table(spark, sf, "events").select(*[n for n, _ in cols])
    line = files.delimited_line([n for n, _ in cols]).alias("line")
    base = shared_path(spark, "stream", "events", unique=True)
    k = F.col("event_id")
    waves = [events.filter(k % 3 != 0).unionByName(events.filter(k % 6 == 1)),
             events.filter(k % 3 == 0).unionByName(events.filter(k % 6 == 2))]
    for i, wave in enumerate(waves):
        files.write_text(wave.select(line), f"{base}/landing/wave={i}")
        once.load_once(spark, f"{base}/landing", lambda raw: files.parse_delimited(raw, cols), ["event_id"], "ts",
                       "INTERVAL 10 DAY", f"{base}/table", f"{base}/_checkpoint", glob="*.txt")
    back = spark.read.parquet(f"{base}/table/rows")
    return back.groupBy("event_id", "load_state").agg(F.sum("n_rows").alias("n"))


# ------------------------------------------------------------------ A10
@query("q_equi_depth", "A10", """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 7 WHEN event_id % 11 = 0 THEN NULL ELSE user_id * 1000 END AS key, event_type FROM events
""")
def q_equi_depth(spark: SparkSession, sf: str):
    """A table read in parts of equal rows by key, the way a database would be: every row
    comes once, though half have one key and some have none."""
    from tillroll.sources import jdbc

    key = F.when(F.col("event_id") % 2 == 0, F.lit(7)).when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(F.col("user_id") * 1000)
    table = read_table(spark, sf, "events").select("event_id", key.cast("bigint").alias("key"), "event_type")
    parts = [table.filter(F.expr(p)) for p in jdbc.equi_depth_predicates(table, "key", 8)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
