"""Queries for the shop model: lookups (B10), reconciliation (B8, B9),
soft delete (B11), typed load (A14) and the stamped update (A22)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    LongType, StringType, StructField, StructType, TimestampNTZType,
)

from tillroll.functions.money import MONEY
from tillroll.operators import load, model, nested, reconcile, transform, update
from tillroll.plans.registry import query
from tillroll.sources.tables import read_table


# ------------------------------------------------------------------ B10
@query("q_lookup_join", "B10", """
WITH c AS (
  SELECT c_custkey, c_name,
         CASE WHEN c_mktsegment = 'AUTOMOBILE' AND c_acctbal < 0 THEN NULL ELSE c_nationkey END AS c_nationkey
  FROM customer)
SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_nationkey, n.n_name, r.r_name
FROM orders o
JOIN c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def q_lookup_join(spark: SparkSession, sf: str):
    """Orders with customer, nation and region. The nation reference is
    nullable (left join); the customer reference is required (inner)."""
    cust = read_table(spark, sf, "customer").select(
        "c_custkey", "c_name",
        F.when((F.col("c_mktsegment") == "AUTOMOBILE") & (F.col("c_acctbal") < 0), F.lit(None))
        .otherwise(F.col("c_nationkey")).alias("c_nationkey"),
    )
    geo = model.lookup(cust, read_table(spark, sf, "nation"), ("c_nationkey", "n_nationkey"),
                       required=False, dim_cols=["n_name", "n_regionkey"])
    geo = model.lookup(geo, read_table(spark, sf, "region"), ("n_regionkey", "r_regionkey"),
                       required=False, dim_cols=["r_name"])
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    out = model.lookup(orders, geo, ("o_custkey", "c_custkey"), required=True)
    return out.select("o_orderkey", "o_custkey", "c_name", "c_nationkey", "n_name", "r_name")


# ------------------------------------------------------------------ B8
def _line_amount():
    ext = F.col("l_extendedprice").cast("decimal(12,2)")
    disc = F.col("l_discount").cast("decimal(4,2)")
    tax = F.col("l_tax").cast("decimal(4,2)")
    return ext * (F.lit(1) - disc) * (F.lit(1) + tax)


@query("q_order_reconcile", "B8", """
WITH li AS (
  SELECT l_orderkey,
         sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
             * (1 + CAST(l_tax AS DECIMAL(4,2)))) AS s,
         count(*) AS n
  FROM lineitem GROUP BY l_orderkey),
r AS (
  SELECT o.o_orderkey, CAST(o.o_totalprice AS DECIMAL(18,2)) AS declared,
         CAST(coalesce(li.s, 0) AS DECIMAL(18,2)) AS computed, li.n
  FROM orders o LEFT JOIN li ON o.o_orderkey = li.l_orderkey)
SELECT o_orderkey, declared, computed,
       CAST(declared - computed AS DECIMAL(18,2)) AS difference,
       CASE WHEN n IS NULL THEN 'no_items' WHEN declared - computed = 0 THEN 'ok' ELSE 'mismatch' END AS status
FROM r
""")
def q_order_reconcile(spark: SparkSession, sf: str):
    """Declared order total vs the exact decimal sum of its line amounts
    (price x (1 - discount) x (1 + tax)); orders without lines report 0."""
    orders = read_table(spark, sf, "orders")
    li = read_table(spark, sf, "lineitem")
    return reconcile.reconcile_orders(orders, li, "o_orderkey", "o_totalprice", "l_orderkey", _line_amount())


@query("q_document_totals", "B8,B3", """
WITH li AS (
  SELECT l_orderkey, CAST(sum(CAST(l_quantity AS DECIMAL(10,0)) * CAST(l_extendedprice AS DECIMAL(10,2))) AS DECIMAL(18,2)) AS s
  FROM lineitem GROUP BY l_orderkey),
r AS (
  SELECT o_orderkey, s, coalesce(s, 0) + CASE o_orderpriority WHEN '1-URGENT' THEN 25.50 WHEN '5-LOW' THEN 0 ELSE 9.90 END AS c,
         CASE WHEN o_orderstatus = 'P' THEN 10 ELSE 0 END AS fault
  FROM orders LEFT JOIN li ON o_orderkey = l_orderkey)
SELECT o_orderkey, CAST(c + fault AS DECIMAL(18,2)) AS declared, CAST(c AS DECIMAL(18,2)) AS computed,
       CAST(fault AS DECIMAL(18,2)) AS difference,
       CASE WHEN s IS NULL THEN 'no_items' WHEN fault = 0 THEN 'ok' ELSE 'mismatch' END AS status
FROM r
""")
def q_document_totals(spark: SparkSession, sf: str):
    """Order documents (items and freight, which low priority lacks) whose
    stated total is ten off for pending orders; checked inside each document."""
    items = read_table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_quantity").cast("decimal(10,0)").alias("quantidade"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("preco_unitario"))
    priority = F.col("o_orderpriority")
    orders = read_table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", 10).otherwise(0).alias("_fault"),
        F.when(priority == "1-URGENT", F.lit(Decimal("25.50"))).when(priority == "5-LOW", F.lit(None))
        .otherwise(F.lit(Decimal("9.90"))).alias("taxa_frete"))
    sums = items.groupBy(F.col("l_orderkey").alias("_k")).agg(
        F.sum(F.col("quantidade") * F.col("preco_unitario")).alias("_sum"))
    stated = F.coalesce("_sum", F.lit(0)) + F.coalesce("taxa_frete", F.lit(0)) + F.col("_fault")
    heads = orders.join(sums, orders["o_orderkey"] == sums["_k"], "left").select(
        "o_orderkey", "taxa_frete", stated.cast("decimal(18,2)").alias("total_pedido"))
    lists = nested.nest(items, ["l_orderkey"], "itens", ["quantidade", "preco_unitario"], max_items=1000)
    docs = heads.join(lists, heads["o_orderkey"] == lists["l_orderkey"], "left")
    return reconcile.reconcile_documents(docs, "o_orderkey", "itens", "quantidade", "preco_unitario",
                                         "total_pedido", "taxa_frete")


# ------------------------------------------------------------------ B9
_LEDGER_SQL = """
SELECT user_id,
       CASE event_type WHEN 'purchase' THEN 'DEBITO' WHEN 'signup' THEN 'CREDITO' END AS tipo,
       CASE event_type WHEN 'purchase' THEN -abs(CAST(value AS DECIMAL(12,2)))
                       WHEN 'signup' THEN abs(CAST(value AS DECIMAL(12,2))) END AS valor
FROM events
"""


def _ledger(spark, sf):
    """Events as account entries: a purchase is a debit, a signup bonus a
    credit; other event kinds move no money (tipo NULL)."""
    ev = read_table(spark, sf, "events")
    tipo = (F.when(F.col("event_type") == "purchase", F.lit(reconcile.DEBIT))
            .when(F.col("event_type") == "signup", F.lit(reconcile.CREDIT)))
    return ev.select(
        "user_id", tipo.alias("tipo"),
        reconcile.signed_amount(F.col("value").cast("decimal(12,2)"), tipo).alias("valor"),
    )


@query("q_balance", "B9", f"""
WITH e AS ({_LEDGER_SQL}),
per AS (
  SELECT user_id,
         sum(CASE WHEN tipo = 'CREDITO' THEN valor END) AS cr,
         sum(CASE WHEN tipo = 'DEBITO' THEN valor END) AS db
  FROM e GROUP BY user_id)
SELECT c.c_custkey,
       CAST(c.c_acctbal AS DECIMAL(18,2)) AS opening,
       CAST(coalesce(per.cr, 0) AS DECIMAL(18,2)) AS credits,
       CAST(coalesce(per.db, 0) AS DECIMAL(18,2)) AS debits,
       CAST(CAST(c.c_acctbal AS DECIMAL(18,2)) + coalesce(per.cr, 0) + coalesce(per.db, 0) AS DECIMAL(18,2))
         AS closing
FROM customer c LEFT JOIN per ON c.c_custkey = per.user_id
""")
def q_balance(spark: SparkSession, sf: str):
    """Opening balance + signed entries = closing balance per customer."""
    cust = read_table(spark, sf, "customer")
    return reconcile.balance_by_account(cust, "c_custkey", "c_acctbal",
                                        _ledger(spark, sf), "user_id", "valor", "tipo")


@query("q_statement_balance", "B9,B3", f"""
WITH e AS ({_LEDGER_SQL}),
per AS (SELECT user_id, sum(valor) AS moved FROM e WHERE tipo IS NOT NULL GROUP BY user_id)
SELECT c_custkey, CAST(c_acctbal AS DECIMAL(18,2)) AS opening,
       CAST(coalesce(moved, 0) AS DECIMAL(18,2)) AS movement,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) + coalesce(moved, 0)
            + CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS closing,
       c_mktsegment IS DISTINCT FROM 'MACHINERY' AS balanced
FROM customer LEFT JOIN per ON c_custkey = user_id
""")
def q_statement_balance(spark: SparkSession, sf: str):
    """Statement documents, one per customer with its entries as an array (a
    long statement has several, the balances on the first), whose closing
    balance is one off in one market segment; checked inside each document."""
    cust = read_table(spark, sf, "customer").select(
        "c_custkey", "c_acctbal", F.col("c_mktsegment").eqNullSafe("MACHINERY").alias("_fault"))
    entries = _ledger(spark, sf).filter(F.col("tipo").isNotNull())
    closing = reconcile.balance_by_account(cust, "c_custkey", "c_acctbal", entries, "user_id", "valor", "tipo")
    docs = nested.nest(entries, ["user_id"], "transacoes", ["tipo", "valor"], max_items=1000)
    heads = cust.join(closing.select("c_custkey", "opening", "closing"), "c_custkey")
    first = F.coalesce(F.col("chunk"), F.lit(0)) == 0
    money = lambda c: F.when(first, c).otherwise(F.lit(0)).cast("decimal(18,2)")
    stated = F.col("closing") + F.col("_fault").cast("int")
    parts = reconcile.statement_balances(heads.join(docs, heads["c_custkey"] == docs["user_id"], "left").select(
        "c_custkey", "transacoes",
        F.struct(money(F.col("opening")).alias("saldo_anterior"), money(stated).alias("saldo_atual")).alias("saldos")),
        key="c_custkey")
    total = {c: F.sum(c).cast("decimal(18,2)") for c in ("opening", "movement", "closing")}
    whole = parts.groupBy("c_custkey").agg(*[v.alias(c) for c, v in total.items()])
    return whole.withColumn("balanced", F.col("opening") + F.col("movement") == F.col("closing"))


@query("q_totals_by_type", "B9", f"""
WITH e AS ({_LEDGER_SQL})
SELECT user_id, tipo, count(*) AS entries, CAST(sum(valor) AS DECIMAL(18,2)) AS total
FROM e WHERE tipo IS NOT NULL GROUP BY user_id, tipo
""")
def q_totals_by_type(spark: SparkSession, sf: str):
    entries = _ledger(spark, sf).filter(F.col("tipo").isNotNull())
    return reconcile.totals_by_type(entries, ["user_id"], "tipo", "valor")


# ------------------------------------------------------------------ B11
@query("q_live_rows", "B11", """
SELECT *, c_acctbal < 0 AS is_deleted FROM customer WHERE NOT (c_acctbal < 0)
""")
def q_live_rows(spark: SparkSession, sf: str):
    """Customers whose soft-delete flag (derived: negative balance) is false."""
    cust = read_table(spark, sf, "customer").withColumn("is_deleted", F.col("c_acctbal") < 0)
    return transform.live_rows(cust, "is_deleted")


# ------------------------------------------------------------------ A14
ORDERS_TYPED = StructType([
    StructField("o_orderkey", LongType(), False),
    StructField("o_custkey", LongType(), False),
    StructField("o_orderstatus", StringType()),
    StructField("o_totalprice", MONEY, False),
    StructField("o_orderdate", TimestampNTZType()),
    StructField("o_orderpriority", StringType()),
])


@query("q_typed_load", "A14", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(10,2)) AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders
""")
def q_typed_load(spark: SparkSession, sf: str):
    """Order headers in their declared types; money becomes NUMERIC(10,2)."""
    return load.conform(read_table(spark, sf, "orders"), ORDERS_TYPED)


# ------------------------------------------------------------------ A22
UPDATE_NOW = "2025-01-01 00:00:00"
UNKNOWN_KEY_OFFSET = 1_000_000_000_000


@query("q_update_stamp", "A22", f"""
WITH u AS (
  SELECT o_orderkey, o_totalprice + 10 AS o_totalprice,
         CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS o_orderpriority
  FROM orders WHERE o_orderstatus = 'P'
  UNION ALL
  SELECT o_orderkey + {UNKNOWN_KEY_OFFSET}, o_totalprice + 10, o_orderpriority
  FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus,
       CASE WHEN u.o_orderkey IS NOT NULL THEN u.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       t.o_orderdate,
       CASE WHEN u.o_orderkey IS NOT NULL THEN u.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority,
       CASE WHEN u.o_orderkey IS NOT NULL THEN TIMESTAMP '{UPDATE_NOW}' ELSE t.o_orderdate END AS o_updated_at
FROM orders t LEFT JOIN u ON t.o_orderkey = u.o_orderkey
""")
def q_update_stamp(spark: SparkSession, sf: str):
    """Batch update of pending orders: new total, priority set to NULL for
    low priority, a stale caller stamp (overwritten), plus updates for keys
    that do not exist (inserted nowhere)."""
    orders = read_table(spark, sf, "orders")
    target = orders.withColumn("o_updated_at", F.col("o_orderdate"))
    stale = F.lit("1999-01-01 00:00:00").cast("timestamp_ntz").alias("o_updated_at")
    pending = orders.filter(F.col("o_orderstatus") == "P").select(
        "o_orderkey",
        (F.col("o_totalprice") + 10).alias("o_totalprice"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
        .otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        stale,
    )
    unknown = orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")).select(
        (F.col("o_orderkey") + UNKNOWN_KEY_OFFSET).alias("o_orderkey"),
        (F.col("o_totalprice") + 10).alias("o_totalprice"),
        "o_orderpriority",
        stale,
    )
    now = F.lit(UPDATE_NOW).cast("timestamp_ntz")
    return update.update_rows(target, pending.unionByName(unknown), "o_orderkey", "o_updated_at", now)
