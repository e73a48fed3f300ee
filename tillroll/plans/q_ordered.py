"""Queries along an order of time or value: periods, as-of matches, running sums, row numbers."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tillroll.operators import intervals, ordered
from tillroll.plans.registry import query
from tillroll.sources.tables import read_table

#: half of all events on one account, some on none
ACCOUNT_SQL = """CASE WHEN event_id % 2 = 0 THEN 0 WHEN event_id % 41 = 0 THEN NULL ELSE user_id END"""


def _events(spark, sf, *kinds):
    events = read_table(spark, sf, "events")
    if kinds:
        events = events.filter(F.col("event_type").isin(*kinds))
    account = F.when(F.col("event_id") % 2 == 0, F.lit(0)).when(F.col("event_id") % 41 == 0, F.lit(None)).otherwise(F.col("user_id"))
    return events.select("event_id", account.alias("account"), "ts", "event_type", F.col("value").cast("decimal(10,2)").alias("value"))


@query("q_period_transactions", "B7,B9", """
WITH p AS (
  SELECT event_id AS period_id, user_id AS account, date_trunc('day', ts) AS period_start,
         date_trunc('day', ts) + to_days(CAST(event_id % 9 AS INTEGER)) + INTERVAL 86399 SECOND AS period_end
  FROM events WHERE event_type = 'signup' AND event_id % 2 = 1)
SELECT period_id, p.account, period_start, period_end, count(*) AS n,
       CAST(sum(CAST(value AS DECIMAL(10,2))) AS DECIMAL(18,2)) AS total
FROM p JOIN events e ON e.user_id = p.account AND e.ts BETWEEN period_start AND period_end AND e.event_type <> 'signup'
GROUP BY ALL
""")
def q_period_transactions(spark: SparkSession, sf: str):
    """Statement periods (of one to nine days) joined to the transactions inside them."""
    events = read_table(spark, sf, "events")
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    periods = events.filter("event_type = 'signup' AND event_id % 2 = 1").select(
        F.col("event_id").alias("period_id"), F.col("user_id").alias("account"), day.alias("period_start"),
        F.expr("cast(date_trunc('day', ts) as timestamp_ntz) + make_dt_interval(cast(event_id % 9 as int), 23, 59, 59)")
        .alias("period_end"))
    entries = events.filter("event_type <> 'signup'").select(
        F.col("user_id").alias("account"), "ts", F.col("value").cast("decimal(10,2)").alias("value"))
    inside = intervals.interval_join(entries, periods, ["account"], "ts", "period_start", "period_end")
    return inside.groupBy("period_id", "account", "period_start", "period_end").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").cast("decimal(18,2)").alias("total"))


@query("q_asof_view", "B9,B10", f"""
WITH e AS (SELECT event_id, {ACCOUNT_SQL} AS account, ts, event_type, CAST(value AS DECIMAL(10,2)) AS value FROM events),
v AS (SELECT event_id, account, ts, value FROM e WHERE event_type = 'view' AND account IS NOT NULL)
SELECT p.event_id, p.account, p.ts, p.value, v.event_id AS view_id, v.ts AS view_ts, v.value AS view_value
FROM (SELECT event_id, account, ts, value FROM e WHERE event_type = 'purchase') p
ASOF LEFT JOIN v ON p.account = v.account AND p.ts >= v.ts
""")
def q_asof_view(spark: SparkSession, sf: str):
    """Every purchase with the last view of its account at or before it; one
    account has half of all events."""
    views = _events(spark, sf, "view").select("account", "ts", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"),
                                             F.col("value").alias("view_value"))
    purchases = _events(spark, sf, "purchase").select("event_id", "account", "ts", "value")
    return ordered.asof_join(purchases, views, ["account"], "ts", "ts", ["view_id", "view_ts", "view_value"], tie=["view_id"])


@query("q_running_balance", "B9", f"""
SELECT event_id, account, ts, signed_value,
       CAST(sum(signed_value) OVER (PARTITION BY account ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DECIMAL(20,2)) AS balance
FROM (SELECT event_id, {ACCOUNT_SQL} AS account, ts,
             CAST(CASE WHEN event_type = 'purchase' THEN -CAST(value AS DECIMAL(10,2)) ELSE CAST(value AS DECIMAL(10,2)) END
                  AS DECIMAL(10,2)) AS signed_value
      FROM events)
""")
def q_running_balance(spark: SparkSession, sf: str):
    """The balance of each account after every entry; one account has half of all entries."""
    entries = _events(spark, sf).select(
        "event_id", "account", "ts",
        F.when(F.col("event_type") == "purchase", -F.col("value")).otherwise(F.col("value")).cast("decimal(10,2)").alias("signed_value"))
    return ordered.running_total(entries, ["account"], ["ts", "event_id"], "signed_value", "balance")


@query("q_row_numbers", "A3", """
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders
""")
def q_row_numbers(spark: SparkSession, sf: str):
    """Orders numbered without gaps by falling total, over all rows."""
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    numbered = ordered.number_rows(orders.withColumn("_down", -F.col("o_totalprice")), ["_down", "o_orderkey"], "place")
    return numbered.drop("_down").select("o_orderkey", "o_totalprice", F.col("place").cast("bigint").alias("place"))
