"""Work along an order: skewed keys, ties, NULLs, empty tables, against brute force."""

import datetime as dt
import random
from bisect import bisect_right
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillroll.operators import differences, intervals, levels, ordered
from tillroll.sources import jdbc

T0 = dt.datetime(2024, 1, 1)


def _at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


@pytest.fixture()
def entries(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([0, 0, 0, 0, 1, 2, None]), _at(rng.randrange(2000)), Decimal(rng.randrange(-500, 500)) / 100)
            for i in range(3000)]
    rows += [(3000 + i, 5, _at(i), None) for i in range(3)]
    return rows, spark.createDataFrame(rows, "id int, account int, ts timestamp_ntz, value decimal(10,2)").repartition(5)


def test_running_total(spark, entries):
    rows, df = entries
    got = {r["id"]: r["balance"] for r in ordered.running_total(df, ["account"], ["ts", "id"], "value", "balance", parts=7).collect()}
    totals: dict = {}
    for i, account, ts, value in sorted(rows, key=lambda r: (r[2], r[0])):
        if value is not None:
            totals[account] = totals.get(account, Decimal(0)) + value
        assert got[i] == totals.get(account)
    assert len(got) == len(rows)
    parts = ordered.ordered_parts(df, ["account", "ts", "id"], 7)
    assert parts.filter("account = 0").select("_part").distinct().count() > 1  # the hot account is spread
    assert ordered.running_total(df.limit(0), ["account"], ["ts", "id"], "value", "balance").count() == 0


def test_numbers_have_no_gaps(spark, entries):
    rows, df = entries
    got = ordered.number_rows(df, ["ts", "id"], parts=7).collect()
    want = {r[0]: n for n, r in enumerate(sorted(rows, key=lambda r: (r[2], r[0])), 1)}
    assert {r["id"]: r["row_number"] for r in got} == want
    tied = ordered.number_rows(df.select((F.col("id") % 2).alias("x")), ["x"], parts=5)
    assert sorted(r["row_number"] for r in tied.collect()) == list(range(1, len(rows) + 1))
    assert ordered.number_rows(df.limit(0), ["ts"]).count() == 0


def test_asof(spark, entries):
    rows, df = entries
    rng = random.Random(5)
    rates = [(k, rng.choice([0, 0, 0, 1, 9, None]), _at(rng.randrange(2500)) if k % 50 else None, k) for k in range(800)]
    right = spark.createDataFrame(rates, "rate int, account int, since timestamp_ntz, no int").repartition(3)
    got = ordered.asof_join(df, right, ["account"], "ts", "since", ["rate"], tie=["no"], parts=7)
    assert got.columns == [*df.columns, "rate"]
    by: dict = {}
    for rate, account, since, no in rates:
        if since is not None and account is not None:
            by.setdefault(account, []).append((since, no, rate))
    for v in by.values():
        v.sort()
    for r in got.collect():
        known = by.get(r["account"], [])
        at = bisect_right(known, (r["ts"], 10**9, 0))
        assert r["rate"] == (known[at - 1][2] if at else None)
    assert got.count() == len(rows)
    assert ordered.asof_join(df, right.limit(0), ["account"], "ts", "since", ["rate"]).filter("rate IS NOT NULL").count() == 0
    assert ordered.asof_join(df.limit(0), right, ["account"], "ts", "since", ["rate"]).count() == 0


def test_interval_join(spark, entries):
    rows, df = entries
    rng = random.Random(6)
    periods = []
    for p in range(150):
        a = rng.randrange(-100, 2200)
        length = rng.choice([0, 1, 7, 64, 500, 5000])
        periods.append((p, rng.choice([0, 1, 2, 9, None]), _at(a), _at(a + length)))
    periods += [(900, 0, _at(10), _at(5)), (901, 0, None, _at(5)), (902, 0, _at(5), None), (903, 0, _at(0), _at(4_000_000))]
    right = spark.createDataFrame(periods, "period int, account int, start timestamp_ntz, stop timestamp_ntz")
    got = intervals.interval_join(df, right, ["account"], "ts", "start", "stop")
    want = sorted((r[0], p[0]) for r in rows for p in periods
                  if r[1] is not None and r[1] == p[1] and p[2] and p[3] and p[2] <= r[2] <= p[3])
    assert sorted((r["id"], r["period"]) for r in got.collect()) == want
    assert got.columns == [*df.columns, "period", "start", "stop"]
    assert "CartesianProduct" not in got._jdf.queryExecution().toString() and "NestedLoop" not in got._jdf.queryExecution().toString()
    assert intervals.interval_join(df, right.limit(0), ["account"], "ts", "start", "stop").count() == 0
    with pytest.raises(ValueError, match="both sides"):
        intervals.interval_join(df, right.withColumn("id", F.lit(1)), ["account"], "ts", "start", "stop")


def test_bag_difference(spark):
    a = spark.createDataFrame([("x", 1), ("x", 1), ("y", 2), (None, 3), ("z", None)], "k string, v int")
    b = spark.createDataFrame([("x", 1), ("y", 2), ("y", 2), (None, None), ("z", None)], "k string, v int")
    got = {(r["k"], r["v"]): (r["missing"], r["surplus"]) for r in differences.bag_difference(a, b, ["k"]).collect()}
    assert got == {("x", 1): (1, 0), ("y", 2): (0, 1), (None, 3): (1, 0), (None, None): (0, 1)}
    assert {r["k"] for r in differences.differing_partitions(a, b, ["k"]).collect()} == {"x", "y", None}
    assert differences.bag_difference(a, a, ["k"]).count() == 0
    assert differences.bag_difference(a, a.limit(0), ["k"]).agg(F.sum("missing")).first()[0] == 5
    assert differences.bag_difference(a.limit(0), a.limit(0), ["k"]).count() == 0


def test_levels(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", 3), (None, None)], "k string, v int")
    got = levels.grouped_levels(df, ["k"], [["k"], []], F.count("*").alias("n"), F.sum("v").alias("s"))
    assert sorted(map(tuple, got.select("k", "level", "n", "s").collect()), key=repr) == sorted(
        [("a", 0, 2, 4), (None, 0, 2, 2), (None, 1, 4, 6)], key=repr)
    with pytest.raises(ValueError):
        levels.grouped_levels(df, ["k"], [["k"], ["k"]], F.count("*").alias("n"))


def test_sketches_merge(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 7).alias("day"), (F.col("id") % 20_000).cast("string").alias("v"))
    merged = levels.merged_sketches(levels.distinct_sketches(df, ["g", "day"], "v"), ["g"])
    exact = {r["g"]: r["n_v"] for r in levels.distinct_counts(df, ["g"], ["v"]).collect()}
    for r in merged.select("g", levels.estimate(F.col("sketch")).alias("n")).collect():
        assert abs(r["n"] - exact[r["g"]]) <= 0.03 * exact[r["g"]]


@pytest.mark.parametrize("kind,values", [
    ("int", [7] * 600 + list(range(300)) + [None] * 100), ("string", ["o'k"] * 500 + [f"k{i:03}" for i in range(400)] + [None] * 9),
    ("date", [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(500)]), ("timestamp", [_at(i) for i in range(500)]),
    ("int", [None, None]), ("int", [])])
def test_equi_depth(spark, kind, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, k {kind}")
    conditions = jdbc.equi_depth_predicates(df, "k", 6)
    parts = [[r["id"] for r in df.filter(F.expr(c)).collect()] for c in conditions]
    assert sorted(i for p in parts for i in p) == list(range(len(values)))  # each row once
    if len(set(values)) == len(values) > 10:
        assert max(map(len, parts)) <= 1.3 * len(values) / 6
