"""A2 schema report, A4 descriptive statistics, A8 group mean.

The schema report and group mean are single aggregate passes; the
statistics keep exact quartiles without shuffling the whole column or
funnelling its values into one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

# The statistics and quartile levels of a descriptive summary,
# in the order a describe() prints them.
DESCRIBE_STATS = ("count", "mean", "std", "min", "25%", "50%", "75%", "max")
QUARTILES = (0.25, 0.5, 0.75)


# --------------------------------------------------------------------- A2
def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, Spark type, non-null count, rows.

    One scan: ``count(c)`` for every column plus ``count(*)`` in a single
    aggregate (partial per task, one tiny final merge), then ``stack``.
    """
    fields = df.schema.fields
    if not fields:
        raise ValueError("empty schema")
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count(F.col(f"`{f.name}`")).alias(f"_nn{i}") for i, f in enumerate(fields)]
    counts = df.agg(*aggs)
    parts = []
    for i, f in enumerate(fields):
        name = f.name.replace("'", "\\'")
        parts.append(f"{i + 1}, '{name}', '{f.dataType.simpleString()}', _nn{i}")
    expr = f"stack({len(fields)}, {', '.join(parts)}) as (position, column_name, data_type, non_null)"
    return counts.selectExpr(expr, "_rows as row_count").select(
        F.col("position").cast("int").alias("position"),
        "column_name",
        "data_type",
        F.col("non_null").cast("bigint").alias("non_null"),
        F.col("row_count").cast("bigint").alias("row_count"),
    )


# --------------------------------------------------------------------- A8
def group_mean(
    df: DataFrame,
    key: str,
    value: str,
    name: str,
    drop_null_keys: bool = False,
    skip_nan: bool = False,
) -> DataFrame:
    """Mean of ``value`` per ``key``.

    Default is the Spark form: a NULL key is its own group, NULL values are
    skipped, NaN propagates. ``drop_null_keys`` / ``skip_nan`` give the pandas
    form. Planned as partial aggregate -> hash exchange on ``key`` -> final
    aggregate, so a hot key is pre-combined in every task before the shuffle.
    """
    v = F.col(value)
    if drop_null_keys:
        df = df.filter(F.col(key).isNotNull())
    if skip_nan:
        v = F.when(~F.isnan(v), v)
    return df.groupBy(key).agg(F.avg(v).alias(name))


# --------------------------------------------------------------------- A4
def _numeric_columns(df: DataFrame, cols: Sequence[str] | None) -> list[str]:
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    if cols is None:
        return numeric
    bad = [c for c in cols if c not in numeric]
    if bad:
        raise ValueError(f"not numeric: {bad}")
    return list(cols)


def _long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, v) for every non-NULL value of every column; one scan."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("v"))
        for c in cols
    ])
    return df.select(F.inline(pairs)).filter(F.col("v").isNotNull())


_ACCURACY = 10_000
_SLACK = 4.0  # the first sketch is asked this many of its rank errors around a level


def _opening(xs: Sequence[Column], levels: Sequence[float], accuracy: int) -> list[Column]:
    """Aggregates of the first quantile pass over column ``i``: non-NULL values ``n``,
    NaN values ``m``, and ``q``, the finite values found a little under and over each level."""
    cuts = [min(max(float(q) + side * _SLACK / accuracy, 0.0), 1.0) for q in levels for side in (-1, 1)]
    return [a for i, x in enumerate(xs) for a in (
        F.count(x).alias(f"n{i}"), F.count_if(F.isnan(x)).alias(f"m{i}"),
        F.percentile_approx(F.when((x > F.lit(-math.inf)) & (x < F.lit(math.inf)), x), cuts, accuracy).alias(f"q{i}"))]


def _exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    levels: Sequence[float],
    accuracy: int = _ACCURACY,
    max_window: int = 10_000,
    opened: dict | None = None,
) -> DataFrame:
    """Exact, linearly interpolated quantiles ``(column_name, level, value)``.

    Approximate, then exact. For every (column, level) the two ranks the
    interpolation needs, ``floor`` and ``ceil`` of ``(n - 1) * level``, are
    kept inside a closed value bracket ``[lo, hi]``; ``below`` counts the values
    under it, ``base`` those up to ``lo`` and ``inside`` those strictly between
    the ends. The first pass counts and sketches every column at once: a level's
    two ranks lie at the fraction ``level`` whatever the number of rows. The second
    checks those brackets. So up to about ``max_window * accuracy / 10`` rows (ten
    million) two jobs come before the last pass. Where more are left inside, or NaN
    and infinite values shift the ranks, each further round
    1. sketches the inside with ``percentile_approx`` (a bounded summary
       per task, merged in a tiny final aggregate), asking for the two ranks
       widened by a few times the sketch's rank error;
    2. checks the narrower bracket with exact counts and keeps it only if it
       still holds both ranks (otherwise the widening grows).
    A hot value soon is an end of its bracket, so it no longer counts as inside.
    Rounds go on until at most ``max_window`` values are inside. The last
    pass collapses the values of each bracket to (value, weight), at most
    ``max_window + 2`` rows, and numbers them with a running sum.

    Every pass is a scan of the numeric columns with partial aggregation;
    only bracket-sized data is shuffled, and a value held by many rows is
    one weighted row. The driver sees a few numbers per bracket. NaN sorts
    above every number (as in Spark and DuckDB); NULLs are skipped.
    ``opened``, a row of the ``_opening`` aggregates of the same columns, levels and
    accuracy, saves the first pass when the caller already has it.
    """
    xs = [F.col(f"`{c}`").cast("double") for c in cols]
    if opened is None:
        opened = df.agg(*_opening(xs, levels, accuracy)).first().asDict()
    slack = _SLACK / accuracy

    done: list[tuple[str, float, float | None]] = []
    open_: list[dict] = []
    for i, c in enumerate(cols):
        n, finite, cuts = opened[f"n{i}"], opened[f"n{i}"] - opened[f"m{i}"], opened[f"q{i}"]
        if n == 0:
            continue
        for j, level in enumerate(levels):
            h = (n - 1) * float(level)
            r0, r1 = math.floor(h), math.ceil(h)
            if r1 >= finite:  # the upper rank is a NaN
                done.append((c, float(level), float("nan")))
                continue
            open_.append(dict(col=c, x=xs[i], level=float(level), h=h, r0=r0, r1=r1,
                              lo=-math.inf, hi=math.inf, below=0, base=0, inside=finite,
                              widen=3.0 / accuracy))
            if cuts is not None:
                open_[-1]["_guess"] = (cuts[2 * j] if level > slack else -math.inf,
                                       cuts[2 * j + 1] if level < 1 - slack else math.inf)

    rounds = 0
    while active := [t for t in open_ if t["inside"] > max_window]:
        rounds += 1
        if rounds > 100:  # each round leaves a few sketch errors of the values inside
            raise RuntimeError(f"quantile brackets do not narrow: {active[0]['col']}")
        # one sketch per bracket, asked for every rank its levels need
        groups: dict[tuple, list[dict]] = {}
        for t in active:
            if "_guess" not in t:
                groups.setdefault((t["col"], t["lo"], t["hi"]), []).append(t)
        sketches = []
        for g, members in enumerate(groups.values()):
            x, lo, hi = members[0]["x"], members[0]["lo"], members[0]["hi"]
            fractions = []
            for t in members:
                t["_at"] = (g, len(fractions))
                t["_cut"] = ((t["r0"] - t["base"]) / t["inside"] - t["widen"],
                             (t["r1"] - t["base"] + 1) / t["inside"] + t["widen"])
                fractions += [min(max(f, 0.0), 1.0) for f in t["_cut"]]
            inner = (x > F.lit(lo)) & (x < F.lit(hi))  # NaN is above every number
            sketches.append(F.percentile_approx(F.when(inner, x), fractions, accuracy).alias(f"s{g}"))
        guess = df.agg(*sketches).first() if sketches else None
        checks = []
        for j, t in enumerate(active):
            if "_guess" in t:
                t["_lo"], t["_hi"] = t["_guess"]
            else:
                g, k = t["_at"]
                seen = guess[f"s{g}"]  # NULL when all values counted inside are infinite
                t["_lo"] = t["lo"] if seen is None or t["_cut"][0] <= 0 else seen[k]
                t["_hi"] = t["hi"] if seen is None or t["_cut"][1] >= 1 else seen[k + 1]
            lo, hi = F.lit(t["_lo"]), F.lit(t["_hi"])
            checks += [F.count_if(t["x"] < lo).alias(f"b{j}"), F.count_if(t["x"] <= lo).alias(f"l{j}"),
                       F.count_if(t["x"] < hi).alias(f"h{j}"),
                       F.count_if((t["x"] <= hi) & ~F.isnan(t["x"])).alias(f"u{j}")]
        seen = df.agg(*checks).first()
        for j, t in enumerate(active):
            if seen[f"b{j}"] <= t["r0"] and seen[f"u{j}"] >= t["r1"] + 1:
                t.update(lo=t["_lo"], hi=t["_hi"], below=seen[f"b{j}"], base=seen[f"l{j}"],
                         inside=max(0, seen[f"h{j}"] - seen[f"l{j}"]), widen=3.0 / accuracy)
            elif "_guess" not in t:  # infinite values shift the first ranks: widen and retry
                t["widen"] *= 4
            t.pop("_guess", None)

    fixed = [F.struct(F.lit(c).alias("column_name"), F.lit(level).alias("level"), F.lit(v).alias("value"))
             for c, level, v in done]
    if not open_:
        return df.sparkSession.range(1).select(F.inline(F.array(*fixed))) if fixed else \
            df.sparkSession.createDataFrame([], "column_name string, level double, value double")
    # levels whose brackets coincide (e.g. no round was needed) share one
    brackets: dict[tuple, list[dict]] = {}
    for t in open_:
        brackets.setdefault((t["col"], t["lo"], t["hi"]), []).append(t)
    members = list(brackets.values())
    picks = F.array(*[
        F.when(ts[0]["x"].between(F.lit(ts[0]["lo"]), F.lit(ts[0]["hi"])) & ~F.isnan(ts[0]["x"]),
               F.struct(F.lit(b).alias("_t"), ts[0]["x"].alias("v")))
        for b, ts in enumerate(members)
    ])
    in_brackets = (
        df.select(F.explode(F.filter(picks, lambda e: e.isNotNull())).alias("_e"))
        .select("_e._t", "_e.v")
        .groupBy("_t", "v").agg(F.count(F.lit(1)).alias("w"))
    )
    upto = F.sum("w").over(Window.partitionBy("_t").orderBy("v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    # the levels of each bracket, as constants indexed by bracket id
    levels_of = F.array(*[
        F.array(*[F.struct(F.lit(t["col"]).alias("column_name"), F.lit(t["level"]).alias("level"),
                           F.lit(t["h"]).alias("_h"), F.lit(t["r0"]).alias("_r0"),
                           F.lit(t["r1"]).alias("_r1"), F.lit(t["below"]).alias("_below"))
                  for t in ts])
        for ts in members
    ])
    spans = in_brackets.withColumn("_upto", upto).select(
        "v", "w", "_upto", F.inline(F.element_at(levels_of, F.col("_t") + 1))
    ).select(
        "column_name", "level", "_h", "_r0", "_r1", "v",
        (F.col("_below") + F.col("_upto") - F.col("w")).alias("_lo"),
        (F.col("_below") + F.col("_upto")).alias("_hi"),
    )
    holds = lambda r: (F.col(r) >= F.col("_lo")) & (F.col(r) < F.col("_hi"))
    found = spans.filter(holds("_r0") | holds("_r1")).groupBy("column_name", "level").agg(
        F.max(F.when(holds("_r0"), F.col("v"))).alias("_v0"),
        F.max(F.when(holds("_r1"), F.col("v"))).alias("_v1"),
        F.max("_h").alias("_h"),
    )
    exact = found.select(
        "column_name", "level",
        (F.col("_v0") + (F.col("_h") - F.floor("_h")) * (F.col("_v1") - F.col("_v0"))).alias("value"),
    )
    if not fixed:
        return exact
    return exact.unionByName(df.sparkSession.range(1).select(F.inline(F.array(*fixed))))


def describe_numeric(
    df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False, accuracy: int = 100_000,
    skip_nan: bool = False,
) -> DataFrame:
    """Long-form summary ``(column_name, stat, value)`` of numeric columns.

    count, mean, sample std, min, 25/50/75 % (linear interpolation), max.
    Exact quartiles by default (see ``_exact_quantiles``); ``approx=True``
    uses ``percentile_approx`` (a bounded sketch per column) instead. A column
    without values has count 0 and NULL elsewhere. NaN counts as the largest
    value (the Spark form); ``skip_nan`` leaves it out (the pandas form).
    """
    cols = _numeric_columns(df, cols)
    if not cols:
        raise ValueError("no numeric columns")
    if skip_nan:
        xs = [(F.col(f"`{c}`").cast("double"), c) for c in cols]
        df = df.select(*[F.when(~F.isnan(x), x).alias(c) for x, c in xs])
    if approx:
        return _describe_approx(df, cols, accuracy)
    # one pass: moments, and the counts and sketches the quartile search starts from
    xs = [F.col(f"`{c}`").cast("double") for c in cols]
    row = df.agg(*_opening(xs, QUARTILES, _ACCURACY), *[a for i, x in enumerate(xs) for a in (
        F.avg(x).alias(f"a{i}"), F.stddev_samp(x).alias(f"s{i}"),
        F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"))]).first()
    entries = []
    for i, c in enumerate(cols):
        stats = [("count", float(row[f"n{i}"])), ("mean", row[f"a{i}"]), ("std", row[f"s{i}"]),
                 ("min", row[f"lo{i}"]), ("max", row[f"hi{i}"])]
        if row[f"n{i}"] == 0:  # no quartile row will follow
            stats += [(f"{int(q * 100)}%", None) for q in QUARTILES]
        for stat, v in stats:
            entries.append(F.struct(F.lit(c).alias("column_name"), F.lit(stat).alias("stat"),
                                    F.lit(v).cast("double").alias("value")))
    quart = _exact_quantiles(df, cols, QUARTILES, _ACCURACY, opened=row.asDict()).select(
        "column_name",
        F.concat((F.col("level") * 100).cast("int").cast("string"), F.lit("%")).alias("stat"),
        "value",
    )
    return df.sparkSession.range(1).select(F.inline(F.array(*entries))).unionByName(quart)


def _describe_approx(df: DataFrame, cols: Sequence[str], accuracy: int) -> DataFrame:
    long = _long_values(df, cols)
    moments = long.groupBy("column_name").agg(
        F.count(F.lit(1)).cast("double").alias("count"),
        F.avg("v").alias("mean"),
        F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
    )
    stacked = moments.selectExpr(
        "column_name",
        "stack(5, 'count', count, 'mean', mean, 'std', std, 'min', min, 'max', max) as (stat, value)",
    )
    q = long.groupBy("column_name").agg(
        F.percentile_approx("v", list(QUARTILES), accuracy).alias("_q")
    )
    quart = q.select(
        "column_name",
        F.posexplode("_q").alias("_i", "value"),
    ).select(
        "column_name",
        F.element_at(F.array(*[F.lit(f"{int(p * 100)}%") for p in QUARTILES]), F.col("_i") + 1).alias("stat"),
        "value",
    )
    every = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(s).alias("stat"),
                               F.lit(0.0 if s == "count" else None).cast("double").alias("_none"))
                      for c in cols for s in DESCRIBE_STATS])
    found = stacked.unionByName(quart)
    return (df.sparkSession.range(1).select(F.inline(every)).join(found, ["column_name", "stat"], "left")
            .select("column_name", "stat", F.coalesce("value", "_none").alias("value")))
