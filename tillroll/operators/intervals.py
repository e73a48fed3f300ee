"""Points in time joined to the periods that hold them, as an equi-join.

A period of length d goes to the level whose buckets are just longer than d, and
lies in two of its buckets at most: those are its copies. A point has one bucket on
each level in use (40 at most). Points and periods of one key meet in equal buckets,
and the bounds decide. Exactly one copy of a period holds a point inside it, so no
pair comes twice, and a hot key is spread over its buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_FINEST, _COARSEST = 20, 62  # levels, as powers of two of microseconds


def interval_join(points: DataFrame, periods: DataFrame, keys: Sequence[str], at: str, start: str, end: str) -> DataFrame:
    """Columns of ``points``, then those of ``periods`` but the keys, for every pair
    with equal keys and ``start <= at <= end``. NULL bounds, times or keys match nothing, nor
    does a period that ends before it starts. Other column names must differ."""
    clash = set(points.columns) & set(periods.columns) - set(keys)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    length = micros(end) - micros(start)
    level = F.greatest(F.lit(_FINEST), F.ceil(F.log2(length + F.lit(1))).cast("int") + F.lit(1))
    held = periods.filter(F.col(start) <= F.col(end)).withColumn("_level", F.least(level, F.lit(_COARSEST)))
    levels = [r[0] for r in held.select("_level").distinct().collect()]  # 43 at most
    bucket = lambda x: F.expr(f"shiftright(unix_micros(cast(`{x}` as timestamp)), _level)")
    held = held.withColumn("_bucket", F.explode(F.sequence(bucket(start), bucket(end))))
    placed = points.withColumn("_level", F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>")))
    placed = placed.withColumn("_bucket", bucket(at))
    joined = placed.join(held, [*keys, "_level", "_bucket"])
    rest = [c for c in periods.columns if c not in keys]
    return joined.filter(F.col(at).between(F.col(start), F.col(end))).select(*points.columns, *rest)
