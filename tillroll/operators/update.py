"""Batch update that stamps the modification time of every matched row.

Rules (the reference does this with a BEFORE UPDATE row trigger):

1. every matched row gets the stamp, even if no value changed;
2. a stamp supplied by the caller is overwritten;
3. the creation time is never touched (it is not an update column);
4. update rows without a target row insert nothing;
5. a match flag, not ``coalesce``, decides, so updating a value *to* NULL works;
6. one stamp per batch (``now`` is a literal or ``current_timestamp()``,
   which is constant within a query);
7. duplicate keys in the batch fail the job (the winner would be arbitrary);
8. unmatched target rows keep their old stamp.

Plan, the same at every size: the batch is grouped by key once (this is also
the duplicate check, raised through ``raise_error``) and that grouping's hash
partitioning is reused by the join, so the batch is shuffled once; adaptive
execution broadcasts a batch it measures as small. The joined rows are filtered
on the batch's row count, so the check runs whichever columns an action reads. The result is a new
DataFrame; the caller writes it beside the old table and swaps
(``sinks.tables.replace_table``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def update_rows(
    target: DataFrame,
    updates: DataFrame,
    key: str | Sequence[str],
    stamp_col: str,
    now: Column,
    protected: Sequence[str] = (),
) -> DataFrame:
    """``target`` with the batch applied and matched rows stamped (rules above)."""
    keys = [key] if isinstance(key, str) else list(key)
    for k in keys:
        if k not in updates.columns or k not in target.columns:
            raise ValueError(f"key {k} missing")
    if stamp_col not in target.columns:
        raise ValueError(f"stamp column {stamp_col} missing from target")
    # columns the batch may change: present in both, not key, stamp or protected
    blocked = set(keys) | {stamp_col} | set(protected)
    unknown = [c for c in updates.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"update columns not in target: {unknown}")
    cols = [c for c in updates.columns if c not in blocked]

    batch = updates.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.first(c, ignorenulls=False).alias(f"_u_{c}") for c in cols],
    )
    dup_msg = F.concat(F.lit("duplicate key in update batch: "),
                       F.to_json(F.struct(*[F.col(k) for k in keys])))
    unique = F.when(F.col("_n") > 1, F.raise_error(dup_msg).cast("boolean")).otherwise(F.lit(True))
    batch = batch.filter(unique)
    # reading _n above the join keeps the batch in the plan of any projection
    joined = target.join(batch, keys, "left").filter(F.col("_n").isNull() | (F.col("_n") == 1))
    matched = F.col("_n").isNotNull()
    out = []
    for f in target.schema.fields:
        c = f.name
        if c in keys:
            out.append(F.col(c))
        elif c == stamp_col:
            out.append(F.when(matched, now.cast(f.dataType)).otherwise(F.col(c)).alias(c))
        elif c in cols:
            out.append(F.when(matched, F.col(f"_u_{c}").cast(f.dataType)).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)
