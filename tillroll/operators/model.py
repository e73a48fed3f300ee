"""Lookup joins along declared keys.

A reference with a nullable foreign key is a left join (the row survives
without its parent); a NOT NULL reference is an inner join. When primary and
foreign keys hold, either keeps the fact table's row count.

Join strategy is left to the planner: with adaptive execution a dimension
whose runtime size is under ``spark.sql.autoBroadcastJoinThreshold`` is
broadcast, anything larger is a sort-merge join, and skewed partitions are
split. Nothing is counted or read back to choose: building a join runs no job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str] | tuple[str, str],
    required: bool,
    dim_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Attach dimension columns to ``df``.

    ``on`` is a shared column name, a list of shared names, or a pair
    ``(fk_in_df, pk_in_dim)``. ``required`` -> inner join, else left join.
    Only ``dim_cols`` (default: all) of the dimension are carried, so the
    dimension scan is pruned to the key plus those columns.
    """
    how = "inner" if required else "left"
    if isinstance(on, tuple) and len(on) == 2:
        fk, pk = on
        keep = [pk] + [c for c in (dim_cols or dim.columns) if c != pk]
        d = dim.select(*keep)
        return df.join(d, df[fk] == d[pk], how).drop(d[pk])
    keys = [on] if isinstance(on, str) else list(on)
    keep = keys + [c for c in (dim_cols or dim.columns) if c not in keys]
    d = dim.select(*keep)
    return df.join(d, keys, how)
