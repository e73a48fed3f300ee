"""Nested documents: flatten (B2), explode arrays of structs (B3), unwrap an
envelope (B4), explode scalar arrays inner/outer (B5), presence of optional
fields (B6), and the inverse of explode, ``nest``.

All but ``nest`` are narrow (per-row) transformations. ``nest`` builds one
array per key and is written so that a key holding a large share of all
rows never becomes one array, one row or one task (see its docstring).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tillroll.session import DROP_SHUFFLES, settings
from tillroll.sinks import tables


def _q(name: str) -> str:
    return f"`{name}`"


# --------------------------------------------------------------------- B2
def flatten(df: DataFrame, sep: str = "_", max_depth: int | None = None) -> DataFrame:
    """Struct leaves become top-level columns named ``parent{sep}child``.

    Arrays (of anything) are left as they are; a NULL parent gives NULL
    leaves. Only the leaves used downstream are read from a parquet source
    (nested schema pruning).
    """
    cols: list[Column] = []
    seen: dict[str, list[str]] = {}

    def walk(path: list[str], dtype, depth: int):
        if isinstance(dtype, StructType) and (max_depth is None or depth < max_depth):
            for f in dtype.fields:
                walk(path + [f.name], f.dataType, depth + 1)
        else:
            ref = F.col(".".join(_q(p) for p in path))
            cols.append(ref.alias(sep.join(path)))
            seen.setdefault(sep.join(path).lower(), []).append(".".join(path))

    for f in df.schema.fields:
        walk([f.name], f.dataType, 0)
    _refuse_clashes(seen)
    return df.select(*cols)


def _refuse_clashes(seen: dict[str, list[str]]) -> None:
    """Raise if several sources would become one column name (letter case aside)."""
    clash = {n: p for n, p in seen.items() if len(p) > 1}
    if clash:
        raise ValueError(f"columns of one name: {clash}")


# --------------------------------------------------------------------- B3
def explode_rows(
    df: DataFrame,
    array: str,
    keys: Sequence[str],
    outer: bool = False,
    position: str | None = None,
    prefix: str = "",
) -> DataFrame:
    """One row per array element, parent ``keys`` kept.

    Struct elements are expanded into their fields (optionally prefixed);
    scalar elements keep the array's name. ``position`` adds the 0-based
    element index. ``outer`` keeps parents whose array is empty or NULL
    (one row with NULL element).
    """
    dtype = df.schema[array].dataType
    if not isinstance(dtype, ArrayType):
        raise ValueError(f"{array} is not an array")
    if position:
        fn = F.posexplode_outer if outer else F.posexplode
        exploded = df.select(*keys, fn(array).alias(position, "_el"))
        base = [*keys, position]
    else:
        fn = F.explode_outer if outer else F.explode
        exploded = df.select(*keys, fn(array).alias("_el"))
        base = list(keys)
    el = dtype.elementType
    if isinstance(el, StructType):
        fields = [F.col(f"_el.{_q(f.name)}").alias(f"{prefix}{f.name}") for f in el.fields]
        return exploded.select(*base, *fields)
    return exploded.select(*base, F.col("_el").alias(array))


# --------------------------------------------------------------------- B4
def unwrap(df: DataFrame, array: str, header_cols: Sequence[str], outer: bool = False) -> DataFrame:
    """Envelope -> one row per record, header values repeated on each row."""
    fn = F.inline_outer if outer else F.inline
    return df.select(*header_cols, fn(array))


# --------------------------------------------------------------------- B5
def explode_scalars(df: DataFrame, array: str, keys: Sequence[str], name: str, outer: bool = False) -> DataFrame:
    """Scalar array -> one row per value. Inner drops empty and NULL arrays;
    outer keeps one row with a NULL value for each of them."""
    fn = F.explode_outer if outer else F.explode
    return df.select(*keys, fn(array).alias(name))


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Frequency of each value; a frequent value is combined in every task
    before the shuffle (partial aggregation)."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name))


# --------------------------------------------------------------------- B6
def presence_report(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``(field, present, row_count)``: how many rows carry each (possibly
    nested, dotted) field. Spark cannot tell an absent key from an explicit
    null; both count as not present. One aggregate for all fields."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count(F.col(".".join(_q(p) for p in f.split(".")))).alias(f"_p{i}")
             for i, f in enumerate(fields)]
    counts = df.agg(*aggs)
    entries = F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f"_p{i}").cast("bigint").alias("present"))
        for i, f in enumerate(fields)
    ])
    return counts.select(F.inline(entries), F.col("_rows").cast("bigint").alias("row_count"))


# --------------------------------------------------------------------- nest
def _row_position(df: DataFrame) -> list[Column]:
    """File and row number of every row of a file source (hidden columns, the
    same when a task is run again)."""
    position = [F.col("_metadata.file_path"), F.col("_metadata.row_index")]
    try:
        df.select(*position)
    except AnalysisException as no_file:
        raise ValueError("rows without a file position: name the columns that tell copies apart "
                         "in spread (empty when no two rows of a key are alike)") from no_file
    return position


def nest(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    item_cols: Sequence[str] | None = None,
    max_items: int = 1000,
    chunk_col: str = "chunk",
    spread: Sequence[str | Column] | None = None,
    stage_heavy: bool = False,
) -> DataFrame:
    """Group rows into documents ``keys + chunk + name: array<struct<item_cols>>``.

    A key with at most ``max_items`` rows becomes one document (chunk 0).
    A bigger key is split into ``ceil(n / max_items)`` documents, to which its
    rows are dealt by a hash, so no array, row or task holds an unbounded
    group, whatever share of the data one key has. One lazy plan at every size:

    1. per-key row counts (partial aggregation, a hot key is one row per task),
       kept only for keys of more than ``max_items`` rows;
    2. rows are left-joined (null-safe) with those keys: adaptive execution
       broadcasts them when it measures them as small, else splits a hot key;
    3. rows are hash-partitioned by ``keys + chunk`` and collected per
       document; elements are sorted so the result does not depend on the
       order rows arrive in.

    The hash covers the items and ``spread``: columns that tell equal rows of a
    key apart and stay the same when a task is run again. By default these are
    the file position of a file source; for other sources name them, or pass
    an empty list when the rows of a key differ. A hashed document holds about
    ``max_items`` rows, and for bounds of 100 or more never twice as many.

    ``stage_heavy`` runs step 1 at once and keeps its keys in a file: if they are few, which
    is known before step 2 is planned, the rows are not shuffled to meet them.
    """
    keys = list(keys)
    items = [c for c in (item_cols or df.columns) if c not in keys]
    if not items:
        raise ValueError("nothing to nest")
    extra = _row_position(df) if spread is None else [F.col(_q(c)) if isinstance(c, str) else c for c in spread]
    # key copies get fresh names so the self-join cannot resolve ambiguously
    heavy = (
        df.groupBy(*[F.col(_q(k)).alias(f"_k{i}") for i, k in enumerate(keys)])
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > F.lit(max_items))
    )
    if stage_heavy:
        with settings(df.sparkSession, DROP_SHUFFLES):
            heavy = df.sparkSession.read.schema(heavy.schema).parquet(tables.stage(heavy, "heavy-keys"))
    rows = df.select(*[F.col(_q(k)) for k in keys], *[F.col(_q(c)) for c in items],
                     F.xxhash64(*[F.col(_q(c)) for c in items], *extra).alias("_h"))
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & rows[_q(k)].eqNullSafe(heavy[f"_k{i}"])
    n_chunks = F.coalesce(F.ceil(F.col("_n") / F.lit(max_items)), F.lit(1))
    keyed = rows.join(heavy, cond, "left").select(
        *[rows[_q(c)] for c in keys + items], F.pmod(F.col("_h"), n_chunks).cast("int").alias(chunk_col))
    return keyed.repartition(*keys, chunk_col).groupBy(*keys, chunk_col).agg(
        F.array_sort(F.collect_list(F.struct(*[F.col(_q(c)) for c in items]))).alias(name)
    )
