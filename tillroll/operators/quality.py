"""Integrity rules as validation jobs (A17-A21) and the object check.

The reference declares these as table constraints that a database enforces
at insert time. Here they run as Spark jobs over whole tables and return
either a summary ``(table, rule, column_name, violations)`` or the offending
rows, so bad rows can be quarantined instead of failing the load.

Cost model:

* row rules (not-null, length, numeric range) for one table are evaluated
  together in **one** scan and one partial/final aggregate;
* key rules (primary key, unique) are one grouped count each; partial
  aggregation makes a hot key one row per task before the shuffle;
* foreign keys: one anti join of the child rows with the parent keys, the
  same plan at every size; adaptive execution broadcasts parent keys it
  measures as small and splits a hot foreign key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.money import MONEY_LIMIT

REPORT_COLUMNS = ("table_name", "rule", "column_name", "violations")


# ----------------------------------------------------------- row rules
@dataclass(frozen=True)
class RowRule:
    """A predicate that is TRUE on a violating row (never NULL)."""

    rule: str
    column: str
    violated: Column


def not_null_rules(cols: Sequence[str]) -> list[RowRule]:
    """One rule per column declared NOT NULL."""
    return [RowRule("not_null", c, F.col(c).isNull()) for c in cols]


def max_length_rule(column: str, n: int) -> RowRule:
    """``VARCHAR(n)``; length counts characters, not bytes."""
    c = F.col(column)
    return RowRule(f"max_length_{n}", column, F.coalesce(F.length(c) > n, F.lit(False)))


def decimal_fits_rule(column: str | Column, name: str, precision: int = 10, scale: int = 2) -> RowRule:
    """The value does not fit ``NUMERIC(precision, scale)`` after rounding."""
    c = F.col(column) if isinstance(column, str) else column
    fits = c.try_cast(f"decimal({precision},{scale})")
    return RowRule(f"numeric_{precision}_{scale}", name, c.isNotNull() & fits.isNull())


def money_range_rule(column: str) -> RowRule:
    """|value| >= 10^8 is out of range for the shop's money type."""
    c = F.col(column)
    return RowRule("money_range", column, F.coalesce(F.abs(c) >= MONEY_LIMIT, F.lit(False)))


def line_rules(fields: Sequence[tuple[str, str]]) -> list[RowRule]:
    """Rules for lines read by ``parse_delimited(checked=True)``: the text of every
    field is of its type, and the line has as many fields as there should be."""
    typed = [RowRule("bad_type", name, F.array_contains("bad_types", name)) for name, _ in fields]
    return [*typed, RowRule("field_count", "line", F.col("n_fields") != len(fields))]


def row_rule_report(df: DataFrame, table: str, rules: Sequence[RowRule]) -> DataFrame:
    """Violation count per rule, all rules in one scan and one aggregate."""
    if not rules:
        raise ValueError("no rules")
    counts = df.agg(*[
        F.sum(F.when(r.violated, 1).otherwise(0)).cast("bigint").alias(f"_v{i}")
        for i, r in enumerate(rules)
    ])
    entries = F.array(*[
        F.struct(F.lit(r.rule).alias("rule"), F.lit(r.column).alias("column_name"),
                 F.coalesce(F.col(f"_v{i}"), F.lit(0).cast("bigint")).alias("violations"))
        for i, r in enumerate(rules)
    ])
    return counts.select(F.lit(table).alias("table_name"), F.inline(entries))


def annotate_violations(df: DataFrame, rules: Sequence[RowRule], name: str = "violations") -> DataFrame:
    """Add an array of the rule names each row breaks (empty when clean)."""
    names = F.array(*[F.when(r.violated, F.lit(f"{r.rule}:{r.column}")) for r in rules])
    return df.withColumn(name, F.filter(names, lambda x: x.isNotNull()))


def split_valid(df: DataFrame, rules: Sequence[RowRule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their broken rules), one annotation
    shared by both outputs."""
    marked = annotate_violations(df, rules, "_violations")
    valid = marked.filter(F.size("_violations") == 0).drop("_violations")
    quarantined = marked.filter(F.size("_violations") > 0).withColumnRenamed("_violations", "violations")
    return valid, quarantined


def offending_rows(df: DataFrame, rules: Sequence[RowRule], keys: Sequence[str]) -> DataFrame:
    """``keys + (rule, column_name)`` for every broken rule of every row, one
    scan (no union of per-rule filters)."""
    hits = F.array(*[
        F.when(r.violated, F.struct(F.lit(r.rule).alias("rule"), F.lit(r.column).alias("column_name")))
        for r in rules
    ])
    return df.select(*keys, F.inline(F.filter(hits, lambda x: x.isNotNull())))


# ----------------------------------------------------------- key rules
def _any_null(keys: Sequence[str]) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


def key_violations(df: DataFrame, keys: Sequence[str], primary: bool = True) -> DataFrame:
    """Key groups that break the rule, with their row count ``n``.

    Primary key: a group breaks it when it has more than one row **or** any
    key column is NULL. Unique: NULL keys never collide and are ignored.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("no key columns")
    src = df.select(*keys)
    if not primary:
        src = src.filter(~_any_null(keys))
    groups = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    bad = F.col("n") > 1
    if primary:
        bad = bad | _any_null(keys)
    return groups.filter(bad)


def check_primary_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return key_violations(df, keys, primary=True)


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return key_violations(df, keys, primary=False)


def key_report(df: DataFrame, table: str, keys: Sequence[str], primary: bool = True) -> DataFrame:
    """Summary row: number of rows that take part in a violation."""
    bad = key_violations(df, keys, primary)
    return bad.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(table).alias("table_name"),
        F.lit("primary_key" if primary else "unique").alias("rule"),
        F.lit(",".join(keys)).alias("column_name"),
        "violations",
    )


# ----------------------------------------------------------- A20
def check_foreign_key(
    child: DataFrame, parent: DataFrame, child_cols: Sequence[str], parent_cols: Sequence[str],
) -> DataFrame:
    """Child rows whose (non-NULL) foreign key has no parent row.

    A NULL in any foreign-key column passes (nullable reference). The whole
    child row is returned so it can be quarantined.

    The child is scanned once; of the parent only its key columns are read.
    """
    child_cols, parent_cols = list(child_cols), list(parent_cols)
    if len(child_cols) != len(parent_cols):
        raise ValueError("key arity differs")
    keyed = child.filter(~_any_null(child_cols))
    p = parent.select(*[F.col(pc).alias(f"_pk{i}") for i, pc in enumerate(parent_cols)])
    cond = F.lit(True)
    for i, cc in enumerate(child_cols):
        cond = cond & (keyed[cc] == p[f"_pk{i}"])
    return keyed.join(p, cond, "left_anti")


# ----------------------------------------------------------- A13
def missing_objects(expected: DataFrame, listing: DataFrame, name_col: str = "name") -> DataFrame:
    """Expected names absent from the listing; a non-empty result is an error."""
    present = listing.select(F.col(name_col).alias("_present"))
    return expected.join(present, expected[name_col] == present["_present"], "left_anti")


def assert_empty(df: DataFrame, what: str) -> None:
    """Raise if ``df`` has a row. Reads at most one row."""
    first = df.limit(1).collect()
    if first:
        raise AssertionError(f"{what}: e.g. {first[0].asDict()}")
