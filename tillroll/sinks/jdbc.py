"""Database sink over JDBC with a staging table (used by the B12 job).

``truncate``+``overwrite`` on the live table is not transactional: a job that
fails half way leaves it half loaded. So the job checks keys, writes a staging
table and counts its rows (``plans.jobs.load_jdbc_staged``). Only then are the
statements of ``swap_sql`` given out, which replace the live table's contents
inside the database and are run by the caller's own database tooling.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from tillroll.sources.jdbc import jdbc_options


def write_jdbc(df: DataFrame, conn: Mapping[str, str], table: str, mode: str = "overwrite",
               num_partitions: int | None = None, batch_size: int = 10_000,
               column_types: str | None = None) -> None:
    """Write ``df`` with at most ``num_partitions`` parallel connections."""
    opts = jdbc_options(conn, table=table)
    opts.pop("fetchsize", None)
    opts["batchsize"] = str(batch_size)
    if mode == "overwrite":
        opts["truncate"] = "true"  # keep the table definition and grants
    if column_types:
        opts["createTableColumnTypes"] = column_types
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    df.write.format("jdbc").mode(mode).options(**opts).save()


def swap_sql(live: str, staging: str, columns: Sequence[str]) -> list[str]:
    """Statements that replace ``live`` with ``staging`` in one transaction;
    columns are matched by name."""
    if not columns:
        raise ValueError("no columns")
    names = ", ".join('"' + c.replace('"', '""') + '"' for c in columns)
    return [
        "BEGIN",
        f"DELETE FROM {live}",
        f"INSERT INTO {live} ({names}) SELECT {names} FROM {staging}",
        f"DROP TABLE {staging}",
        "COMMIT",
    ]
