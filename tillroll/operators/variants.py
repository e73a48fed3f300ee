"""Documents as VARIANT values: a field that is absent is not a field that is null.

A struct schema reads both as NULL. A variant keeps the document: a path that leads
nowhere gives no value, a path to ``null`` gives the variant null. The schema of all
documents is found in one aggregation, without a second read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ABSENT, NULL, PRESENT, MALFORMED = "absent", "null", "present", "malformed"


def to_variant(df: DataFrame, text: str, name: str = "document") -> DataFrame:
    """``df`` with the JSON text parsed as a variant; NULL where it is none."""
    return df.withColumn(name, F.try_parse_json(F.col(text)))


def state(document: str, path: str) -> Column:
    """absent, null or present; malformed for a row without a document."""
    value = F.try_variant_get(F.col(document), path, "variant")
    return (F.when(F.col(document).isNull(), MALFORMED).when(value.isNull(), ABSENT)
            .when(F.is_variant_null(value), NULL).otherwise(PRESENT))


def field_states(df: DataFrame, document: str, paths: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, path, state, n): how many documents have each field absent, null or present. One pass."""
    states = F.array(*[F.struct(F.lit(p).alias("path"), state(document, p).alias("state")) for p in paths])
    return df.select(*by, F.inline(states)).groupBy(*by, "path", "state").agg(F.count(F.lit(1)).alias("n"))


def fields(df: DataFrame, document: str, wanted: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``df`` with typed columns ``{name: (path, type)}``; NULL where the field is
    absent, null or of another type."""
    return df.withColumns({n: F.try_variant_get(F.col(document), p, t) for n, (p, t) in wanted.items()})


def document_schema(df: DataFrame, document: str, by: Sequence[str] = ()) -> DataFrame:
    """The merged schema of all documents, as text."""
    return df.groupBy(*by).agg(F.schema_of_variant_agg(F.col(document)).alias("document_schema"))
