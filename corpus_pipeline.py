"""Training-data pipeline over ``documents``: five stages, each one operator.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and reread as the next stage's ``docs``. All but the last
return the columns of ``documents``.

1. quality: texts that the line field scores below 0.7 go.
2. near_duplicates: one document of each group (five-word shingles, similarity
   0.8 or more) stays, the one with the smallest id.
3. decontamination: documents with a benchmark window go.
4. secrets: findings are replaced by a mark; ``n_chars`` follows the new text.
5. packing: the texts are packed into sequences of 4,096 tokens.

Defined results of each stage, beside those of its operator:

* Null and empty texts: the quality field scores them like any other; near duplicates, decontamination
  and secrets keep them as they are (a null text stays null); packing gives them the end id alone.
* Repeated rows and ids: quality and decontamination judge row by row; of equal or near equal
  texts one row stays, also where they share an id or have none; texts without words all stay.
* Ties: the smallest id stays, null ids last, then the text seen first; packing keeps no given order.
* Very long texts are scored, compared, searched and packed whole, in slices.
* Empty tables give empty results. Extra columns are kept by all stages but the last; the
  operators work on names of their own, so an extra column may have any name but those of
  ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import decontam, neardup, packing, quality, secrets
from tillroll.llm.common import read_table, stage

THRESHOLD = 0.7


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit_quality(docs, read_table(spark, sf_dir, "labels"), threshold=THRESHOLD)
    scored = quality.score_quality(docs, model, out_col="_quality")
    return scored.filter(F.col("_quality") >= THRESHOLD).drop("_quality")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicate(docs, k=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"), action="document")


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.length("text").cast(kind))
    return clean.select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "ids")


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

#: the classifier and the tokenizer are beyond SQL; tests hold the run against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{name}")
    return docs
