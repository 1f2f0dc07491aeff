"""The corpus pipeline: documents through five stages, each written as Parquet and read again.

A stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; all but the last
return the columns of ``documents``. Intermediate tables lie in the shared folder of the session.
Null and empty texts pass every filter but the quality stage, which judges them like any text, and
are nothing to mix; an empty table stays empty; repeated rows of one document end in the second
stage; further columns are carried to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.llm import decontaminate, fragment_join, mixing, secrets_ledger, subword_quality
from tillstream.llm.scratch import save


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return subword_quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five-word shingles, similarity 0.8."""
    return fragment_join.keep_one(docs, n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    held = decontaminate.leaks(docs, _table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(held, "doc_id", "left_anti").select(docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in place; the length of a masked text follows."""
    found, _, _ = secrets_ledger.scan(docs, "doc_id")
    rows = found.select("row.*", F.col("found").alias("_found"))
    masked = {"text": secrets_ledger.masked("text", "_found")}
    if "n_chars" in docs.columns:
        masked["n_chars"] = F.when(F.size("_found") > 0, F.length(masked["text"]).cast("long")).otherwise(F.col("n_chars"))
    return rows.withColumns(masked).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words the mix takes of each document, for those of which it takes any."""
    return mixing.mix(docs).where("taken > 0")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mix", mix),
]
#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
