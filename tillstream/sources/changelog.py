"""Decoded database change records: ``{"table": ..., "op": ..., "after": {...}}`` per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream import schemas
from tillstream.operators import ingest


def changes(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Text lines to change records; the others are given by ``ingest.rejected``."""
    rows = ingest.good_rows(ingest.decode(lines, schemas.CHANGE_LOG, keep=keep))
    return rows.where(F.col("table").isNotNull() & F.col("op").isNotNull())


def stream(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """Change files arriving in a folder; the trigger replaces the polling loop."""
    return (
        spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(path)
        .select("value", F.current_timestamp().alias("arrival"))
    )


def topic_records(lines: DataFrame, topics=None) -> DataFrame:
    """Change lines to ``(topic, value)`` records for the three topics."""
    routed = ingest.route_changes(changes(lines), *([topics] if topics else []))
    return ingest.after_image(routed)
