"""Folder streams and the daily log landing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from tillstream.functions import day_of


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType | None = None,
                 files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table as a stream. A file stream reads folders, so one file is picked by name."""
    schema = table(spark, folder, name).schema if schema is None else schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}*.parquet")
    if files_per_trigger is not None:
        stream = stream.option("maxFilesPerTrigger", files_per_trigger)
    return stream.parquet(folder)


def line_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Text lines arriving in a folder."""
    stream = spark.readStream.format("text")
    if files_per_trigger is not None:
        stream = stream.option("maxFilesPerTrigger", files_per_trigger)
    return stream.load(folder)


def land_lines(lines: DataFrame, path: str, checkpoint: str, ts_ms: str = "ts") -> DataStreamWriter:
    """Append stamped log lines below one folder per day."""
    dated = lines.withColumn("log_date", day_of(F.timestamp_millis(F.col(ts_ms)))).select("value", "log_date")
    return (
        dated.writeStream.format("text").partitionBy("log_date")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
