"""Kafka as source and sink. Needs Spark's Kafka connector on the class path when run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamReader, DataStreamWriter


def reader_options(servers: str, topic: str, starting: str = "latest",
                   max_per_trigger: int | None = None) -> dict[str, str]:
    """Options of a subscription to one topic. Offsets are kept in the query's checkpoint."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "true",
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def reader(spark: SparkSession, servers: str, topic: str, **kwargs) -> DataStreamReader:
    return spark.readStream.format("kafka").options(**reader_options(servers, topic, **kwargs))


def lines(records: DataFrame) -> DataFrame:
    """Broker records to the text value and its arrival time at the broker."""
    return records.select(
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("arrival"),
    )


def stream(spark: SparkSession, servers: str, topic: str, **kwargs) -> DataFrame:
    return lines(reader(spark, servers, topic, **kwargs).load())


def records(df: DataFrame, topic: str | None = None) -> DataFrame:
    """Rows as unkeyed broker records; the topic comes from a column unless one is given."""
    target = F.col("topic") if topic is None else F.lit(topic)
    return df.select(target.cast("string").alias("topic"), F.col("value").cast("string").alias("value"))


def writer(df: DataFrame, servers: str, checkpoint: str, topic: str | None = None) -> DataStreamWriter:
    return (
        records(df, topic).writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
    )
