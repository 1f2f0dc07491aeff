"""Intermediate tables in the folder that driver and executors share.

A table written there cuts the lineage and survives the loss of an executor. The folder is the
one the session names in ``spark.checkpoint.dir``; where that is unset, one beside the warehouse.
The files of one run may be deleted as soon as its result has been written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    return (root or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints").rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table and read it back."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
