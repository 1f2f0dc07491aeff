"""Relational tables over JDBC. Needs the database's driver on the class path when run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_options(url: str, table: str, user: str = "", password: str = "", fetch_size: int = 10_000,
                 partition_column: str | None = None, lower: int | None = None,
                 upper: int | None = None, partitions: int | None = None) -> dict[str, str]:
    """Options of a table read. With a partition column the table is read in parallel ranges."""
    options = {"url": url, "dbtable": table, "user": user, "password": password, "fetchsize": str(fetch_size)}
    if partition_column is not None:
        if lower is None or upper is None or partitions is None:
            raise ValueError("a partition column needs lower, upper and partitions")
        options |= {
            "partitionColumn": partition_column, "lowerBound": str(lower),
            "upperBound": str(upper), "numPartitions": str(partitions),
        }
    return options


def read(spark: SparkSession, url: str, table: str, single_task: bool = False, **kwargs) -> DataFrame:
    """A table as a DataFrame; filters and column lists are pushed to the database.

    Name a partition column, or say that the table is small enough for one task.
    """
    if kwargs.get("partition_column") is None and not single_task:
        raise ValueError("give a partition column with its range, or single_task=True for a small table")
    return spark.read.format("jdbc").options(**read_options(url, table, **kwargs)).load()


def users(table: DataFrame) -> DataFrame:
    """The four user columns needed for enrichment. Look users up by joining, not row by row."""
    return table.select("id", "gender", "user_level", "birthday")


def write_options(url: str, table: str, user: str = "", password: str = "",
                  batch_size: int = 1_000) -> dict[str, str]:
    return {"url": url, "dbtable": table, "user": user, "password": password, "batchsize": str(batch_size)}


def append(df: DataFrame, url: str, table: str, **kwargs) -> None:
    """Append rows in batches. Spark commits once per task, so a retried task may repeat rows:
    give the table a primary key or load it through a staging table."""
    df.write.format("jdbc").options(**write_options(url, table, **kwargs)).mode("append").save()
