"""Small text files in whatever store the session's paths name: the records beside a written table."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, path: str) -> list[str]:
    """Visible files and folders directly below a folder; none if it does not exist."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(where)) if not n.startswith("."))


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a file, or none if it is gone."""
    fs, where = _at(spark, path)
    try:
        stream = fs.open(where)
    except Py4JJavaError as e:
        if "FileNotFoundException" in str(e.java_exception):
            return None
        raise
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file; it appears under its name only when it is complete."""
    folder, name = path.rsplit("/", 1)
    fs, part = _at(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = fs.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not fs.rename(part, _at(spark, path)[1]):
        raise OSError(f"{path} could not be written")


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)
