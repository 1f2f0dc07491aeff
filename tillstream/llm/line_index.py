"""Line dedup that can be undone: an index of the lines of documents with insertion and deletion.

The index has three tables in a folder that all executors share, cut into shards by key:

- ``refs``: which document holds which line (once per document),
- ``counts``: per line the number of documents and the smallest id among them,
- ``filters``: per shard a cuckoo filter of its lines.

An insertion asks the filters first. Lines they deny are new: their counts are written without
reading anything. Only lines that may be known are looked up in the exact tables. A deletion takes
a document's references back, counts the lines they belonged to anew from the references that are
left, and removes lines without any from the filters, so the index is as if the document had never
been inserted. Every step writes a version of its own and names it last, so a step that failed left
nothing that is read. Versions follow one another: one writer at a time, and only the newest can be
continued, while earlier ones stay readable. :meth:`LineIndex.compacted` merges all into one.

Keys are 128-bit hashes of the line without blanks (0x20, 0x09-0x0D) at its ends, A-Z in lower case;
lines with fewer than ``LEAST`` code points have none. A shard is laid out for a fixed number of distinct
lines, and lines are counted before they meet in a shard, so a very frequent line weighs no more there
than any other. Counts of a line are partial sums of map tasks.

Null and empty texts are one empty line. Documents with a null id are not indexed and keep all
lines. Rows with one id are one document: inserting it again adds the lines it does not have yet. Rows
keep their own lines, so repeated rows give repeated results. Columns other than doc_id and text are
left out, whatever their names; an empty table changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tillstream.llm import cuckoo
from tillstream.llm.scratch import fresh_path, save
from tillstream.llm.words import Batches, texts

BLANKS = b" \t\n\x0b\x0c\r"
LEAST = 10
SCHEMAS = {
    "refs": "shard int, key binary, doc_id bigint, held boolean",
    "counts": "shard int, key binary, docs bigint, low bigint",
    "filters": "shard int, cells binary",
    "meta": "base int, shards int",
}
#: Key pairs a task gives out at a time.
ROWS = 100_000


def key_of(line: bytes) -> bytes | None:
    """Key of a line, or none if it is too short."""
    line = line.strip(BLANKS).lower()
    if len(line) < LEAST or (len(line) < 4 * LEAST and len(line.decode()) < LEAST):
        return None
    return xxhash.xxh3_128_digest(line)


def line_keys(docs: DataFrame) -> DataFrame:
    """Per row the distinct keys of its lines: (key, doc_id). Rows without an id have none."""

    def flush(ids: list, counts: list, keys: list) -> pa.RecordBatch:
        owner = np.repeat(np.array(ids, np.int64), counts)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(owner)], ["key", "doc_id"])

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        ids, counts, keys = [], [], []
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                found = {key_of(line) for line in (text or b"").split(b"\n")} - {None}
                ids.append(doc_id)
                counts.append(len(found))
                keys.extend(found)
                if len(keys) >= ROWS:
                    yield flush(ids, counts, keys)
                    ids, counts, keys = [], [], []
        if keys:
            yield flush(ids, counts, keys)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    return rows.mapInArrow(run, "key binary, doc_id bigint")


def _numbers(keys: pa.ChunkedArray) -> np.ndarray:
    """The first 64 bits of keys."""
    return np.frombuffer(b"".join(keys.to_pylist()), np.uint64)[::2]


def _filters(keys: pa.Table, old: pa.Table) -> np.ndarray:
    return cuckoo.load(old.column("cells")[0].as_py() if old.num_rows else None)


def _with_filters(keys: DataFrame, filters: DataFrame, fn, schema: str) -> DataFrame:
    """Apply ``fn(key table, filter table)`` to every shard that has keys."""

    def run(mine: pa.Table, old: pa.Table) -> pa.Table:
        if not mine.num_rows:
            return pa.Table.from_batches([], pa.schema(wanted))
        return fn(mine, old)

    wanted = [("shard", pa.int32()), ("cells" if "cells" in schema else "key", pa.binary())]
    return keys.select("shard", "key").groupBy("shard").cogroup(filters.select("shard", "cells").groupBy("shard")).applyInArrow(
        run, schema)


def _probe(mine: pa.Table, old: pa.Table) -> pa.Table:
    """Keys the filter takes for present."""
    return mine.select(["shard", "key"]).filter(pa.array(cuckoo.contains(_filters(mine, old), _numbers(mine.column("key")))))


def _changed(change):
    def fn(mine: pa.Table, old: pa.Table) -> pa.Table:
        tables = change(_filters(mine, old), _numbers(mine.column("key")))
        return pa.table({"shard": mine.column("shard")[:1], "cells": pa.array([tables.tobytes()], pa.binary())})

    return fn


@dataclass(frozen=True)
class LineIndex:
    """One version of an index; operations return the next one.

    ``shards`` is 0 until the first insertion, which sets it by the number of its lines; beyond
    ``cuckoo.KEYS`` lines a shard's filter grows by further tables.
    """

    spark: SparkSession
    path: str
    version: int = 0
    base: int = 0
    shards: int = 0

    @staticmethod
    def create(spark: SparkSession, path: str | None = None) -> LineIndex:
        """An empty index, by default in a fresh folder of the session's shared one."""
        return LineIndex(spark, path or fresh_path(spark, "lines"))

    @staticmethod
    def open(spark: SparkSession, path: str) -> LineIndex:
        """The newest version that was written to the end."""
        try:
            rows = spark.read.schema(f"{SCHEMAS['meta']}, v int").parquet(f"{path}/meta")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return LineIndex(spark, path)
        last = rows.agg(F.max_by(F.struct("v", "base", "shards"), "v").alias("m")).first().m
        return LineIndex(spark, path, *last)

    # --- reading ---------------------------------------------------------------------------

    def _all(self, name: str) -> DataFrame:
        if not self.version:
            return self.spark.createDataFrame([], f"{SCHEMAS[name]}, v int")
        rows = self.spark.read.schema(f"{SCHEMAS[name]}, v int").parquet(f"{self.path}/{name}")
        return rows.where(F.col("v").between(self.base, self.version))

    def _newest(self, rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
        """Of each key the row of its newest version; one version alone has each key once."""
        if self.base == self.version:
            return rows.drop("v")
        return rows.groupBy(*keys).agg(*[F.max_by(c, "v").alias(c) for c in values])

    def refs(self, keys: DataFrame | None = None) -> DataFrame:
        """Which document holds which line, of the given keys or of all: (shard, key, doc_id)."""
        rows = self._all("refs") if keys is None else self._all("refs").join(keys.select("key"), "key", "left_semi")
        held = self._newest(rows, ["shard", "key", "doc_id"], ["held"]).where("held")
        return held.select("shard", "key", "doc_id")

    def counts(self, keys: DataFrame | None = None) -> DataFrame:
        """Documents and smallest id of the given keys or of all: (shard, key, docs, low)."""
        rows = self._all("counts") if keys is None else self._all("counts").join(keys.select("key"), "key", "left_semi")
        return self._newest(rows, ["shard", "key"], ["docs", "low"]).where("docs > 0").select("shard", "key", "docs", "low")

    def filters(self) -> DataFrame:
        return self._newest(self._all("filters"), ["shard"], ["cells"])

    # --- writing ---------------------------------------------------------------------------

    def _check(self) -> None:
        newest = LineIndex.open(self.spark, self.path).version
        if newest != self.version:
            raise ValueError(f"version {self.version} was followed by {newest}")

    def _write(self, name: str, version: int, rows: DataFrame) -> None:
        kinds = T.StructType.fromDDL(SCHEMAS[name])
        rows.select([F.col(f.name).cast(f.dataType) for f in kinds]).write.mode("overwrite").parquet(f"{self.path}/{name}/v={version}")

    def _next(self, refs: DataFrame, counts: DataFrame, filters: DataFrame, shards: int, base: int | None = None) -> LineIndex:
        version = self.version + 1
        for name, rows in (("refs", refs), ("counts", counts), ("filters", filters)):
            self._write(name, version, rows)
        base = base or self.base or version
        self._write("meta", version, self.spark.createDataFrame([(base, shards)], SCHEMAS["meta"]))
        return replace(self, version=version, base=base, shards=shards)

    def _sharded(self, rows: DataFrame, shards: int) -> DataFrame:
        return rows.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))

    def insert(self, docs: DataFrame) -> LineIndex:
        """The index with further documents (doc_id, text)."""
        self._check()
        pairs = save(line_keys(docs).distinct(), "pairs")

        def counted(rows: DataFrame) -> DataFrame:
            return rows.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("low"))

        if not self.shards:
            keys = save(counted(pairs), "keys")
            shards = -(-keys.count() // cuckoo.KEYS) or 1
            keys = self._sharded(keys, shards)
            filters = _with_filters(keys, self.filters(), _changed(cuckoo.add), SCHEMAS["filters"])
            return self._next(self._sharded(pairs, shards).withColumn("held", F.lit(True)), keys, filters, shards)
        asked = self._sharded(pairs.select("key").distinct(), self.shards)
        maybe = save(_with_filters(asked, self.filters(), _probe, "shard int, key binary"), "maybe")
        fresh = save(pairs.join(self.refs(maybe).select("key", "doc_id"), ["key", "doc_id"], "left_anti"), "fresh")
        old = self.counts(maybe).select("key", F.col("docs").alias("old_docs"), F.col("low").alias("old_low"))
        keys = save(self._sharded(counted(fresh), self.shards).join(old, "key", "left"), "keys")
        filters = _with_filters(keys.where("old_docs is null"), self.filters(), _changed(cuckoo.add), SCHEMAS["filters"])
        merged = keys.select(
            "shard", "key", (F.col("docs") + F.coalesce("old_docs", F.lit(0))).alias("docs"), F.least("low", "old_low").alias("low"))
        return self._next(self._sharded(fresh, self.shards).withColumn("held", F.lit(True)), merged, filters, self.shards)

    def delete(self, ids: DataFrame) -> LineIndex:
        """The index without the documents of these ids (doc_id); unknown ids change nothing."""
        self._check()
        ids = ids.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
        gone = save(self.refs().join(ids, "doc_id", "left_semi").select("shard", "key", "doc_id"), "gone")
        keys = gone.select("shard", "key").distinct()
        left = self.refs(keys).join(gone.select("key", "doc_id"), ["key", "doc_id"], "left_anti")
        left = left.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("low"))
        counts = save(keys.join(left, "key", "left").select(
            "shard", "key", F.coalesce("docs", F.lit(0)).alias("docs"), "low"), "counts")
        filters = _with_filters(counts.where("docs = 0"), self.filters(), _changed(cuckoo.remove), SCHEMAS["filters"])
        return self._next(gone.withColumn("held", F.lit(False)), counts, filters, self.shards)

    def compacted(self) -> LineIndex:
        """The same index as a single version."""
        self._check()
        if self.base == self.version:
            return self
        refs = self.refs().withColumn("held", F.lit(True))
        return self._next(refs, self.counts(), self.filters(), self.shards, base=self.version + 1)

    # --- use -------------------------------------------------------------------------------

    def seen(self, docs: DataFrame) -> DataFrame:
        """Lines of other documents that the index knows: (key, doc_id, docs, low).

        The filters rule out most lines before the counts are read.
        """
        pairs = line_keys(docs).distinct()
        if not self.shards:
            return pairs.join(self.counts(), "key").select("key", "doc_id", "docs", "low")
        pairs = save(pairs, "pairs")
        asked = self._sharded(pairs.select("key").distinct(), self.shards)
        maybe = save(_with_filters(asked, self.filters(), _probe, "shard int, key binary"), "maybe")
        return pairs.join(self.counts(maybe), "key").select("key", "doc_id", "docs", "low")

    def cleaned(self, docs: DataFrame) -> DataFrame:
        """Indexed documents without the lines that a document with a smaller id holds.

        Per row: doc_id, n_lines, n_dropped and the kept lines as ``text``.
        """
        shared = self.counts().where("docs > 1").select("key", "low")
        dropped = self.refs().join(shared, "key").where("doc_id > low").groupBy("doc_id").agg(F.collect_list("key").alias("dropped"))

        def run(batches: Batches) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes, struck, kept = [], [], []
                for text, gone in zip(texts(batch), batch.column("dropped").to_pylist()):
                    lines = (text or b"").split(b"\n")
                    left = lines
                    if gone:
                        gone = set(gone)
                        left = [line for line in lines if key_of(line) not in gone]
                    sizes.append(len(lines))
                    struck.append(len(lines) - len(left))
                    kept.append(b"\n".join(left))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(struck, pa.int64()),
                     pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_lines", "n_dropped", "text"])

        schema = T.StructType([
            docs.schema["doc_id"], T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()),
            T.StructField("text", T.StringType())])
        return docs.select("doc_id", "text").join(dropped, "doc_id", "left").mapInArrow(run, schema)
