"""Keyed upsert into a partitioned parquet table that merges itself and lets readers pin a version.

A micro-batch writes a folder of its own and then a record that names it; rows become visible
with the record. When ``fan`` folders of one level have gathered, they are merged into one folder of the
next level with the chosen row per key, and the new record names those it replaces. So there are
at most ``fan`` folders per level, each row is rewritten once per level, and the number of levels
grows with the logarithm of the number of batches.

A reader takes the records once and reads the folders they name, so it sees one version, whatever is
written or merged meanwhile. Replaced folders are deleted ``retain`` seconds after their
merge. Writers need no lock: a folder is named by the writer's own id, a batch whose record is there
is not written again, and two merges of the same folders only repeat rows that readers pick from.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tillstream.operators.dedup import first_per_key, latest_by_key
from tillstream.streaming import store

FOLDER, LOG = "_folder", "_log"
#: Columns kept with every row: which batch of which writer wrote it. Later writers have later epochs.
WRITTEN = ("_epoch", "_batch", "_writer")


@dataclass(frozen=True)
class Record:
    """A folder of the table.

    ``parts`` are the partition folders in it, ``batches`` the epoch and last batch of each writer whose
    rows it holds, ``replaces`` the folders it was merged from.
    """

    name: str
    level: int
    parts: list[str]
    batches: dict[str, list[int]]
    replaces: list[str] = field(default_factory=list)
    at: float = 0.0


def _later(maps: list[dict[str, list[int]]]) -> dict[str, list[int]]:
    """Epoch and last batch of each writer over several folders."""
    out: dict[str, list[int]] = {}
    for positions in maps:
        for writer, (epoch, batch) in positions.items():
            known = out.get(writer, [epoch, batch])
            out[writer] = [epoch, max(batch, known[1])]
    return out


@dataclass(frozen=True)
class KeyedTable:
    """``order`` columns decide which row of a key is newest inside one batch.

    Batches are numbered from 0 again under each new checkpoint, so each streaming query writes as a
    ``writer`` of its own. Of rows with one key the one written last counts; with ``earliest`` the
    table keeps the first row by ``order`` instead, whenever it was written. A writer's epoch is that of
    its first batch, unless it is given; rows of a higher epoch count as written later.
    """

    path: str
    keys: tuple[str, ...]
    day: str
    order: tuple[str, ...] = ()
    earliest: bool = False
    writer: str = "direct"
    epoch: int | None = None
    fan: int = 16
    retain: float = 3600.0

    def of_writer(self, writer: str) -> KeyedTable:
        """This table as written by ``writer``, the id of a streaming query."""
        return replace(self, writer=writer)

    # --- records ---------------------------------------------------------------------------

    def _all_records(self, spark: SparkSession) -> dict[str, Record]:
        found = {}
        for name in store.names(spark, f"{self.path}/{LOG}"):
            text = store.read_text(spark, f"{self.path}/{LOG}/{name}")
            if text is not None:  # else it was replaced long ago and deleted just now
                found[name] = Record(**json.loads(text))
        return found

    def version(self, spark: SparkSession) -> list[Record]:
        """The folders that make up the table now. Pass it to :meth:`read` to keep reading these."""
        found = self._all_records(spark)
        gone = {name for r in found.values() for name in r.replaces}
        return [r for name, r in sorted(found.items()) if name not in gone]

    def _commit(self, spark: SparkSession, record: Record) -> None:
        parts = [n for n in store.names(spark, self._folder(record.name)) if n.startswith(f"{self.day}=")]
        done = replace(record, parts=parts, at=time.time())
        store.write_text(spark, f"{self.path}/{LOG}/{record.name}", json.dumps(asdict(done)))

    def _folder(self, name: str) -> str:
        return f"{self.path}/{FOLDER}={name}"

    # --- writing ---------------------------------------------------------------------------

    def _pick(self, df: DataFrame, order: list[str]) -> DataFrame:
        keys, chosen = [self.day, *self.keys], list(self.order or self.keys)
        return first_per_key(df, keys, chosen) if self.earliest else latest_by_key(df, keys, order or chosen)

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        """Write one micro-batch; one that was written to the end before changes nothing.

        Usable in ``foreachBatch``.
        """
        spark, batch_id = df.sparkSession, int(batch_id)
        known = _later([r.batches for r in self.version(spark)])
        new = max([e for e, _ in known.values()], default=-1) + 1 if self.epoch is None else self.epoch
        epoch, last = known.get(self.writer, [new, -1])
        if batch_id <= last:
            return
        name = f"b-{self.writer}-{batch_id}"
        (
            self._pick(df, []).withColumns(dict(zip(WRITTEN, (
                F.lit(epoch), F.lit(batch_id).cast("bigint"), F.lit(self.writer)))))
            .write.mode("overwrite").partitionBy(self.day).parquet(self._folder(name))
        )
        self._commit(spark, Record(name, 0, [], {self.writer: [epoch, batch_id]}))
        self.merge(spark, df.schema)

    def merge(self, spark: SparkSession, schema: T.StructType) -> None:
        """Merge every level that is full, and delete what was replaced long enough ago."""
        level, merged = 0, False
        while len(group := [r for r in self.version(spark) if r.level == level]) >= self.fan:
            name = f"m{level + 1}-{uuid.uuid4().hex}"
            rows = self._pick(self._rows(spark, schema, group, None), list(WRITTEN)).drop(FOLDER)
            (
                rows.hint("rebalance", F.col(self.day)).sortWithinPartitions(self.day, *self.keys)
                .write.mode("overwrite").partitionBy(self.day).parquet(self._folder(name))
            )
            # What its parts have replaced must stay replaced for as long as records of it are there.
            left = set(store.names(spark, f"{self.path}/{LOG}"))
            replaced = [r.name for r in group] + [n for r in group for n in r.replaces if n in left]
            self._commit(spark, Record(name, level + 1, [], _later([r.batches for r in group]), replaced))
            level, merged = level + 1, True
        if merged:
            self.clean(spark)

    def clean(self, spark: SparkSession) -> None:
        """Delete folders and records that were replaced more than ``retain`` seconds ago."""
        found = self._all_records(spark)
        for record in found.values():
            if time.time() - record.at >= self.retain:
                for name in record.replaces:
                    if name in found:
                        store.delete(spark, self._folder(name))
                        store.delete(spark, f"{self.path}/{LOG}/{name}")

    # --- reading ---------------------------------------------------------------------------

    def _rows(self, spark: SparkSession, schema: T.StructType, records: list[Record], days: list | None) -> DataFrame:
        full = T.StructType(
            [f for f in schema.fields if f.name != self.day]
            + [T.StructField(c, k) for c, k in zip(WRITTEN, (T.IntegerType(), T.LongType(), T.StringType()))]
            + [T.StructField(FOLDER, T.StringType()), schema[self.day]]
        )
        # Folder names of plain values are known; others, with escapes, are left to the filter on the rows.
        wanted = None if days is None else {f"{self.day}={d}" for d in days}
        paths = [
            f"{self._folder(r.name)}/{part}" for r in records for part in r.parts
            if wanted is None or part in wanted or "%" in part
        ]
        if not paths:
            return spark.createDataFrame([], full)
        rows = spark.read.schema(full).option("basePath", self.path).parquet(*paths)
        return rows if days is None else rows.where(F.col(self.day).isin(*days))

    def read(self, spark: SparkSession, schema: T.StructType, days: list | None = None,
             version: list[Record] | None = None) -> DataFrame:
        """The row that counts per key, of some days or of all; only their folders are listed and read.

        Without ``version`` it is the newest one at the time of the call.
        """
        records = self.version(spark) if version is None else version
        return self._pick(self._rows(spark, schema, records, days), list(WRITTEN)).select(*schema.fieldNames())

    def publish(self, spark: SparkSession, schema: T.StructType, target: str,
                days: list[str] | None = None) -> None:
        """Write the rows that count as a plain table at another path, replacing the given days.

        ``rebalance`` evens out file sizes: small days become few files, big ones many.
        """
        (
            self.read(spark, schema, days).hint("rebalance", F.col(self.day))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(self.day).parquet(target)
        )


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Table after an upsert: the newest new row per key, and old rows whose key is not in it."""
    newest = latest_by_key(new, keys, order)
    return old.join(newest.select(*keys), keys, "left_anti").unionByName(newest)


def with_auto_id(df: DataFrame, doc_id: str, content: list[str]) -> DataFrame:
    """Fill a missing document id from the content, so that a replayed batch gives it again."""
    digest = F.sha2(F.to_json(F.struct(*content)), 256)
    return df.withColumn(doc_id, F.coalesce(F.col(doc_id), digest))


def upper_names(df: DataFrame) -> DataFrame:
    """Column names in upper case, as the wide-column store expects them."""
    return df.toDF(*[c.upper() for c in df.columns])
