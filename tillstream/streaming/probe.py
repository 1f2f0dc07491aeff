"""Row counts per stage and micro-batch, without extra passes over the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQueryListener

from tillstream.streaming.sinks import KeyedTable

COUNT_TABLE = T.StructType([
    T.StructField("query", T.StringType()), T.StructField("batch", T.LongType()), T.StructField("stage", T.StringType()),
    T.StructField("rows", T.LongType()), T.StructField("dt", T.StringType())])


def probe(df: DataFrame, stage: str, rows: Column | None = None) -> DataFrame:
    """Count the rows that pass this point; the count arrives with the batch's progress.

    With ``rows`` each row stands for that many.
    """
    n = F.count(F.lit(1)) if rows is None else F.coalesce(F.sum(rows), F.lit(0))
    return df.observe(stage, n.alias("rows"))


class StageCounts(StreamingQueryListener):
    """Collects the counts of all probes: ``(batch id, stage, rows)``, newest last.

    Rows dropped behind the watermark are listed as the stage ``late``. Single counts beyond the
    last ``keep`` leave the list; ``totals`` holds the sum of every stage since the start.
    :class:`StoredCounts` keeps all of them.
    """

    def __init__(self, keep: int = 1000) -> None:
        self.keep, self.counts, self.totals = keep, [], {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for stage, n in stage_rows(event.progress).items():
            self.counts.append((event.progress.batchId, stage, n))
            self.totals[stage] = self.totals.get(stage, 0) + n
        del self.counts[:-self.keep]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


class StoredCounts(StageCounts):
    """Also keeps every count in a table, one row per query, batch and stage.

    The table is written like those of the jobs: a batch that is replayed after a restart is not counted
    again, and its folders are merged. Read it with :meth:`read`.
    """

    def __init__(self, spark: SparkSession, path: str, keep: int = 1000) -> None:
        super().__init__(keep)
        self.spark, self.table = spark, KeyedTable(path, ("query", "batch", "stage"), "dt")

    def onQueryProgress(self, event) -> None:
        super().onQueryProgress(event)
        p = event.progress
        rows = [(p.name or str(p.id), p.batchId, stage, n, p.timestamp[:10]) for stage, n in stage_rows(p).items()]
        if rows:
            self.table.of_writer(str(p.id)).write_batch(self.spark.createDataFrame(rows, COUNT_TABLE).coalesce(1), p.batchId)

    def read(self) -> DataFrame:
        return self.table.read(self.spark, COUNT_TABLE)


def stage_rows(progress) -> dict[str, int]:
    """Rows by stage of one batch; a batch without data has none."""
    rows = {stage: int(row["rows"]) for stage, row in (progress.observedMetrics or {}).items()}
    late = late_rows(progress)
    return rows | ({"late": late} if late else {})


def late_rows(progress) -> int:
    """Rows dropped behind the watermark in a batch, over all stateful operators."""
    return sum(int(op.numRowsDroppedByWatermark) for op in progress.stateOperators)
