"""Resampling of documents towards the feature distribution of a target text collection.

Features are the runs of 1 to ``longest`` words of a text, hashed into ``buckets``. A bucket's gain is
the logarithm of its share in the target over its share in the documents, as an array that every task
looks features up in; a document's weight is the sum of its features' gains. A Gumbel number drawn
from the document's id is added, so that the highest scores are a sample without replacement in
proportion to the weights.

The cutoff is found by a weighted selection over the whole pool, without sorting it: every block of at
most ``BLOCK`` keys names its median, the median of these weighted by the blocks' remaining sizes
is the pivot, and each round discards at least a quarter of what remains. Survivors are written anew as
they shrink, so all rounds together read the pool a few times. Only the winners are sorted, and their
ranks are counts before their range plus a running count within it.

What reaches the driver: ``buckets`` counts, a median per block, a count per range, and the last
``LAST`` keys at most. Rows that are equal in id, weight and number of features are one key with a
number of copies, so a row repeated any number of times is one key, too.

Null and empty texts have no features, weight 0 and are not in the pool if ``min_words`` is positive. A
null id is drawn for like an empty one and comes last among ties. Copies take consecutive ranks.
Other columns are left out, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillstream.llm.scratch import partitions, save
from tillstream.llm.words import Batches, texts

#: Keys that name one median together, and keys that are left to the driver.
BLOCK, LAST = 1_000_000, 10_000
#: Survivors are written anew when they are this part of what was written last.
SHRINK = 8
#: Bytes of a text that are cut into words at a time, and features a task remembers.
PIECE, REMEMBERED = 1 << 20, 500_000
#: Copies of one key that one task gives out.
COPIES = 10_000

#: Letters A-Z become a-z; digits, a-z and all bytes beyond ASCII stay; all others separate words.
TABLE = bytes(
    c if c >= 0x80 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 0x20 for c in range(256))
KEY = ("k1", "k2", "k3")


def pieces(text: bytes, longest: int = 1) -> Iterator[tuple[list[bytes], int]]:
    """Words of a text in bounded pieces, each after up to ``longest - 1`` words before it, and how many these are."""
    text, begin, carried = text.translate(TABLE), 0, []
    while begin < len(text):
        end = text.find(b" ", begin + PIECE)
        words = carried + text[begin : end if end >= 0 else len(text)].split()
        yield words, len(carried)
        carried = words[max(0, len(words) - longest + 1) :] if longest > 1 else []
        begin = end if end >= 0 else len(text)


class Buckets(dict):
    """Bucket of each feature, remembered up to a bound."""

    def __init__(self, buckets: int) -> None:
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[feature] = zlib.crc32(feature) % self.buckets
        return value

    def of(self, text: bytes | None, longest: int) -> Iterator[tuple[np.ndarray, int]]:
        """Buckets of all features and the number of words, piece by piece."""
        for words, carried in pieces(text or b"", longest):
            # Features that end within the words carried over were taken with the piece before.
            found = [words[carried:]]
            for n in range(2, longest + 1):
                found.append([b" ".join(words[i : i + n]) for i in range(max(0, carried - n + 1), len(words) - n + 1)])
            size = sum(map(len, found))
            flat = (self[f] for part in found for f in part) if longest > 1 else map(self.__getitem__, found[0])
            yield np.fromiter(flat, np.int64, size), len(words) - carried


def bucket_counts(texts_of: DataFrame, buckets: int, longest: int) -> np.ndarray:
    """Features of all texts by bucket."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        cache, total, waiting, held = Buckets(buckets), np.zeros(buckets, np.int64), [], 0
        for batch in batches:
            for text in texts(batch):
                for ids, _ in cache.of(text, longest):
                    waiting.append(ids)
                    held += len(ids)
                    if held >= 100_000:
                        total += np.bincount(np.concatenate(waiting), minlength=buckets)
                        waiting, held = [], 0
        if waiting:
            total += np.bincount(np.concatenate(waiting), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    rows = texts_of.select("text").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in rows.collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floor of 1000 times the logarithm of the target's smoothed share over the source's, by bucket."""
    s_all, t_all, n = int(source.sum()), int(target.sum()), len(source)
    return np.array([
        math.floor(1000 * math.log(float(t + 1) * float(s_all + n) / (float(s + 1) * float(t_all + n))))
        for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, longest: int) -> DataFrame:
    """Per row: doc_id, n_words, n_features and the sum of its features' gains."""
    buckets = len(gain)

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        cache = Buckets(buckets)
        for batch in batches:
            out = np.zeros((3, batch.num_rows), np.int64)
            for k, text in enumerate(texts(batch)):
                for ids, words in cache.of(text, longest):
                    out[:, k] += (words, len(ids), gain[ids].sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, out)], ["doc_id", "n_words", "n_features", "weight"])

    schema = T.StructType([
        docs.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def gumbel(doc_id: Column, seed: int) -> Column:
    """Floor of 1000 times a Gumbel number, from the first 32 bits of a hash of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


# --- selection -------------------------------------------------------------------------------


def _order(keys: np.ndarray) -> np.ndarray:
    return np.lexsort((keys[:, 2], keys[:, 1], keys[:, 0]))


def _before(keys: np.ndarray, pivot: tuple[int, int, int]) -> int:
    """Number of sorted keys that come before the pivot."""
    low, high = 0, len(keys)
    for k, p in enumerate(pivot):
        low, high = low + np.searchsorted(keys[low:high, k], p), low + np.searchsorted(keys[low:high, k], p, side="right")
    return int(low)


def _median(keys: np.ndarray, copies: np.ndarray) -> tuple[int, list[int]]:
    """Number of copies and the key in their middle, of sorted keys."""
    if not len(keys):
        return 0, [0, 0, 0]
    reached = np.cumsum(copies)
    return int(reached[-1]), keys[np.searchsorted(2 * reached, reached[-1])].tolist()


PART = ("before", "b1", "b2", "b3", "equal", "after", "a1", "a2", "a3")


def _block(keys: np.ndarray, copies: np.ndarray, pivot: tuple[int, int, int] | None) -> list[int]:
    """Sizes of a block on both sides of the pivot, and the medians there."""
    order = _order(keys)
    keys, copies = keys[order], copies[order]
    at = _before(keys, pivot) if pivot is not None else 0
    hit = pivot is not None and at < len(keys) and tuple(keys[at].tolist()) == pivot
    n_before, b = _median(keys[:at], copies[:at])
    n_after, a = _median(keys[at + hit :], copies[at + hit :])
    return [n_before, *b, int(copies[at]) if hit else 0, n_after, *a]


def _as_struct(key: tuple[int, int, int]) -> Column:
    return F.struct(*[F.lit(v).cast("bigint").alias(c) for c, v in zip(KEY, key)])


def _measure(pool: DataFrame, pivot: tuple[int, int, int] | None) -> np.ndarray:
    """One row of ``PART`` for every block of the remaining keys."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        held, size, rows = [], 0, []

        def close() -> None:
            whole = np.concatenate(held)
            rows.append(_block(whole[:, :3], whole[:, 3], pivot))

        for batch in batches:
            held.append(np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in (*KEY, "copies")], axis=1))
            size += batch.num_rows
            if size >= BLOCK:
                close()
                held, size = [], 0
        if size:
            close()
        if rows:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, np.array(rows, np.int64).T)), list(PART))

    got = pool.mapInArrow(run, ", ".join(f"{c} bigint" for c in PART)).collect()
    return np.array([tuple(r) for r in got], np.int64).reshape(-1, len(PART))


def _weighted_median(keys: np.ndarray, sizes: np.ndarray) -> tuple[int, int, int]:
    order = _order(keys)
    reached = np.cumsum(sizes[order])
    return tuple(keys[order][np.searchsorted(2 * reached, reached[-1])].tolist())


def cutoff(pool: DataFrame, draw: int) -> tuple[tuple[int, int, int], int]:
    """Key at which the first ``draw`` copies of the pool end, and how many copies of it are among them.

    ``pool`` has distinct keys (k1, k2, k3; smallest first) and their copies, ``draw`` at least 1 and
    at most all copies.
    """
    need, pivot, low, high = draw, None, None, None
    written = rest = None
    while True:
        parts = _measure(pool, pivot)
        before, equal, after = (int(parts[:, PART.index(c)].sum()) for c in ("before", "equal", "after"))
        if pivot is not None and before < need <= before + equal:
            return pivot, need - before
        if need <= before:
            high, rest, sizes, medians = pivot, before, parts[:, 0], parts[:, 1:4]
        else:
            low, need, rest, sizes, medians = pivot, need - before - equal, after, parts[:, 5], parts[:, 6:9]
        written = written or before + equal + after
        left = pool
        if low is not None:
            left = left.where(F.struct(*KEY) > _as_struct(low))
        if high is not None:
            left = left.where(F.struct(*KEY) < _as_struct(high))
        if rest <= LAST:
            rows = np.array([tuple(r) for r in left.select(*KEY, "copies").collect()], np.int64)
            rows = rows[_order(rows[:, :3])]
            reached = np.cumsum(rows[:, 3])
            at = int(np.searchsorted(reached, need))
            return tuple(rows[at, :3].tolist()), need - int(reached[at] - rows[at, 3])
        pool = left
        if SHRINK * rest <= written:
            pool, written = save(left, "survivors"), rest
        low = high = None
        pivot = _weighted_median(medians[sizes > 0], sizes[sizes > 0])


# --- ranks -----------------------------------------------------------------------------------


def _ranked(winners: DataFrame) -> DataFrame:
    """Winners with ``first``, the rank of the first of their copies in key order.

    Broadcast is one number per range, that is per shuffle partition.
    """
    schema = T.StructType([*winners.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("until", T.LongType())])

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        part, until = TaskContext.get().partitionId(), 0
        for batch in batches:
            reached = until + np.cumsum(batch.column("copies").to_numpy(zero_copy_only=False))
            until = int(reached[-1]) if len(reached) else until
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(reached)],
                [*batch.schema.names, "part", "until"])

    n = partitions(winners.sparkSession)
    ordered = winners.repartitionByRange(n, *KEY).sortWithinPartitions(*KEY)
    placed = save(ordered.mapInArrow(run, schema), "ranked")
    sizes = sorted((r.part, r.n) for r in placed.groupBy("part").agg(F.max("until").alias("n")).collect())
    starts = np.concatenate([[0], np.cumsum([n for _, n in sizes])]).tolist()
    offsets = winners.sparkSession.createDataFrame(
        [(part, start) for (part, _), start in zip(sizes, starts)], "part int, offset bigint")
    first = (F.col("offset") + F.col("until") - F.col("copies") + 1).alias("first")
    return placed.join(F.broadcast(offsets), "part").select(*winners.columns, first)


def _copies(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row per copy, ranked from ``first`` on; many copies of one key are shared out over tasks."""
    step = F.col("step")
    few = rows.where(F.col("copies") <= COPIES).select("*", F.lit(0).cast("bigint").alias("step"))
    many = rows.where(F.col("copies") > COPIES).select(
        "*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / COPIES))).alias("step"))
    here = F.least(F.col("copies") - step * COPIES, F.lit(COPIES).cast("bigint"))
    out = few.unionByName(many.repartition(partitions(rows.sparkSession)))
    return out.withColumn("copy", F.explode(F.sequence(step * COPIES, step * COPIES + here - 1))).select(
        *columns, (F.col("first") + F.col("copy")).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, longest: int = 1,
             buckets: int = 10_000, seed: int = 2024) -> DataFrame:
    """Every document's doc_id, n_words, n_features, weight, score and rank.

    Of the documents with ``min_words`` words and more, ``percent`` per hundred (rounded down) with the
    highest scores are drawn and ranked from 1 on, ties by the smaller id; for all others the rank is
    null. ``docs`` and ``target`` have a ``text``; ids are integers.
    """
    gain = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    scored = weights(docs, gain, longest).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    nameless = F.col("doc_id").isNull()
    keys = save(scored.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).select(
        *columns, "copies", (-F.col("score")).alias("k1"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(2**63 - 1)).alias("k2"),
        (F.col("n_features") + F.when(nameless, F.lit(2**62)).otherwise(F.lit(0))).alias("k3")), "weights")
    enough = F.col("n_words") >= min_words
    n = keys.where(enough).agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    draw = percent * n // 100
    none = F.lit(None).cast("bigint").alias("first")
    if not draw:
        return _copies(keys.select(*columns, "copies", none), columns)
    end, taken = cutoff(keys.where(enough).select(*KEY, "copies"), draw)
    key, last = F.struct(*KEY), _as_struct(end)
    won = keys.where(enough & (key <= last)).withColumn(
        "copies", F.when(key == last, F.lit(taken)).otherwise(F.col("copies")).cast("bigint"))
    lost = keys.where(~enough | (key >= last)).withColumn(
        "copies", F.when(enough & (key == last), F.col("copies") - taken).otherwise(F.col("copies"))).where("copies > 0")
    ranked = _ranked(won).select(*columns, "copies", "first")
    return _copies(ranked.unionByName(lost.select(*columns, "copies", none)), columns)
