"""Removal of repeated passages by fixed-block anchors.

Every document is indexed by its non-overlapping blocks of ``(window + 1) // 2`` words, and every
document probes that index with all of its rolling windows of the same size. A passage of
``window`` words shared by two documents holds at least one whole indexed block of the earlier
one, so the later one's probe finds it. Around the hits, exact windows of ``window`` words are
compared; the union of those that start in an earlier document is the maximal repeat.

What travels: for each group of documents read together and each range of hashes one row with
packed numbers (four bytes per probe, eight per exact window) instead of a row per window. A hash
is sent at most once per such group, so a passage in a third of all documents is no hot key. The
number of ranges grows with the text, and with it the bits that tell two hashes apart. The text is
shuffled once and read twice; nothing is collected per passage. Replies go back in packed rows as
well, to groups of documents by a hash of their id.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillstream.llm.words import Batches, WordIds, flat, texts, windows

#: Bytes of text per range of hashes.
RANGE_BYTES = 12_000_000
#: Keys that are sorted and packed together.
GROUP_KEYS = 1_500_000
PACKED = "bin int, docs array<long>, counts array<int>, flagged array<int>, packed binary"


def _bin_of(keys: np.ndarray, bins: int) -> np.ndarray:
    return (((keys >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64)


def _rows(bins: np.ndarray, docs: np.ndarray, keys: np.ndarray, flags: np.ndarray, kind) -> pa.RecordBatch:
    """One row per bin; inside a row the keys lie by document, flagged keys first."""
    order = np.lexsort((~flags, docs, bins))
    bins, docs, keys, flags = bins[order], docs[order], keys[order].astype(kind), flags[order]
    runs = np.flatnonzero(np.r_[True, (bins[1:] != bins[:-1]) | (docs[1:] != docs[:-1])]) if len(bins) else np.empty(0, int)
    counts = np.diff(np.r_[runs, len(bins)])
    flagged = np.add.reduceat(flags.astype(np.int64), runs) if len(runs) else counts
    starts = np.flatnonzero(np.r_[True, bins[runs][1:] != bins[runs][:-1]]) if len(runs) else np.empty(0, int)
    offsets = pa.array(np.r_[starts, len(runs)].astype(np.int32))
    at = np.r_[runs[starts], len(bins)]
    split = lambda v, t: pa.ListArray.from_arrays(offsets, pa.array(v, t))
    return pa.RecordBatch.from_arrays(
        [pa.array(bins[at[:-1]], pa.int32()), split(docs[runs], pa.int64()), split(counts, pa.int32()),
         split(flagged, pa.int32()),
         pa.array([keys[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())],
        ["bin", "docs", "counts", "flagged", "packed"])


def _groups(described, most: int = GROUP_KEYS):
    """Documents in groups of about ``most`` keys, so that memory doesn't follow the batch."""
    docs, keys, flags, held = [], [], [], 0
    for doc_id, own, flag in described:
        docs.append(doc_id)
        keys.append(own)
        flags.append(flag)
        held += len(own)
        if held >= most:
            yield docs, keys, flags
            docs, keys, flags, held = [], [], [], 0
    if docs:
        yield docs, keys, flags


def _local(docs: list[int], keys: list[np.ndarray], flags: list[np.ndarray]):
    """All keys of a group sorted by key and document, and the first entry of every key."""
    k = np.concatenate(keys) if keys else np.empty(0, np.uint64)
    f = np.concatenate(flags) if flags else np.empty(0, bool)
    d = np.repeat(np.array(docs, np.int64), [len(x) for x in keys])
    order = np.lexsort((d, k))
    k, d, f = k[order], d[order], f[order]
    first = np.r_[True, k[1:] != k[:-1]] if len(k) else np.empty(0, bool)
    return k, d, f, first


def _probes(block: int, bins: int):
    """Packed probes of every document. Bins from ``bins`` up hold what is already known to be hit."""

    def run(batches: Batches) -> Batches:
        ids = WordIds()
        for batch in batches:
            for docs, keys, flags in _groups(described(batch, ids)):
                yield from packed(docs, keys, flags)

    def described(batch, ids):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
            probes = windows(ids.of((text or b"").split()), block)
            if doc_id is not None and len(probes):
                own = np.unique(probes)
                indexed = np.zeros(len(own), bool)
                indexed[np.searchsorted(own, probes[::block])] = True
                yield doc_id, own, indexed

    def packed(docs, keys, flags):
        k, d, f, first = _local(docs, keys, flags)
        group = np.cumsum(first) - 1
        many = np.bincount(group)[group] > 1
        p = _bin_of(k, bins)
        yield _rows(p[first], d[first], k[first], np.logical_or.reduceat(f, np.flatnonzero(first)), np.uint32)
        if many.any():
            yield _rows(p[many] + bins, d[many], k[many], f[many], np.uint32)

    return run


def _unpack(table: pa.Table, kind):
    docs, counts, flagged = (flat(table.column(c)) for c in ("docs", "counts", "flagged"))
    keys = np.concatenate([np.frombuffer(x, kind) for x in table.column("packed").to_pylist()])
    owner = np.repeat(np.arange(len(docs)), counts)
    inside = np.arange(len(keys)) - np.repeat(np.cumsum(counts) - counts, counts)
    return docs[owner], inside < flagged[owner], keys


def _replies(bin_: int, docs: np.ndarray, keys: np.ndarray, groups: int) -> pa.Table:
    """One row per group of documents; inside a row the keys lie by document."""
    order = np.argsort(docs, kind="stable")
    docs, keys = docs[order], keys[order]
    runs = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]]) if len(docs) else np.empty(0, int)
    ends = np.r_[runs[1:], len(docs)] if len(docs) else runs
    rows = defaultdict(lambda: ([], [], []))
    for doc_id, a, b in zip(docs[runs].tolist(), runs, ends):
        ids, counts, parts = rows[zlib.crc32(b"%d" % doc_id) % groups]
        ids.append(doc_id)
        counts.append(b - a)
        parts.append(keys[a:b])
    return pa.table({
        "part": pa.array(rows.keys(), pa.int64()), "bin": pa.array([bin_] * len(rows), pa.int32()),
        "docs": pa.array([r[0] for r in rows.values()], pa.list_(pa.int64())),
        "counts": pa.array([r[1] for r in rows.values()], pa.list_(pa.int32())),
        "packed": pa.array([np.concatenate(r[2]).tobytes() for r in rows.values()], pa.binary()),
    })


def _hits(replies: pa.Table, kind) -> dict[int, list[tuple[int, np.ndarray]]]:
    """(bin, keys) of every document that has a reply."""
    hits = defaultdict(list)
    for row in replies.to_pylist():
        keys = np.frombuffer(row["packed"], kind)
        at = 0
        for doc_id, count in zip(row["docs"], row["counts"]):
            hits[doc_id].append((row["bin"], keys[at : at + count]))
            at += count
    return hits


def _met(bins: int, groups: int):
    """Probes of one range of hashes that meet an indexed block, and blocks that are met."""

    def run(key, table):
        bin_ = key[0].as_py()
        docs, indexed, keys = _unpack(table, np.uint32)
        if bin_ < bins:
            order = np.argsort(keys, kind="stable")
            docs, indexed, keys = docs[order], indexed[order], keys[order]
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            sizes = np.diff(np.r_[starts, len(keys)])
            live = np.repeat((sizes > 1) & np.logical_or.reduceat(indexed, starts), sizes)
            docs, keys = docs[live], keys[live]
        return _replies(bin_ % bins, docs, keys, groups)

    return run


def _candidates(window: int, block: int, bins: int):
    """Packed exact windows around the hits of every document."""

    def run(rows, replies):
        out = [b for group in _groups(described(rows, _hits(replies, np.uint32), WordIds())) for b in packed(*group)]
        return pa.Table.from_batches(out, _rows(*[np.empty(0, int)] * 3, np.empty(0, bool), np.uint64).schema)

    def described(rows, hits, ids):
        for doc_id, text in zip(rows.column("doc_id").to_pylist(), texts(rows)):
            if doc_id not in hits:
                continue
            numbers = ids.of((text or b"").split())
            exact = windows(numbers, window)
            if not len(exact):
                continue
            probes = windows(numbers, block)
            name = (_bin_of(probes, bins).astype(np.uint64) << np.uint64(32)) | (probes & np.uint64(0xFFFFFFFF))
            known = np.concatenate([k.astype(np.uint64) | np.uint64(b << 32) for b, k in hits[doc_id]])
            met = np.r_[0, np.cumsum(np.isin(name, known))]
            span = window - block + 1
            around = met[span:][: len(exact)] > met[:-span][: len(exact)]
            own = np.unique(exact[around])
            yield doc_id, own, np.zeros(len(own), bool)

    def packed(docs, keys, flags):
        k, d, none, first = _local(docs, keys, flags)
        if not len(k):
            return
        later = d > d[np.flatnonzero(first)][np.cumsum(first) - 1]
        p = _bin_of(k, bins)
        yield _rows(p[first], d[first], k[first], none[first], np.uint64)
        if later.any():
            yield _rows(p[later] + bins, d[later], k[later], none[later], np.uint64)

    return run


def _later(bins: int, groups: int):
    """Exact windows of one range of hashes that also start in a smaller document."""

    def run(key, table):
        bin_ = key[0].as_py()
        docs, _, keys = _unpack(table, np.uint64)
        if bin_ < bins:
            order = np.lexsort((docs, keys))
            docs, keys = docs[order], keys[order]
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            least = np.repeat(docs[starts], np.diff(np.r_[starts, len(keys)]))
            docs, keys = docs[docs > least], keys[docs > least]
        return _replies(bin_ % bins, docs, keys, groups)

    return run


def _cut(window: int, with_text: bool):
    def run(rows, replies):
        ids, hits = WordIds(), _hits(replies, np.uint64)
        sizes, removed, digests, kept_texts = [], [], [], []
        for doc_id, text in zip(rows.column("doc_id").to_pylist(), texts(rows)):
            words = (text or b"").split()
            kept = words
            if doc_id in hits:
                known = np.concatenate([k for _, k in hits[doc_id]])
                starts = np.flatnonzero(np.isin(windows(ids.of(words), window), known))
                edge = np.zeros(len(words) + 1, np.int64)
                edge[starts] += 1
                np.subtract.at(edge, starts + window, 1)
                kept = [w for w, depth in zip(words, np.cumsum(edge).tolist()) if not depth]
            joined = b" ".join(kept)
            sizes.append(len(words))
            removed.append(len(words) - len(kept))
            digests.append(hashlib.sha256(joined).hexdigest())
            kept_texts.append(joined if with_text else None)
        columns = {"doc_id": rows.column("doc_id"), "n_words": pa.array(sizes, pa.int64()),
                   "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(digests, pa.string())}
        if with_text:
            columns["kept_text"] = pa.array(kept_texts, pa.binary()).cast(pa.string())
        return pa.table(columns)

    return run


def remove_repeats(docs: DataFrame, window: int = 13, with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256``
    and, if asked for, ``kept_text``.

    A word goes if a window of ``window`` words that covers it also starts in a document with a
    smaller ``doc_id``; windows are judged on the input. Kept words are joined by one space. A null
    or empty text has no words and keeps the empty text. Texts shorter than the window keep all
    words. Rows without ``doc_id`` keep all words and remove none; rows that share a ``doc_id``
    never remove each other's words. Further columns of ``docs`` are ignored.
    """
    block = (window + 1) // 2
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # From the bytes alone: reply rows are one per range and group of documents that it has hits for.
    bins = size // RANGE_BYTES + 1
    groups = 2 * bins
    part = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit("")).cast("binary")) % groups
    placed = rows.withColumn("part", part)
    reply = "part long, bin int, docs array<long>, counts array<int>, packed binary"

    def with_replies(packed: DataFrame, merge, then, schema: str) -> DataFrame:
        """``then`` over the texts and replies of each group of documents."""
        replies = packed.groupBy("bin").applyInArrow(merge, reply)
        return placed.groupBy("part").cogroup(replies.groupBy("part")).applyInArrow(then, schema)

    probes = rows.mapInArrow(_probes(block, bins), PACKED)
    # The exchange of the texts is the same in both, so it is made once.
    candidates = with_replies(probes, _met(bins, groups), _candidates(window, block, bins), PACKED)
    out = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")
    return with_replies(candidates, _later(bins, groups), _cut(window, with_text), out)
