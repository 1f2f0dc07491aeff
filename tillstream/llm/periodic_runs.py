"""Periodic runs: stretches of words that repeat a shorter sequence of words again and again.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are equal) that
holds at least ``exponent`` periods and ``minimum`` words and that no neighbouring word extends.

Runs are found by a dictionary of basic factors. Every stretch of 1, 2, 4, ... words gets a name, the
rank of the pair of names of its halves, so equal stretches have equal names. Where a name occurs
again after at most twice its length, and once more after the same distance, the occurrences form
an arithmetic progression and its difference is proposed as a period. A run with period ``q`` and four
periods always shows such a progression at the first length that is not below ``q``, because there the
next occurrence of a stretch is exactly ``q`` words on. Proposals are extended word by word in both
directions, and of the periods of one stretch the smallest stays.

Documents are independent: one pass of map tasks, no shuffle. Texts are taken in chunks of about
``CHUNK`` words, a longer text alone, and only stretches that occur twice in their text stay in the
dictionary, so memory is some tens of bytes per word of a chunk.

Null, empty and blank texts have no words and no runs; repeated rows give repeated results; a null
id is kept; other columns are left out, whatever their names; an empty table gives no rows. Of equal
runs there is one, since start and length settle a run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from tillstream.llm.words import Batches, texts

#: Words of the texts that are worked on together.
CHUNK = 200_000
#: With fewer periods a run need not show three equally spaced occurrences.
LEAST_EXPONENT = 4

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


class Numbers(dict):
    """Numbers the distinct words it is asked for."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key and place, whether an entry of that order equals the next one, and dense ranks."""
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    same = sorted_key[1:] == sorted_key[:-1]
    rank = np.empty(len(key), np.int64)
    if len(key):
        rank[order] = np.concatenate([[0], np.cumsum(~same)])
    return order, same, rank


def proposals(names: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods proposed by equally spaced stretches of every power-of-two length.

    ``names`` are the numbers of the words; equal ones lie in one text. ``longest`` is the number of
    words of the longest text.
    """
    at, key, length = np.arange(len(names)), names, 1
    starts, periods = [], []
    while len(at):
        order, same, rank = ranked(key)
        place = at[order]
        gap = np.diff(place)
        spaced = same[:-1] & same[1:] & (gap[:-1] == gap[1:]) & (gap[:-1] <= 2 * length)
        starts.append(place[:-2][spaced])
        periods.append(gap[:-1][spaced])
        # The next length covers periods up to itself, which four periods of the longest text bound.
        if 4 * length >= longest:
            break
        again = np.zeros(len(at), bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        at, rank = at[again], rank[again]
        half = np.searchsorted(at, at + length)
        whole = half < len(at)
        whole[whole] = at[half[whole]] == at[whole] + length
        key = rank[whole] * (len(order) + 1) + rank[half[whole]]
        at, length = at[whole], 2 * length
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start, period = np.concatenate(starts), np.concatenate(periods)
    order = np.lexsort((start, period))
    start, period = start[order], period[order]
    # Neighbouring starts with one period belong to one stretch.
    first = np.ones(len(start), bool)
    first[1:] = (period[1:] != period[:-1]) | (start[1:] > start[:-1] + 1)
    return start[first], period[first]


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning of two arrays, read in growing pieces."""
    n, done, size = min(len(a), len(b)), 0, 64
    while done < n:
        end = min(n, done + size)
        differ = a[done:end] != b[done:end]
        if differ.any():
            return done + int(differ.argmax())
        done, size = end, 2 * size
    return n


def runs_of(names: np.ndarray, longest: int, minimum: int, exponent: int) -> np.ndarray:
    """Rows of start, length and period of all runs, by start and period."""
    found: dict[tuple[int, int], int] = {}
    last_period, last_end = 0, -1
    start, period = proposals(names, longest)
    for s, q in zip(start.tolist(), period.tolist()):
        if q == last_period and s + q <= last_end:
            continue  # inside the stretch extended just before
        low = s - common(names[:s][::-1], names[: s + q][::-1])
        high = s + q + common(names[s:], names[s + q :])
        last_period, last_end = q, high
        if high - low >= max(minimum, exponent * q):
            found[low, high] = min(q, found.get((low, high), q))
    rows = sorted((low, q, high - low) for (low, high), q in found.items())
    return np.array([(s, n, q) for s, q, n in rows], np.int64).reshape(-1, 3)


def chunk_runs(split: list[list[bytes]], minimum: int, exponent: int) -> list[np.ndarray]:
    """Runs of every text of a chunk, given as lists of words; starts count from the text's first word."""
    sizes = np.array([len(w) for w in split], np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    numbers = Numbers()
    words = np.empty(begin[-1], np.int64)
    for k, w in enumerate(split):
        words[begin[k] : begin[k + 1]] = np.fromiter(map(numbers.__getitem__, w), np.int64, len(w))
    # The same word in another text is another name, so no stretch and no run crosses texts.
    names = np.repeat(np.arange(len(split)), sizes) * max(1, len(numbers)) + words
    runs = runs_of(names, int(sizes.max(initial=0)), minimum, exponent)
    owner = np.searchsorted(begin, runs[:, 0], side="right") - 1
    runs[:, 0] -= begin[owner]
    cut = np.searchsorted(owner, np.arange(len(split) + 1))
    return [runs[cut[k] : cut[k + 1]] for k in range(len(split))]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if len(runs):
        steps = np.zeros(len(words) + 1, np.int64)
        np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
        np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
        words = [w for w, inside in zip(words, np.cumsum(steps[:-1]).tolist()) if not inside]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, minimum: int = 6, exponent: int = 4) -> DataFrame:
    """Per document: doc_id, n_words, runs (start, length, period; by start, then period) and text.

    ``text`` is the document's words without those that only repeat: of every run the first period
    stays. Words are separated by blanks and ASCII control blanks (0x09-0x0D).
    """
    if exponent < LEAST_EXPONENT:
        raise ValueError(f"runs are found from {LEAST_EXPONENT} periods on")
    run_kind = pa.struct([(f.name, pa.int64()) for f in RUN.fields])

    def result(ids: pa.Array, split: list[list[bytes]]) -> pa.RecordBatch:
        runs = chunk_runs(split, minimum, exponent)
        flat = np.concatenate(runs)
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
        rows = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(run_kind))
        return pa.RecordBatch.from_arrays([
            ids, pa.array([len(w) for w in split], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), rows),
            pa.array([collapsed(w, r) for w, r in zip(split, runs)], pa.binary()).cast(pa.string()),
        ], ["doc_id", "n_words", "runs", "text"])

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, split, begin, held = batch.column("doc_id"), [], 0, 0
            for k, text in enumerate(texts(batch)):
                split.append((text or b"").split())
                held += len(split[-1])
                if held >= CHUNK or k == batch.num_rows - 1:
                    yield result(ids.slice(begin, len(split)), split)
                    split, begin, held = [], k + 1, 0

    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)),
        T.StructField("text", T.StringType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)
