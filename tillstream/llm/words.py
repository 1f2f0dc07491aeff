"""Words of whole texts as 64-bit numbers, for operators whose tasks work on numpy arrays.

Texts are handled as UTF-8 bytes. ``bytes.split()`` cuts at exactly the characters 0x09-0x0D and
0x20, and ``bytes.lower()`` changes exactly A-Z, so no text is decoded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

MASK = (1 << 64) - 1
#: Odd multipliers of the polynomial over word numbers and of the final mixing.
STEP = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)


class WordIds(dict):
    """Hash of each word, remembered while the vocabulary of a task stays below a bound."""

    LIMIT = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def windows(ids: np.ndarray, n: int) -> np.ndarray:
    """Hash of every window of ``n`` words, by start; none where there are fewer words."""
    if len(ids) < n:
        return np.empty(0, np.uint64)
    last = len(ids) - n + 1
    out = ids[:last].copy()
    for i in range(1, n):
        out = out * STEP + ids[i : last + i]
    return mix(out)


def shingle_set(ids: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word windows; a shorter text is one window."""
    return np.unique(windows(ids, min(n, len(ids)))) if len(ids) else np.empty(0, np.uint64)


def texts(batch: pa.RecordBatch | pa.Table, column: str = "text") -> list[bytes | None]:
    """The texts of an Arrow batch or table as bytes, without decoding."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def slices(batches: Batches, rows: int = 1000) -> Batches:
    """The same rows in smaller batches, for tasks that hold several objects per row of a batch."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def flat(column: pa.ChunkedArray) -> np.ndarray:
    """All numbers of a column of lists, without a Python object for each."""
    return pc.list_flatten(column).to_numpy().astype(np.int64)


def lists(values: list[np.ndarray], kind: pa.DataType = pa.int64()) -> pa.ListArray:
    """One list per row out of numpy arrays."""
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    flat = np.concatenate(values) if values else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


Batches = Iterator[pa.RecordBatch]
