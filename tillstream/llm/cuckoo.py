"""Cuckoo filters as numpy tables: sets of 16-bit fingerprints that support deletion.

A key has two buckets, each the other's partner by its fingerprint alone, so a stored fingerprint can
be moved without its key. A filter is one table or, where a shard outgrows it, several of the same
size; fingerprints are interchangeable between them. No key that was added is ever denied; a key
that was not is taken for present with a chance of about 8 in 65,535 per table.
"""

from __future__ import annotations

import numpy as np

from tillstream.llm.words import mix

BUCKETS, SLOTS = 1 << 13, 4
#: Keys a shard is laid out for: three quarters of the slots of one table.
KEYS = BUCKETS * SLOTS * 3 // 4
#: Rounds of moving before what is left goes to the next table.
ROUNDS = 60


def _marks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint (not 0) and first bucket of 64-bit key numbers."""
    return (keys % np.uint64(65535) + np.uint64(1)).astype(np.uint16), (mix(keys) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _partner(prints: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    return bucket ^ (mix(prints.astype(np.uint64)) & np.uint64(BUCKETS - 1)).astype(np.int64)


def load(cells: bytes | None) -> np.ndarray:
    """Tables of a stored filter; of none, no tables."""
    return np.frombuffer(cells or b"", np.uint16).reshape(-1, BUCKETS, SLOTS).copy()


def contains(tables: np.ndarray, keys: np.ndarray) -> np.ndarray:
    prints, first = _marks(keys)
    second = _partner(prints, first)
    found = np.zeros(len(keys), bool)
    for table in tables:
        found |= (table[first] == prints[:, None]).any(1) | (table[second] == prints[:, None]).any(1)
    return found


def _settle(table: np.ndarray, prints: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Put fingerprints into free slots of their buckets; the others are returned."""
    order = np.argsort(bucket, kind="stable")
    prints, bucket = prints[order], bucket[order]
    turn = np.arange(len(bucket)) - np.searchsorted(bucket, bucket)
    free = np.cumsum(table[bucket] == 0, axis=1)
    fits = free[:, -1] > turn
    slot = (free == turn[:, None] + 1).argmax(1)
    table[bucket[fits], slot[fits]] = prints[fits]
    return prints[~fits], bucket[~fits]


def _fill(table: np.ndarray, prints: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    prints, bucket = _settle(table, prints, bucket)
    prints, bucket = _settle(table, prints, _partner(prints, bucket))
    for round_ in range(ROUNDS):
        if not len(prints):
            break
        # One fingerprint per full bucket takes the place of another, which moves to its partner.
        _, one = np.unique(bucket, return_index=True)
        at, slot = bucket[one], (prints[one].astype(np.int64) + round_) % SLOTS
        moved = table[at, slot]
        table[at, slot] = prints[one]
        rest = np.ones(len(prints), bool)
        rest[one] = False
        prints, bucket = _settle(
            table, np.concatenate([prints[rest], moved]), np.concatenate([bucket[rest], _partner(moved, at)]))
    return prints, bucket


def add(tables: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Tables with further distinct keys; what the last table cannot take opens a new one."""
    prints, bucket = _marks(keys)
    out = list(tables)
    for table in out[-1:]:
        prints, bucket = _fill(table, prints, bucket)
    while len(prints):
        out.append(np.zeros((BUCKETS, SLOTS), np.uint16))
        prints, bucket = _fill(out[-1], prints, bucket)
    return np.stack(out) if out else tables


def remove(tables: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Tables without one fingerprint per key; only keys that were added may be removed."""
    prints, first = _marks(keys)
    second = _partner(prints, first)
    while len(prints):
        open_ = np.ones(len(prints), bool)
        for table in tables:
            for bucket in (first, second):
                hits = table[bucket] == prints[:, None]
                cell = bucket * SLOTS + hits.argmax(1)
                has = np.flatnonzero(open_ & hits.any(1))
                # Equal fingerprints of one bucket clear one slot each, round by round.
                _, one = np.unique(cell[has], return_index=True)
                chosen = has[one]
                table.reshape(-1)[cell[chosen]] = 0
                open_[chosen] = False
        if open_.all():
            raise ValueError("a key to remove is not in the filter")
        prints, first, second = prints[open_], first[open_], second[open_]
    return tables[tables.any(axis=(1, 2))]
