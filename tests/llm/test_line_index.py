from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from tillstream.llm import cuckoo, line_index
from tillstream.llm.line_index import LineIndex

LOWER = {c: c + 32 for c in range(65, 91)}


def key(line):
    key = line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    return key if len(key) >= 10 else None


def brute(rows):
    low, held = {}, {}
    for d, t in rows:
        for k in filter(None, map(key, (t or "").split("\n"))):
            if d is not None:
                held.setdefault(k, set()).add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or key(x) is None or d == min(held[key(x)])]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def cleaned(index, docs):
    return sorted(map(tuple, index.cleaned(docs).collect()), key=str)


def state(index):
    """References and counts, and how many lines the filters hold."""
    refs = sorted((bytes(r.key), r.doc_id) for r in index.refs().collect())
    counts = sorted((bytes(r.key), r.docs, r.low) for r in index.counts().collect())
    cells = sum(int((cuckoo.load(bytes(r.cells)) != 0).sum()) for r in index.filters().collect())
    return refs, counts, cells


def corpus(seed, n, first=0):
    rng = random.Random(seed)
    common = [f"Common line number {i}" for i in range(12)]
    line = lambda: rng.choice([rng.choice(common), rng.choice(common).upper() + " \t", f" own line {rng.random()}", "short", "äöüäöüäöü", "äöüäöüäöüÄ", ""])
    return [(first + d, "\n".join(line() for _ in range(rng.randrange(0, 9)))) for d in range(n)]


def test_one_insertion_equals_brute_force(spark, make_docs):
    rows = corpus(1, 150)
    docs = make_docs(rows).repartition(5)
    index = LineIndex.create(spark).insert(docs)
    assert cleaned(index, docs) == brute(rows)


def test_steps_equal_the_whole_and_deletions_undo_them(spark, make_docs, monkeypatch):
    monkeypatch.setattr(cuckoo, "KEYS", 10)
    a, b, c = corpus(2, 60, 100), corpus(3, 60, 50), corpus(4, 40, 200)
    one = LineIndex.create(spark).insert(make_docs(a))
    assert one.shards > 1
    two = one.insert(make_docs(b))
    three = two.insert(make_docs(c))
    everything = {}
    for d, t in a + b + c:
        everything[d] = everything.get(d, "") + "\n" + t
    merged = list(everything.items())
    assert cleaned(three, make_docs(merged)) == brute(merged)
    refs, counts, cells = state(three)
    assert cells == len(counts) == len({k for k, _ in refs})
    assert {k: (n, low) for k, n, low in counts} == {
        k: (sum(x == k for x, _ in refs), min(d for x, d in refs if x == k)) for k in {k for k, _ in refs}}
    # Taking back what an insertion brought gives the earlier state.
    before = state(two)
    back = three.delete(make_docs(c))
    assert state(back) == before
    with pytest.raises(ValueError):
        three.delete(make_docs(a))
    only_b = [(d, t) for d, t in b if not 100 <= d < 160]
    again = back.delete(make_docs(a))
    assert cleaned(again, make_docs(only_b)) == brute(only_b)
    # A document may come and go repeatedly, and merging versions changes nothing.
    before = state(again)
    merged_versions = again.insert(make_docs(c)).delete(make_docs(c)).compacted()
    assert state(merged_versions) == before and merged_versions.base == merged_versions.version
    assert LineIndex.open(spark, three.path) == merged_versions
    assert state(merged_versions.delete(make_docs(merged))) == ([], [], 0)
    assert LineIndex.open(spark, three.path + "/none").version == 0


def test_seen_lines_of_other_documents(spark, make_docs):
    index = LineIndex.create(spark).insert(make_docs([(5, "a line to know\nanother line"), (3, "A LINE TO KNOW ")]))
    got = index.seen(make_docs([(9, "a line to know\nnever met before"), (10, None)])).collect()
    assert [(r.doc_id, r.docs, r.low) for r in got] == [(9, 2, 3)]
    assert LineIndex.create(spark).seen(make_docs([(1, "a line to know")])).count() == 0


def test_odd_rows(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    index = LineIndex.create(spark).insert(docs)
    assert cleaned(index, docs) == brute(odd_rows)
    empty = LineIndex.create(spark).insert(make_docs([]))
    assert cleaned(empty, make_docs([])) == [] and state(empty) == ([], [], 0)
    assert state(empty.insert(docs))[:2] == state(index)[:2]
    before = state(index)
    assert state(LineIndex.open(spark, index.path).delete(make_docs([(99, None)]))) == before


def test_cuckoo_filter_adds_finds_and_removes():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 70_000).astype(np.uint64)
    tables = cuckoo.load(None)
    for part in np.array_split(keys, 7):
        tables = cuckoo.add(tables, part)
        assert cuckoo.contains(tables, part).all()
    assert len(tables) == 3 and int((tables != 0).sum()) == len(keys) and cuckoo.contains(tables, keys).all()
    others = rng.integers(0, 2**63, 50_000).astype(np.uint64)
    assert cuckoo.contains(tables, others).mean() < 0.001
    gone, left = keys[::2], keys[1::2]
    tables = cuckoo.remove(tables, gone)
    assert cuckoo.contains(tables, left).all() and int((tables != 0).sum()) == len(left)
    assert cuckoo.contains(tables, gone).mean() < 0.001
    assert cuckoo.load(tables.tobytes()).shape == tables.shape
    assert len(cuckoo.remove(tables, left)) == 0
    with pytest.raises(ValueError):
        cuckoo.remove(tables[:0], left[:1])


def test_equal_fingerprints_of_one_bucket():
    same = np.full(8, 12345, np.uint64)
    tables = cuckoo.add(cuckoo.load(None), same)
    assert int((tables != 0).sum()) == 8
    tables = cuckoo.add(tables, same)  # more than two buckets hold: a second table
    assert len(tables) >= 2 and int((tables != 0).sum()) == 16
    assert Counter(cuckoo.contains(cuckoo.remove(tables, same), same)) == {True: 8}


def test_key_of_a_line():
    assert line_index.key_of(b"123456789") is None and line_index.key_of("äöüäöüäöü".encode()) is None
    assert line_index.key_of(b" ABCdefghij\r") == line_index.key_of(b"abcdefghij")
    assert line_index.key_of(" abcdefghij".encode()) != line_index.key_of(b"abcdefghij")
