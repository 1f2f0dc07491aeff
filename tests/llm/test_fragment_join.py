from __future__ import annotations

import random

import numpy as np
import pytest

from tillstream.llm import fragment_join
from tillstream.llm.components import components


def sets_of(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if len(words) >= n else frozenset([tuple(words)])


def brute(rows, n, percent):
    """Components by comparing every pair."""
    sets = {d: sets_of(t, n) for d, t in rows if d is not None}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


def family(seed, size, edits, words=60):
    rng = random.Random(seed)
    base = [f"w{seed}_{i}" for i in range(words)]
    out = [base]
    for _ in range(size):
        text = list(out[rng.randrange(len(out))])
        for _ in range(rng.randrange(1, edits + 1)):
            at = rng.randrange(len(text))
            rng.choice([lambda: text.__setitem__(at, f"e{rng.random()}"), lambda: text.pop(at),
                        lambda: text.insert(at, f"i{rng.random()}")])()
        out.append(text)
    return [" ".join(t) for t in out]


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_components_equal_brute_force(spark, make_docs, n, percent):
    texts = [t for s in range(6) for t in family(s, 25, 3, 20 + 30 * s)]
    texts += [f"common line of many words here {i} " + " ".join(f"u{i}_{j}" for j in range(i % 9)) for i in range(60)]
    random.Random(1).shuffle(texts)
    rows = list(enumerate(texts + texts[:20]))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           fragment_join.link_components(make_docs(rows), n, percent).collect()}
    assert got == brute(rows, n, percent)


def test_odd_rows(spark, make_docs, odd_rows):
    got = fragment_join.link_components(make_docs(odd_rows), 3, 90).collect()
    assert len(got) == len(odd_rows)
    by_id = {r.doc_id: (r.n_shingles, r.component_id) for r in got}
    want = brute([r for r in odd_rows if r[0] is not None], 3, 90)
    assert {k: v for k, v in by_id.items() if k is not None} == want
    assert by_id[None] == (5, None)
    assert fragment_join.link_components(make_docs([]), 3, 90).count() == 0


def test_one_of_each_group_stays_with_all_columns(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    kept = fragment_join.keep_one(docs, 3, 90)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, d) for d in (1, 2, 3, 4, 5, 7, 9, 11)] + [(True, 0)]


@pytest.mark.parametrize("percent", [30, 50, 80, 90])
def test_linked_sets_share_a_key(percent):
    """The guarantee of the fragments, on random sets around the limit."""
    rng = np.random.default_rng(5)
    table = fragment_join.levels(percent, 4000)
    for _ in range(3000):
        size = int(rng.integers(1, 120))
        x = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
        drop, add = rng.integers(0, max(1, size * (100 - percent) // percent) + 1, 2)
        y = np.unique(np.r_[rng.permutation(x)[: len(x) - drop], rng.integers(0, 2**64, add, dtype=np.uint64)])
        common = len(np.intersect1d(x, y))
        if len(y) and len(np.setxor1d(x, y)) and 100 * common >= percent * (len(x) + len(y) - common):
            keys = [set(fragment_join.meeting_keys(v, table, percent).tolist()) for v in (x, y)]
            assert keys[0] & keys[1]


def test_hardly_any_set_announces_empty_fragments():
    """At 80 percent most sets have empty fragments; their lists would hold most sets."""
    rng, table, many = np.random.default_rng(6), fragment_join.levels(80, 10_000), 0
    for _ in range(1500):
        x = np.unique(rng.integers(0, 2**64, int(rng.integers(60, 3000)), dtype=np.uint64))
        keys = fragment_join.meeting_keys(x, table, 80)
        i = next(i for i, level in enumerate(table) if len(x) <= level.high)
        parts = table[i].parts + (table[i + 1].parts if 100 * len(x) >= 80 * table[i + 1].low else 0)
        many += len(keys) == parts
    assert many < 30


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1000), (None, 5)], "a long, b long")
    got = {r.node: r.component for r in components(links, "a", "b").collect()}
    assert got == {i: 0 for i in range(301)}


def test_tasks_keep_little_of_a_batch_at_once():
    """Sets and packed rows come in parts of a batch, and a word cache holds few words."""
    import pyarrow as pa

    from tillstream.llm.words import WordIds

    texts = [" ".join(f"w{i}_{j}" for j in range(300)) for i in range(5000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(5000)), "text": texts})
    for fn, size in ((fragment_join._names(5), 1000), (fragment_join._describe(5, 80), 1000)):
        parts = [b.num_rows for b in fn(iter([batch]))]
        assert sum(parts) == 5000 and max(parts) <= size
    sums = [sum(sum(c) for c in b.column("counts").to_pylist()) for b in fragment_join._counted(5, 4)(iter([batch]))]
    one = [fragment_join._counted(5, 4)(iter([batch.slice(i, 1)])) for i in range(5000)]
    assert len(sums) > 1 and sum(sums) == sum(sum(sum(c) for c in b.column("counts").to_pylist()) for r in one for b in r)
    assert max(sums) <= fragment_join.COUNTED_KEYS + 300
    assert WordIds.LIMIT <= 200_000


def test_versions_too_far_apart_make_no_pairs(spark, make_docs):
    """Members of one family that differ too much meet in lists, but their pairs are not made."""
    rng, texts = random.Random(7), []
    base = [f"b{i}" for i in range(400)]
    for v in range(40):
        text = list(base)
        for at in rng.sample(range(400), 32):
            text[at] = f"v{v}_{at}"
        near = list(text)
        near[rng.randrange(400)] = f"n{v}"
        texts += [" ".join(text), " ".join(near)]
    rows = [(i, t) for i, t in enumerate(texts)]
    made, old = [], fragment_join._rest
    fragment_join._rest = lambda *a: made.append(old(*a)) or made[-1]
    try:
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in
               fragment_join.link_components(make_docs([*rows, *rows[:5]]), 5, 80).collect()}
    finally:
        fragment_join._rest = old
    assert got == brute(rows, 5, 80) and len({c for _, c in got.values()}) == 40
    assert made[0].count() <= 40


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_prefixes_hold_a_common_gram_of_linked_sets(spark, percent):
    """The guarantee of the prefixes, on random sets around the limit; equal rows count once."""
    rng, sets = np.random.default_rng(8), []
    for _ in range(12):
        x = rng.integers(0, 2**62, int(rng.integers(1, 60)))
        for _ in range(6):
            drop, add = rng.integers(0, max(1, len(x) * (100 - percent) // percent) + 1, 2)
            sets.append(np.unique(np.r_[rng.permutation(x)[: len(x) - drop], rng.integers(0, 2**62, add)]))
    sets = [(i, set(map(int, x))) for i, x in enumerate(sets) if len(x)]
    nodes = spark.createDataFrame([(i, bytes([i]), len(x)) for i, x in sets] * 2, "doc_id long, set_id binary, n_shingles long")
    meetings = spark.createDataFrame([(1, i) for i, _ in sets], "key long, node long")
    segments = spark.createDataFrame([(i, bytes([i]), 0, list(x)) for i, x in sets], "node long, set_id binary, part int, grams array<long>")
    none = spark.createDataFrame([], "node long, component long")
    open_ = fragment_join._open(meetings, none, nodes)
    found = {(r.a, r.b) for r in fragment_join._rest(fragment_join._prefixes(open_, segments, percent), percent).collect()}
    linked = {(a, b) for a, x in sets for b, y in sets if a < b and 100 * len(x & y) >= percent * len(x | y)}
    assert linked and linked <= found
