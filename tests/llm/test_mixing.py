from __future__ import annotations

import random
from collections import defaultdict

import pytest

from tillstream.llm import mixing


def water(sizes, limit=3.0):
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    target, open_ = {s: 0.0 for s in sizes}, set(sizes)
    left = float(sum(sizes.values()))
    while left > 1e-9 and open_:
        share = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in sorted(open_, key=str):
            target[s] += share * weight[s]
        for s in list(open_):
            if target[s] >= limit * sizes[s]:
                left += target[s] - limit * sizes[s]
                target[s] = limit * sizes[s]
                open_.discard(s)
    return target


def test_targets_and_taken_words(spark, make_docs):
    rng = random.Random(4)
    rows, d = [], 0
    for source, n in [("b", 900), ("a", 30), ("é", 200), ("Z", 1), (None, 50), ("", 10), ("c", 300)]:
        for _ in range(n):
            rows.append((d, "w " * rng.choice([0, 1, 5, 50, rng.randrange(1, 400)]), source))
            d += 1
    docs = make_docs(rows)
    got = mixing.mix(docs).collect()
    size, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    source = {r[0]: r[2] for r in rows}
    for r in got:
        s = source[r.doc_id]
        size[s] += r.size
        taken[s] += r.taken
        longest[s] = max(longest[s], r.size)
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    want = water(size)
    for r in got:
        assert r.source_size == size[source[r.doc_id]] and r.target == pytest.approx(want[source[r.doc_id]])
    for s in size:
        assert abs(taken[s] - want[s]) <= longest[s] / 2 + 1e-6
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def expected_copies(sizes, target):
    """Copies by size: whole ones for all, then in proportion to binary digits, none above one more."""
    total = sum(sizes)
    whole = target // total
    rest, certain = target - whole * total, set()
    while True:
        parts = sum(s.bit_length() * s for s in sizes if s not in certain)
        factor = (rest - sum(s for s in sizes if s in certain)) / parts
        over = {s for s in sizes if s not in certain and factor * s.bit_length() >= 1}
        if not over:
            return {s: whole + (1 if s in certain else factor * s.bit_length()) for s in sizes}
        certain |= over


def test_inclusion_rates_over_seeds(spark, make_docs):
    """The mean copies of a document follow its own odds, source by source and size by size."""
    rows = [(d, "w " * (1, 3, 40, 500)[d % 4], "ab"[d % 5 < 2]) for d in range(600)]
    size = {d: len(t.split()) for d, t, _ in rows}
    of = {d: s for d, _, s in rows}
    seen, target, seeds = defaultdict(list), {}, 12
    for seed in range(seeds):
        for r in mixing.mix(make_docs(rows), seed=seed).collect():
            seen[of[r.doc_id], r.size].append(r.taken / r.size)
            target[of[r.doc_id]] = r.target
    unequal = 0
    for s in "ab":
        want = expected_copies([size[d] for d in of if of[d] == s], target[s])
        unequal += len({round(w, 6) for w in want.values()}) > 1
        for n, copies in want.items():
            got = seen[s, n]
            assert abs(sum(got) / len(got) - copies) < 4 * 0.5 / len(got) ** 0.5 + 0.01
            assert {int(copies), -int(-copies // 1)} >= set(got)
    assert unequal == 2


def test_equal_rows_are_drawn_one_by_one(spark, make_docs, monkeypatch):
    monkeypatch.setattr(mixing, "PIECE", 7)
    rows = [(1, "one two three", "b")] * 300 + [(d, "four five", "a") for d in range(2, 400)] + [(None, None, None)] * 9
    got = mixing.mix(make_docs(rows)).collect()
    assert len(got) == len(rows)
    for s, ids in (("b", {1}), ("a", set(range(2, 400)))):
        mine = [r for r in got if r.doc_id in ids]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 1.5
    assert len({r.taken for r in got if r.doc_id == 1}) == 2


def test_odd_rows(spark, make_docs, odd_rows):
    got = mixing.mix(make_docs(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    assert all((r.size, r.taken) == (0, 0) for r in got if r.doc_id in (1, 2, 3))
    assert all(r.target == r.source_size and r.taken == r.size for r in got)
    assert mixing.mix(make_docs([])).count() == 0
    blank = mixing.mix(make_docs([(1, None, None), (2, "", "a")])).collect()
    assert all((r.source_size, r.target, r.taken) == (0, 0.0, 0) for r in blank)
