from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tillstream.llm import importance_draw as draw


def features(text, longest):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return len(w), [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute(rows, target, percent, min_words, longest, buckets, seed):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    split = [(d, *features(t, longest)) for d, t in rows]
    s = Counter(bucket(f) for _, _, fs in split for f in fs)
    t = Counter(bucket(f) for x in target for f in features(x, longest)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    out = []
    for d, n, fs in split:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
                     for b in map(bucket, fs))
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append((d, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    pool = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    taken = pool[: percent * len(pool) // 100]
    rest = pool[len(taken):] + [r for r in out if r[1] < min_words]
    return sorted([(*r, k + 1) for k, r in enumerate(taken)] + [(*r, None) for r in rest], key=str)


def result(docs, target, **args):
    return sorted(map(tuple, draw.resample(docs, target, **args).collect()), key=str)


@pytest.mark.parametrize("longest", [1, 3])
@pytest.mark.parametrize("last", [3, 10_000])
def test_draw_equals_brute_force(spark, make_docs, monkeypatch, longest, last):
    for name, value in (("LAST", last), ("BLOCK", 16), ("PIECE", 20), ("REMEMBERED", 50), ("COPIES", 4)):
        monkeypatch.setattr(draw, name, value)
    rng = random.Random(longest)
    text = lambda: rng.choice([" ", ", ", "-"]).join(f"Wörd{rng.randrange(60)}" for _ in range(rng.randrange(0, 40)))
    rows = [(d, text()) for d in range(400)] + [(7, "same words " * 12)] * 150 + [(None, "no name " * 9)] * 3
    target = ["wörd1 wörd2 wörd3 " * 5, "same", None, ""]
    args = dict(percent=35, min_words=5, longest=longest, buckets=101, seed=3)
    got = result(make_docs(rows).repartition(6), spark.createDataFrame([(t,) for t in target], "text string"), **args)
    assert got == brute(rows, target, **args)


def test_cutoff_inside_copies_of_one_row(spark, make_docs):
    rows = [(1, "only words here")] * 50 + [(2, None)] * 5
    got = result(make_docs(rows), spark.createDataFrame([("words",)], "text string"), min_words=1, percent=30)
    assert sorted(r[5] for r in got if r[5]) == list(range(1, 16)) and len(got) == 55


def test_odd_rows(spark, make_docs, odd_rows):
    target = spark.createDataFrame([("w1x1 one \U0001F600",)], "text string")
    args = dict(percent=50, min_words=0, longest=2, buckets=50, seed=1)
    assert result(make_docs(odd_rows), target, **args) == brute(odd_rows, ["w1x1 one \U0001F600"], **args)
    assert result(make_docs([]), target) == []
    assert [r[5] for r in result(make_docs([(1, "a b")]), target.where("false"))] == [None]


def test_cutoff_key_of_every_rank(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(-5, 5), k, 0, rng.choice([1, 1, 1, 9])) for k in range(60)]
    pool = spark.createDataFrame(rows, "k1 bigint, k2 bigint, k3 bigint, copies bigint").repartition(4)
    expanded = [r[:3] for r in sorted(rows) for _ in range(r[3])]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(draw, "LAST", 0)
        patch.setattr(draw, "BLOCK", 8)
        for need in (1, 2, 40, len(expanded) // 2, len(expanded)):
            key, taken = draw.cutoff(pool, need)
            assert key == expanded[need - 1] and taken == expanded[:need].count(key)


def test_a_round_leaves_at_most_three_quarters():
    rng = np.random.default_rng(1)
    for _ in range(30):
        blocks = [np.sort(rng.integers(0, 10**6, rng.integers(1, 400))) for _ in range(20)]
        keys = [np.stack([b, np.arange(len(b)), np.zeros(len(b), int)], 1) for b in blocks]
        sizes, medians = zip(*[draw._median(k, np.ones(len(k), np.int64)) for k in keys])
        pivot = draw._weighted_median(np.array(medians), np.array(sizes))
        below = sum(draw._before(k, pivot) for k in keys)
        assert 0.25 * sum(sizes) - 20 <= below <= 0.75 * sum(sizes) + 20
