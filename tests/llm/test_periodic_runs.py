from __future__ import annotations

import random
import zlib

import pytest

from tillstream.llm import periodic_runs
from tillstream.llm.queries import planted_periods


def brute(words, minimum=6, exponent=4):
    """All runs by trying every period over the whole text."""
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        start = 0
        while start < n - q:
            end = start
            while end < n - q and words[end] == words[end + q]:
                end += 1
            length = end - start + q
            if end > start and length >= max(minimum, exponent * q):
                found.setdefault((start, length), q)
            start = end + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def collapse(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def results(df):
    return [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.text) for r in df.collect()]


def words_of(rng):
    """Random words over small alphabets, with planted, nested and broken repetitions."""
    kind, n = rng.randrange(5), rng.randrange(0, 120)
    letters = [f"w{i}" for i in range(rng.choice([1, 2, 3, 30]))]
    words = [rng.choice(letters) for _ in range(n)]
    if kind == 1:
        part = [rng.choice(letters) for _ in range(rng.randrange(1, 12))]
        words = words[: n // 3] + part * rng.randrange(3, 9) + part[: rng.randrange(len(part))] + words[n // 3 :]
    if kind == 2:
        inner = [rng.choice(letters)] * rng.randrange(5, 9)
        words = (inner + ["x"]) * rng.randrange(3, 6) + words
    if kind == 3 and words:
        words = words * 5
        words[rng.randrange(len(words))] = "broken"
    if kind == 4:
        a, b = ["a"], ["a", "b"]
        for _ in range(7):
            a, b = b, b + a  # Fibonacci words: squares and cubes everywhere, no fourth powers
        words += b
    return words


def test_runs_equal_brute_force():
    rng = random.Random(7)
    texts = [words_of(rng) for _ in range(600)]
    for size in (1, 40, 600):
        for at in range(0, 600, size):
            part = texts[at : at + size]
            got = periodic_runs.chunk_runs([[w.encode() for w in t] for t in part], 6, 4)
            assert [list(map(tuple, g.tolist())) for g in got] == [brute(t) for t in part]
    assert sum(map(len, map(brute, texts))) > 200


def test_other_exponents_and_lengths():
    rng = random.Random(8)
    for minimum, exponent in ((1, 4), (12, 5), (6, 7)):
        for _ in range(150):
            t = words_of(rng)
            got = periodic_runs.chunk_runs([[w.encode() for w in t]], minimum, exponent)[0]
            assert list(map(tuple, got.tolist())) == brute(t, minimum, exponent)
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(None, exponent=3)


def test_documents(spark, make_docs, monkeypatch):
    monkeypatch.setattr(periodic_runs, "CHUNK", 300)
    rng = random.Random(9)
    rows = [(d, "  ".join(words_of(rng))) for d in range(200)]
    got = results(periodic_runs.periodic_runs(make_docs(rows).repartition(5)))
    want = [(d, len(t.split()), brute(t.split()), collapse(t.split(), brute(t.split()))) for d, t in rows]
    assert sorted(got) == sorted(want)


def test_odd_rows(spark, make_docs, odd_rows):
    rows = [*odd_rows, (20, "z " * 100_000), (20, "z " * 100_000), (21, "a\x0bb " * 4)]
    got = {(r[0], r[1]): r for r in results(periodic_runs.periodic_runs(make_docs(rows)))}
    assert len(results(periodic_runs.periodic_runs(make_docs(rows)))) == len(rows)
    for d, t in rows[:-3]:
        words = [w.decode() for w in (t or "").encode().split()]
        want = [] if len(words) > 1000 else brute(words)
        if len(words) <= 1000:
            assert got[d, len(words)][2:] == (want, collapse(words, want)), d
    assert got[20, 100_000][2:] == ([(0, 100_000, 1)], "z")
    assert got[21, 8][2:] == ([(0, 8, 2)], "a b")
    assert results(periodic_runs.periodic_runs(make_docs([]))) == []


def test_long_period_in_a_long_text(spark, make_docs):
    part = [f"u{i}" for i in range(20_000)]
    text = " ".join(["head", *part * 4, "tail"])
    (row,) = results(periodic_runs.periodic_runs(make_docs([(1, text)])))
    assert row[2] == [(1, 80_000, 20_000)] and row[3] == " ".join(["head", *part, "tail"])


def test_planted_periods(spark, make_docs, odd_rows):
    rng = random.Random(10)
    rows = [(d, " ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(0, 90)))) for d in range(300)]
    got = dict(map(tuple, planted_periods(make_docs(rows)).collect()))
    changed = 0
    for d, text in rows:
        words, h = text.split(), zlib.crc32(str(d).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            changed += 1
        assert got[d].split() == words, d
    assert changed > 10
    assert planted_periods(make_docs(odd_rows)).count() == len(odd_rows)
