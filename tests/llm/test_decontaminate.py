from __future__ import annotations

import random
import re
from collections import Counter

from tillstream.llm import decontaminate


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def grams(w, n=5):
    return [tuple(w[i : i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [tuple(w)] if w else []


def brute(docs, items):
    """Best similarity of any item-sized window, per document and item."""
    out = {}
    for d, t in docs:
        have = grams(words(t))
        for i, u in items:
            want = grams(words(u))
            if not have or not want or d is None or i is None:
                continue
            span, there = min(len(have), len(want)), Counter(want)
            for s in range(len(have) - span + 1):
                here = Counter(have[s : s + span])
                common = sum((here & there).values())
                sim = common / (span + len(want) - common)
                if sim >= 0.8:
                    out[d, i] = max(out.get((d, i), 0), sim)
    return out


def test_leaks_equal_brute_force(spark, make_docs):
    rng = random.Random(9)
    items = [(i, " ".join(f"b{i}_{j}" for j in range(rng.randrange(3, 70)))) for i in range(25)] + [(None, "a b c d e f"), (90, None), (91, " ")]
    docs = [(None, items[4][1]), (500, None), (501, ""), (502, items[7][1]), (502, items[7][1]), (503, "-- ??")]
    for d in range(80):
        i = rng.randrange(25)
        w = items[i][1].split()
        if d % 4 == 1 and len(w) > 30:
            w[rng.randrange(len(w))] = "edited"
        if d % 4 == 2:
            w = w[rng.randrange(3) : len(w) - rng.randrange(3)]
        text = [f"n{rng.randrange(500)}" for _ in range(rng.randrange(40))] + w + [f"n{rng.randrange(500)}" for _ in range(rng.randrange(40))]
        docs.append((d, (" ".join(text)).upper() if d % 3 else ", ".join(text)))
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, h string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.leaks(make_docs(docs), bench).collect()}
    want = brute(docs, items)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_wide_radius_finds_all(spark, make_docs):
    items = [(1, " ".join(f"b{j}" for j in range(60)))]
    text = items[0][1].split()
    docs = [(k, " ".join(text[:k] + ["edit"] + text[k + 1 :])) for k in range(0, 60, 6)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id for r in decontaminate.leaks(make_docs(docs), bench, radius=31).collect()}
    assert got == {d for d, _ in brute(docs, items)}


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(make_docs([(1, "a b c d e f")]), none).count() == 0
    one = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.leaks(make_docs([]), one).count() == 0


def test_beyond_the_broadcast_bound(spark, make_docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_SHINGLES", 0)
    one = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert [tuple(r)[:3] for r in decontaminate.leaks(make_docs([(1, "x a b c d e f")]), one).collect()] == [(1, 1, 1)]


def test_recall_of_the_radius(spark, make_docs):
    """Items of 5 to 70 words, each in many edited forms: 99 in a hundred similar pairs are found, here all."""
    rng = random.Random(11)
    items = [(i, " ".join(f"r{i}_{j}" for j in range(5 + i))) for i in range(66)]
    docs = []
    for i, text in items:
        for _ in range(12):
            w = text.split()
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(w))
                w[at : at + 1] = rng.choice([["edited"], [], ["edited", w[at]]]) if len(w) > 1 else ["edited"]
            docs.append((len(docs), " ".join(["x"] * rng.randrange(4) + w + ["y"] * rng.randrange(4))))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(make_docs(docs), bench).collect()}
    want = brute(docs, items).keys()
    assert got <= want and len(want) > 300 and len(got) >= 0.99 * len(want)


def test_long_texts_and_ties(spark, make_docs):
    """A long text made of benchmark passages alone, in which one item stands many times: the first place counts."""
    items = [(i, " ".join(f"t{i}x{j}" for j in range(12 + i))) for i in range(5)]
    text = " ".join(t for k in range(400) for _, t in items[k % 5 :])
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.start_word, r.similarity) for r in decontaminate.leaks(make_docs([(1, text), (1, text)]), bench).collect()}
    first = {(1, i): (words(text).index(f"t{i}x0"), 1.0) for i, _ in items}
    assert got == first


def test_blocks_meet_within_the_radius(spark):
    """Any fingerprint within the radius of an item's meets it in a block, none beyond it is given."""
    rng = random.Random(5)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    item = rng.getrandbits(64)
    apart = {}
    for d in list(range(30)) * 20:
        bits = sum(1 << b for b in rng.sample(range(64), d))
        apart[signed(item ^ bits)] = d
    windows = spark.createDataFrame([(9, p) for p in apart], "item_size int, print long")
    one = spark.createDataFrame([(7, 9, signed(item), 0)], "item_id long, item_size int, item_print long, firm long")
    for radius in (0, 7, decontaminate.RADIUS):
        got = {r.print for r in decontaminate._near(windows, one, radius).collect()}
        assert got == {p for p, d in apart.items() if d <= radius}


def test_no_pair_is_missed(spark, make_docs):
    """Edited items of 5 to 70 words, some with repeats or words in common, against all comparisons."""
    rng = random.Random(4)
    items = [(i, " ".join(f"b{i}_{j}" for j in range(5 + 3 * i))) for i in range(22)]
    items += [(200 + i, " ".join(rng.choice("abcd") if i % 2 else "a" for _ in range(5 + 6 * i))) for i in range(4)]
    shared = " ".join(f"c{j}" for j in range(40))
    items += [(300 + i, f"{shared} " + " ".join(f"t{i}_{j}" for j in range(i % 9))) for i in range(4)]
    docs = []
    for i, text in items:
        for k in range(6):
            w = text.split()
            for _ in range(1 + (len(w) > 45)):
                at = 0 if k == 0 else len(w) - 1 if k == 1 else rng.randrange(len(w))
                w[at : at + 1] = [["edited"], [], ["edited", w[at]]][k % 3]
            docs.append((len(docs), " ".join(["x"] * rng.randrange(3) + w + ["y", "z"][: rng.randrange(3)])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.leaks(make_docs(docs), bench).collect()}
    want = brute(docs, items)
    assert len(want) > 60 and got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)
    near = decontaminate.leaks(make_docs(docs), bench, radius=11).count()
    assert near < len(want)
