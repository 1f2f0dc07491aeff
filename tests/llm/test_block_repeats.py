from __future__ import annotations

import hashlib
import random

from tillstream.llm import block_repeats


def brute(rows, window):
    first, out = {}, []
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for d, words in split:
        for i in range(len(words) - window + 1):
            g = tuple(words[i : i + window])
            if d is not None:
                first[g] = min(first.get(g, d), d)
    for d, words in split:
        gone = set()
        for i in range(len(words) - window + 1):
            if d is not None and first[tuple(words[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((d, len(words), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out, key=str)


def test_planted_repeats_equal_brute_force(spark, make_docs, monkeypatch):
    monkeypatch.setattr(block_repeats, "GROUP_KEYS", 500)
    rng = random.Random(3)
    passages = [[f"p{k}_{i}" for i in range(rng.choice([12, 13, 14, 20, 60]))] for k in range(12)]
    rows = []
    for d in range(150):
        words = []
        for _ in range(rng.randrange(1, 5)):
            words += [f"u{rng.randrange(40)}" for _ in range(rng.randrange(0, 30))] + rng.choice(passages)
        rows.append((d, "\n".join(words) if d % 2 else " ".join(words)))
    rng.shuffle(rows)
    got = sorted(map(tuple, block_repeats.remove_repeats(make_docs(rows).repartition(7), 13, with_text=True).collect()), key=str)
    assert got == brute(rows, 13)


def test_odd_rows(spark, make_docs, odd_rows):
    got = sorted(map(tuple, block_repeats.remove_repeats(make_docs(odd_rows), 5, with_text=True).collect()), key=str)
    assert got == brute(odd_rows, 5)
    assert block_repeats.remove_repeats(make_docs([]), 13).count() == 0
