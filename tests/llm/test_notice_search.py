from __future__ import annotations

import random

from tillstream.llm import notice_search as notices

FUZZY = notices.Notice("gpl-3", "licensed under the gnu general public license version 3", 4)


def distance(needle, text):
    """Fewest edits of ``needle`` against any stretch of ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(needle, 1):
        new = [i] + [0] * len(text)
        for j, t in enumerate(text, 1):
            new[j] = min(row[j - 1] + (c != t), row[j] + 1, new[j - 1] + 1)
        row = new
    return min(row)


def test_edits_within_the_bound_are_found(spark, make_docs):
    rng = random.Random(6)
    rows = []
    for d in range(120):
        text = list(FUZZY.words)
        for _ in range(rng.randrange(0, 8)):
            at = rng.randrange(len(text))
            rng.choice([lambda: text.__setitem__(at, "q"), lambda: text.pop(at), lambda: text.insert(at, "q")])()
        rows.append((d, f"some words {''.join(text)} and more"))
    got = {r.doc_id: r.matches for r in notices.find_notices(make_docs(rows), (), (FUZZY,)).collect()}
    for d, text in rows:
        line = f" {b' '.join(notices.words_of(text.encode())).decode()} "
        assert bool(got[d]) == (distance(FUZZY.needle, line) <= FUZZY.errors), text
        for m in got[d]:
            words = line.split()
            assert " ".join(words[m.first_word : m.last_word + 1]).startswith(m.text.split()[0][:1]) and m.errors <= FUZZY.errors


def test_base_phrases_equal_brute_force(spark, make_docs, odd_rows):
    rows = [*odd_rows, (30, "CC-BY-NC cc by nc; Under The MIT License. under the mit licenses"), (31, "cc by nc cc by nc by nc"),
            (32, "Apache License, Version 2.0 é under the mit license")]
    for r in notices.find_notices(make_docs(rows), notices.BASE, ()).collect():
        text = next(t for d, t in rows if d == r.doc_id)
        words = notices.words_of((text or "").encode())
        want = sorted((i, n.label) for n in notices.BASE for i in range(len(words))
                      if words[i : i + len(n.words.split())] == n.words.encode().split())
        assert r.n_words == len(words) and sorted((m.first_word, m.label) for m in r.matches) == want


def test_empty_table(spark, make_docs):
    assert notices.find_notices(make_docs([])).count() == 0


def test_edited_notices_beside_better_ones(spark, make_docs):
    """No place hides another of the same notice beside it; equal places are given once."""
    notice = notices.Notice("mit", "released under the mit license", 3)
    edited, exact, far = "released under the mit licence", notice.words, "relased undr the mit licence"
    rows = [(1, f"{edited} {exact} foo"), (2, f"{exact} {edited} {exact}"), (3, f"{edited} {edited} x {far} {exact}"), (4, far),
            (5, " ".join([edited, exact] * 3000))]
    got = {r.doc_id: [(m.first_word, m.last_word, m.errors) for m in r.matches]
           for r in notices.find_notices(make_docs(rows), (), (notice,)).collect()}
    assert got[1] == [(0, 4, 1), (5, 9, 0)]
    assert got[2] == [(0, 4, 0), (5, 9, 1), (10, 14, 0)]
    assert got[3] == [(0, 4, 1), (5, 9, 1), (11, 15, 3), (16, 20, 0)]
    assert got[4] == [(0, 4, 3)]
    assert got[5] == [(5 * i, 5 * i + 4, 1 - i % 2) for i in range(6000)]
