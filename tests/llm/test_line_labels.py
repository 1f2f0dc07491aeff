from __future__ import annotations

import itertools
import re
from collections import Counter

import numpy as np

from tillstream.llm import line_labels
from tillstream.llm.queries import QUERIES, read


def chain(seed, n):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n, 2)), rng.normal(size=(2, 2))


def value(scores, moves, labels):
    return sum(scores[i, y] for i, y in enumerate(labels)) + sum(moves[a, b] for a, b in zip(labels, labels[1:]))


def test_viterbi_and_marginals_equal_enumeration():
    for seed in range(30):
        scores, moves = chain(seed, 1 + seed % 7)
        every = list(itertools.product((0, 1), repeat=len(scores)))
        values = np.array([value(scores, moves, y) for y in every])
        assert tuple(line_labels.viterbi(scores, moves)) == every[values.argmax()]
        share = np.exp(values - values.max())
        share /= share.sum()
        single, pairs = line_labels.marginals(scores, moves)
        for i in range(len(scores)):
            assert np.isclose(single[i, 1], sum(p for p, y in zip(share, every) if y[i]))
        want = np.zeros((2, 2))
        for p, y in zip(share, every):
            for a, b in zip(y, y[1:]):
                want[a, b] += p
        assert np.allclose(pairs, want)


def test_chains_side_by_side_equal_single_ones():
    lengths = np.array([6, 6, 3, 1, 1])
    parts = [chain(50 + i, n)[0] for i, n in enumerate(lengths)]
    moves = chain(60, 1)[1]
    weight = np.array([0.5, 1.0, 2.0, 3.0, 1.0])
    single, pairs = line_labels.Chains(lengths).expect(np.concatenate(parts), moves, weight)
    alone = [line_labels.marginals(x, moves) for x in parts]
    assert np.allclose(single, np.concatenate([p for p, _ in alone]))
    assert np.allclose(pairs, sum(w * q for w, (_, q) in zip(weight, alone)))


def test_expected_labels_meet_the_shares_and_move_no_further():
    lengths, settings = np.array([7, 5, 5, 2]), line_labels.Settings()
    scores = np.concatenate([chain(70 + i, n)[0] for i, n in enumerate(lengths)])
    moves, chains = chain(80, 1)[1], line_labels.Chains(lengths)
    sizes = np.arange(1.0, 20.0)
    good = np.array([True, False, True, False])
    single, _ = line_labels.expected_labels(chains, scores, moves, sizes, good, np.ones(4), settings)
    free, _ = chains.expect(scores, moves, np.ones(4))
    share, before = (chains.total(sizes * p[:, 1]) / chains.total(sizes) for p in (single, free))
    for i, is_good in enumerate(good):
        limit = settings.good_share if is_good else settings.poor_share
        if (before[i] >= limit) == is_good:
            assert np.isclose(share[i], before[i])
        else:
            assert abs(share[i] - limit) < 0.02


def planted(n=60):
    """Good documents of prose between a head and a foot that all share; poor ones of symbols behind a line of prose."""
    rng = np.random.default_rng(5)

    def prose(k):
        return " ".join("".join(rng.choice(list("aeioustrnl"), rng.integers(2, 9))) for _ in range(k)) + "."

    docs, want = [], []
    for i in range(1, n + 1):
        if i % 3:
            body = [prose(rng.integers(12, 40)) for _ in range(rng.integers(3, 8))]
            docs.append((i, "\n".join(["Home of all our news", *body, "Sign up for our letter today"])))
            want.append("B" + "C" * len(body) + "B")
        else:
            junk = [" ".join(w + "***" for w in prose(30).split()) for _ in range(rng.integers(3, 6))]
            docs.append((i, "\n".join([prose(15), *junk])))
            want.append("C" + "B" * len(junk))
    return docs, want


def test_lines_of_one_document_get_their_own_labels(spark, make_docs):
    docs, want = planted()
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i, _ in docs], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in line_labels.judge(make_docs(docs), labels).collect()}
    pairs = [(a, b) for (i, _), w in zip(docs, want) for a, b in zip(got[i].line_labels, w, strict=True)]
    assert sum(a == b for a, b in pairs) >= 0.95 * len(pairs)
    assert all(got[i].kept is (i % 3 > 0 and not got[i].base_failed) for i, _ in docs)


def test_spread_equals_brute_force(spark, make_docs):
    rng = np.random.default_rng(9)
    body = [(i, "\n".join(rng.choice(["a", "b", "C", "", " a ", "d e", "f"], rng.integers(1, 7)))) for i in range(80)]
    docs = body + [(100 + i, body[3][1]) for i in range(20)] + [(200, None), (201, "")]
    rows = line_labels.measured(make_docs(docs).select("doc_id", "text"))
    spread = line_labels.spread_lines(rows, 64).collect()
    got = {r.text_key: {s.key: s.spread for s in r.spread} for r in spread}
    before, after, holds = {}, {}, Counter()
    for text in {t or "" for _, t in docs}:
        full = [s for line in text.split("\n") if (s := line.strip())]
        for line in set(full):
            i = full.index(line)
            near = [full[j] for j in (i - 1, i + 1) if 0 <= j < len(full)] or [None]
            holds[line] += 1
            before.setdefault(line, set()).add(near[0])
            after.setdefault(line, set()).add(near[-1])
    want = {}
    for line, n in holds.items():
        least = min(len(before[line]), len(after[line]))
        if least > 1:
            want[line] = min(1, np.log2(least) / 6) * least / n
    assert want
    known = {r.doc_id: (r.text_key, r.lines) for r in rows.collect()}
    for i, text in docs:
        key, numbers = known[i]
        for line, number in zip((text or "").split("\n"), numbers, strict=True):
            assert np.isclose(got.get(key, {}).get(number, 0), want.get(line.strip(), 0))


def test_one_labelled_document_repeated_many_times_is_one_row(spark, make_docs):
    docs = make_docs([(1, "a b c\nd e")] * 500 + [(2, "x y z")])
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    rows = line_labels.judge(docs, labels, line_labels.Settings(sample=3)).collect()
    assert len(rows) == 501 and len({(r.line_labels, r.content_share) for r in rows if r.doc_id == 1}) == 1


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        duplicates += line in seen and bool(re.search(r"[^\x20\x09-\x0D]", line))
        seen.add(line)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(inside), failed


def rules(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_counts_equal_brute_force_on_whole_table(spark, sf):
    text = {r.doc_id: r.text for r in read(spark, sf, "documents").select("doc_id", "text").collect()}
    rows = QUERIES["op8_quality_rules"](spark, sf).collect()
    assert all(rules(r) == base(text[r.doc_id]) and not (r.kept and r.base_failed) for r in rows)
    good = {r.doc_id for r in read(spark, sf, "labels").where("quality = 1").collect()}
    sound = [r for r in rows if r.doc_id in good and not r.base_failed]
    assert sum(r.kept for r in sound) >= 0.97 * len(sound)
    many = [set(r.line_labels) for r in line_labels.judge(
        read(spark, sf, "documents"), read(spark, sf, "labels")).collect() if len(r.line_labels) > 1]
    assert sum(len(kinds) > 1 for kinds in many) >= 0.1 * len(many)
    poor = {r.doc_id for r in read(spark, sf, "labels").where("quality = 0").collect()}
    assert sum(r.kept for r in rows if r.doc_id in poor) <= 0.2 * len(poor)


def test_odd_rows(spark, make_docs, odd_rows):
    labels = spark.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int")
    rows = line_labels.judge(make_docs(odd_rows), labels).collect()
    text = {r[0]: r[1] for r in odd_rows}
    assert len(rows) == len(odd_rows) and all(rules(r) == base(text[r.doc_id]) for r in rows)
    assert all(r.kept is not r.base_failed for r in rows)
    assert line_labels.judge(make_docs([]), labels).count() == 0
