from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from tillstream.llm import subword_quality as quality
from tillstream.llm.queries import QUERIES, read


def test_held_out_accuracy(spark, sf):
    rows = QUERIES["op2_quality"](spark, sf).join(read(spark, sf, "labels"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert len(held) > 40 and sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_only_text_and_learned_folds_count(spark, sf):
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    want = {r.doc_id: r.score for r in quality.score(docs, labels).collect()}
    turned = labels.withColumn("quality", F.when(quality.fold_of() == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")})
    assert {r.doc_id: r.score for r in quality.score(other, turned).collect()} == want


def test_odd_rows_and_missing_labels(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (None, 0, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality.score(docs, labels).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    none = quality.score(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.score(make_docs([]), labels).count() == 0
    kept = quality.keep_good(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == len(odd_rows)


def test_middle_of_a_long_word_counts(monkeypatch):
    settings = quality.Settings()
    a, b = (b"x" * 50 + middle * 40 + b"y" * 50 for middle in (b"good", b"poor"))
    # All features but the hash of the whole word.
    inner = [{int(i) for f, _ in list(quality.word_features([w], settings))[1:] for i in f} for w in (a, b)]
    assert len(inner[0] - inner[1]) > 5 and len(inner[1] - inner[0]) > 5
    whole = sum(len(f) for f, _ in quality.word_features([a], settings))
    assert whole == 1 + sum(len(a) + 2 - n + 1 for n in (3, 4, 5))
    long = [b"ab", a, b"c", b]
    want = [quality.features(b" ".join(w), settings) for w in ([a], long)]
    monkeypatch.setattr(quality, "PIECE", 16)
    for w, (used, share) in zip(([a], long), want):
        got = quality.features(b" ".join(w), settings)
        assert (got[0] == used).all() and abs(got[1] - share).max() < 1e-12
    weights = np.random.default_rng(1).normal(size=settings.buckets)
    cut = quality._Sums(weights, settings)
    cut.learn([long])
    monkeypatch.undo()
    full = quality._Sums(weights, settings)
    full.learn([long])
    for w in long:
        assert cut.counts[cut[w]] == full.counts[full[w]] and abs(cut.sums[cut[w]] - full.sums[full[w]]) < 1e-9


def test_a_labelled_id_with_many_rows_is_one_training_row(spark, make_docs):
    docs = make_docs([(4, "good text")] * 400 + [(4, "another text"), (6, "bad"), (9, None)])
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, 0), (9, 0, 0)], "doc_id long, quality int, toxic int")
    rows = quality.training_rows(docs, labels, quality.Settings(sample=2))
    labelled = [d for d in (4, 6, 9) if zlib.crc32(str(d).encode()) % 5]
    assert sorted(r.doc_id for r in rows.collect()) == labelled
    assert all(bytes(r.text) == b"another text" for r in rows.collect() if r.doc_id == 4)


def test_scores_equal_a_plain_average(spark, make_docs):
    """The score of a text from its features one by one, against the sums per word."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" * int(rng.integers(1, 4)) for i in range(60)]
    rows = [(d, " ".join(rng.choice(words[:40] if d % 2 else words[20:], int(rng.integers(0, 80))))) for d in range(120)]
    labels = spark.createDataFrame([(d, d % 2, 0) for d in range(100)], "doc_id long, quality int, toxic int")
    settings = quality.Settings()
    sample = [(t.encode(), d % 2) for d, t in rows if d < 100 and zlib.crc32(str(d).encode()) % 5]
    weights, bias = quality.train(sample, settings)
    got = {r.doc_id: r.score for r in quality.score(make_docs(rows), labels).collect()}
    for d, text in rows:
        found, share = quality.features(text.encode(), settings)
        want = 1 / (1 + np.exp(-(bias + float(share @ weights[found]))))
        assert abs(got[d] - want) < 1e-9, d
