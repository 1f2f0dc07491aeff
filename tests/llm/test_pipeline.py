"""The stages of the pipeline one after the other, each against a plain version of its rule."""

from __future__ import annotations

import re

import corpus_pipeline
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_fragment_join import brute as groups
from tests.llm.test_mixing import water
from tests.llm.test_secrets_ledger import brute as secret_spans
from tillstream.llm import subword_quality
from tillstream.llm.queries import read


def test_stages_on_the_whole_table(spark, sf):
    docs = read(spark, sf, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf).cache()
        kept[name] = docs.count()
        rows = {r.doc_id: r for r in before.collect()}
        mine = {r.doc_id: r for r in docs.collect()}
        if name != "mix":
            assert docs.columns == before.columns and mine.keys() <= rows.keys()
        if name == "quality":
            predicted = subword_quality.score(before, read(spark, sf, "labels")).where("predicted = 1")
            assert mine.keys() == {r.doc_id for r in predicted.collect()}
        elif name == "near_duplicates":
            # Pairs that share no rare word cannot be similar, so families are compared one by one.
            want = groups([(d, r.text) for d, r in rows.items()], 5, 80)
            assert mine.keys() == {d for d, (_, c) in want.items() if c == d}
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in read(spark, sf, "benchmark").collect()]
            verbatim = {d for d, r in rows.items() if any(
                " ".join(re.findall(r"[^\W_]+", t.lower())) in " ".join(re.findall(r"[^\W_]+", r.text.lower())) for _, t in items)}
            gone = rows.keys() - mine.keys()
            assert verbatim <= gone and all(leaks([(d, rows[d].text)], items) for d in gone)
        elif name == "secrets":
            for d, r in mine.items():
                assert not secret_spans(r.text) and r.n_chars == len(r.text)
                assert (r.text == rows[d].text) == (not secret_spans(rows[d].text))
        else:
            sizes = {}
            for r in rows.values():
                sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
            target = water(sizes)
            assert all(abs(r.target - target[rows[d].source]) < 1e-6 and r.taken > 0 for d, r in mine.items())
    assert list(kept) == ["quality", "near_duplicates", "decontamination", "secrets", "mix"]
    assert 0 < kept["mix"] < kept["secrets"] == kept["decontamination"] < kept["near_duplicates"] < kept["quality"]


def test_run_gives_the_last_stage(spark, sf):
    assert corpus_pipeline.run(spark, sf).columns == ["doc_id", "size", "source_size", "target", "taken"]


def test_odd_rows_pass_through(spark, sf, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, sf)
    assert {r.doc_id for r in docs.collect()} == {4, 5, 7, 9, 11, None}
