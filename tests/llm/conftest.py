from __future__ import annotations

import pytest
from pyspark.sql import types as T

from tillstream.llm import scratch

#: Columns that operators use inside, as they may also come with the input.
CLASHING = ["node", "key", "keys", "size", "score", "found", "row", "blob", "copy", "hits", "label", "b"]


@pytest.fixture(autouse=True)
def own_folder(tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "folder", lambda spark: f"file://{tmp_path}")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with the given (doc_id, text, source) and further columns with clashing names."""
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in CLASHING]])

    def make(rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), *["x"] * len(CLASHING))
                for r in rows]
        return spark.createDataFrame(full, schema)

    return make


LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(60_000))


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, blank, short, repeated and very long texts; a null id; equal rows."""
    return [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one two"), (6, "one two"), (7, LONG), (8, LONG),
            (9, "a b c d e f g"), (9, "a b c d e f g"), (None, "a b c d e f g"), (11, "\U0001F600 é\x0bñ x")]
