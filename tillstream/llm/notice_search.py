"""Fuzzy search of short licence notices.

A notice with at most ``k`` edits, cut into ``k + 1`` pieces, holds at least one piece unchanged.
All pieces of all notices are searched at once with one automaton; around each piece found, the
``regex`` library matches the whole notice with bounded errors and gives span and edits. Of places of
one notice that overlap in more than the blank between them the one with fewer edits counts. Notices
without allowed edits are their own only piece. Words are runs of letters and digits (A-Z in lower
case; everything beyond ASCII counts as a letter), joined by one space for the search.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass
from functools import cached_property

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tillstream.llm.words import Batches, texts


@dataclass(frozen=True)
class Notice:
    """Words of a notice in lower case, and how many characters may differ."""

    label: str
    words: str
    errors: int = 0

    @property
    def needle(self) -> str:
        return f" {self.words} "

    @cached_property
    def pieces(self) -> list[tuple[int, str]]:
        """(offset, text) of ``errors + 1`` pieces of about equal length."""
        text, n = self.needle, self.errors + 1
        edges = [len(text) * i // n for i in range(n + 1)]
        return [(a, text[a:b]) for a, b in zip(edges, edges[1:])]


#: Phrases and labels that the result must name (fixed values).
BASE = (
    Notice("mit", "under the mit license"),
    Notice("apache-2", "apache license version 2"),
    Notice("cc-by-nc", "cc by nc"),
)
#: Short notices in public use, searched with edits.
MORE = (
    Notice("mit", "released under the mit license", 3),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    Notice("apache-2", "licensed under the apache license version 2", 4),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification", 6),
    Notice("gpl-3", "licensed under the gnu general public license version 3", 4),
    Notice("gpl-2", "licensed under the gnu general public license version 2", 4),
    Notice("mpl-2", "subject to the terms of the mozilla public license v 2 0", 4),
    Notice("cc-by-sa", "licensed under a creative commons attribution sharealike", 4),
    Notice("cc-by-nc", "licensed under cc by nc 4 0", 2),
)
_LETTERS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
MATCH = "struct<label: string, base: boolean, first_word: long, last_word: long, errors: int, score: double, text: string>"


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_LETTERS).split()


class Searcher:
    """Automaton over the pieces of all notices, and a pattern with bounded errors for each."""

    def __init__(self, notices: tuple[Notice, ...], exact: int):
        self.notices, self.exact = notices, exact
        by_piece: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(notices):
            for offset, piece in notice.pieces:
                by_piece.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in by_piece.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()
        self.patterns = [
            regex.compile(f"(?b)(?:{regex.escape(n.needle)}){{e<={n.errors}}}") if n.errors else None for n in notices]

    def windows(self, line: str) -> dict[int, set[int]]:
        """Where a notice would start in ``line`` if the piece found stood at its place, by notice."""
        found: dict[int, set[int]] = {}
        for end, (length, uses) in self.automaton.iter(line):
            for i, offset in uses:
                found.setdefault(i, set()).add(end + 1 - length - offset)
        return found

    def places(self, line: str, i: int, starts: set[int]) -> list[tuple[int, int, int]]:
        """(start, end, errors) of a notice around the places of its pieces, in order.

        Each is matched in a stretch of its own, so no match hides another that lies beside it.
        """
        notice, pattern = self.notices[i], self.patterns[i]
        size, k = len(notice.needle), notice.errors
        if pattern is None:
            return [(s, s + size, 0) for s in sorted(starts)]
        matches = (pattern.search(line, max(0, s - k), s + size + k) for s in starts)
        kept: list[tuple[int, int, int]] = []
        for errors, start, end in sorted({(sum(m.fuzzy_counts), m.start(), m.end()) for m in matches if m}):
            at = bisect_left(kept, (start, end, errors))
            if (at == 0 or kept[at - 1][1] - 1 <= start) and (at == len(kept) or end - 1 <= kept[at][0]):
                insort(kept, (start, end, errors))
        return kept

    def search(self, words: list[bytes]) -> list[dict]:
        line = f" {b' '.join(words).decode('utf-8', 'replace')} "
        out = []
        for i, starts in self.windows(line).items():
            notice = self.notices[i]
            at = blanks = 0
            for start, end, errors in self.places(line, i, starts):
                inner = line[start:end].strip()
                begin = start + (line[start : start + 1] == " ")
                # Blanks are counted on from the place before; two places share one blank at most.
                blanks += line.count(" ", at, begin) if begin >= at else -line.count(" ", begin, at)
                at, first = begin, blanks - 1
                out.append({
                    "label": notice.label, "base": i < self.exact, "first_word": first,
                    "last_word": first + inner.count(" "), "errors": errors,
                    "score": max(0.0, 1 - errors / len(notice.needle)), "text": inner})
        out.sort(key=lambda m: (m["first_word"], m["last_word"], m["label"], not m["base"]))
        return out


def _search(notices: tuple[Notice, ...], exact: int):
    def run(batches: Batches) -> Batches:
        searcher = Searcher(notices, exact)
        kind = pa.list_(pa.struct([
            ("label", pa.string()), ("base", pa.bool_()), ("first_word", pa.int64()), ("last_word", pa.int64()),
            ("errors", pa.int32()), ("score", pa.float64()), ("text", pa.string())]))
        for batch in batches:
            words = [words_of(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(w) for w in words], pa.int64()),
                 pa.array([searcher.search(w) for w in words], kind)], ["doc_id", "n_words", "matches"])

    return run


def find_notices(docs: DataFrame, base: tuple[Notice, ...] = BASE, more: tuple[Notice, ...] = MORE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words`` and ``matches``, an array of the places
    with label, first and last word, edits, score (1 less the share of edits) and matched words.

    Null, empty and blank texts have no words and no matches. Repeated rows give repeated results;
    nothing depends on other rows. Further columns of ``docs`` are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _search(base + more, len(base)), f"doc_id {kind}, n_words long, matches array<{MATCH}>")
