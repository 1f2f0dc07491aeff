"""Tokenised text match.

Tokens are lower-cased runs of letters and digits; each Han, Kana or Hangul character is a
token of its own, so one character matches inside a longer text.
"""

from __future__ import annotations

from functools import reduce

import regex
from pyspark.sql import Column, functions as F

# Script ranges cut into single characters, and the token separators.
SINGLE = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]"
SEPARATOR = r"[^\p{L}\p{M}\p{N}]+"
# A character that continues a token (Java syntax), and the single characters in Python syntax.
WORD = r"[\p{L}\p{M}\p{N}&&[^" + SINGLE[1:-1] + "]]"
SINGLE_PY = SINGLE.replace("Is", "Script=")


def tokens(text: Column) -> Column:
    """Array of distinct tokens of a text column; empty for null or blank text."""
    spaced = F.regexp_replace(F.lower(text), f"({SINGLE})", " $1 ")
    words = F.array_remove(F.split(spaced, SEPARATOR), "")
    return F.coalesce(F.array_distinct(words), F.array().cast("array<string>"))


def keyword_terms(keyword: str | None) -> list[str]:
    """The keyword cut by the same rules, once, when the query is built."""
    spaced = regex.sub(f"({SINGLE_PY})", r" \1 ", (keyword or "").lower())
    return list(dict.fromkeys(t for t in regex.split(SEPARATOR, spaced) if t))


def has_token(text: Column, term: str) -> Column:
    """True where the lower-case ``term`` is one of the text's tokens.

    The text is searched, not cut: first for the plain substring, which drops most rows
    cheaply, then for an occurrence with no word character on either side.
    """
    low = F.lower(text)
    if regex.fullmatch(SINGLE_PY, term):
        return low.contains(term)
    literal = rf"\Q{term}\E"
    return low.contains(term) & low.rlike(rf"{literal}(?!{WORD})(?<!{WORD}{literal})")


def all_terms(text: Column, keyword: str | None) -> Column:
    """True where every term of the keyword occurs. An empty keyword matches nothing."""
    terms = keyword_terms(keyword)
    if not terms:
        return F.lit(False)
    return F.coalesce(reduce(Column.__and__, [has_token(text, t) for t in terms]), F.lit(False))


def any_term(text: Column, keyword: str | None) -> Column:
    """True where at least one term of the keyword occurs."""
    terms = keyword_terms(keyword)
    if not terms:
        return F.lit(False)
    return F.coalesce(reduce(Column.__or__, [has_token(text, t) for t in terms]), F.lit(False))
