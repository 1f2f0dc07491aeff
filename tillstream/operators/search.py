"""Faceted search over documents: filter, match, facets, shares, pages."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tillstream.config import GENDER_MALE, SENIOR_FROM, YOUNG_BELOW
from tillstream.functions import all_terms, any_term, pct, pct_text

# Facet size, titles of the reply.
FACET_SIZE = 10
GENDER_TITLE = "用户性别占比"
MALE_NAME = "男"
FEMALE_NAME = "女"
AGE_TITLE = "用户年龄占比"
YOUNG_NAME = "20岁以下"
MIDDLE_NAME = "20岁到30岁"
SENIOR_NAME = "30岁及30岁以上"


@dataclass(frozen=True)
class Request:
    """A search: exact terms AND a text match, sorted and paged.

    ``sort`` names columns, with a leading ``-`` for descending. Without it, and for equal rows,
    the other columns of the documents decide, so every page has one meaning.
    """

    terms: dict[str, object] = field(default_factory=dict)
    match: tuple[str, str] | None = None
    match_all: bool = True
    sort: tuple[str, ...] = ()
    page: int = 1
    size: int = 10


def term_filter(column: str, value: object) -> Column:
    """Exact match; reaches the scan as a pushed filter."""
    return F.col(column) == F.lit(value)


def condition(request: Request) -> Column:
    """All term filters and the text match, combined with AND."""
    parts = [term_filter(c, v) for c, v in request.terms.items()]
    if request.match:
        column, keyword = request.match
        parts.append((all_terms if request.match_all else any_term)(F.col(column), keyword))
    return reduce(Column.__and__, parts, F.lit(True))


def hits(docs: DataFrame, request: Request) -> DataFrame:
    """All matching documents."""
    return docs.where(condition(request))


def hit_total(found: DataFrame) -> DataFrame:
    return found.agg(F.count(F.lit(1)).alias("total"))


def max_metric(found: DataFrame, column: str, name: str) -> DataFrame:
    return found.agg(F.max(column).alias(name))


def terms(found: DataFrame, column: str) -> DataFrame:
    """Document count of every value (null is no value)."""
    return found.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("doc_count"))


def top_terms(found: DataFrame, column: str, size: int = FACET_SIZE) -> DataFrame:
    """The most frequent values; equal counts are ordered by value."""
    return terms(found, column).orderBy(F.desc("doc_count"), F.asc(column)).limit(size)


def facets(found: DataFrame, columns: list[str]) -> DataFrame:
    """Several facets in one pass: rows ``(facet, value, doc_count)``, and ``total``.

    Grouping sets read the hits once; partial counts are made before the shuffle.
    """
    texts = found.select(*[F.col(c).cast("string").alias(c) for c in columns])
    sets = [[F.col(c)] for c in columns] + [[]]
    gid = F.grouping_id()
    grouped = texts.groupingSets(sets, *columns).agg(gid.alias("_gid"), F.count(F.lit(1)).alias("doc_count"))
    # In a set's grouping id every bit is 1 except the one of its own column.
    full = (1 << len(columns)) - 1
    facet, value = F.lit("total"), F.lit(None).cast("string")
    for i, c in enumerate(columns):
        mine = F.col("_gid") == full - (1 << (len(columns) - 1 - i))
        facet, value = F.when(mine, c).otherwise(facet), F.when(mine, F.col(c)).otherwise(value)
    out = grouped.select(facet.alias("facet"), value.alias("value"), "doc_count")
    return out.where((F.col("facet") == "total") | F.col("value").isNotNull())


def _share_counts(gender: str, age: str, male: object) -> list[Column]:
    g, a = F.col(gender), F.col(age)
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(g == F.lit(male)).alias("male"),
        F.count_if(g.isNull()).alias("unknown_gender"),
        F.count_if(a < YOUNG_BELOW).alias("young"),
        F.count_if(a >= SENIOR_FROM).alias("senior"),
        F.count_if(a.isNull()).alias("unknown_age"),
    ]


def share_counts(found: DataFrame, gender: str = "user_gender", age: str = "user_age",
                 male: object = GENDER_MALE) -> DataFrame:
    """All counts behind both share charts, in a single pass over the hits."""
    return found.agg(*_share_counts(gender, age, male))


def gender_ratio(found: DataFrame, gender: str = "user_gender", male: object = GENDER_MALE) -> DataFrame:
    """Male share and its complement; an unknown gender counts in the complement and is
    counted on its own as well. No hits give null shares."""
    g, n, m = F.col(gender), F.col("total"), F.col("male")
    counts = found.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(g == F.lit(male)).alias("male"),
        F.count_if(g.isNull()).alias("unknown"),
    )
    return counts.select(
        "total", pct(m, n).alias("male_pct"), pct(n - m, n).alias("female_pct"), "unknown"
    )


def age_ratio(found: DataFrame, age: str = "user_age") -> DataFrame:
    """Shares of the three age bands among hits with a known age."""
    a, n = F.col(age), F.col("known")
    counts = found.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(a).alias("known"),
        F.count_if(a < YOUNG_BELOW).alias("young"),
        F.count_if(a >= SENIOR_FROM).alias("senior"),
    )
    young, senior = F.col("young"), F.col("senior")
    return counts.select(
        "total", "known",
        pct(young, n).alias("young_pct"),
        pct(n - young - senior, n).alias("middle_pct"),
        pct(senior, n).alias("senior_pct"),
    )


def page(found: DataFrame, order: list[Column], page_no: int, size: int) -> DataFrame:
    """Page ``page_no`` (from 1) of the hits in a total order, at any depth.

    Each task keeps its first ``offset + size`` rows, so a deep page costs its depth;
    :func:`page_after` goes on from a known row at the cost of one page.
    """
    if page_no < 1:
        raise ValueError("page numbers start at 1")
    return page_at_row(found, order, (page_no - 1) * size, size)


def page_at_row(found: DataFrame, order: list[Column], start: int, length: int) -> DataFrame:
    """``length`` rows from any 0-based row offset, as grids send it."""
    if start < 0 or length < 0:
        raise ValueError("offsets and sizes start at 0")
    return found.orderBy(*order).offset(start).limit(length)


def page_after(found: DataFrame, keys: list[str], last: tuple | None, size: int) -> DataFrame:
    """The page after the row whose ascending sort keys are ``last``; None for the first page.

    The keys must be unique together; nulls come first. Cost does not grow with depth: the filter
    on the first key reaches the scan, and each task keeps ``size`` rows.
    """
    if last is not None:
        if len(last) != len(keys):
            raise ValueError("one value per sort key")
        beyond = F.lit(False)
        for i in reversed(range(len(keys))):
            k, v = F.col(keys[i]), F.lit(last[i])
            after = k.isNotNull() if last[i] is None else F.coalesce(k > v, F.lit(False))
            beyond = after | (k.eqNullSafe(v) & beyond)
        if last[0] is not None:
            found = found.where(F.col(keys[0]) >= F.lit(last[0]))
        found = found.where(beyond)
    return found.orderBy(*keys).limit(size)


def order_of(docs: DataFrame, request: Request) -> list[Column]:
    """The request's order, made total by the remaining columns that can be ordered."""
    named = {c.removeprefix("-") for c in request.sort}
    asked = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in request.sort]
    rest = [f.name for f in docs.schema.fields
            if f.name not in named and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return asked + [F.asc(c) for c in rest]


@dataclass(frozen=True)
class Reply:
    """Parts of a search, each of its own shape; a part that nobody reads is never computed."""

    total: DataFrame
    page: DataFrame
    facets: DataFrame | None
    maximum: DataFrame | None


def search(docs: DataFrame, request: Request, facet_columns: tuple[str, ...] = (), max_column: str | None = None) -> Reply:
    """Filter, match, facets, maximum, order and page of one request."""
    found = hits(docs, request)
    return Reply(
        hit_total(found), page(found, order_of(docs, request), request.page, request.size),
        facets(found, list(facet_columns)) if facet_columns else None,
        max_metric(found, max_column, "maximum") if max_column else None,
    )


def stat_document(found: DataFrame, order: list[Column], page_no: int, size: int,
                  gender: str = "user_gender", age: str = "user_age",
                  male: object = GENDER_MALE) -> DataFrame:
    """The whole reply as one JSON row: total, both share charts, one page of details.

    Two passes over the hits: one aggregate for all counts, one top-rows selection for the
    page. Only the page (``size`` rows) is gathered into an array.
    """
    n, m = F.col("total"), F.col("male")
    young, senior = F.col("young"), F.col("senior")
    known = n - F.col("unknown_age")

    def option(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.alias("value"))

    def chart(title: str, *options: Column) -> Column:
        return F.struct(F.lit(title).alias("title"), F.array(*options).alias("options"))

    stat = F.array(
        chart(GENDER_TITLE, option(MALE_NAME, pct_text(m, n)), option(FEMALE_NAME, pct_text(n - m, n))),
        chart(
            AGE_TITLE,
            option(YOUNG_NAME, pct_text(young, known)),
            option(MIDDLE_NAME, pct_text(known - young - senior, known)),
            option(SENIOR_NAME, pct_text(senior, known)),
        ),
    )
    head = share_counts(found, gender, age, male).select("total", stat.alias("stat"))
    position = F.row_number().over(Window.orderBy(*order)).alias("_pos")
    rows = page(found, order, page_no, size).select(position, F.struct(*found.columns).alias("_row"))
    detail = rows.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_row"))), lambda r: r["_row"]).alias("detail")
    )
    whole = head.withColumn("detail", detail.scalar())
    return whole.select(F.to_json(F.struct("total", "stat", "detail")).alias("document"))
