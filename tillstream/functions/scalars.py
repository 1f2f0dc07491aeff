"""Masking, numbers, ages and shares."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tillstream.config import PHONE_MASK, PHONE_PREFIX, SENIOR_FROM, YOUNG_BELOW


def mask_phone(phone: Column) -> Column:
    """First characters kept, the rest replaced by stars; null stays null."""
    return F.concat(F.substring(phone, 1, PHONE_PREFIX), F.lit(PHONE_MASK))


def to_number(text: Column, kind: str = "double") -> Column:
    """Text to number; malformed text gives null instead of an error."""
    return text.try_cast(kind)


def exact_sum(amount: Column) -> Column:
    """Sum of money without binary rounding: the same for every row order and partitioning."""
    return F.sum(amount.cast("decimal(18,2)")).cast("double")


def age_years(birthday: Column, as_of: Column) -> Column:
    """Whole 365-day years between two days; leap days are not counted."""
    days = F.datediff(F.to_date(as_of), F.to_date(birthday))
    return F.call_function("div", days, F.lit(365)).cast("int")


def age_band(age: Column) -> Column:
    """Three bands; an unknown age belongs to none."""
    return (
        F.when(age < YOUNG_BELOW, F.lit(f"under {YOUNG_BELOW}"))
        .when(age >= SENIOR_FROM, F.lit(f"{SENIOR_FROM} and over"))
        .when(age.isNotNull(), F.lit(f"{YOUNG_BELOW} to {SENIOR_FROM}"))
    )


def pct(part: Column, total: Column) -> Column:
    """``100 * part / total`` with one decimal, halves up; null when total is 0.

    Counted in whole numbers, so exact halves round the same way everywhere.
    """
    part, total = part.cast("bigint"), total.cast("bigint")
    tenths = F.call_function("div", part * 2000 + total, total * 2)
    return F.when(total > 0, tenths.cast("double") / 10)


def pct_text(part: Column, total: Column) -> Column:
    """Text form of :func:`pct`, always with one decimal; null when total is 0."""
    share = pct(part, total)
    return F.when(share.isNotNull(), F.format_string("%.1f", share))
