"""Null-aware scalar helpers. Spark's ``greatest`` skips nulls, so each clamp guards them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_double(value: Column, is_text: bool = True) -> Column:
    """Number or null: bad text and NaN become null. Java reads '1d' and '1f' as numbers, text parsing here does not."""
    number = value.try_cast("double")
    number = F.when(~F.isnan(number), number)
    return F.when(~value.rlike(r"[0-9.][dDfF]\s*$"), number) if is_text else number


def double_or(value: Column, fallback: float | Column = 0.0, is_text: bool = True) -> Column:
    return F.coalesce(lenient_double(value, is_text), F.lit(fallback))


def floored(value: Column, floor: float = 1e-6) -> Column:
    """Denominator guard: at least ``floor``, null stays null."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(floor)))


def non_negative(value: Column) -> Column:
    return F.when(value.isNotNull(), F.greatest(F.lit(0.0), value))


def mean_of_present(values: list[Column]) -> Column:
    """Row mean over the non-null columns; null when all are null."""
    present = sum((F.when(v.isNotNull(), 1).otherwise(0) for v in values), F.lit(0))
    total = sum((F.coalesce(v, F.lit(0.0)) for v in values), F.lit(0.0))
    return F.when(present > 0, total / present)


def sorted_median(ordered: Column) -> Column:
    """Median of an ascending array; null when empty."""
    n = F.size(ordered)
    low = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    high = F.get(ordered, F.floor(n / 2).cast("int"))
    return F.when(n > 0, (low + high) / 2)
