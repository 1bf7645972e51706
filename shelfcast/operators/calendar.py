"""Calendar and holiday features of a panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.calendar import (
    calendar_columns,
    holiday_dimension,
    no_holiday_columns,
    us_holidays,
    years_around,
)
from shelfcast.schema import DATE


def add_date_features(
    df: DataFrame,
    holidays: DataFrame | str | None = "us",
    base_year: int | None = None,
) -> DataFrame:
    """Add the calendar columns and the two holiday columns.

    ``holidays`` is a table with a ``date`` column, ``"us"`` for the built-in rules, or None.
    ``base_year`` defaults to the first year of the table; pass it to keep ``year_index`` stable
    when only a part of the history is featured.
    """
    base: Column = F.lit(base_year) if base_year is not None else F.year(df.agg(F.min(DATE)).scalar())
    dated = df.withColumns(calendar_columns(DATE, base))
    if holidays is None:
        return dated.select("*", *no_holiday_columns())
    table = us_holidays(years_around(df)) if isinstance(holidays, str) else holidays
    # The day table is as long as the calendar, so Catalyst broadcasts it by its own size check.
    days = holiday_dimension(df, table)
    return dated.join(days, DATE, "left").select(
        *dated.columns, "is_us_holiday", "days_to_nearest_us_holiday"
    )
