"""Calendar attributes of a date, and the holiday dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the distance reported when there is no holiday table.
NO_HOLIDAY_DISTANCE = 999

# Federal holidays of the United States. A rule is a day of a month, the n-th
# weekday of a month (0 = Monday), or the last weekday (n = -1); with first and last year.
FIXED_DAYS = [
    ("New Year's Day", 1, 1, 1870, 9999),
    ("Washington's Birthday", 2, 22, 1879, 1970),
    ("Memorial Day", 5, 30, 1888, 1970),
    ("Juneteenth", 6, 19, 2021, 9999),
    ("Independence Day", 7, 4, 1870, 9999),
    ("Columbus Day", 10, 12, 1937, 1970),
    ("Veterans Day", 11, 11, 1938, 1970),
    ("Veterans Day", 11, 11, 1978, 9999),
    ("Christmas Day", 12, 25, 1870, 9999),
]
NTH_WEEKDAYS = [
    ("Martin Luther King Jr. Day", 1, 0, 3, 1986, 9999),
    ("Washington's Birthday", 2, 0, 3, 1971, 9999),
    ("Memorial Day", 5, 0, -1, 1971, 9999),
    ("Labor Day", 9, 0, 1, 1894, 9999),
    ("Columbus Day", 10, 0, 2, 1971, 9999),
    ("Veterans Day", 10, 0, 4, 1971, 1977),
    ("Thanksgiving", 11, 3, 4, 1942, 9999),
]


def calendar_columns(date: str | Column, base_year: Column) -> dict[str, Column]:
    """Calendar features of one date column; ``year_index`` counts from ``base_year``."""
    day = F.col(date) if isinstance(date, str) else date
    return {
        "day_of_week": F.weekday(day).cast("string"),
        "month": F.month(day).cast("string"),
        "day_of_month": F.dayofmonth(day),
        "week_of_year": F.weekofyear(day),
        "is_weekend": (F.weekday(day) >= 5).cast("int"),
        "is_month_start": (F.dayofmonth(day) == 1).cast("int"),
        "is_month_end": (day == F.last_day(day)).cast("int"),
        "quarter": F.quarter(day).cast("string"),
        "year_index": F.year(day) - base_year,
    }


def _rule_rows(years: DataFrame) -> DataFrame:
    """Holiday dates of every year in ``years`` by the rules above."""
    year = F.col("year")
    fixed = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                F.when(year.between(first, last), F.make_date(year, F.lit(month), F.lit(day))).alias("date"),
            )
            for name, month, day, first, last in FIXED_DAYS
        ]
    )

    def nth(month: int, weekday: int, n: int) -> Column:
        start = F.make_date(year, F.lit(month), F.lit(1))
        if n < 0:
            end = F.last_day(start)
            return F.date_sub(end, (F.weekday(end) - weekday + 7) % 7)
        return F.date_add(start, (F.lit(weekday) - F.weekday(start) + 7) % 7 + 7 * (n - 1))

    moving = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                F.when(year.between(first, last), nth(month, weekday, n)).alias("date"),
            )
            for name, month, weekday, n, first, last in NTH_WEEKDAYS
        ]
    )
    return years.select(F.inline(F.concat(fixed, moving))).where(F.col("date").isNotNull())


def us_holidays(years: DataFrame, observed: bool = True) -> DataFrame:
    """(date, name) of the federal holidays for a one-row table (first_year, last_year).

    A fixed-day holiday on a Saturday is also kept on the Friday before, on a Sunday on the Monday
    after; the next year's New Year's Day can thus fall on 31 December.
    """
    span = years.select(
        "first_year", "last_year", F.explode(F.expr("sequence(first_year, last_year + 1)")).alias("year")
    )
    rules = _rule_rows(span)
    if observed:
        moved = F.when(F.weekday("date") == 5, F.date_sub("date", 1)).when(
            F.weekday("date") == 6, F.date_add("date", 1)
        )
        rules = rules.select(
            F.inline(
                F.array(
                    F.struct("date", "name"),
                    F.struct(moved.alias("date"), F.concat("name", F.lit(" (observed)")).alias("name")),
                )
            )
        ).where(F.col("date").isNotNull())
    last_year = years.select("last_year").scalar()
    return rules.where(F.year("date") <= last_year).select("date", "name")


def years_around(df: DataFrame, date: str = "date") -> DataFrame:
    """One row: the years of the data widened by one on each side."""
    return df.agg(
        (F.year(F.min(date)) - 1).alias("first_year"), (F.year(F.max(date)) + 1).alias("last_year")
    )


def calendar_days(df: DataFrame, date: str = "date") -> DataFrame:
    """Every day between the first and last date: bounded by the calendar, not by the rows."""
    return df.agg(F.min(date).alias("_a"), F.max(date).alias("_b")).select(
        F.explode(F.sequence("_a", "_b")).alias(date)
    )


def holiday_dimension(df: DataFrame, holidays: DataFrame | None, date: str = "date") -> DataFrame:
    """Per calendar day: is_us_holiday and the distance to the nearest holiday."""
    days = calendar_days(df, date)
    if holidays is None:
        return days.select(date, *no_holiday_columns())
    known = holidays.agg(F.array_sort(F.collect_set("date"))).scalar()
    distance = F.array_min(F.transform("_known", lambda h: F.abs(F.datediff(h, F.col(date)))))
    return days.withColumn("_known", known).select(
        date,
        F.array_contains("_known", F.col(date)).cast("int").cast("string").alias("is_us_holiday"),
        F.coalesce(distance, F.lit(NO_HOLIDAY_DISTANCE)).alias("days_to_nearest_us_holiday"),
    )


def no_holiday_columns() -> list[Column]:
    return [
        F.lit("0").alias("is_us_holiday"),
        F.lit(NO_HOLIDAY_DISTANCE).alias("days_to_nearest_us_holiday"),
    ]
