"""Trailing-window statistics that exclude the current row, and the demand-pattern features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.scalars import floored, sorted_median
from shelfcast.operators.lag import series_window
from shelfcast.schema import SALES, SHAPE_WINDOWS, WINDOWS

# The pattern window and its two minimum counts.
PATTERN_DAYS = 28
ZERO_MIN_ROWS = 7
TREND_MIN_ROWS = 14


def _trailing(rows: int):
    return series_window().rowsBetween(-rows, -1)


def rolling_windows(windows: Sequence[int] = WINDOWS) -> dict[str, Column]:
    """Window columns of every statistic; the names starting with ``_`` feed ``rolling_statistics``."""
    out: dict[str, Column] = {}
    for n in windows:
        frame = _trailing(n)
        out[f"_count_{n}"] = F.count(SALES).over(frame)
        out[f"_mean_{n}"] = F.avg(SALES).over(frame)
        if n in SHAPE_WINDOWS:
            out[f"_past_{n}"] = F.collect_list(SALES).over(frame)
            out[f"_std_{n}"] = F.stddev_samp(SALES).over(frame)
            out[f"_min_{n}"] = F.min(SALES).over(frame)
            out[f"_max_{n}"] = F.max(SALES).over(frame)
    return out


def staging_columns(windows: Sequence[int] = WINDOWS) -> list[str]:
    return list(rolling_windows(windows))


def ordered_past(windows: Sequence[int] = WINDOWS) -> dict[str, Column]:
    """Sorts each shape window once, in a projection of its own, before the median reads it."""
    return {f"_past_{n}": F.sort_array(f"_past_{n}") for n in windows if n in SHAPE_WINDOWS}


def rolling_statistics(windows: Sequence[int] = WINDOWS) -> dict[str, Column]:
    """The published columns: null until max(2, n // 2) rows are known."""
    out: dict[str, Column] = {}
    for n in windows:
        values = {"mean": F.col(f"_mean_{n}")}
        if n in SHAPE_WINDOWS:
            values |= {
                "median": sorted_median(F.col(f"_past_{n}")),
                "std": F.col(f"_std_{n}"),
                "min": F.col(f"_min_{n}"),
                "max": F.col(f"_max_{n}"),
            }
        enough = F.col(f"_count_{n}") >= max(2, n // 2)
        out |= {f"sales_rolling_{name}_{n}": F.when(enough, value) for name, value in values.items()}
    return out


def add_rolling_features(df: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    staged = df.withColumns(rolling_windows(windows)).withColumns(ordered_past(windows))
    done = rolling_statistics(windows)
    return staged.withColumns(done).select(*df.columns, *done)


def pattern_windows() -> dict[str, Column]:
    """Zero count and trend of the last 28 rows.

    The zero count starts at the seventh row because the first row, which has no past, counts
    as a non-zero. The mean of first differences telescopes to (last - first) / (count - 1).
    """
    frame = _trailing(PATTERN_DAYS)
    zeros = F.coalesce(F.count_if(F.col(SALES) == 0).over(frame), F.lit(0)).cast("double")
    seen = F.count(SALES).over(frame)
    slope = (F.last(SALES).over(frame) - F.first(SALES).over(frame)) / (seen - 1)
    return {
        "recent_zero_sales_28": F.when(F.row_number().over(series_window()) >= ZERO_MIN_ROWS, zeros),
        "sales_trend_28": F.when(seen >= TREND_MIN_ROWS, slope),
    }


def pattern_ratios() -> dict[str, Column]:
    mean28 = floored(F.col("sales_rolling_mean_28"))
    return {
        "sales_cv_28": F.col("sales_rolling_std_28") / mean28,
        "sales_momentum_7_28": F.col("sales_rolling_mean_7") / mean28,
        "intermittency_score_28": F.col("recent_zero_sales_28") / PATTERN_DAYS,
    }


# Reading order of the demand-pattern columns.
PATTERN_COLUMNS = [
    "recent_zero_sales_28",
    "sales_cv_28",
    "sales_momentum_7_28",
    "sales_trend_28",
    "intermittency_score_28",
]


def add_demand_pattern_features(df: DataFrame) -> DataFrame:
    """Needs the 7 and 28 row rolling means and the 28 row deviation."""
    done = df.withColumns(pattern_windows()).withColumns(pattern_ratios())
    return done.select(*df.columns, *PATTERN_COLUMNS)
