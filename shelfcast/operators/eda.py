"""Descriptive reports of a panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.lag import lag_name, lag_windows, series_window
from shelfcast.operators.quality import distinct_levels, duplicate_keys
from shelfcast.operators.ranking import exact_quantiles
from shelfcast.schema import DATE, ITEM, LAGS, SALES, SERIES, STORE

# Monday-first weekday names.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _median(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return exact_quantiles(df, SALES, [0.5], by).select(*by, F.col("quantiles")[0].alias("median_sales"))


def sales_summary(df: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: size, dates, distinct keys, mean, median, zero rate, duplicates and nulls.

    ``approximate`` replaces the exact median and level counts by sketches in the main pass.
    """
    nulls = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
    surplus = duplicate_keys(df).agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)))
    sketches = [
        F.approx_count_distinct(STORE).alias("store_count"),
        F.approx_count_distinct(ITEM).alias("item_count"),
        F.percentile_approx(SALES, 0.5, 10_000).cast("double").alias("median_sales"),
    ]
    summary = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(DATE).alias("date_min"),
        F.max(DATE).alias("date_max"),
        F.avg(SALES).alias("mean_sales"),
        F.avg((F.col(SALES) == 0).cast("double")).alias("zero_sales_rate"),
        nulls.alias("missing_value_count"),
        *(sketches if approximate else []),
    ).withColumn("duplicate_key_count", surplus.scalar())
    if approximate:
        return summary
    return summary.withColumns(
        {
            "store_count": distinct_levels(df, STORE).scalar(),
            "item_count": distinct_levels(df, ITEM).scalar(),
            "median_sales": _median(df).select("median_sales").scalar(),
        }
    )


def dataset_metadata(df: DataFrame) -> DataFrame:
    """One row: rows, columns, date range, level counts and target range of a raw table.

    Dates that do not parse are ignored; what depends on an absent column is null.
    """
    def known(column: str, value: Column, kind: str) -> Column:
        return value if column in df.columns else F.lit(None).cast(kind)

    day = F.col(DATE).try_cast("date") if DATE in df.columns else F.lit(None)
    number = F.col(SALES).try_cast("double") if SALES in df.columns else F.lit(None)
    facts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        known(DATE, F.min(day), "date").alias("date_min"),
        known(DATE, F.max(day), "date").alias("date_max"),
        known(SALES, F.min(number), "double").alias("target_min"),
        known(SALES, F.max(number), "double").alias("target_max"),
    ).withColumn("columns", F.lit(",".join(df.columns)))
    for column, name in ((STORE, "store_count"), (ITEM, "item_count")):
        counted = distinct_levels(df, column).scalar() if column in df.columns else F.lit(None).cast("long")
        facts = facts.withColumn(name, counted)
    return facts


def daily_sales(df: DataFrame) -> DataFrame:
    return df.groupBy(DATE).agg(F.sum(SALES).alias("total_sales"))


def weekday_profile(df: DataFrame) -> DataFrame:
    """Mean sales per weekday with its Monday-first position."""
    names = F.array(*[F.lit(n) for n in WEEKDAYS])
    return (
        df.groupBy(F.weekday(DATE).alias("position"))
        .agg(F.avg(SALES).alias("mean_sales"))
        .select("position", F.get(names, F.col("position")).alias("day_of_week"), "mean_sales")
    )


def month_profile(df: DataFrame) -> DataFrame:
    return df.groupBy(F.month(DATE).alias("month")).agg(F.avg(SALES).alias("mean_sales"))


def store_profile(df: DataFrame) -> DataFrame:
    return df.groupBy(STORE).agg(F.avg(SALES).alias("mean_sales")).orderBy("mean_sales", STORE)


def store_item_pivot(df: DataFrame, items: Sequence[str] | None = None) -> DataFrame:
    """Mean sales with one column per item; name the items to save the pass that finds them."""
    return df.groupBy(STORE).pivot(ITEM, list(items) if items else None).agg(F.avg(SALES))


def top_items(df: DataFrame, n: int = 15) -> DataFrame:
    return (
        df.groupBy(ITEM)
        .agg(F.avg(SALES).alias("mean_sales"))
        .orderBy(F.desc("mean_sales"), ITEM)
        .limit(n)
    )


def example_series(df: DataFrame, window: int = 28) -> DataFrame:
    """The series with the highest mean, with its trailing average once ``window`` rows are known."""
    best = (
        df.groupBy(*SERIES)
        .agg(F.avg(SALES).alias("_mean"))
        .orderBy(F.desc("_mean"), *SERIES)
        .limit(1)
        .select(*SERIES)
    )
    frame = series_window().rowsBetween(-(window - 1), 0)
    average = F.when(F.count(SALES).over(frame) >= window, F.avg(SALES).over(frame))
    chosen = df.join(best, SERIES, "left_semi")
    return chosen.select(DATE, *SERIES, SALES, average.alias(f"trailing_mean_{window}"))


def lag_autocorrelation(df: DataFrame, max_lag: int = 56) -> DataFrame:
    """Mean over the series of the correlation of sales with its own lag, for lags 1..max_lag.

    A series is one ordered array, as long as the calendar at most; each lag takes the products of two slices of it. One
    row per series and lag goes on. Series without variance are skipped.
    """
    series = df.groupBy(*SERIES).agg(F.array_sort(F.collect_list(F.struct(DATE, SALES))).alias("_days"))
    # Less the mean of the series, so that the sums below stay small.
    series = series.select(F.transform("_days", lambda d: d[SALES]).alias("_x"))
    mean = F.aggregate("_x", F.lit(0.0), lambda a, v: a + v) / F.size("_x")
    centred = series.select(F.transform("_x", lambda v: v - mean).alias("_x"))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)

    def correlation(lag: Column) -> Column:
        n = F.size("_x") - lag
        now, past = F.slice("_x", lag + 1, n), F.slice("_x", F.lit(1), n)
        sums = F.struct(
            n.alias("n"), total(now).alias("y"), total(past).alias("x"),
            total(F.transform(now, lambda v: v * v)).alias("yy"), total(F.transform(past, lambda v: v * v)).alias("xx"),
            total(F.zip_with(now, past, lambda a, b: a * b)).alias("xy"),
        )
        return F.struct(lag.alias("lag"), sums.alias("s"))

    lags = F.filter(F.sequence(F.lit(1), F.lit(max_lag)), lambda k: k < F.size("_x"))
    per_series = centred.select(F.inline(F.transform(lags, correlation)))
    s = {name: F.col(f"s.{name}") for name in ("n", "x", "y", "xx", "yy", "xy")}
    spread = (s["xx"] - s["x"] * s["x"] / s["n"]) * (s["yy"] - s["y"] * s["y"] / s["n"])
    # What is left of a constant stretch after rounding is no variance.
    varies = (s["n"] > 1) & (spread > 1e-18 * (s["xx"] + 1) * (s["yy"] + 1))
    corr = F.when(varies, (s["xy"] - s["x"] * s["y"] / s["n"]) / F.sqrt(F.when(varies, spread)))
    return per_series.groupBy("lag").agg(F.avg(corr).alias("correlation"))


def pooled_lag_correlation(df: DataFrame, lags: Sequence[int] = LAGS) -> DataFrame:
    """Correlation of sales with each lag over all rows of all series together."""
    lagged = df.select(SALES, *[c.alias(n) for n, c in lag_windows(lags).items()])
    pooled = lagged.agg(*[F.corr(SALES, lag_name(k)).alias(str(k)) for k in lags])
    return pooled.unpivot([], [str(k) for k in lags], "lag", "correlation").select(
        F.col("lag").cast("int").alias("lag"), "correlation"
    )


def panel_coverage(df: DataFrame) -> DataFrame:
    return df.groupBy(*SERIES).agg(
        F.min(DATE).alias("first_date"), F.max(DATE).alias("last_date"), F.count(F.lit(1)).alias("rows")
    )


def coverage_summary(df: DataFrame) -> DataFrame:
    """Distribution of the series lengths: count, mean, std, min, quartiles, max."""
    lengths = panel_coverage(df)
    quartiles = exact_quantiles(lengths, "rows", [0.25, 0.5, 0.75])
    return (
        lengths.agg(
            F.count("rows").alias("series"),
            F.avg("rows").alias("mean"),
            F.stddev_samp("rows").alias("std"),
            F.min("rows").alias("min"),
            F.max("rows").alias("max"),
        )
        .withColumn("_q", quartiles.scalar())
        .select(
            "*", F.col("_q")[0].alias("p25"), F.col("_q")[1].alias("p50"), F.col("_q")[2].alias("p75")
        )
        .drop("_q")
    )


def group_stats(df: DataFrame, by: str, digits: int = 2) -> DataFrame:
    """Mean, median and deviation of sales per level of one key."""
    spread = df.groupBy(by).agg(F.avg(SALES).alias("mean_sales"), F.stddev_samp(SALES).alias("std_sales"))
    stats = spread.join(_median(df, [by]), by)
    return stats.select(
        F.lit(by).alias("level"),
        F.col(by).alias("key"),
        *[F.round(c, digits).alias(c) for c in ("mean_sales", "median_sales", "std_sales")],
    )
