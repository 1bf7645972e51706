"""Rolling-origin backtests."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.metrics import regression_aggregates
from shelfcast.operators.evaluate import regression_metrics
from shelfcast.operators.models import side_by_side
from shelfcast.schema import DATE, SALES, SERIES


def _fold_array(last_day: str, folds: int, horizon_days: int, step_days: int) -> Column:
    """Folds as array of (fold, test_start, test_end) counted back from the last day."""
    reach = folds * step_days + horizon_days - 1
    return F.expr(
        f"""transform(sequence(1, {folds}), k -> named_struct(
              'fold', k,
              'test_start', date_add(date_sub({last_day}, {reach}), (k - 1) * {step_days}),
              'test_end', date_add(date_sub({last_day}, {reach}), (k - 1) * {step_days} + {horizon_days - 1})))"""
    )


def _with_folds(df: DataFrame, folds: int, horizon_days: int, step_days: int) -> DataFrame:
    return df.withColumn("_last", df.agg(F.max(DATE)).scalar()).withColumn(
        "_folds", _fold_array("_last", folds, horizon_days, step_days)
    ).drop("_last")


def _require_history(df: DataFrame, needed: int) -> DataFrame:
    """Fails the job when the table has fewer distinct days than the folds need."""
    days = df.select(DATE).distinct().agg(F.count(F.lit(1))).scalar()
    return df.withColumn(
        "_folds",
        F.when(
            days < needed, F.raise_error(F.lit("The table has fewer days than these folds need."))
        ).otherwise(F.col("_folds")),
    )


def fold_windows(
    df: DataFrame, folds: int = 3, horizon_days: int = 28, step_days: int = 28
) -> DataFrame:
    """(fold, train_end, test_start, test_end, rows); folds without train or test rows are left out.

    Rows are first counted per day, so the folds are matched to days, not to rows.
    """
    per_day = df.groupBy(DATE).agg(F.count(F.lit(1)).alias("_n"))
    days = _require_history(
        _with_folds(per_day, folds, horizon_days, step_days), horizon_days * folds + step_days
    )
    return (
        days.select(DATE, "_n", F.inline("_folds"))
        .groupBy("fold", "test_start", "test_end")
        .agg(
            F.max(F.when(F.col(DATE) < F.col("test_start"), F.col(DATE))).alias("train_end"),
            F.sum(F.when(F.col(DATE).between(F.col("test_start"), F.col("test_end")), F.col("_n"))).alias("rows"),
        )
        .where(F.col("train_end").isNotNull() & F.col("rows").isNotNull())
        .select("fold", "train_end", "test_start", "test_end", "rows")
    )


def fold_test_rows(
    df: DataFrame, folds: int = 3, horizon_days: int = 28, step_days: int = 28
) -> DataFrame:
    """Test rows with their fold and its bounds; a row is repeated only for folds that overlap."""
    matched = F.expr("filter(_folds, f -> date BETWEEN f.test_start AND f.test_end)")
    tagged = _with_folds(df, folds, horizon_days, step_days)
    first = F.get(F.col("_folds"), F.lit(0))["test_start"]
    return tagged.where(F.col(DATE) >= first).select(*df.columns, F.inline(matched))


def fold_series_means(
    df: DataFrame, folds: int = 3, horizon_days: int = 28, step_days: int = 28
) -> DataFrame:
    """Mean of each series over the training part of each fold.

    Rows are summed per (series, number of folds that start on or before the day); a fold then
    adds the sums below it. Training rows are not repeated per fold.
    """
    started = F.expr("size(filter(_folds, f -> f.test_start <= date))")
    parts = (
        _with_folds(df, folds, horizon_days, step_days)
        .groupBy(*SERIES, started.alias("_part"))
        .agg(F.sum(SALES).alias("_s"), F.count(SALES).alias("_n"))
    )
    return (
        parts.where(F.col("_part") < folds)
        .withColumn("fold", F.explode(F.sequence(F.col("_part") + 1, F.lit(folds))))
        .groupBy("fold", *SERIES)
        .agg((F.sum("_s") / F.sum("_n")).alias("_mean"))
    )


def backtest_seasonal_naive(
    df: DataFrame, folds: int = 3, horizon_days: int = 28, step_days: int = 28, lag_days: int = 7
) -> DataFrame:
    """Seasonal-naive predictions of every fold, in one plan."""
    tests = fold_test_rows(df, folds, horizon_days, step_days).withColumn(
        "lookup_date", F.date_sub(DATE, lag_days)
    )
    reach = folds * step_days + horizon_days - 1 + lag_days
    earliest = F.date_sub(df.agg(F.max(DATE)).scalar(), reach)
    lookup = df.where(F.col(DATE) >= earliest).select(
        *SERIES, F.col(DATE).alias("lookup_date"), F.col(SALES).alias("_seasonal")
    )
    means = fold_series_means(df, folds, horizon_days, step_days)
    seen = F.when(F.col("lookup_date") < F.col("test_start"), F.col("_seasonal"))
    return (
        tests.join(lookup, [*SERIES, "lookup_date"], "left")
        .join(means, ["fold", *SERIES], "left")
        .select("fold", *SERIES, DATE, SALES, F.coalesce(seen, F.col("_mean")).alias("prediction"))
    )


def backtest_moving_average(
    df: DataFrame, folds: int = 3, horizon_days: int = 28, step_days: int = 28, window: int = 7
) -> DataFrame:
    """Rolling-mean predictions of every fold; needs the rolling mean column."""
    column = f"{SALES}_rolling_mean_{window}"
    tests = fold_test_rows(df, folds, horizon_days, step_days)
    overall = tests.groupBy("fold").agg(F.avg(column).alias("_overall"))
    return tests.join(overall, "fold").select(
        "fold", *SERIES, DATE, SALES, F.coalesce(F.col(column), F.col("_overall")).alias("prediction")
    )


def backtest_metrics(predictions: DataFrame, windows: DataFrame, model: str) -> DataFrame:
    """(model, fold, train_end, test_start, test_end, rows, errors) from fold predictions."""
    scored = predictions.groupBy("fold").agg(*regression_aggregates(SALES, "prediction"))
    return windows.join(scored, "fold").select(
        F.lit(model).alias("model"), *windows.columns, "mae", "rmse", "mape", "smape"
    )


def backtest_baselines(
    df: DataFrame, folds: int = 3, horizon_days: int = 28, step_days: int = 28
) -> DataFrame:
    """Both baselines on every fold."""
    windows = fold_windows(df, folds, horizon_days, step_days)
    size = (folds, horizon_days, step_days)
    return backtest_metrics(backtest_seasonal_naive(df, *size), windows, "seasonal_naive_7").unionByName(
        backtest_metrics(backtest_moving_average(df, *size), windows, "moving_average_7")
    )


def backtest_model(
    features: DataFrame,
    fit: Callable[[DataFrame], Callable[[DataFrame], DataFrame]],
    model: str,
    folds: int = 3,
    horizon_days: int = 28,
    step_days: int = 28,
) -> DataFrame:
    """Fit on everything before each fold, score the fold; one fit per fold, on Spark, side by side.

    ``fit`` takes the training rows and returns a function that adds ``prediction``. The fold
    bounds (one row per fold) are read by the driver; the filters they become reach the scan, and where the table
    is stored by ``sales_month`` the months beyond a fold are not read.
    """
    by_month = "sales_month" in features.columns
    table = features.drop("sales_month")

    def between(first, last) -> DataFrame:
        day, rows = F.col(DATE), features
        for bound, keep in ((first, lambda c, v: c >= v), (last, lambda c, v: c <= v)):
            if bound is not None:
                rows = rows.where(keep(day, F.lit(bound)))
                rows = rows.where(keep(F.col("sales_month"), F.lit(bound.strftime("%Y-%m")))) if by_month else rows
        return rows.select(*[f"`{c}`" for c in table.columns])

    def tested(fold) -> DataFrame:
        train, test = between(None, fold["train_end"]), between(fold["test_start"], fold["test_end"])
        return regression_metrics(fit(train)(test)).select(
            F.lit(model).alias("model"),
            *[F.lit(fold[c]).alias(c) for c in ("fold", "train_end", "test_start", "test_end", "rows")],
            "*",
        )

    windows = fold_windows(table, folds, horizon_days, step_days).orderBy("fold").collect()
    if not windows:
        raise ValueError("No fold has both training and test rows.")
    results = side_by_side([lambda fold=fold: tested(fold) for fold in windows])
    return reduce(DataFrame.unionByName, results)
