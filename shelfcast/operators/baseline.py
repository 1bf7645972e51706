"""Forecasts without a fitted model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.evaluate import regression_metrics
from shelfcast.schema import DATE, SALES, SERIES, require_columns


def seasonal_naive(train: DataFrame, test: DataFrame, lag_days: int = 7) -> DataFrame:
    """Sales ``lag_days`` earlier if the training part has that day, else the series mean.

    A series unknown to the training part gets a null prediction. Only the days a test row can
    look back to are read for the lookup; the means are summed before their shuffle.
    """
    day = F.col(DATE)
    bounds = test.agg(
        F.date_sub(F.min(DATE), lag_days).alias("a"), F.date_sub(F.max(DATE), lag_days).alias("b")
    )
    lookup = train.where(
        (day >= bounds.select("a").scalar()) & (day <= bounds.select("b").scalar())
    ).select(*SERIES, day.alias("lookup_date"), F.col(SALES).alias("_seasonal"))
    fallback = train.groupBy(*SERIES).agg(F.avg(SALES).alias("_mean"))
    return (
        test.select(*SERIES, DATE, SALES, F.date_sub(DATE, lag_days).alias("lookup_date"))
        .join(lookup, [*SERIES, "lookup_date"], "left")
        .join(fallback, SERIES, "left")
        .select(*SERIES, DATE, SALES, F.coalesce("_seasonal", "_mean").alias("prediction"))
    )


def moving_average(df: DataFrame, window: int = 7) -> DataFrame:
    """The rolling mean as prediction; where it is missing, its mean over the scored rows."""
    column = f"{SALES}_rolling_mean_{window}"
    require_columns(df, [column])
    overall = df.agg(F.avg(column)).scalar()
    return df.withColumn("prediction", F.coalesce(F.col(column), overall))


def baseline_scores(
    train: DataFrame, validation: DataFrame, test: DataFrame, same_split: bool = False
) -> list[DataFrame]:
    """One leaderboard row per baseline with the split it was scored on.

    The published leaderboard scores the seasonal baseline on the test part and everything else
    on the validation part; ``same_split`` scores both on the validation part.
    """
    if same_split:
        naive, split = seasonal_naive(train, validation), "validation"
    else:
        naive, split = seasonal_naive(train.unionByName(validation), test), "test"
    rows = [("seasonal_naive_7", split, naive), ("moving_average_7", "validation", moving_average(validation))]
    return [
        regression_metrics(scored).select(F.lit(model).alias("model"), F.lit(part).alias("split"), "*")
        for model, part, scored in rows
    ]
