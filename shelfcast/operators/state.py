"""Feature state: the bounded recent past and the level means that serving needs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.schema import DATE, ITEM, SALES, SERIES, STATE_ROWS, STORE


@dataclass(frozen=True)
class FeatureState:
    """``series``: one row per series; ``means``: one row per level key; ``totals``: one row."""

    series: DataFrame
    means: DataFrame
    totals: DataFrame


def state_tail(df: DataFrame, rows: int = STATE_ROWS) -> DataFrame:
    """The last ``rows`` days of each series; Spark cuts most rows before the shuffle."""
    latest = Window.partitionBy(*SERIES).orderBy(F.desc(DATE))
    return (
        df.select(*SERIES, DATE, SALES)
        .withColumn("_back", F.row_number().over(latest))
        .where(F.col("_back") <= rows)
        .drop("_back")
    )


def state_means(df: DataFrame) -> DataFrame:
    """(level, store, item, mean_sales) for store, item, series and global.

    Rows are summed per series first; the grouping sets then only see series totals.
    """
    series = df.groupBy(*SERIES).agg(F.sum(SALES).alias("_s"), F.count(SALES).alias("_n"))
    level = F.expr("CASE _g WHEN 0 THEN 'series' WHEN 1 THEN 'store' WHEN 2 THEN 'item' ELSE 'global' END")
    return (
        series.groupingSets([[STORE], [ITEM], [STORE, ITEM], []], STORE, ITEM)
        .agg(
            (F.sum("_s") / F.sum("_n")).alias("mean_sales"),
            F.grouping_id().cast("int").alias("_g"),
        )
        .select(level.alias("level"), STORE, ITEM, "mean_sales")
    )


def feature_state(df: DataFrame, rows: int = STATE_ROWS) -> FeatureState:
    """State tables of a clean panel."""
    means = state_means(df)
    history = (
        state_tail(df, rows)
        .groupBy(*SERIES)
        .agg(F.array_sort(F.collect_list(F.struct(DATE, SALES))).alias("history"))
    )

    def level(name: str, keys: list[str], alias: str) -> DataFrame:
        return means.where(F.col("level") == name).select(*keys, F.col("mean_sales").alias(alias))

    series = (
        history.join(level("series", SERIES, "series_mean"), SERIES)
        .join(level("store", [STORE], "store_mean"), STORE)
        .join(level("item", [ITEM], "item_mean"), ITEM)
        .select(*SERIES, "history", "series_mean", "store_mean", "item_mean")
    )
    totals = df.agg(F.avg(SALES).alias("global_mean"), F.max(DATE).alias("last_date"))
    return FeatureState(series, means.where(F.col("level").isin("store", "item")), totals)
