"""Expanding means of past sales per store, item, series, weekday and month.

``pooled`` follows the published semantics: inside a store the running order is (item, date), so a
row also sees later days of items that sort before its own. ``chronological`` only looks at
strictly earlier days. Neither sorts a whole store in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.ranking import running_totals
from shelfcast.schema import DATE, ITEM, SALES, SERIES, STORE

# Rows needed before a mean is reported.
LEVEL_MIN_ROWS = 7
CALENDAR_MIN_ROWS = 3

HISTORY_COLUMNS = [
    "store_historical_mean",
    "item_historical_mean",
    "store_item_historical_mean",
    "store_day_of_week_historical_mean",
    "item_day_of_week_historical_mean",
    "store_month_historical_mean",
    "item_month_historical_mean",
]


def _mean(total: Column, count: Column, min_rows: int) -> Column:
    return F.when(count >= min_rows, total / count)


def _slots(df: DataFrame) -> DataFrame:
    return df.withColumns({"_dow": F.weekday(DATE), "_month": F.month(DATE)})


# A series carries one slot for everything, seven for its weekdays and twelve for its months.
ALL_SLOT = 0
DOW_SLOTS = 1
MONTH_SLOTS = 7
SLOTS = 20


def series_carry(df: DataFrame) -> DataFrame:
    """Per series the sums and counts, by slot, of everything that sorts before the series.

    Columns ``store_s``, ``store_n``, ``item_s`` and ``item_n`` are arrays of 20 slots: the total,
    the seven weekdays, the twelve months. Only series totals are shuffled, never rows.
    """
    slots = F.array(F.lit(ALL_SLOT), DOW_SLOTS + F.col("_dow"), MONTH_SLOTS + F.col("_month"))
    by_slot = (
        _slots(df)
        .groupBy(*SERIES, "_dow", "_month")
        .agg(F.sum(SALES).alias("_s"), F.count(SALES).alias("_n"))
        .withColumn("slot", F.explode(slots))
        .groupBy(*SERIES, "slot")
        .agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
    )

    # Both levels go through one pass: items in order within a store, stores in order within an item.
    both = F.expr(
        "inline(array(struct('store' AS level, store AS outer, item AS inner),"
        " struct('item' AS level, item AS outer, store AS inner)))"
    )
    before = running_totals(
        by_slot.select("slot", "_s", "_n", both), ["level", "outer", "slot"], "inner", ["_s", "_n"]
    )
    per_series = before.selectExpr(
        "CASE WHEN level = 'store' THEN outer ELSE inner END AS store",
        "CASE WHEN level = 'store' THEN inner ELSE outer END AS item",
        "level",
        "slot",
        "_s_before AS s",
        "_n_before AS n",
    )

    def by_position(name: str, value: str) -> Column:
        picked = [f"max(CASE WHEN level = '{name}' AND slot = {k} THEN {value} END)" for k in range(SLOTS)]
        return F.expr(f"array({', '.join(picked)}) AS {name}_{value}")

    return per_series.groupBy(*SERIES).agg(*[by_position(n, v) for n in SERIES for v in ("s", "n")])


def own_totals() -> dict[str, str]:
    """Running sums and counts of the row's own series, overall and for its weekday and month."""
    out = {}
    for name, slot in (("all", ""), ("dow", ", weekday(date)"), ("month", ", month(date)")):
        over = f"OVER (PARTITION BY store, item{slot} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        out[f"_s_{name}"] = f"coalesce(sum(sales) {over}, 0D)"
        out[f"_n_{name}"] = f"count(sales) {over}"
    return out


def pooled_means() -> dict[str, str]:
    """The seven means from own totals plus what the series carries."""
    slots = {
        "all": f"{ALL_SLOT}",
        "dow": f"{DOW_SLOTS} + weekday(date)",
        "month": f"{MONTH_SLOTS} + month(date)",
    }

    def mean(level: str, name: str, min_rows: int) -> str:
        total = f"(_s_{name} + get({level}_s, {slots[name]}))"
        count = f"(_n_{name} + get({level}_n, {slots[name]}))"
        return f"CASE WHEN {count} >= {min_rows} THEN {total} / {count} END"

    return {
        "store_historical_mean": mean(STORE, "all", LEVEL_MIN_ROWS),
        "item_historical_mean": mean(ITEM, "all", LEVEL_MIN_ROWS),
        "store_item_historical_mean": f"CASE WHEN _n_all >= {LEVEL_MIN_ROWS} THEN _s_all / _n_all END",
        "store_day_of_week_historical_mean": mean(STORE, "dow", CALENDAR_MIN_ROWS),
        "item_day_of_week_historical_mean": mean(ITEM, "dow", CALENDAR_MIN_ROWS),
        "store_month_historical_mean": mean(STORE, "month", CALENDAR_MIN_ROWS),
        "item_month_historical_mean": mean(ITEM, "month", CALENDAR_MIN_ROWS),
    }


def _add_pooled(df: DataFrame, panel: DataFrame) -> DataFrame:
    # The windows and the join all cluster on the series, so the panel is shuffled once. The
    # carried arrays join last, to keep them out of the window sorts.
    rows = df.select("*", *[F.expr(e).alias(c) for c, e in own_totals().items()])
    joined = rows.join(series_carry(panel), SERIES, "left")
    return joined.select(*df.columns, *[F.expr(e).alias(c) for c, e in pooled_means().items()])


def _daily_history(df: DataFrame, level: str) -> DataFrame:
    """Per (level, day): means over strictly earlier days, overall, same weekday, same month.

    Rows are summed per day first; each window then holds at most one row per calendar day.
    """
    daily = _slots(df).groupBy(level, DATE, "_dow", "_month").agg(
        F.sum(SALES).alias("_s"), F.count(SALES).alias("_n")
    )

    def past(keys: list[str], min_rows: int) -> Column:
        frame = Window.partitionBy(level, *keys).orderBy(DATE).rowsBetween(Window.unboundedPreceding, -1)
        return _mean(F.sum("_s").over(frame), F.sum("_n").over(frame), min_rows)

    return daily.select(
        level,
        DATE,
        past([], LEVEL_MIN_ROWS).alias(f"{level}_historical_mean"),
        past(["_dow"], CALENDAR_MIN_ROWS).alias(f"{level}_day_of_week_historical_mean"),
        past(["_month"], CALENDAR_MIN_ROWS).alias(f"{level}_month_historical_mean"),
    )


def _add_chronological(df: DataFrame, panel: DataFrame) -> DataFrame:
    past = Window.partitionBy(*SERIES).orderBy(DATE).rowsBetween(Window.unboundedPreceding, -1)
    own = _mean(F.sum(SALES).over(past), F.count(SALES).over(past), LEVEL_MIN_ROWS)
    rows = (
        df.join(_daily_history(panel, STORE), [STORE, DATE], "left")
        .join(_daily_history(panel, ITEM), [ITEM, DATE], "left")
        .withColumn("store_item_historical_mean", own)
    )
    return rows.select(*df.columns, *HISTORY_COLUMNS)


def add_history_aggregates(
    df: DataFrame, mode: str = "pooled", panel: DataFrame | None = None
) -> DataFrame:
    """Add the seven means. ``panel`` is the bare panel when ``df`` already carries other features."""
    panel = df if panel is None else panel
    if mode == "pooled":
        return _add_pooled(df, panel)
    if mode == "chronological":
        return _add_chronological(df, panel)
    raise ValueError(f"Unknown history mode {mode!r}; use 'pooled' or 'chronological'.")
