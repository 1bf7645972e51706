"""Serving-time features and multi-day forecasts from the feature state.

Serving features follow the published serving rules, which differ from training on purpose: lags
look up calendar days and fall back to the mean of the kept history, windows have no minimum
count, weekday and month means are replaced by the level means, and optional inputs are 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.calendar import (
    calendar_columns,
    holiday_dimension,
    no_holiday_columns,
    us_holidays,
    years_around,
)
from shelfcast.functions.scalars import non_negative
from shelfcast.operators.state import FeatureState
from shelfcast.schema import ITEM, LAGS, OPTIONAL, SERIES, SHAPE_WINDOWS, STORE, WINDOWS, require_columns

REQUEST_DATE = "forecast_date"
_EMPTY = "cast(array() AS array<struct<date: date, sales: double>>)"


def _mean(values: str) -> str:
    return f"(aggregate({values}, 0D, (a, x) -> a + x) / size({values}))"


def _median(values: str) -> str:
    n = f"size({values})"
    return f"((sort_array({values})[int(({n} - 1) / 2)] + sort_array({values})[int({n} / 2)]) / 2)"


def _deviation(values: str, mean: str) -> str:
    squares = f"aggregate({values}, 0D, (a, x) -> a + (x - {mean}) * (x - {mean}))"
    return f"CASE WHEN size({values}) > 1 THEN sqrt({squares} / (size({values}) - 1)) ELSE 0D END"


def _with_level_means(requests: DataFrame, state: FeatureState, cold_start: str) -> DataFrame:
    """Requests with history and level means; unknown series fall back to the global mean.

    ``hierarchical`` still uses the store or item mean when only the pair is unknown.
    """
    joined = requests.join(state.series, SERIES, "left").withColumn(
        "_global", state.totals.select("global_mean").scalar()
    )
    if cold_start == "hierarchical":
        for key in (STORE, ITEM):
            level = state.means.where(F.col("level") == key).select(key, F.col("mean_sales").alias(f"_{key}"))
            joined = joined.join(level, key, "left").withColumn(
                f"{key}_mean", F.coalesce(f"{key}_mean", f"_{key}")
            )
    elif cold_start != "pair":
        raise ValueError(f"Unknown cold start {cold_start!r}; use 'pair' or 'hierarchical'.")
    return joined.withColumns(
        {
            "history": F.coalesce(F.col("history"), F.expr(_EMPTY)),
            **{c: F.coalesce(c, "_global") for c in ("store_mean", "item_mean", "series_mean")},
        }
    )


def _serve(rows: DataFrame, holidays: DataFrame | str | None) -> DataFrame:
    """Feature columns for rows that hold the keys, the date, the history and the means."""
    keep = [c for c in rows.columns if c not in ("history", "store_mean", "item_mean", "series_mean", "_global")]
    staged = (
        rows.withColumns(
            {
                "_fallback": F.expr(
                    f"CASE WHEN size(history) > 0 THEN {_mean('history.sales')} ELSE _global END"
                ),
                "_prior": F.expr(f"filter(history, h -> h.date < {REQUEST_DATE}).sales"),
            }
        )
        .withColumns(
            {f"_w{n}": F.expr(f"slice(_prior, greatest(1, size(_prior) - {n - 1}), {n})") for n in WINDOWS}
        )
        .withColumns(
            {f"_m{n}": F.expr(f"CASE WHEN size(_w{n}) > 0 THEN {_mean(f'_w{n}')} ELSE _fallback END") for n in WINDOWS}
        )
        .withColumns(
            {
                f"_l{k}": F.expr(
                    f"coalesce(get(filter(history, h -> h.date = date_sub({REQUEST_DATE}, {k})), 0).sales, _fallback)"
                )
                for k in LAGS
            }
        )
    )

    same_weekday = [k for k in (7, 14, 21, 28) if k in LAGS]
    columns: dict[str, str] = {f"sales_lag_{k}": f"_l{k}" for k in LAGS}
    columns |= {
        "sales_lag_delta_7_14": "_l7 - _l14",
        "sales_lag_ratio_7_28": "_l7 / greatest(_l28, 1e-6D)",
        "sales_same_weekday_4wk_mean": f"({' + '.join(f'_l{k}' for k in same_weekday)}) / {len(same_weekday)}",
    }
    for n in WINDOWS:
        columns[f"sales_rolling_mean_{n}"] = f"_m{n}"
        if n in SHAPE_WINDOWS:
            for name, value in (
                ("median", _median(f"_w{n}")),
                ("std", None),
                ("min", f"array_min(_w{n})"),
                ("max", f"array_max(_w{n})"),
            ):
                columns[f"sales_rolling_{name}_{n}"] = (
                    f"CASE WHEN size(_w{n}) > 0 THEN {value} ELSE _fallback END"
                    if value
                    else _deviation(f"_w{n}", f"_m{n}")
                )
    columns |= {
        "store_historical_mean": "store_mean",
        "item_historical_mean": "item_mean",
        "store_item_historical_mean": "series_mean",
        "store_day_of_week_historical_mean": "store_mean",
        "item_day_of_week_historical_mean": "item_mean",
        "store_month_historical_mean": "store_mean",
        "item_month_historical_mean": "item_mean",
        "recent_zero_sales_28": "double(size(filter(_w28, x -> x = 0)))",
        "sales_cv_28": f"({_deviation('_w28', '_m28')}) / greatest(_m28, 1e-6D)",
        "sales_momentum_7_28": "_m7 / greatest(_m28, 1e-6D)",
        "sales_trend_28": (
            "CASE WHEN size(_w28) > 1 THEN (_w28[size(_w28) - 1] - _w28[0]) / (size(_w28) - 1) ELSE 0D END"
        ),
        "intermittency_score_28": "size(filter(_w28, x -> x = 0)) / 28D",
    }
    columns |= {c: "0D" for c in OPTIONAL}

    # A request is scored on its own, so the year index always starts at its own year.
    calendar = calendar_columns(REQUEST_DATE, F.year(REQUEST_DATE))
    served = staged.select(
        *keep, *[c.alias(n) for n, c in calendar.items()], *[F.expr(e).alias(n) for n, e in columns.items()]
    )
    order = [*keep, *calendar, "is_us_holiday", "days_to_nearest_us_holiday", *columns]
    if holidays is None:
        return served.select("*", *no_holiday_columns()).select(*order)
    dates = rows.select(REQUEST_DATE)
    table = us_holidays(years_around(dates, REQUEST_DATE)) if isinstance(holidays, str) else holidays
    days = holiday_dimension(dates, table, REQUEST_DATE)
    return served.join(days, REQUEST_DATE, "left").select(*order)


def serving_features(
    requests: DataFrame,
    state: FeatureState,
    cold_start: str = "pair",
    holidays: DataFrame | str | None = "us",
) -> DataFrame:
    """Features of (store, item, forecast_date) requests, one row per request."""
    require_columns(requests, [*SERIES, REQUEST_DATE])
    typed = requests.withColumns(
        {REQUEST_DATE: F.col(REQUEST_DATE).cast("date"), **{k: F.col(k).cast("string") for k in SERIES}}
    )
    return _serve(_with_level_means(typed, state, cold_start), holidays)


def forecast_grid(
    state: FeatureState,
    days: int = 28,
    start_date: str | Column | None = None,
    holidays: DataFrame | str | None = "us",
) -> DataFrame:
    """Features of every series for ``days`` days after the last day (or from ``start_date``).

    The state row is expanded in place: no join and no model call per row.
    """
    first = (
        F.date_add(state.totals.select("last_date").scalar(), 1)
        if start_date is None
        else (F.lit(start_date).cast("date") if isinstance(start_date, str) else start_date)
    )
    grid = (
        state.series.withColumn("_global", state.totals.select("global_mean").scalar())
        .withColumn("_first", first)
        .withColumn("horizon", F.explode(F.expr(f"sequence(1, {int(days)})")))
        .withColumn(REQUEST_DATE, F.expr("date_add(_first, horizon - 1)"))
        .drop("_first")
    )
    return _serve(grid, holidays)


def forecast_next_days(
    state: FeatureState,
    score: Callable[[DataFrame], DataFrame],
    days: int = 28,
    start_date: str | None = None,
    holidays: DataFrame | str | None = "us",
) -> DataFrame:
    """(store, item, forecast_date, horizon, prediction); ``score`` adds ``prediction``."""
    scored = score(forecast_grid(state, days, start_date, holidays))
    return scored.select(
        *SERIES, REQUEST_DATE, "horizon", non_negative(F.col("prediction")).alias("prediction")
    )


def forecast_series(
    state: FeatureState,
    store: str,
    item: str,
    score: Callable[[DataFrame], DataFrame],
    days: int = 28,
    start_date: str | None = None,
) -> DataFrame:
    """Forecast of one series, known or not, for 1 to 90 days."""
    if not 1 <= days <= 90:
        raise ValueError("days must be between 1 and 90.")
    first = (
        F.date_add("last_date", 1) if start_date is None else F.lit(start_date).cast("date")
    )
    requests = state.totals.select(
        F.lit(str(store)).alias(STORE),
        F.lit(str(item)).alias(ITEM),
        first.alias("_first"),
        F.explode(F.expr(f"sequence(1, {int(days)})")).alias("horizon"),
    ).select(*SERIES, F.expr("date_add(_first, horizon - 1)").alias(REQUEST_DATE), "horizon")
    scored = score(serving_features(requests, state))
    return scored.select(
        *SERIES, REQUEST_DATE, "horizon", non_negative(F.col("prediction")).alias("prediction")
    )


def score_requests(
    requests: DataFrame,
    state: FeatureState,
    score: Callable[[DataFrame], DataFrame],
    cold_start: str = "pair",
) -> DataFrame:
    """Business requests (store, item, forecast_date) with a floored prediction."""
    scored = score(serving_features(requests, state, cold_start))
    return scored.withColumn("prediction", non_negative(F.col("prediction")))


# The inputs every ready-made feature row must bring.
SCORED_FEATURES = [
    "store",
    "item",
    "day_of_week",
    "month",
    "day_of_month",
    "week_of_year",
    "is_weekend",
    "sales_lag_7",
    "sales_lag_14",
    "sales_lag_28",
    "sales_rolling_mean_7",
    "sales_rolling_mean_28",
    "store_historical_mean",
    "item_historical_mean",
]


def score_features(
    rows: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    feature_columns: list[str] | None = None,
) -> DataFrame:
    """Score ready-made feature rows; fails when a mandatory or model column is missing."""
    needed = {*SCORED_FEATURES, *(feature_columns or [])}
    missing = sorted(needed - set(rows.columns))
    if missing:
        raise ValueError(f"The rows lack columns that scoring needs: {missing}")
    return score(rows).withColumn("prediction", non_negative(F.col("prediction")))
