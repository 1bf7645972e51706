"""The full feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfcast.config import FeatureConfig
from shelfcast.operators.calendar import add_date_features
from shelfcast.operators.history import HISTORY_COLUMNS, add_history_aggregates
from shelfcast.operators.lag import lag_ratios, lag_windows
from shelfcast.operators.rolling import (
    PATTERN_COLUMNS,
    ordered_past,
    pattern_ratios,
    pattern_windows,
    rolling_statistics,
    rolling_windows,
    staging_columns,
)
from shelfcast.schema import SALES


def build_features(
    df: DataFrame,
    drop_missing: bool = True,
    config: FeatureConfig | None = None,
    holidays: DataFrame | str | None = "us",
) -> DataFrame:
    """Calendar, lag, rolling, history and demand-pattern columns over a clean panel.

    All per-series columns are declared in one projection, so they share one shuffle and one sort.
    With ``drop_missing`` only rows where every feature is known are kept.
    """
    config = config or FeatureConfig()
    lags, windows = list(config.lags), list(config.rolling_windows)
    patterned = config.enable_demand_pattern_features and {7, 28} <= set(windows)

    dated = add_date_features(df, holidays)
    per_series = {**lag_windows(lags), **rolling_windows(windows)}
    derived = {**lag_ratios(lags), **rolling_statistics(windows)}
    if patterned:
        per_series |= pattern_windows()
    featured = dated.withColumns(per_series).withColumns(ordered_past(windows)).withColumns(derived)
    if patterned:
        featured = featured.withColumns(pattern_ratios())
    featured = featured.drop(*staging_columns(windows))
    historic = config.enable_hierarchical_features
    if historic:
        featured = add_history_aggregates(featured, config.history_mode, panel=df)

    ordered = featured.select(
        *dated.columns,
        *lag_windows(lags),
        *derived,
        *(HISTORY_COLUMNS if historic else []),
        *(PATTERN_COLUMNS if patterned else []),
    )
    return complete_cases(ordered) if drop_missing else ordered


def complete_cases(features: DataFrame) -> DataFrame:
    """Rows without a null in any column but the target."""
    return features.dropna(how="any", subset=[c for c in features.columns if c != SALES])
