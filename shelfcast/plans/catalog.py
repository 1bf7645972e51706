"""The named queries: each runs an operator over whole panels derived from the order tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators import (
    backtest,
    baseline,
    calendar,
    drift,
    eda,
    evaluate,
    features,
    forecast,
    history,
    importance,
    lag,
    lifecycle,
    models,
    normalize,
    quality,
    ridge,
    rolling,
    state,
)
from shelfcast.functions.scalars import non_negative
from shelfcast.plans import panels
from shelfcast.schema import DATE, ITEM, SALES, SERIES, STORE, feature_columns
from shelfcast.session import materialize
from shelfcast.sources.tables import table_fingerprint, with_month

Query = Callable[[SparkSession, str], DataFrame]


# Means of whole numbers can lie exactly between two rounded values; engines round those differently.
TIE_BREAK = 1e-10


def report(df: DataFrame, digits: int = 6) -> DataFrame:
    """Comparable output: text dates, 64-bit counts, rounded numbers (without a negative zero)."""
    shown = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c + F.lit(TIE_BREAK), digits) + F.lit(0.0)
        shown.append(c.alias(field.name))
    return df.select(*shown)


def _stored_panel(spark, sf, panel=panels.sales_sparse):
    """The panel as the operators with several passes expect it: written once, then read."""
    return materialize(panel(spark, sf))


# ---- intake and quality -------------------------------------------------------------------------


def _metadata(spark, sf):
    return eda.dataset_metadata(panels.dirty_sales(spark, sf))


def _fingerprint(spark, sf):
    return table_fingerprint(panels.sales_sparse(spark, sf))


def _normalized(spark, sf):
    return normalize.normalize_schema(panels.raw_sales(spark, sf))


def _coerced(spark, sf):
    named = normalize.canonical_names(panels.raw_sales(spark, sf))
    return normalize.coerce_numeric(named, [SALES, "price"])


def _split(spark, sf):
    return normalize.chronological_split(panels.sales_sparse(spark, sf))


def _split_timeline(spark, sf):
    return normalize.split_bounds(panels.sales_sparse(spark, sf))


def _split_windows(spark, sf):
    return normalize.split_windows(normalize.chronological_split(panels.sales_sparse(spark, sf)))


def _dense(spark, sf):
    return panels.sales_dense(spark, sf)


def _duplicates(spark, sf):
    return quality.duplicate_keys(panels.dirty_sales(spark, sf))


def _dq_report(spark, sf):
    return quality.quality_report(panels.dirty_sales(spark, sf), require_daily_continuity=True)


def _dq_shape(spark, sf):
    return quality.quality_report(_stored_panel(spark, sf), check_shape=True)


def _dq_missingness(spark, sf):
    return quality.missing_rates(panels.dirty_sales(spark, sf))


def _dq_continuity(spark, sf):
    return quality.continuity_gaps(panels.sales_sparse(spark, sf))


def _dq_contract(spark, sf):
    return quality.check_contract(panels.dirty_sales(spark, sf))


EXPECTED = quality.DatasetExpectation(min_rows=40_000, stores=5, items=7, start="1995-01-02", end="2001-11-04")


def _verify(spark, sf):
    return quality.verify_dataset(_stored_panel(spark, sf), EXPECTED)


def _verdict(spark, sf):
    return quality.verification_verdict(_verify(spark, sf))


# ---- features -----------------------------------------------------------------------------------


def _calendar(spark, sf):
    return calendar.add_date_features(panels.sales_sparse(spark, sf), holidays=None)


def _holidays(spark, sf):
    dated = calendar.add_date_features(_stored_panel(spark, sf))
    return dated.select(DATE, *SERIES, "is_us_holiday", "days_to_nearest_us_holiday")


def _lags(spark, sf, panel=panels.sales_sparse):
    return lag.add_lag_features(panel(spark, sf))


def _horizon(spark, sf):
    return lag.add_horizon_target(panels.sales_sparse(spark, sf), 7)


def _rolling(spark, sf, panel=panels.sales_sparse):
    rolled = rolling.add_rolling_features(panel(spark, sf))
    return rolled.drop("sales_rolling_median_7", "sales_rolling_median_28")


def _rolling_median(spark, sf):
    rolled = rolling.add_rolling_features(panels.sales_sparse(spark, sf), [7, 28])
    return rolled.select(DATE, *SERIES, "sales_rolling_median_7", "sales_rolling_median_28")


def _history(spark, sf, panel=panels.sales_sparse):
    return history.add_history_aggregates(_stored_panel(spark, sf, panel))


def _history_chrono(spark, sf):
    return history.add_history_aggregates(_stored_panel(spark, sf), mode="chronological")


def _patterns(spark, sf):
    rolled = rolling.add_rolling_features(panels.sales_dense(spark, sf), [7, 28])
    return rolling.add_demand_pattern_features(rolled).select(DATE, *SERIES, *rolling.PATTERN_COLUMNS)


def _features(spark, sf, panel=panels.sales_sparse):
    return features.build_features(_stored_panel(spark, sf, panel), drop_missing=False)


def _features_complete(spark, sf):
    return features.build_features(_stored_panel(spark, sf))


# ---- descriptive reports ------------------------------------------------------------------------


def _group_stats(spark, sf):
    panel = _stored_panel(spark, sf)
    return eda.group_stats(panel, STORE).unionByName(eda.group_stats(panel, ITEM))


def _on_sparse(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: operator(panels.sales_sparse(spark, sf))


def _on_stored(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: operator(_stored_panel(spark, sf))


# ---- evaluation ---------------------------------------------------------------------------------


def _parts(spark, sf):
    return normalize.split_parts(_stored_panel(spark, sf))


def _seasonal(spark, sf):
    train, validation, test = _parts(spark, sf)
    return baseline.seasonal_naive(train.unionByName(validation), test)


def _metrics(spark, sf):
    return evaluate.regression_metrics(_seasonal(spark, sf))


def _rolled_parts(spark, sf):
    rolled = rolling.add_rolling_features(_stored_panel(spark, sf), [7])
    return normalize.split_parts(rolled)


def _moving_average(spark, sf):
    _, validation, _ = _rolled_parts(spark, sf)
    return baseline.moving_average(validation).select(DATE, *SERIES, SALES, "prediction")


def _leaderboard(spark, sf):
    return evaluate.leaderboard(baseline.baseline_scores(*_rolled_parts(spark, sf)))


def _select_model(spark, sf):
    board = evaluate.leaderboard(baseline.baseline_scores(*_rolled_parts(spark, sf), same_split=True))
    return evaluate.select_model(board, ["seasonal_naive_7", "moving_average_7"])


def _sliced(spark, sf):
    return evaluate.sliced_metrics(_seasonal(spark, sf))


def _interval(spark, sf):
    train, validation, test = _parts(spark, sf)
    scored_validation = baseline.seasonal_naive(train, validation)
    scored_test = baseline.seasonal_naive(train.unionByName(validation), test)
    return evaluate.prediction_interval(scored_validation, scored_test)


def _clamped(spark, sf):
    """Sales minus the series' trailing mean, floored at 0; null before the mean exists."""
    rolled = rolling.add_rolling_features(panels.sales_sparse(spark, sf), [7])
    excess = F.col(SALES) - F.col("sales_rolling_mean_7")
    return rolled.select(DATE, *SERIES, non_negative(excess).alias("excess"))


def _folds(spark, sf):
    return backtest.fold_windows(panels.sales_sparse(spark, sf))


def _backtest_baseline(spark, sf):
    rolled = rolling.add_rolling_features(_stored_panel(spark, sf), [7])
    return backtest.backtest_baselines(rolled)


# ---- drift --------------------------------------------------------------------------------------


def _drift_sides(spark, sf):
    panel = panels.sales_business(spark, sf).withColumn("sales_month", F.date_format(DATE, "yyyy-MM"))
    train, validation, test = normalize.split_parts(materialize(panel))
    return train.unionByName(validation), test


def _psi(spark, sf):
    return drift.population_stability_index(*_drift_sides(spark, sf), [SALES, "price", "promotion_flag"])


def _numeric_drift(spark, sf):
    return drift.numeric_drift(*_drift_sides(spark, sf))


def _categorical_drift(spark, sf):
    return drift.categorical_drift(*_drift_sides(spark, sf))


def _new_categories(spark, sf):
    return drift.new_levels(*_drift_sides(spark, sf), [STORE, ITEM, "sales_month"])


def _feature_sides(spark, sf):
    """The feature table before and after the cut by date, every column of it."""
    table = materialize(features.build_features(_stored_panel(spark, sf)))
    cut = F.date_sub(table.agg(F.max(DATE)).scalar(), 89)
    return table.where(F.col(DATE) < cut).drop(DATE), table.where(F.col(DATE) >= cut).drop(DATE)


def _drift_features(spark, sf):
    return drift.detect_drift(*_feature_sides(spark, sf))[1]


def _drift_features_findings(spark, sf):
    return drift.detect_drift(*_feature_sides(spark, sf))[0]


def _drift_summary(spark, sf):
    return drift.detect_drift(*_drift_sides(spark, sf))[1]


def _drift_findings(spark, sf):
    return drift.detect_drift(*_drift_sides(spark, sf))[0]


def _drift_status(spark, sf):
    return drift.drift_status(_drift_findings(spark, sf))


def _drift_split(spark, sf, panel=panels.sales_sparse):
    return drift.split_reference_current(_stored_panel(spark, sf, panel), by="position")


def _drift_split_date(spark, sf):
    return drift.split_reference_current(panels.sales_sparse(spark, sf), by="date")


# ---- state and forecasts ------------------------------------------------------------------------


def _feature_state(spark, sf, panel=panels.sales_sparse):
    series = state.feature_state(_stored_panel(spark, sf, panel)).series
    return series.select(
        *SERIES,
        F.size("history").alias("kept_days"),
        F.get("history", F.lit(0))["date"].alias("first_kept"),
        F.expr("aggregate(history.sales, 0D, (a, x) -> a + x)").alias("kept_sales"),
        "series_mean",
        "store_mean",
        "item_mean",
    )


def requests_from(panel: DataFrame) -> DataFrame:
    """Requests inside, just after and long after the history of each series, and for unknown items."""
    known = panel.groupBy(*SERIES).agg(F.max(DATE).alias("_last"))
    return known.select(
        STORE,
        F.explode(F.array(F.col(ITEM), F.concat(F.lit("NEW "), F.col(ITEM)))).alias(ITEM),
        "_last",
    ).select(
        *SERIES,
        F.explode(F.transform(F.array(*[F.lit(d) for d in (-40, 1, 6, 45)]), lambda d: F.date_add("_last", d))).alias(
            "forecast_date"
        ),
    )


def _serving(spark, sf):
    panel = _stored_panel(spark, sf)
    served = forecast.serving_features(requests_from(panel), state.feature_state(panel))
    return served.where(~F.col(ITEM).startswith("NEW "))


def _cold_start(spark, sf):
    panel = _stored_panel(spark, sf)
    served = forecast.serving_features(
        requests_from(panel), state.feature_state(panel), cold_start="hierarchical"
    )
    return served.where(F.col(ITEM).startswith("NEW ")).select(
        *SERIES,
        "forecast_date",
        "sales_lag_7",
        "sales_rolling_mean_28",
        "store_historical_mean",
        "item_historical_mean",
        "store_item_historical_mean",
    )


def _grid(spark, sf):
    grid = forecast.forecast_grid(state.feature_state(_stored_panel(spark, sf)))
    return grid.select(
        *SERIES, "forecast_date", "horizon", "day_of_week", "sales_lag_7", "sales_lag_28", "sales_rolling_mean_7"
    )


def lag_or_mean(rows: DataFrame) -> DataFrame:
    """A model-free scorer: the mean of last week's day and the 28-day mean."""
    return rows.withColumn("prediction", (F.col("sales_lag_7") + F.col("sales_rolling_mean_28")) / 2)


def _forecast(spark, sf, panel=panels.sales_sparse):
    return forecast.forecast_next_days(state.feature_state(_stored_panel(spark, sf, panel)), lag_or_mean)


def _forecast_series(spark, sf):
    series_state = state.feature_state(_stored_panel(spark, sf))
    return forecast.forecast_series(series_state, "ASIA", "PROMO", lag_or_mean, days=60)


def _score_requests(spark, sf):
    panel = _stored_panel(spark, sf)
    scored = forecast.score_requests(requests_from(panel), state.feature_state(panel), lag_or_mean)
    return scored.select(*SERIES, "forecast_date", "prediction")


# ---- models -------------------------------------------------------------------------------------


def _feature_table(spark, sf):
    """The feature table, written once by month for all fits that read it."""
    return materialize(with_month(features.build_features(_stored_panel(spark, sf))), "sales_month")


def _feature_parts(spark, sf):
    return normalize.split_parts(_feature_table(spark, sf).drop("sales_month"))


def _model_leaderboard(spark, sf):
    train, validation, test = _feature_parts(spark, sf)
    rows, _ = models.compare_models(train, validation, models.model_candidates(feature_columns(train)))
    return evaluate.leaderboard([*baseline.baseline_scores(train, validation, test, same_split=True), *rows])


def _ridge_on_known(spark, sf):
    train, validation, test = _feature_parts(spark, sf)
    known = train.unionByName(validation)
    return models.fit(models.ridge(feature_columns(known)), known), known, test


def _ridge_predictions(spark, sf):
    fitted, _, test = _ridge_on_known(spark, sf)
    scored = models.score(fitted, test)
    # Two solvers of one system agree to about nine places.
    return scored.select(DATE, *SERIES, SALES, F.round("prediction", 4).alias("prediction"))


def _ridge_optimality(spark, sf):
    fitted, known, _ = _ridge_on_known(spark, sf)
    return ridge.optimality(fitted, known)


def _backtest_boosted(spark, sf):
    table = _feature_table(spark, sf)
    columns = feature_columns(table.drop("sales_month"))

    def fit(part):
        fitted = models.fit(models.boosted_trees(columns, models.BACKTEST_BOOSTING), part)
        return lambda rows: models.score(fitted, rows)

    return backtest.backtest_model(table, fit, "boosted_trees")


def _importance(spark, sf):
    train, validation, _ = _feature_parts(spark, sf)
    columns = feature_columns(train)
    fitted = models.fit(models.ridge(columns), train)
    return importance.permutation_importance(fitted, validation, columns)


def _native_importance(spark, sf):
    fitted, _, _ = _ridge_on_known(spark, sf)
    return importance.native_importance(fitted)


# ---- lifecycle ----------------------------------------------------------------------------------


def candidates_from(spark, sf):
    """The two baselines as registered versions, and one more version on changed data."""
    panel = _stored_panel(spark, sf)
    parts = normalize.split_parts(rolling.add_rolling_features(panel, [7]))
    board = materialize(evaluate.leaderboard(baseline.baseline_scores(*parts, same_split=True)))
    dataset = panel.agg(
        F.count(F.lit(1)).alias("dataset_rows"), F.min(DATE).alias("dataset_start"), F.max(DATE).alias("dataset_end")
    ).withColumn("dataset_hash", F.md5(F.concat_ws("|", "dataset_rows", "dataset_start", "dataset_end")))
    version = F.when(F.col("model") == "seasonal_naive_7", 1).otherwise(2)
    metrics = F.create_map(F.lit("rmse"), F.col("rmse"), F.lit("mae"), F.col("mae"))
    first = board.select(version.alias("version"), F.col("model").alias("name"), metrics.alias("metrics"))
    both = first.withColumn("dataset_hash", dataset.select("dataset_hash").scalar())
    renewed = both.where("version = 1").select(
        F.lit(3).alias("version"), "name", "metrics", F.concat(F.lit("new-"), F.col("dataset_hash")).alias("dataset_hash")
    )
    unscored = both.where("version = 1").select(
        F.lit(4).alias("version"), "name", F.create_map().cast("map<string,double>").alias("metrics"), "dataset_hash"
    )
    return both.unionByName(renewed).unionByName(unscored)


def _promotion(spark, sf):
    candidates = candidates_from(spark, sf)
    champion = candidates.where("version = 2")
    return lifecycle.promotion_decision(candidates, champion, "rmse", 0.01)


def _registry_status(spark, sf):
    candidates = candidates_from(spark, sf)
    first = lifecycle.promotion_decision(candidates.where("version = 1"), candidates.where("version = 0"))
    later = lifecycle.promotion_decision(candidates.where("version > 1"), candidates.where("version = 1"))
    log = first.unionByName(later).withColumn("decided_at", F.timestamp_seconds("candidate_version"))
    return lifecycle.registry_status(candidates, log)


def _logged(spark, sf):
    """The versions in the order in which they were registered, each judged against what was in production then."""
    candidates = candidates_from(spark, sf)
    log = lifecycle.empty_decisions(spark)
    for version in (1, 2, 3, 4):
        chosen = candidates.where(F.col("version") == version)
        champion = lifecycle.active_model(candidates, log)
        decided = lifecycle.promotion_decision(chosen, champion, "rmse", 0.01)
        # A clock that is the version keeps the run repeatable.
        log = materialize(log.unionByName(decided.withColumn("decided_at", F.timestamp_seconds(F.lit(version)))))
    return candidates, log


def _registered(spark, sf):
    """The row that registering the moving average next would append."""
    candidates = candidates_from(spark, sf).select("version", "name", "metrics")
    panel = _stored_panel(spark, sf)
    parts = normalize.split_parts(rolling.add_rolling_features(panel, [7]))
    board = evaluate.leaderboard(baseline.baseline_scores(*parts, same_split=True))
    metrics = board.where("model = 'moving_average_7'").select("mae", "rmse")
    dataset = panel.agg(F.count(F.lit(1)).alias("dataset_rows"), F.min(DATE).alias("dataset_start"), F.max(DATE).alias("dataset_end"))
    dataset = dataset.withColumn("dataset_hash", F.md5(F.col("dataset_rows").cast("string")))
    row = lifecycle.new_candidate(candidates, "moving_average_7", materialize(metrics), dataset)
    shown = ["version", "name", "dataset_hash", "dataset_rows", "dataset_start", "dataset_end"]
    return row.select(*shown, F.element_at("metrics", "rmse").alias("rmse"), F.element_at("metrics", "mae").alias("mae"))


def _promotions(spark, sf):
    return _logged(spark, sf)[1].drop("decided_at")


def _candidate_status(spark, sf):
    return lifecycle.candidate_status(*_logged(spark, sf))


def _active_model(spark, sf):
    return lifecycle.active_model(*_logged(spark, sf)).select("version", "name", F.element_at("metrics", "rmse").alias("rmse"))


def _stored_metrics(spark, sf):
    """Errors computed again from stored predictions, as a later run reads them."""
    return evaluate.regression_metrics(materialize(_seasonal(spark, sf)))


QUERIES: dict[str, Query] = {
    "dataset_metadata": _metadata,
    "table_fingerprint": _fingerprint,
    "normalize_schema": _normalized,
    "coerce_numeric": _coerced,
    "chronological_split": _split,
    "split_timeline": _split_timeline,
    "split_windows": _split_windows,
    "dense_panel": _dense,
    "dq_duplicate_keys": _duplicates,
    "dq_report": _dq_report,
    "dq_shape": _dq_shape,
    "dq_missingness": _dq_missingness,
    "dq_continuity": _dq_continuity,
    "dq_contract": _dq_contract,
    "verify_dataset": _verify,
    "verify_verdict": _verdict,
    "calendar_features": _calendar,
    "holiday_features": _holidays,
    "lag_features": _lags,
    "horizon_target": _horizon,
    "rolling_features": _rolling,
    "rolling_median": _rolling_median,
    "history_means": _history,
    "history_means_chrono": _history_chrono,
    "demand_pattern": _patterns,
    "build_features": _features,
    "features_complete": _features_complete,
    "sales_summary": _on_stored(eda.sales_summary),
    "daily_sales": _on_sparse(eda.daily_sales),
    "dow_profile": _on_sparse(eda.weekday_profile),
    "month_profile": _on_sparse(eda.month_profile),
    "store_profile": _on_sparse(eda.store_profile),
    "store_item_pivot": _on_stored(eda.store_item_pivot),
    "top_items": _on_sparse(lambda df: eda.top_items(df, 3)),
    "example_series": _on_sparse(eda.example_series),
    "lag_autocorrelation": _on_sparse(eda.lag_autocorrelation),
    "lag_correlation_pooled": _on_sparse(eda.pooled_lag_correlation),
    "panel_coverage": _on_sparse(eda.panel_coverage),
    "coverage_summary": _on_sparse(eda.coverage_summary),
    "group_stats": _group_stats,
    "seasonal_naive": _seasonal,
    "regression_metrics": _metrics,
    "moving_average_baseline": _moving_average,
    "non_negative": _clamped,
    "leaderboard": _leaderboard,
    "select_model": _select_model,
    "sliced_metrics": _sliced,
    "prediction_interval": _interval,
    "backtest_folds": _folds,
    "backtest_baseline": _backtest_baseline,
    "psi": _psi,
    "numeric_drift": _numeric_drift,
    "categorical_drift": _categorical_drift,
    "new_categories": _new_categories,
    "drift_features": _drift_features,
    "drift_features_findings": _drift_features_findings,
    "drift_summary": _drift_summary,
    "drift_findings": _drift_findings,
    "drift_status": _drift_status,
    "drift_split": _drift_split,
    "drift_split_by_date": _drift_split_date,
    "state_means": _on_sparse(state.state_means),
    "state_tail": _on_sparse(state.state_tail),
    "feature_state": _feature_state,
    "serving_features": _serving,
    "serving_cold_start": _cold_start,
    "forecast_grid": _grid,
    "forecast_next_days": _forecast,
    "forecast_series": _forecast_series,
    "score_requests": _score_requests,
    "model_leaderboard": _model_leaderboard,
    "ridge_predictions": _ridge_predictions,
    "ridge_optimality": _ridge_optimality,
    "backtest_boosted": _backtest_boosted,
    "permutation_importance": _importance,
    "native_importance": _native_importance,
    "promotion_decision": _promotion,
    "stored_metrics": _stored_metrics,
    "registry_status": _registry_status,
    "register_candidate": _registered,
    "promotion_log": _promotions,
    "candidate_status": _candidate_status,
    "active_model": _active_model,
}

# The same operators over many short series.
OVER_WIDE = {
    "lag_features": _lags,
    "rolling_features": _rolling,
    "history_means": _history,
    "build_features": _features,
    "drift_split": _drift_split,
    "feature_state": _feature_state,
    "forecast_next_days": _forecast,
}
QUERIES |= {f"wide_{name}": partial(run, panel=panels.sales_wide) for name, run in OVER_WIDE.items()}


def registered() -> dict[str, Query]:
    """Every query with comparable output."""
    return {name: (lambda spark, sf, run=run: report(run(spark, sf))) for name, run in QUERIES.items()}
