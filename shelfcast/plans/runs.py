"""End-to-end runs over stored tables: training, batch forecast, drift monitoring, backtest.

Every intermediate that a later step reads is a written table, so a lost executor or a restarted
driver continues from storage and no step recomputes another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.config import Config
from shelfcast.operators import backtest, baseline, drift, evaluate, features, forecast, importance, lifecycle, models
from shelfcast.operators.eda import dataset_metadata, sales_summary
from shelfcast.operators.normalize import normalize_schema, require_split, chronological_split, split_parts, split_windows
from shelfcast.operators.quality import quality_report, raise_for_errors
from shelfcast.operators.state import feature_state
from shelfcast.schema import DATE, SALES, feature_columns
from shelfcast.session import materialize
from shelfcast.sources import tables


def prepare(spark: SparkSession, raw: DataFrame, out: str, config: Config | None = None) -> DataFrame:
    """Clean panel, metadata, feature table and state, all written; returns the feature table."""
    config = config or Config()
    # Nothing is published before the gate: a bad delivery leaves the last good panel as it is.
    staged = materialize(normalize_schema(raw))
    raise_for_errors(quality_report(staged, require_daily_continuity=True))
    tables.write_document(dataset_metadata(raw), f"{out}/metadata")
    tables.write_table(staged, f"{out}/clean")
    clean = tables.read_table(spark, f"{out}/clean")
    tables.write_document(sales_summary(clean), f"{out}/summary")
    built = features.build_features(clean, config=config.features)
    tables.write_table(tables.with_month(built), f"{out}/features", partition_by=["sales_month"])
    tables.write_state(feature_state(clean), f"{out}/state")
    return tables.read_table(spark, f"{out}/features").drop("sales_month")


def train(
    spark: SparkSession,
    raw: DataFrame,
    out: str,
    config: Config | None = None,
    candidates: Sequence[str] | None = None,
) -> str:
    """Prepare, compare the candidates, refit the best on train and validation, score and register.

    ``candidates`` names the models to compare (default: all). Returns the chosen model's name.
    """
    config = config or Config()
    table = prepare(spark, raw, out, config)
    days = (config.data.validation_days, config.data.test_days)
    require_split(chronological_split(table.select(DATE), *days))
    train_part, validation, test = split_parts(table, *days)
    tables.write_document(split_windows(chronological_split(table.select(DATE), *days)), f"{out}/splits")

    columns = feature_columns(table)
    pipelines = models.model_candidates(columns)
    pipelines["boosted_trees"] = models.boosted_trees(columns, config.boosting)
    if candidates:
        pipelines = {name: pipelines[name] for name in candidates}
    rows, fitted = models.compare_models(train_part, validation, pipelines)
    baselines = baseline.baseline_scores(train_part, validation, test, same_split=True)
    tables.write_table(evaluate.leaderboard([*baselines, *rows]), f"{out}/leaderboard")
    board = tables.read_table(spark, f"{out}/leaderboard")
    chosen = evaluate.select_model(board, list(pipelines)).first()["model"]

    known = train_part.unionByName(validation)
    production = models.fit(pipelines[chosen], known)
    models.save_model(production, f"{out}/model")

    scored = evaluate.prediction_interval(
        models.score(fitted[chosen], validation), models.score(production, test)
    )
    tables.write_table(scored, f"{out}/predictions")
    predictions = tables.read_table(spark, f"{out}/predictions")
    tables.write_table(evaluate.regression_metrics(predictions), f"{out}/metrics")
    tables.write_table(evaluate.sliced_metrics(predictions), f"{out}/slices")
    tables.write_table(importance.native_importance(production), f"{out}/importance")
    _register(spark, out, chosen, config)
    return chosen


def _register(spark: SparkSession, out: str, name: str, config: Config) -> None:
    """Append the candidate and the promotion decision to the two logs."""
    clean = tables.read_table(spark, f"{out}/clean")
    mark = tables.table_fingerprint(clean)
    dataset = clean.agg(F.min(DATE).alias("dataset_start"), F.max(DATE).alias("dataset_end")).withColumns(
        {
            "dataset_hash": mark.select(F.concat_ws(":", *mark.columns)).scalar(),
            "dataset_rows": mark.select("rows").scalar(),
        }
    )
    board = tables.read_table(spark, f"{out}/leaderboard").select("model", "mae", "rmse", "mape", "smape")
    metrics = tables.read_table(spark, f"{out}/metrics")
    scores = [board.where(F.col("model") == model).drop("model") for model in (name, "seasonal_naive_7")]
    tables.commit_entry(
        spark,
        f"{out}/candidates",
        lifecycle.CANDIDATE_SCHEMA,
        lambda log: lifecycle.new_candidate(log, name, metrics, dataset, f"{out}/model", *scores),
    )
    candidates, _ = registry(spark, out)
    tables.commit_entry(
        spark,
        f"{out}/decisions",
        lifecycle.DECISION_SCHEMA,
        lambda log: lifecycle.promote_candidate(
            candidates,
            log,
            metric=config.registry.primary_metric,
            min_improvement=config.registry.minimum_relative_improvement,
        ),
    )


def registry(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """(candidates, decisions) in effect so far."""
    found = [
        tables.read_entries(spark, f"{out}/{name}", schema).drop("entry", "token")
        for name, schema in (("candidates", lifecycle.CANDIDATE_SCHEMA), ("decisions", lifecycle.DECISION_SCHEMA))
    ]
    return found[0], found[1]


def forecast_run(spark: SparkSession, out: str, days: int = 28) -> DataFrame:
    """Forecast every series with the saved model and state; written and returned."""
    model = models.load_model(f"{out}/model")
    state = tables.load_state(spark, f"{out}/state")
    result = forecast.forecast_next_days(state, lambda rows: models.score(model, rows), days)
    tables.write_table(result, f"{out}/forecast")
    return tables.read_table(spark, f"{out}/forecast")


def drift_run(
    spark: SparkSession,
    out: str,
    reference: DataFrame | None = None,
    current: DataFrame | None = None,
    config: Config | None = None,
    by: str = "date",
) -> DataFrame:
    """Summary, findings and status of two tables, or of the stored features split in two."""
    config = config or Config()
    if reference is None or current is None:
        table = tables.read_table(spark, f"{out}/features").drop("sales_month")
        sides = drift.split_reference_current(table, by=by)
        tables.write_table(sides, f"{out}/drift_sides", partition_by=["side"])
        stored = tables.read_table(spark, f"{out}/drift_sides")
        reference, current = (stored.where(F.col("side") == s).drop("side") for s in ("reference", "current"))
    _, summary = drift.detect_drift(reference, current, config.monitoring)
    tables.write_table(summary, f"{out}/drift_summary")
    findings = drift.drift_findings(tables.read_table(spark, f"{out}/drift_summary"), config.monitoring)
    tables.write_table(findings, f"{out}/drift_findings")
    status = drift.drift_status(tables.read_table(spark, f"{out}/drift_findings"))
    tables.write_document(status, f"{out}/drift_status")
    return status


def backtest_run(
    spark: SparkSession, out: str, config: Config | None = None, params: models.BoostingConfig | None = None
) -> DataFrame:
    """Baselines and boosted trees on every fold of the stored features."""
    size = config.backtest if config else Config().backtest
    folds = (size.folds, size.horizon_days, size.step_days)
    table = tables.read_table(spark, f"{out}/features").drop("sales_month")
    columns = feature_columns(table)

    def fit(part: DataFrame):
        fitted = models.fit(models.boosted_trees(columns, params or models.BACKTEST_BOOSTING), part)
        return lambda rows: models.score(fitted, rows)

    result = backtest.backtest_baselines(table.select(DATE, "store", "item", SALES, "sales_rolling_mean_7"), *folds)
    result = result.unionByName(backtest.backtest_model(table, fit, "boosted_trees", *folds))
    tables.write_table(result, f"{out}/backtest")
    return tables.read_table(spark, f"{out}/backtest")


def monitoring_tables(spark: SparkSession, out: str, top_n: int = 20) -> dict[str, DataFrame]:
    """What a dashboard reads: leaderboard, backtest, drift, importance and the active model."""
    candidates, decisions = registry(spark, out)
    return {
        "leaderboard": tables.read_table(spark, f"{out}/leaderboard"),
        "backtest": tables.read_table(spark, f"{out}/backtest"),
        "drift": tables.read_table(spark, f"{out}/drift_findings"),
        "importance": tables.read_table(spark, f"{out}/importance").orderBy("rank").limit(top_n),
        "active_model": lifecycle.active_model(candidates, decisions),
    }
