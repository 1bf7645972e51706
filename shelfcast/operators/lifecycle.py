"""Candidates, champion/challenger decisions and what is in production, as tables.

Both tables only grow: a candidate or a decision is appended, and the status of a model is a query
over the decision log.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the smallest denominator of a relative improvement.
IMPROVEMENT_FLOOR = 1e-8

CANDIDATE_SCHEMA = (
    "version int, name string, artifact_path string, registered_at timestamp, metrics map<string, double>,"
    " validation_metrics map<string, double>, baseline_metrics map<string, double>, dataset_hash string,"
    " dataset_rows bigint, dataset_start date, dataset_end date"
)
DECISION_SCHEMA = (
    "candidate_version int, previous_version int, promoted boolean, reason string, decided_at timestamp"
)


def empty_candidates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CANDIDATE_SCHEMA)


def empty_decisions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DECISION_SCHEMA)


def metric_map(row: DataFrame) -> DataFrame:
    """A one-row metric table as one map column ``metrics``."""
    pairs = [x for c in row.columns for x in (F.lit(c), F.col(c).cast("double"))]
    return row.select(F.create_map(*pairs).alias("metrics"))


def new_candidate(
    candidates: DataFrame,
    name: str,
    metrics: DataFrame,
    dataset: DataFrame,
    artifact_path: str = "",
    validation_metrics: DataFrame | None = None,
    baseline_metrics: DataFrame | None = None,
) -> DataFrame:
    """The row to append: next version, metrics and the facts of the training data.

    ``metrics`` are one-row metric tables; ``dataset`` is one row with dataset_hash, dataset_rows,
    dataset_start and dataset_end.
    """
    def mapped(row: DataFrame | None) -> Column:
        if row is None:
            return F.create_map().cast("map<string, double>")
        return metric_map(row).scalar()

    version = candidates.agg(F.coalesce(F.max("version"), F.lit(0)) + 1).scalar()
    return dataset.select(
        version.cast("int").alias("version"),
        F.lit(name).alias("name"),
        F.lit(artifact_path).alias("artifact_path"),
        F.current_timestamp().alias("registered_at"),
        mapped(metrics).alias("metrics"),
        mapped(validation_metrics).alias("validation_metrics"),
        mapped(baseline_metrics).alias("baseline_metrics"),
        "dataset_hash",
        F.col("dataset_rows").cast("long").alias("dataset_rows"),
        "dataset_start",
        "dataset_end",
    )


def latest_candidate(candidates: DataFrame) -> DataFrame:
    return candidates.orderBy(F.desc("version")).limit(1)


def production_version(decisions: DataFrame) -> DataFrame:
    """One row: the last promoted version, or null."""
    promoted = F.when(F.col("promoted"), F.col("decided_at"))
    return decisions.agg(F.max_by("candidate_version", promoted).alias("production_version"))


def active_model(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """The candidate row in production; empty before the first promotion."""
    return candidates.where(F.col("version") == production_version(decisions).scalar())


def promotion_decision(
    candidates: DataFrame,
    champion: DataFrame,
    metric: str = "rmse",
    min_improvement: float = 0.0,
) -> DataFrame:
    """Judge each candidate row against the champion (no row or one row).

    In order: a missing metric refuses; no champion, or one without the metric, promotes; another
    dataset hash promotes whatever the score; else the relative improvement must exceed the
    threshold. Lower metric values are better.
    """
    best = champion.select(
        F.col("version").alias("previous_version"),
        F.col("dataset_hash").alias("_champion_hash"),
        F.try_element_at("metrics", F.lit(metric)).alias("_champion"),
    ).agg(F.max(F.struct("previous_version", "_champion_hash", "_champion")))
    judged = candidates.withColumn("_best", best.scalar()).select(
        "*",
        F.try_element_at("metrics", F.lit(metric)).alias("_value"),
        F.col("_best.previous_version").alias("previous_version"),
        F.col("_best._champion_hash").alias("_champion_hash"),
        F.col("_best._champion").alias("_champion"),
    )
    improvement = (F.col("_champion") - F.col("_value")) / F.greatest(
        F.col("_champion"), F.lit(IMPROVEMENT_FLOOR)
    )
    new_data = (
        F.col("dataset_hash").isNotNull()
        & (F.col("dataset_hash") != "")
        & ~F.col("dataset_hash").eqNullSafe(F.col("_champion_hash"))
    )
    # The reasons' texts, as published.
    outcomes: list[tuple[Column | None, Column, Column]] = [
        (F.col("_value").isNull(), F.lit(False), F.lit(f"candidate missing metric {metric}")),
        (F.col("_champion").isNull(), F.lit(True), F.lit("no current production champion")),
        (new_data, F.lit(True), F.lit("candidate was trained on a new verified dataset version")),
        (
            improvement > min_improvement,
            F.lit(True),
            F.format_string(f"{metric} improved by %.2f%%", improvement * 100),
        ),
        (
            None,
            F.lit(False),
            F.format_string(
                f"{metric} improvement %.2f%% below threshold {min_improvement * 100:.2f}%%", improvement * 100
            ),
        ),
    ]
    promoted = reason = None
    for condition, verdict, text in outcomes[:-1]:
        promoted = F.when(condition, verdict) if promoted is None else promoted.when(condition, verdict)
        reason = F.when(condition, text) if reason is None else reason.when(condition, text)
    return judged.select(
        F.col("version").alias("candidate_version"),
        "previous_version",
        promoted.otherwise(outcomes[-1][1]).alias("promoted"),
        reason.otherwise(outcomes[-1][2]).alias("reason"),
    )


def promote_candidate(
    candidates: DataFrame,
    decisions: DataFrame,
    version: int | None = None,
    metric: str = "rmse",
    min_improvement: float = 0.0,
) -> DataFrame:
    """The decision row to append for one version, by default the latest."""
    chosen = latest_candidate(candidates) if version is None else candidates.where(F.col("version") == version)
    if chosen.isEmpty():
        raise ValueError(
            "An empty registry has nothing to promote." if version is None else f"The registry has no version {version}."
        )
    decided = promotion_decision(chosen, active_model(candidates, decisions), metric, min_improvement)
    return decided.withColumn("decided_at", F.current_timestamp())


def candidate_status(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """(version, name, status): candidate, production or archived."""
    live = production_version(decisions).scalar()
    ever = decisions.where("promoted").select(F.col("candidate_version").alias("version")).distinct()
    marked = candidates.join(ever.withColumn("_promoted", F.lit(True)), "version", "left")
    status = (
        F.when(F.col("version").eqNullSafe(live), "production")
        .when(F.col("_promoted"), "archived")
        .otherwise("candidate")
    )
    return marked.select("version", "name", status.alias("status"))


def registry_status(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """One row: production version, number of candidates, latest version and its name."""
    return candidates.agg(
        F.count(F.lit(1)).alias("candidate_count"),
        F.max("version").alias("latest_version"),
        F.max_by("name", "version").alias("latest_name"),
    ).withColumn("production_version", production_version(decisions).scalar())
