"""Which features a fitted model relies on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.functions.metrics import rmse
from shelfcast.operators.models import RidgeModel, TreeModel, score
from shelfcast.operators.ridge import INTERCEPT
from shelfcast.schema import KEY, SALES

# Fixed value: shuffles per feature.
REPEATS = 3
BLOCK_ROWS = 4096


def _ranked(rows: DataFrame, top_n: int | None) -> DataFrame:
    """Rank by importance. The table has one row per model input, so one task ranks it."""
    # Solvers differ beyond some places, and the two levels of a pair have the same weight: such ties go by name.
    order = Window.orderBy(F.desc(F.round("importance", 6)), "feature")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top_n) if top_n else ranked


def native_importance(model: RidgeModel | TreeModel, top_n: int | None = None) -> DataFrame:
    """Importances of the tree inputs, or absolute ridge weights, one for each level of a categorical input."""
    if isinstance(model, RidgeModel):
        named = F.concat_ws("_", "feature", "level").alias("feature")
        return _top(model.weights().where(F.col("feature") != INTERCEPT).select(named, F.abs("weight").alias("importance")), top_n)
    return _ranked(SparkSession.active().createDataFrame(model.importances(), "feature string, importance double"), top_n)


def _top(rows: DataFrame, top_n: int | None) -> DataFrame:
    """Ranks of a table with as many rows as there are levels: with `top_n` only those rows meet in one task."""
    return _ranked(rows.orderBy(F.desc("importance"), "feature").limit(top_n) if top_n else rows, top_n)


def _shuffled(column: str, repeat: int, rows_per_block: int, total: Column) -> Column:
    """The value of a random other row: a cyclic shift along a hash order inside hash blocks.

    Blocks keep every sort small however many rows there are; hashes make the shuffle repeatable.
    """
    block = F.pmod(F.xxhash64(*KEY, F.lit(repeat)), F.greatest(F.lit(1), F.ceil(total / rows_per_block)))
    order = F.xxhash64(*KEY, F.lit(repeat), F.lit("order"))
    ring = Window.partitionBy(block).orderBy(order, *KEY)
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.coalesce(F.lag(column).over(ring), F.last(column).over(whole))


def permutation_importance(
    model: RidgeModel | TreeModel,
    rows: DataFrame,
    features: Sequence[str],
    repeats: int = REPEATS,
    rows_per_block: int = BLOCK_ROWS,
    top_n: int | None = None,
) -> DataFrame:
    """Mean RMSE increase when one feature is shuffled, floored at 0.

    One scoring pass per repeat: each row is expanded to one copy per feature with that feature
    replaced, and copies are reduced to squared errors before any shuffle.
    """
    features = list(features)
    base = score(model, rows).agg(rmse(F.col(SALES), F.col("prediction"))).scalar()
    total = rows.agg(F.count(F.lit(1))).scalar()
    scored = None
    for repeat in range(repeats):
        mixed = rows.withColumn("_total", total).withColumns(
            {f"_p_{c}": _shuffled(c, repeat, rows_per_block, F.col("_total")) for c in features}
        )
        copies = mixed.withColumn("feature", F.explode(F.array(*[F.lit(c) for c in features]))).select(
            "feature",
            SALES,
            *[F.when(F.col("feature") == c, F.col(f"_p_{c}")).otherwise(F.col(c)).alias(c) for c in features],
        )
        part = (
            score(model, copies)
            .groupBy("feature")
            .agg(rmse(F.col(SALES), F.col("prediction")).alias("error"))
        )
        scored = part if scored is None else scored.unionByName(part)
    gain = F.greatest(F.lit(0.0), F.avg("error") - F.first("_base"))
    return _ranked(scored.withColumn("_base", base).groupBy("feature").agg(gain.alias("importance")), top_n)
