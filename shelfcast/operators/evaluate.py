"""Error reports, residual intervals and model choice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.metrics import mae, regression_aggregates, rmse
from shelfcast.functions.scalars import non_negative
from shelfcast.operators.sketches import column_quantiles
from shelfcast.schema import SALES, STORE

# Names of the volume thirds.
VOLUME_LABELS = ["low", "medium", "high"]


def regression_metrics(
    df: DataFrame, actual: str = SALES, predicted: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    return df.groupBy(*by).agg(*regression_aggregates(actual, predicted))


def sliced_metrics(df: DataFrame, predicted: str = "prediction") -> DataFrame:
    """Rows, MAE and RMSE per third of the actual volume and per store.

    The thirds are cut at quantiles, right-closed, so equal actuals stay together. Fails when the
    actuals have too few distinct levels for three thirds.
    """
    edges = column_quantiles(df, [SALES], [0.0, 1 / 3, 2 / 3, 1.0])[SALES] or []
    cut = df.withColumn("_edges", F.array(*[F.lit(float(e)) for e in edges]))
    distinct = F.size(F.array_distinct("_edges")) == 4
    volume = (
        F.when(~distinct, F.raise_error(F.lit("Too few distinct actuals for three volume slices.")))
        .when(F.col(SALES) <= F.get("_edges", F.lit(1)), VOLUME_LABELS[0])
        .when(F.col(SALES) <= F.get("_edges", F.lit(2)), VOLUME_LABELS[1])
        .otherwise(VOLUME_LABELS[2])
    )
    slices = F.array(F.concat(F.lit("volume="), volume), F.concat(F.lit("store="), F.col(STORE)))
    y, p = F.col(SALES), F.col(predicted)
    return (
        cut.select(F.explode(slices).alias("slice"), SALES, predicted)
        .groupBy("slice")
        .agg(F.count(F.lit(1)).alias("rows"), mae(y, p).alias("mae"), rmse(y, p).alias("rmse"))
    )


def prediction_interval(
    validation: DataFrame,
    scored: DataFrame,
    actual: str = SALES,
    predicted: str = "prediction",
    alpha: float = 0.1,
) -> DataFrame:
    """Add ``prediction_p10`` and ``prediction_p90`` from the validation residuals, floored at 0.

    The names are the published ones; with the default ``alpha`` the bounds are the 5 % and 95 %
    residual quantiles.
    """
    residuals = validation.select((F.col(actual) - F.col(predicted)).alias("residual"))
    band = column_quantiles(residuals, ["residual"], [alpha / 2, 1 - alpha / 2])["residual"]
    band = F.array(*[F.lit(b) for b in band]) if band else F.lit(None).cast("array<double>")
    point = F.col(predicted)
    return (
        scored.withColumn("_band", band)
        .withColumns(
            {
                "prediction_p10": non_negative(point + F.col("_band")[0]),
                "prediction_p90": non_negative(point + F.col("_band")[1]),
            }
        )
        .drop("_band")
    )


def leaderboard(rows: Sequence[DataFrame]) -> DataFrame:
    """Union of one-row results with a ``model`` column, best RMSE first."""
    board = rows[0]
    for row in rows[1:]:
        board = board.unionByName(row, allowMissingColumns=True)
    return board.orderBy("rmse", "model")


def select_model(board: DataFrame, trainable: Sequence[str]) -> DataFrame:
    """The best model among those that can be refitted, as one row."""
    return board.where(F.col("model").isin(*trainable)).orderBy("rmse", "model").limit(1)
