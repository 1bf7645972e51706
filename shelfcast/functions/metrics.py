"""Forecast error as aggregate expressions, usable in any grouping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the smallest denominator of the two relative errors.
RELATIVE_FLOOR = 1e-8


def _complete(value: Column, aggregate: Column) -> Column:
    """An error over rows with a missing prediction is undefined, not an average of the rest."""
    return F.when(F.count(value) == F.count(F.lit(1)), aggregate)


def mae(actual: Column, predicted: Column) -> Column:
    error = F.abs(actual - predicted)
    return _complete(error, F.avg(error))


def rmse(actual: Column, predicted: Column) -> Column:
    error = actual - predicted
    return _complete(error, F.sqrt(F.avg(error * error)))


def mape(actual: Column, predicted: Column) -> Column:
    error = F.abs(actual - predicted)
    return _complete(error, F.avg(error / F.greatest(F.abs(actual), F.lit(RELATIVE_FLOOR))))


def smape(actual: Column, predicted: Column) -> Column:
    error = F.abs(actual - predicted)
    scale = (F.abs(actual) + F.abs(predicted)) / 2
    return _complete(error, F.avg(error / F.greatest(scale, F.lit(RELATIVE_FLOOR))))


def regression_aggregates(actual: str | Column, predicted: str | Column) -> list[Column]:
    """The four errors, as fractions, named mae, rmse, mape and smape."""
    y = F.col(actual) if isinstance(actual, str) else actual
    p = F.col(predicted) if isinstance(predicted, str) else predicted
    return [f(y, p).alias(f.__name__) for f in (mae, rmse, mape, smape)]
