"""Running totals and exact quantiles over groups of any size.

A plain ordered window puts a whole group into one task. Here the rows are dealt by ranges of group and order, so a hot
group is spread over many tasks, and stored with the number of their range. The totals of the ranges are tiny and are
summed first; only the inside of a range is sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.session import materialize

#: Real values are added as decimals of so many places: their sums are exact, so that the layout cannot show in them.
EXACT = T.DecimalType(28, 10)


def _partition(columns: Sequence[str | Column]):
    return Window.partitionBy(*columns) if columns else Window.partitionBy(F.lit(0))


def running_totals(
    rows: DataFrame, by: Sequence[str], order: str, values: Sequence[str], ranges: int | None = None
) -> DataFrame:
    """Add, for each value ``v``, ``v_before`` (sum over earlier rows of the group) and ``v_total``.

    ``rows`` holds one row per (by, order); a null key has no place in the order and is left out. Whole numbers are added
    as such, real ones to ten decimal places. The rows are computed and stored once, in ``ranges`` ranges of (by, order);
    by default as many as the session has shuffle partitions, so their number follows what the cluster is set to.
    """
    real = {f.name for f in rows.schema if f.name in values and isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    keys = [*by, order]
    rows = rows.dropna(subset=keys)
    dealt = rows.repartitionByRange(ranges, *keys) if ranges else rows.repartitionByRange(*keys)
    stored = materialize(dealt.withColumn("_range", F.spark_partition_id()))

    def exact(v: str) -> Column:
        return F.col(v).cast(EXACT) if v in real else F.col(v)

    def shown(v: str, total: Column) -> Column:
        return total.cast("double") if v in real else total

    group, past = _partition(by), (Window.unboundedPreceding, -1)
    earlier = group.orderBy("_range").rowsBetween(*past)
    totals = stored.groupBy(*by, "_range").agg(*[F.sum(exact(v)).alias(f"_{v}") for v in values])
    bases = totals.select(
        *by,
        "_range",
        *[F.coalesce(F.sum(f"_{v}").over(earlier), F.lit(0)).alias(f"_{v}_base") for v in values],
        *[shown(v, F.sum(f"_{v}").over(group)).alias(f"{v}_total") for v in values],
    )
    inside = _partition([*by, "_range"]).orderBy(order).rowsBetween(*past)

    def before(v: str) -> Column:
        return shown(v, F.col(f"_{v}_base") + F.coalesce(F.sum(exact(v)).over(inside), F.lit(0)))

    return (
        stored.join(bases, [*by, "_range"])
        .withColumns({f"{v}_before": before(v) for v in values})
        .drop("_range", *[f"_{v}_base" for v in values])
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    by: Sequence[str] = (),
) -> DataFrame:
    """Linear-interpolated quantiles per group as an array column ``quantiles``.

    Equal values are counted before the shuffle; ranks come from running totals of the counts.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    return quantiles_of_counts(counts, value, probabilities, by)


def quantiles_of_counts(
    counts: DataFrame,
    value: str,
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    order: str | None = None,
) -> DataFrame:
    """``exact_quantiles`` of a table that already holds one row and a count ``_n`` per value.

    Rows may also stand for values between two others, with a null value and their place in ``order``; a quantile that
    falls on such a row is null.
    """
    ranked = running_totals(counts, by, order or value, ["_n"])
    exact = [f"((_n_total - 1) * {float(p)!r}D)" for p in probabilities]
    # A position that is whole but for rounding error is whole.
    positions = [
        f"CASE WHEN abs({e} - rint({e})) < 1e-9D THEN rint({e}) ELSE {e} END AS _p{i}" for i, e in enumerate(exact)
    ]
    picks = []
    for i in range(len(exact)):
        for name, rank in (("lo", f"floor(_p{i})"), ("hi", f"ceil(_p{i})")):
            hit = f"_n_before <= {rank} AND {rank} < _n_before + _n"
            picks.append(f"max(CASE WHEN {hit} THEN double(`{value}`) END) AS _{name}{i}")
        picks.append(f"max(_p{i} - floor(_p{i})) AS _f{i}")
    steps = ", ".join(f"_lo{i} + (_hi{i} - _lo{i}) * _f{i}" for i in range(len(exact)))
    return (
        ranked.selectExpr(*[f"`{b}`" for b in by], f"`{value}`", "_n", "_n_before", "_n_total", *positions)
        .groupBy(*by)
        .agg(*[F.expr(p) for p in picks])
        .select(*by, F.expr(f"array({steps})").alias("quantiles"))
    )
