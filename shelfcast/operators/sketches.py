"""Exact quantiles of many columns at once, bracketed by mergeable sketches.

One pass builds a KLL sketch of every column. Its ranks are off by a known share, so each quantile lies in a narrow bracket
of values. A second pass counts, task by task, the values inside the brackets one by one and what lies between them as
totals: so few rows are shuffled, whatever the number of cells. From these counts the quantiles are picked exactly; where
a bracket turns out not to hold its quantile, it is widened and counted again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.ranking import quantiles_of_counts
from shelfcast.session import materialize

#: Size of a sketch (53 KB at most) and the share of ranks on either side of a quantile that its bracket takes in first;
#: three times what the ranks of such a sketch are off.
SKETCH = 4096
MARGIN = 0.004


def present(column: Column) -> Column:
    """The number, or null where it is missing."""
    value = column.cast("double")
    return F.when(~F.isnan(value), value)


@dataclass(frozen=True)
class Brackets:
    """Disjoint intervals of values of one column, in order."""

    low: tuple[float, ...]
    high: tuple[float, ...]

    def place(self, value: Column) -> Column:
        """Intervals that begin at or below the value."""
        return F.size(F.filter(F.array(*[F.lit(x) for x in self.low]), lambda x: x <= value))

    def inside(self, value: Column, place: Column) -> Column:
        highs = F.array(*[F.lit(x) for x in self.high])
        return (place > 0) & (value <= F.get(highs, place - 1))


def _merged(pairs: list[tuple[float, float]]) -> Brackets:
    found: list[list[float]] = []
    for low, high in sorted(pairs):
        if found and low <= found[-1][1]:
            found[-1][1] = max(found[-1][1], high)
        else:
            found.append([low, high])
    return Brackets(tuple(x for x, _ in found), tuple(y for _, y in found))


def sketched(column: Column, probabilities: Sequence[float], margin: float) -> Column:
    """Aggregate: (n, low, high, bounds) of the values that are there; null bounds where there are none."""
    ends = [min(max(p + side, 0.0), 1.0) for p in probabilities for side in (-margin, margin)]
    bounds = F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(column, F.lit(SKETCH)), F.array(*[F.lit(e) for e in ends]))
    n = F.count(column)
    return F.struct(n.alias("n"), F.min(column).alias("low"), F.max(column).alias("high"), F.when(n > 0, bounds).alias("bounds"))


def brackets_of(fact, probabilities: Sequence[float]) -> Brackets | None:
    """Intervals that hold the quantiles by the sketch's account; None for a column without values."""
    if not fact["n"]:
        return None
    pairs = list(zip(fact["bounds"][::2], fact["bounds"][1::2]))
    fixed = [
        (fact["low"] if p <= 0 else low, fact["high"] if p >= 1 else high) for p, (low, high) in zip(probabilities, pairs)
    ]
    # The outermost quantiles are the least and the greatest value themselves.
    fixed = [(fact["low"],) * 2 if p <= 0 else (fact["high"],) * 2 if p >= 1 else b for p, b in zip(probabilities, fixed)]
    return _merged(fixed)


def slot_counts(rows: DataFrame, brackets: dict[str, Brackets], weights: dict[str, Column]) -> DataFrame:
    """(feature, place, value, weight...) summed over the cells of `rows`, stored: `value` is null between brackets."""
    cells = []
    for c, held in brackets.items():
        value = present(F.col(f"`{c}`"))
        place = held.place(value)
        cells.append(
            F.struct(
                F.lit(c).alias("feature"), place.alias("place"), F.when(held.inside(value, place), value).alias("value"),
                value.isNotNull().alias("there"),
            )
        )
    long = rows.select(F.explode(F.array(*cells)).alias("cell"), *[w.alias(name) for name, w in weights.items()])
    counted = long.where("cell.there").groupBy("cell.feature", "cell.place", "cell.value")
    return materialize(counted.agg(*[F.sum(name).alias(name) for name in weights]))


def picked(counts: DataFrame, weight: str, probabilities: Sequence[float]) -> dict[str, list]:
    """Quantiles by feature from slot counts; None for one that its bracket does not hold."""
    at = F.struct("place", F.col("value").isNull().alias("between"), F.coalesce("value", F.lit(0.0)).alias("value"))
    ordered = counts.where(F.col(weight) > 0).select("feature", at.alias("_at"), "value", F.col(weight).alias("_n"))
    rows = quantiles_of_counts(ordered, "value", probabilities, ["feature"], order="_at").collect()
    return {r["feature"]: r["quantiles"] for r in rows}


def column_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> dict[str, list[float] | None]:
    """Linear-interpolated quantiles of each column over its values; None for a column without any.

    What the driver gets is a few numbers for each column.
    """
    return quantiles_and_counts(df, df, columns, probabilities, {"_all": F.lit(1)}, "_all")[0]


def quantiles_and_counts(
    base: DataFrame, rows: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
    weights: dict[str, Column], weight: str, facts=None,
) -> tuple[dict[str, list[float] | None], dict[str, Brackets], DataFrame | None]:
    """Quantiles of the rows of `base`, the last brackets, and the slot counts of `rows` under all `weights`.

    `weight` names the one of `weights` that counts the rows of `base`; `facts` may bring the sketches of an earlier pass.
    """
    margin, found, used, tables = MARGIN, {}, {}, []
    left = list(columns)
    while left:
        if facts is None:
            facts = base.agg(*[sketched(present(F.col(f"`{c}`")), probabilities, margin).alias(c) for c in left]).first()
        held = {c: brackets_of(facts[c], probabilities) for c in left}
        found |= {c: None for c in left if held[c] is None}
        held = {c: b for c, b in held.items() if b is not None}
        if not held:
            break
        counts = slot_counts(rows, held, weights)
        quantiles = picked(counts, weight, probabilities)
        good = [c for c in held if None not in quantiles[c]]
        found |= {c: quantiles[c] for c in good}
        used |= {c: held[c] for c in good}
        tables.append(counts.where(F.col("feature").isin(good)))
        left, facts, margin = [c for c in held if c not in good], None, min(1.0, max(margin * 8, 1e-3))
    whole = None
    for table in tables:
        whole = table if whole is None else whole.unionByName(table)
    return found, used, whole
