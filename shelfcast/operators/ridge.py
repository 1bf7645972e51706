"""Ridge regression in closed form for any number of levels.

The levels of the widest categorical input never meet each other in the normal equations: their block is diagonal. It is
eliminated by sums per level, so only a system over the other inputs is left for the driver, and the weights of the many
levels come back as a table. Both passes over the rows add up small matrices task by task.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.schema import CATEGORICAL, SALES
from shelfcast.session import materialize

#: Fixed value: the published penalty.
ALPHA = 1.0
#: Weights that the driver solves for at most: all but those of the widest categorical input.
MOST_SOLVED = 4096
INTERCEPT = "(intercept)"


def gram(rows: DataFrame, column: str, width: int) -> np.ndarray:
    """Sum of the outer products of the arrays in `column`; every task hands on one matrix, and few reach the driver."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * width)
        for batch in batches:
            for m in batch.column(0).to_pylist():
                total += np.frombuffer(m)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])

    parts = rows.select(column).mapInArrow(fold, "m binary").repartition(8).mapInArrow(add, "m binary").collect()
    return sum((np.frombuffer(r.m) for r in parts), np.zeros(width * width)).reshape(width, width)


@dataclass(frozen=True)
class Inputs:
    """Numeric inputs as (name, mean, deviation), narrow categorical ones with their levels, and the widest one."""

    numeric: tuple[tuple[str, float, float], ...]
    narrow: tuple[tuple[str, tuple[str, ...]], ...]
    wide: str | None

    def scaled(self) -> list[tuple[str, Column]]:
        """Numeric columns less their mean in units of their deviation; a constant one is 0."""
        return [(c, (F.col(f"`{c}`").cast("double") - F.lit(m)) / F.lit(s or 1.0)) for c, m, s in self.numeric]

    def slots(self) -> list[tuple[str, str | None]]:
        """(input, level) of the weights that the driver solves for, the intercept first."""
        levels = [(c, level) for c, values in self.narrow for level in values]
        return [(INTERCEPT, None), *levels, *[(c, None) for c, _, _ in self.numeric]]

    def vector(self) -> list[Column]:
        """The row's values of the slots."""
        hot = [
            F.when(F.col(f"`{c}`").cast("string") == level, 1.0).otherwise(0.0) for c, values in self.narrow for level in values
        ]
        return [F.lit(1.0), *hot, *[x for _, x in self.scaled()]]


def read_inputs(rows: DataFrame, columns: Sequence[str]) -> Inputs:
    """Scales of the numeric columns and levels of the categorical ones, from two passes.

    Null and unknown levels have no weight. A null number is an error, as it would be in training by Spark ML.
    """
    categorical = [c for c in CATEGORICAL if c in columns]
    numeric = [c for c in columns if c not in categorical]
    facts = [F.count(F.lit(1)).alias("rows")]
    for k, c in enumerate(numeric):
        value = F.col(f"`{c}`").cast("double")
        missing = F.count_if(value.isNull() | F.isnan(value))
        facts += [F.avg(value).alias(f"m{k}"), F.stddev_pop(value).alias(f"s{k}"), missing.alias(f"x{k}")]
    facts += [F.approx_count_distinct(f"`{c}`").alias(f"d{k}") for k, c in enumerate(categorical)]
    seen = rows.agg(*facts).first()
    if not seen["rows"]:
        raise ValueError("The training part is empty.")
    bad = [c for k, c in enumerate(numeric) if seen[f"x{k}"]]
    if bad:
        raise ValueError(f"Inputs without a value in some rows: {bad}")
    sizes = {c: seen[f"d{k}"] for k, c in enumerate(categorical)}
    wide = max(sizes, key=lambda c: (sizes[c], -categorical.index(c)), default=None)
    narrow = [c for c in categorical if c != wide]
    # Estimates may be a few percent off; the exact number is checked when the levels are there.
    if 1 + len(numeric) + sum(sizes[c] for c in narrow) > 1.2 * MOST_SOLVED:
        raise ValueError(f"More than {MOST_SOLVED} weights besides those of {wide}.")
    levels: dict[str, list[str]] = {c: [] for c in narrow}
    if narrow:
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").cast("string").alias("v")) for c in narrow]))
        for r in rows.select(pairs.alias("p")).select("p.*").filter("v IS NOT NULL").distinct().collect():
            levels[r.c].append(r.v)
    inputs = Inputs(
        tuple((c, seen[f"m{k}"], seen[f"s{k}"]) for k, c in enumerate(numeric)),
        tuple((c, tuple(sorted(values))) for c, values in levels.items()),
        wide,
    )
    if len(inputs.slots()) > MOST_SOLVED:
        raise ValueError(f"More than {MOST_SOLVED} weights besides those of {wide}.")
    return inputs


@dataclass(frozen=True)
class RidgeModel:
    """Weights: `solved` for the slots of `inputs`, and a table (level, weight) for the levels of the widest input."""

    inputs: Inputs
    solved: tuple[float, ...]
    levels: DataFrame
    rows: int
    alpha: float
    columns: tuple[str, ...] = field(default=())

    def transform(self, rows: DataFrame) -> DataFrame:
        """Add `prediction`. Levels that training has not seen count as none; a null number gives a null prediction."""
        at = {slot: w for slot, w in zip(self.inputs.slots(), self.solved)}
        total: Column = F.lit(at[INTERCEPT, None])
        for c, values in self.inputs.narrow:
            if values:
                pairs = [x for v in values for x in (F.lit(v), F.lit(at[c, v]))]
                total = total + F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(f"`{c}`").cast("string")), F.lit(0.0))
        for c, x in self.inputs.scaled():
            total = total + F.lit(at[c, None]) * x
        named = self.levels.select(F.col("level").alias("__level"), F.col("weight").alias("__weight"))
        known = F.col(f"`{self.inputs.wide}`").cast("string") == F.col("__level") if self.inputs.wide else F.lit(False)
        joined = rows.join(named, known, "left")
        return joined.select(*[f"`{c}`" for c in rows.columns], (total + F.coalesce("__weight", F.lit(0.0))).alias("prediction"))

    def weights(self) -> DataFrame:
        """(feature, level, weight); numbers and the intercept have no level, numbers count in deviations."""
        spark = self.levels.sparkSession
        small = [(c, level, w) for (c, level), w in zip(self.inputs.slots(), self.solved)]
        table = spark.createDataFrame(small, "feature string, level string, weight double")
        return table.unionByName(self.levels.select(F.lit(self.inputs.wide).alias("feature"), "level", "weight"))

    def save(self, path: str) -> None:
        spark = self.levels.sparkSession
        rest = {
            "numeric": self.inputs.numeric, "narrow": self.inputs.narrow, "wide": self.inputs.wide, "solved": self.solved,
            "rows": self.rows, "alpha": self.alpha, "columns": self.columns,
        }
        self.levels.write.mode("overwrite").parquet(f"{path}/levels")
        spark.createDataFrame([(json.dumps(rest),)], "model string").write.mode("overwrite").json(f"{path}/rest")

    @staticmethod
    def load(spark: SparkSession, path: str) -> RidgeModel:
        rest = json.loads(spark.read.schema("model string").json(f"{path}/rest").first().model)
        narrow = tuple((c, tuple(values)) for c, values in rest["narrow"])
        inputs = Inputs(tuple(tuple(x) for x in rest["numeric"]), narrow, rest["wide"])
        levels = spark.read.schema("level string, weight double").parquet(f"{path}/levels")
        return RidgeModel(inputs, tuple(rest["solved"]), levels, rest["rows"], rest["alpha"], tuple(rest["columns"]))


@dataclass(frozen=True)
class Ridge:
    """Least squares with the penalty `alpha` on the squares of all weights but the intercept.

    Inputs: one weight for each level of the categorical columns, and the numeric columns in population deviations.
    """

    columns: tuple[str, ...]
    alpha: float = ALPHA

    def fit(self, rows: DataFrame) -> RidgeModel:
        inputs = read_inputs(rows, self.columns)
        width = len(inputs.slots()) + 1  # the target comes last
        target = F.col(SALES).cast("double")
        level = F.col(f"`{inputs.wide}`").cast("string") if inputs.wide else F.lit(None).cast("string")
        x = rows.select(level.alias("level"), F.array(*inputs.vector(), target).alias("x"))
        whole = gram(x, "x", width)

        # With n rows of a level and their sums s, eliminating its weight takes s s' / (n + alpha) out of the system.
        sums = [F.sum(F.col("x")[k]).alias(f"s{k}") for k in range(width)]
        by_level = x.filter("level IS NOT NULL").groupBy("level").agg(*sums)
        by_level = materialize(by_level.select("level", F.array(*[f"s{k}" for k in range(width)]).alias("s")))
        scaled = F.transform("s", lambda v: v / F.sqrt(F.get("s", F.lit(0)) + self.alpha))
        left = whole - gram(by_level.select(scaled.alias("s")), "s", width)

        penalty = self.alpha * np.eye(width - 1)
        penalty[0, 0] = 0.0
        solved = np.linalg.solve(left[:-1, :-1] + penalty, left[:-1, -1])
        known = F.array(*[F.lit(float(w)) for w in solved], F.lit(0.0))
        explained = F.aggregate(F.zip_with("s", known, lambda s, w: s * w), F.lit(0.0), lambda a, v: a + v)
        weight = (F.get("s", F.lit(width - 1)) - explained) / (F.get("s", F.lit(0)) + self.alpha)
        levels = materialize(by_level.select("level", weight.alias("weight")))
        rows_seen = round(whole[0, 0])
        return RidgeModel(inputs, tuple(map(float, solved)), levels, rows_seen, self.alpha, self.columns)


def optimality(model: RidgeModel, rows: DataFrame) -> DataFrame:
    """(feature, level, gap) for each weight: the slope of the penalised loss a row, 0 at the minimum.

    The loss is strictly convex in all weights but the intercept, so zeros prove that these are its weights.
    """
    inputs = model.inputs
    rest = F.col(SALES).cast("double") - F.col("prediction")
    keys = [c for c, _ in inputs.narrow] + ([inputs.wide] if inputs.wide else [])
    scored = model.transform(rows)
    numbers = scored.agg(
        F.sum(rest).alias(INTERCEPT), *[F.sum(rest * x).alias(c) for c, x in inputs.scaled()]
    )
    names = [INTERCEPT, *[c for c, _, _ in inputs.numeric]]
    slopes = numbers.unpivot([], [f"`{c}`" for c in names], "feature", "slope").withColumn("level", F.lit(None).cast("string"))
    if keys:
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("level")) for c in keys]))
        slopes = slopes.unionByName(
            scored.select(rest.alias("rest"), pairs.alias("p")).groupBy("p.feature", "p.level").agg(F.sum("rest").alias("slope"))
        )
    weights = model.weights()
    same = (weights["feature"] == slopes["feature"]) & weights["level"].eqNullSafe(slopes["level"])
    penalty = F.when(weights["feature"] == INTERCEPT, 0.0).otherwise(F.lit(model.alpha) * weights["weight"])
    gap = (F.coalesce(slopes["slope"], F.lit(0.0)) - penalty) / F.lit(float(model.rows))
    return weights.join(slopes, same, "left").select(weights["feature"], weights["level"], gap.alias("gap"))
