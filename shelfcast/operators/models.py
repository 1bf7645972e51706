"""Regressors on the feature table: ridge in closed form, and Spark ML tree ensembles on nominal and numeric inputs."""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.config import BoostingConfig
from shelfcast.operators.evaluate import regression_metrics
from shelfcast.operators.ridge import ALPHA, Ridge, RidgeModel
from shelfcast.schema import CATEGORICAL, SALES, feature_columns
from shelfcast.session import checkpoint_folder, materialize

# Settings of the published candidates.
HISTOGRAM_ITERATIONS = 150
HISTOGRAM_BINS = 255
FOREST_TREES = 120
FOREST_MIN_ROWS = 3
BACKTEST_BOOSTING = BoostingConfig(n_estimators=100, max_depth=5, learning_rate=0.06)
SEED = 42

#: Levels up to which a categorical input is nominal to the trees, which then order its levels in every node. The levels
#: of a wider one are ordered by their mean target and cut into as many bins.
NOMINAL_LEVELS = 30
#: Fits that run at the same time: each is many small jobs, so together they keep a cluster busy.
PARALLEL_FITS = 4


@dataclass(frozen=True)
class TreeInputs:
    """How the columns become a vector with one slot each, however many levels there are.

    `nominal`: (column, levels); `ordered`: (column, table of level and bin, bin of a level that training has not seen).
    """

    numeric: tuple[str, ...]
    nominal: tuple[tuple[str, tuple[str, ...]], ...]
    ordered: tuple[tuple[str, DataFrame, int], ...]

    @property
    def names(self) -> list[str]:
        return [c for c, _ in self.nominal] + [c for c, _, _ in self.ordered] + list(self.numeric)

    def transform(self, rows: DataFrame) -> DataFrame:
        """Add `features`. An unseen level of a nominal input is a level of its own."""
        columns: list[Column] = []
        for c, levels in self.nominal:
            index = F.create_map(*[x for k, v in enumerate(levels) for x in (F.lit(v), F.lit(float(k)))]) if levels else None
            known = F.try_element_at(index, F.col(f"`{c}`").cast("string")) if levels else F.lit(None).cast("double")
            values = [*levels, "(unseen)"]
            described = {"ml_attr": {"type": "nominal", "name": c, "vals": values}}
            columns.append(F.coalesce(known, F.lit(float(len(levels)))).alias(f"_in_{c}", metadata=described))
        joined = rows
        for k, (c, bins, unseen) in enumerate(self.ordered):
            table = bins.select(F.col("level").alias(f"_level{k}"), F.col("bin").alias(f"_bin{k}"))
            joined = joined.join(table, F.col(f"`{c}`").cast("string") == F.col(f"_level{k}"), "left")
            columns.append(F.coalesce(f"_bin{k}", F.lit(unseen)).cast("double").alias(f"_in_{c}"))
        columns += [F.col(f"`{c}`").cast("double").alias(f"_in_{c}") for c in self.numeric]
        shown = joined.select(*[f"`{c}`" for c in rows.columns], *columns)
        made = VectorAssembler(inputCols=[f"_in_{c}" for c in self.names], outputCol="features").transform(shown)
        return made.drop(*[f"_in_{c}" for c in self.names])

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        rest = {"numeric": self.numeric, "nominal": self.nominal, "ordered": [(c, u) for c, _, u in self.ordered]}
        spark.createDataFrame([(json.dumps(rest),)], "inputs string").write.mode("overwrite").json(f"{path}/inputs")
        for k, (_, bins, _) in enumerate(self.ordered):
            bins.write.mode("overwrite").parquet(f"{path}/bins{k}")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TreeInputs:
        rest = json.loads(spark.read.schema("inputs string").json(f"{path}/inputs").first().inputs)
        read = spark.read.schema("level string, bin int")
        ordered = tuple((c, read.parquet(f"{path}/bins{k}"), u) for k, (c, u) in enumerate(rest["ordered"]))
        return TreeInputs(tuple(rest["numeric"]), tuple((c, tuple(v)) for c, v in rest["nominal"]), ordered)


def _ordered_bins(rows: DataFrame, column: str, bins: int) -> tuple[DataFrame, int]:
    """(level, bin) of a wide input: levels by mean target, cut where the rows below a mean reach a further share.

    Only one row per level is sorted, and its cuts come from a mergeable sketch of the means weighted by rows: the bins
    are a layout of the input, like the bins of a numeric one. Also returns the bin of the overall mean.
    """
    level = F.col(f"`{column}`").cast("string")
    means = rows.filter(level.isNotNull()).groupBy(level.alias("level")).agg(F.avg(SALES).alias("mean"), F.count(F.lit(1)).alias("n"))
    means = materialize(means)
    shares = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    facts = means.agg(
        F.percentile_approx("mean", shares, F.lit(10_000)).alias("cuts"), (F.sum(F.col("mean") * F.col("n")) / F.sum("n")).alias("all")
    ).first()
    cuts = sorted(set(facts["cuts"] or []))
    place = lambda mean: F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < mean)) if cuts else F.lit(0)
    return materialize(means.select("level", place(F.col("mean")).alias("bin"))), sum(c < (facts["all"] or 0.0) for c in cuts)


def tree_inputs(rows: DataFrame, columns: Sequence[str], levels: int = NOMINAL_LEVELS) -> TreeInputs:
    """Inputs for the trees, from the training rows alone."""
    categorical = [c for c in CATEGORICAL if c in columns]
    numeric = tuple(c for c in columns if c not in categorical)
    nominal, ordered = [], []
    for c in categorical:
        seen = rows.select(F.col(f"`{c}`").cast("string").alias("v")).filter("v IS NOT NULL").distinct().limit(levels + 1).collect()
        if len(seen) <= levels:
            nominal.append((c, tuple(sorted(r.v for r in seen))))
        else:
            ordered.append((c, *_ordered_bins(rows, c, levels)))
    return TreeInputs(numeric, tuple(nominal), tuple(ordered))


@dataclass(frozen=True)
class TreeModel:
    inputs: TreeInputs
    fitted: GBTRegressionModel | RandomForestRegressionModel

    def transform(self, rows: DataFrame) -> DataFrame:
        """Add `prediction`."""
        return self.fitted.transform(self.inputs.transform(rows)).drop("features")

    def importances(self) -> list[tuple[str, float]]:
        return list(zip(self.inputs.names, map(float, self.fitted.featureImportances.toArray())))

    def save(self, path: str) -> None:
        self.inputs.save(path)
        kind = "boosted" if isinstance(self.fitted, GBTRegressionModel) else "forest"
        self.fitted.write().overwrite().save(f"{path}/{kind}")

    @staticmethod
    def load(spark: SparkSession, path: str, kind: str) -> TreeModel:
        reader = GBTRegressionModel if kind == "boosted" else RandomForestRegressionModel
        return TreeModel(TreeInputs.load(spark, path), reader.load(f"{path}/{kind}"))


@dataclass(frozen=True)
class Trees:
    """A tree ensemble of Spark ML over `columns`; `inputs` that were made before are taken as they are."""

    columns: tuple[str, ...]
    regressor: GBTRegressor | RandomForestRegressor
    inputs: TreeInputs | None = None

    def fit(self, rows: DataFrame) -> TreeModel:
        inputs = self.inputs or tree_inputs(rows, self.columns)
        return TreeModel(inputs, self.regressor.fit(inputs.transform(rows).select("features", SALES)))


def ridge(columns: Sequence[str], alpha: float = ALPHA) -> Ridge:
    return Ridge(tuple(columns), alpha)


def boosted_trees(columns: Sequence[str], params: BoostingConfig | None = None) -> Trees:
    params = params or BoostingConfig()
    model = GBTRegressor(
        labelCol=SALES,
        maxIter=params.n_estimators,
        maxDepth=params.max_depth,
        stepSize=params.learning_rate,
        subsamplingRate=params.subsample,
        featureSubsetStrategy=str(params.colsample) if params.colsample < 1 else "all",
        seed=SEED,
    )
    return Trees(tuple(columns), model)


def histogram_boosting(columns: Sequence[str], iterations: int = HISTOGRAM_ITERATIONS) -> Trees:
    model = GBTRegressor(
        labelCol=SALES, maxIter=iterations, maxDepth=5, stepSize=0.1, maxBins=HISTOGRAM_BINS, seed=SEED
    )
    return Trees(tuple(columns), model)


def random_forest(columns: Sequence[str], trees: int = FOREST_TREES, max_depth: int = 30) -> Trees:
    model = RandomForestRegressor(
        labelCol=SALES,
        numTrees=trees,
        maxDepth=max_depth,
        minInstancesPerNode=FOREST_MIN_ROWS,
        featureSubsetStrategy="all",
        maxMemoryInMB=1024,  # deep levels have many nodes; each pass over the rows grows as many as fit
        cacheNodeIds=True,
        seed=SEED,
    )
    return Trees(tuple(columns), model)


def model_candidates(columns: Sequence[str]) -> dict[str, Ridge | Trees]:
    """The published candidates at their published settings."""
    return {
        "ridge": ridge(columns),
        "hist_gradient_boosting": histogram_boosting(columns),
        "random_forest": random_forest(columns),
        "boosted_trees": boosted_trees(columns),
    }


def fit(estimator: Ridge | Trees, train: DataFrame) -> RidgeModel | TreeModel:
    """Fit on a stored training part; long boosting lineages go to the shared checkpoint folder."""
    train.sparkSession.sparkContext.setCheckpointDir(checkpoint_folder(train.sparkSession))
    return estimator.fit(train)


def score(model: RidgeModel | TreeModel, rows: DataFrame) -> DataFrame:
    """Add ``prediction``; columns that the model makes for itself are dropped."""
    return model.transform(rows).select(*[f"`{c}`" for c in rows.columns], "prediction")


def side_by_side(tasks: Sequence[Callable[[], object]], at_once: int = PARALLEL_FITS) -> list:
    """Results of independent Spark jobs that are submitted from a few threads of the driver."""
    with ThreadPoolExecutor(max(1, min(at_once, len(tasks)))) as pool:
        return list(pool.map(lambda task: task(), tasks))


def prepared(train: DataFrame, columns: Sequence[str]) -> tuple[TreeInputs, DataFrame]:
    """Tree inputs made from the training part, and its (features, sales), stored once for any number of fits."""
    inputs = tree_inputs(train, columns)
    return inputs, materialize(inputs.transform(train).select("features", SALES))


def compare_models(
    train: DataFrame, validation: DataFrame, candidates: dict[str, Ridge | Trees]
) -> tuple[list[DataFrame], dict[str, RidgeModel | TreeModel]]:
    """One leaderboard row per candidate, and the fitted models.

    The tree candidates share one preparation of their inputs, and the fits run side by side.
    """
    trees = {name: c for name, c in candidates.items() if isinstance(c, Trees)}
    train.sparkSession.sparkContext.setCheckpointDir(checkpoint_folder(train.sparkSession))
    inputs, stored = prepared(train, next(iter(trees.values())).columns) if trees else (None, None)

    def fitted(name: str):
        if name in trees:
            return TreeModel(inputs, trees[name].regressor.fit(stored))
        return candidates[name].fit(train)

    found = side_by_side([lambda name=name: fitted(name) for name in candidates])
    models = dict(zip(candidates, found))
    rows = [
        regression_metrics(score(model, validation)).select(F.lit(name).alias("model"), F.lit("validation").alias("split"), "*")
        for name, model in models.items()
    ]
    return rows, models


def train_boosted(
    train: DataFrame, validation: DataFrame, params: BoostingConfig | None = None, path: str | None = None
) -> tuple[TreeModel, DataFrame]:
    """Fit, score the validation part, and save the model when a path is given."""
    model = fit(boosted_trees(feature_columns(train), params), train)
    if path:
        save_model(model, path)
    return model, regression_metrics(score(model, validation))


def save_model(model: RidgeModel | TreeModel, path: str) -> None:
    """Write a model and what kind it is; an earlier one of the same kind is replaced."""
    kind = "ridge" if isinstance(model, RidgeModel) else "boosted" if isinstance(model.fitted, GBTRegressionModel) else "forest"
    model.save(path)
    SparkSession.active().createDataFrame([(kind,)], "kind string").write.mode("overwrite").json(f"{path}/kind")


def load_model(path: str) -> RidgeModel | TreeModel:
    spark = SparkSession.active()
    kind = spark.read.schema("kind string").json(f"{path}/kind").first().kind
    return RidgeModel.load(spark, path) if kind == "ridge" else TreeModel.load(spark, path, kind)


# Ranges of the parameter search.
SEARCH_TREES = (100, 500)
SEARCH_DEPTH = (3, 9)
SEARCH_RATE = (0.01, 0.2)
SEARCH_SHARE = (0.65, 1.0)


def search_space(trials: int = 20, seed: int = SEED, trees: tuple[int, int] = SEARCH_TREES) -> list[BoostingConfig]:
    """Seeded random draws; the learning rate is drawn on a log scale."""
    draw = random.Random(seed)
    low, high = (math.log(x) for x in SEARCH_RATE)
    return [
        BoostingConfig(
            n_estimators=draw.randint(*trees),
            max_depth=draw.randint(*SEARCH_DEPTH),
            learning_rate=math.exp(draw.uniform(low, high)),
            subsample=draw.uniform(*SEARCH_SHARE),
            colsample=draw.uniform(*SEARCH_SHARE),
        )
        for _ in range(trials)
    ]


def param_search(
    train: DataFrame, validation: DataFrame, trials: Sequence[BoostingConfig], at_once: int = PARALLEL_FITS
) -> DataFrame:
    """Validation errors of each trial, best first; both parts are prepared once for all trials."""
    train.sparkSession.sparkContext.setCheckpointDir(checkpoint_folder(train.sparkSession))
    columns = feature_columns(train)
    inputs, known = prepared(train, columns)
    unseen = materialize(inputs.transform(validation).select("features", SALES))

    def tried(params: BoostingConfig) -> tuple:
        model = boosted_trees(columns, params).regressor.fit(known)
        row = regression_metrics(model.transform(unseen)).first()
        return (
            params.n_estimators, params.max_depth, params.learning_rate, params.subsample, params.colsample,
            row["mae"], row["rmse"], row["mape"], row["smape"],
        )

    found = side_by_side([lambda params=params: tried(params) for params in trials], at_once)
    return _trial_table(train.sparkSession, [(i, *row) for i, row in enumerate(found, start=1)])


def _trial_table(spark: SparkSession, results: list[tuple]) -> DataFrame:
    names = (
        "trial int, n_estimators int, max_depth int, learning_rate double, subsample double,"
        " colsample double, mae double, rmse double, mape double, smape double"
    )
    return spark.createDataFrame(results, names).orderBy("rmse", "trial")
