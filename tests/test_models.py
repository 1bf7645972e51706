"""Metrics, drift, backtests, models and the lifecycle."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.schema import CATEGORICAL
from shelfcast.operators import backtest, baseline, drift, evaluate, features, importance, lifecycle, models, normalize, ridge


def test_errors_of_three_rows(spark):
    rows = [(4.0, 5.0), (8.0, 6.0), (0.0, 6.0)]
    df = spark.createDataFrame(rows, "sales double, prediction double")
    found = evaluate.regression_metrics(df).first()
    assert found["mae"] == pytest.approx(3.0) and found["rmse"] == pytest.approx(math.sqrt(41 / 3))
    missing = df.unionByName(spark.createDataFrame([(1.0, None)], df.schema))
    assert evaluate.regression_metrics(missing).first()["mae"] is None


def _tenths(values):
    """Values at the tenths of a sorted list, straight lines between neighbours, each once."""
    ordered, found = sorted(values), []
    for k in range(11):
        whole, part = divmod(k * (len(ordered) - 1), 10)
        above = ordered[min(whole + 1, len(ordered) - 1)]
        found.append(ordered[whole] + (above - ordered[whole]) * part / 10)
    return sorted(set(found))


def _stability(before, after):
    bounds = _tenths(before)
    if len(bounds) < 3:
        low, high = min(before), max(before) + 1e-6
        bounds = [low + (high - low) * k / 10 for k in range(11)]

    def shares(values):
        inside = [v for v in values if bounds[0] <= v <= bounds[-1]]
        counts = [0] * (len(bounds) - 1)
        for v in inside:
            counts[min(sum(v >= b for b in bounds) - 1, len(counts) - 1)] += 1
        return [max(c / len(inside) if inside else 0.0, 1e-6) for c in counts]

    return sum((c - b) * math.log(c / b) for b, c in zip(shares(before), shares(after)))


@pytest.mark.parametrize(
    "before, after",
    [
        ([2, 3, 3, 5, 8, 8, 9, 12, 15, 15, 21], [30, 31, 40]),
        ([7, 7, 7], [7, 9, 7, 7]),
        ([float(i * 11 % 43) for i in range(260)], [float(i * 3 % 29) for i in range(120)]),
        ([1e-12, 2e-12, 5e-12, 9e-12] * 5, [3e-12, 8e-12]),
        ([1e18, 2e18, 7e18, 9e18], [2e18, 5e18]),
    ],
)
def test_stability_index(spark, before, after):
    a, b = (spark.createDataFrame([(float(v),) for v in x], "x double") for x in (before, after))
    value = drift.population_stability_index(a, b, ["x"]).first()["psi"]
    assert value == pytest.approx(_stability(before, after), rel=1e-9, abs=1e-12)


def test_empty_side_has_no_drift(spark):
    a = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    b = spark.createDataFrame([(None,)], "x double")
    assert drift.population_stability_index(a, b, ["x"]).first()["psi"] == 0.0


def test_shifted_feature_is_found(spark):
    a, b = (
        spark.createDataFrame([(float(v), "1") for v in r], "sales_lag_7 double, store string")
        for r in (range(10, 15), range(100, 105))
    )
    findings, summary = drift.detect_drift(a, b)
    assert summary.count() == 2
    assert {r["kind"] for r in findings.where("feature = 'sales_lag_7'").collect()} >= {"mean_shift"}
    assert drift.drift_status(findings).first()["status"] == "warning"


def test_position_split(spark, daily):
    sides = drift.split_reference_current(daily(1, 1, 10), 0.3, by="position")
    assert {r["side"]: r["count"] for r in sides.groupBy("side").count().collect()} == {"reference": 7, "current": 3}
    with pytest.raises(ValueError, match="above 0 and below 1"):
        drift.split_reference_current(daily(1, 1, 10), 1.0)


def test_published_position_split(daily):
    """4 x 12 series of 730 days: the position cut separates stores, not time."""
    built = features.build_features(
        daily(4, 12, 730, "2021-01-01", "1 + (s * 7 + i * 3 + d) % 50"), holidays=None
    ).select("date", "store", "item", "sales")
    sides = drift.split_reference_current(built, by="position").groupBy("side").agg(
        F.count("*").alias("rows"), *[F.countDistinct(c).alias(c) for c in ("store", "item", "date")]
    )
    found = {r["side"]: (r["store"], r["item"], r["date"]) for r in sides.collect()}
    assert found == {"reference": (4, 12, 674), "current": (1, 10, 674)}
    assert sides.agg(F.sum("rows")).first()[0] == 31_902


def test_too_few_levels_for_slices(spark):
    df = spark.createDataFrame([("1", 1.0, 1.0)] * 6, "store string, sales double, prediction double")
    with pytest.raises(Exception, match="Too few distinct"):
        evaluate.sliced_metrics(df).collect()


def test_backtest_needs_history(daily):
    with pytest.raises(Exception, match="fewer days"):
        backtest.fold_windows(daily(1, 1, 50), 3, 28, 28).collect()


def _numpy_ridge(train, test, columns):
    categorical = [c for c in CATEGORICAL if c in columns]
    numeric = [c for c in columns if c not in categorical]

    def matrix(part):
        parts = [
            np.array([[r[c] == level for level in sorted({x[c] for x in train})] for r in part], float)
            for c in categorical
        ]
        x = np.array([[float(r[c]) for c in numeric] for r in train])
        deviation = x.std(axis=0)
        scaled = (np.array([[float(r[c]) for c in numeric] for r in part]) - x.mean(axis=0)) / np.where(
            deviation > 0, deviation, 1
        )
        return np.hstack([*parts, scaled])

    x, y = matrix(train), np.array([r["sales"] for r in train])
    centre = x.mean(axis=0)
    weights = np.linalg.solve((x - centre).T @ (x - centre) + np.eye(x.shape[1]), (x - centre).T @ (y - y.mean()))
    return (matrix(test) - centre) @ weights + y.mean()


@pytest.fixture(scope="module")
def parts(spark):
    panel = spark.range(4 * 160).selectExpr(
        "date_add(DATE'2024-01-01', int(id % 160)) AS date",
        "string(id div 320 + 1) AS store",
        "string((id div 160) % 2 + 1) AS item",
        "double(20 + (id % 160) % 7 + (id * 37) % 5 + 3 * (id div 320)) AS sales",
    )
    built = features.build_features(panel, holidays=None).checkpoint() if spark.sparkContext.getCheckpointDir() else (
        features.build_features(panel, holidays=None)
    )
    return [p.persist() for p in normalize.split_parts(built, 20, 20)]


def test_ridge_is_the_closed_form(parts):
    train, validation, _ = parts
    columns = models.feature_columns(train)
    fitted = models.fit(models.ridge(columns), train)
    scored = models.score(fitted, validation.orderBy("store", "item", "date")).collect()
    expected = _numpy_ridge(train.collect(), scored, columns)
    assert np.allclose([r["prediction"] for r in scored], expected, atol=1e-6)


def test_ridge_over_thousands_of_items(spark):
    """One path for any catalogue: 5,000 items leave a system of a few weights, and the result is the closed form."""
    rng = np.random.default_rng(3)
    n, items, stores = 12_000, 5_000, 4
    item, store = rng.integers(0, items, n), rng.integers(0, stores, n)
    x = rng.normal(size=(n, 2)) * [3.0, 50.0] + [1.0, 400.0]
    y = 2.0 * x[:, 0] - 0.01 * x[:, 1] + store + (item % 7) + rng.normal(size=n)
    rows = [(f"s{s}", f"i{i}", float(a), float(b), float(t)) for s, i, (a, b), t in zip(store, item, x, y)]
    train = spark.createDataFrame(rows, "store string, item string, price double, size double, sales double")
    model = models.fit(models.ridge(["store", "item", "price", "size"]), train)
    assert model.inputs.wide == "item" and len(model.solved) == 1 + stores + 2
    # Dense closed form with the intercept taken out by centring.
    hot = np.zeros((n, stores + items))
    hot[np.arange(n), store] = 1
    hot[np.arange(n), stores + item] = 1
    dense = np.hstack([hot, (x - x.mean(axis=0)) / x.std(axis=0)])
    centre = dense - dense.mean(axis=0)
    weights = np.linalg.solve(centre.T @ centre + np.eye(dense.shape[1]), centre.T @ (y - y.mean()))
    expected = centre @ weights + y.mean()
    found = np.array([r.prediction for r in model.transform(train).select("prediction").collect()])
    # Rows have no order; predictions as a multiset are compared, and the residuals of the normal equations.
    assert np.allclose(np.sort(found), np.sort(expected), atol=1e-8)
    gaps = ridge.optimality(model, train).collect()
    assert len(gaps) == 1 + stores + len(set(item.tolist())) + 2 and max(abs(r.gap) for r in gaps) < 1e-10


def test_ridge_is_saved_and_takes_unknown_levels(spark, tmp_path):
    rows = [("a", "1", 1.0, 5.0), ("a", "2", 2.0, 7.0), ("b", "3", 3.0, 9.0), (None, None, 4.0, 12.0)]
    train = spark.createDataFrame(rows, "store string, item string, price double, sales double")
    model = models.fit(models.ridge(["store", "item", "price"]), train)
    models.save_model(model, str(tmp_path / "ridge"))
    again = models.load_model(str(tmp_path / "ridge"))
    unknown = spark.createDataFrame([("z", "9", 2.0, 0.0), ("a", "1", None, 0.0), (None, None, 2.0, 0.0)], train.schema)
    first, second = ([r.prediction for r in m.transform(unknown).orderBy("store").collect()] for m in (model, again))
    assert first == second and first[0] == first[2] and first[1] is None
    with pytest.raises(ValueError, match="without a value"):
        models.fit(models.ridge(["store", "item", "price"]), unknown)
    with pytest.raises(ValueError, match="empty"):
        models.fit(models.ridge(["store", "item", "price"]), train.limit(0))


@pytest.mark.parametrize("items", [3, 500])
def test_tree_inputs_are_as_many_as_columns(spark, items):
    rows = [(str(k % 4), f"i{k % items}", float(k % 11), float(k % items % 5 + k % 11)) for k in range(3000)]
    train = spark.createDataFrame(rows, "store string, item string, price double, sales double")
    inputs = models.tree_inputs(train, ["store", "item", "price"])
    made = inputs.transform(train)
    assert inputs.names == (["store", "item", "price"]) and len(made.first().features) == 3
    attributes = made.schema["features"].metadata["ml_attr"]["attrs"]
    assert len(attributes["nominal"]) == (2 if items == 3 else 1)
    model = models.Trees(("store", "item", "price"), models.random_forest([], 5, 8).regressor).fit(train)
    assert evaluate.regression_metrics(model.transform(train)).first()["rmse"] < 1.0
    unseen = spark.createDataFrame([("9", "new", 1.0, 0.0), (None, None, 1.0, 0.0)], train.schema)
    assert all(r.prediction >= 0 for r in model.transform(unseen).collect())


def test_models_beat_the_baselines(parts, tmp_path):
    train, validation, _ = parts
    params = models.BoostingConfig(n_estimators=20, max_depth=3, learning_rate=0.3, subsample=1.0, colsample=1.0)
    fitted, metrics = models.train_boosted(train, validation, params, str(tmp_path / "model"))
    naive = evaluate.regression_metrics(baseline.seasonal_naive(train, validation)).first()["rmse"]
    assert metrics.first()["rmse"] < naive
    again = models.load_model(str(tmp_path / "model"))
    assert models.score(again, validation).count() == validation.count()
    ranked = importance.native_importance(fitted, top_n=5).collect()
    assert [r["rank"] for r in ranked] == [1, 2, 3, 4, 5]


def test_permutation_finds_the_signal(parts):
    train, validation, _ = parts
    columns = models.feature_columns(train)
    fitted = models.fit(models.ridge(columns), train)
    ranked = importance.permutation_importance(fitted, validation, columns, repeats=1).collect()
    assert len(ranked) == len(columns)
    assert all(r["importance"] >= 0 for r in ranked) and ranked[0]["importance"] > 0


def test_search_is_seeded():
    assert models.search_space(5) == models.search_space(5)
    assert all(0.01 <= p.learning_rate <= 0.2 and 3 <= p.max_depth <= 9 for p in models.search_space(50))


def test_search_tries_all_and_ranks_them(parts):
    train, validation, _ = parts
    trials = [models.BoostingConfig(n_estimators=n, max_depth=2, learning_rate=0.3) for n in (1, 8, 3)]
    found = models.param_search(train, validation, trials).collect()
    assert sorted(r.trial for r in found) == [1, 2, 3] and [r.rmse for r in found] == sorted(r.rmse for r in found)
    assert found[0].n_estimators > 1


def _dataset(spark, mark):
    return spark.createDataFrame(
        [(mark, 10, None, None)], "dataset_hash string, dataset_rows long, dataset_start date, dataset_end date"
    )


def test_lifecycle(spark):
    def metrics(value):
        return spark.createDataFrame([(value, value - 1)], "rmse double, mae double")

    candidates, decisions = lifecycle.empty_candidates(spark), lifecycle.empty_decisions(spark)
    with pytest.raises(ValueError, match="empty registry"):
        lifecycle.promote_candidate(candidates, decisions)
    steps = [
        (5.0, "abc", 0.0, True, "no current production champion"),
        (4.9, "abc", 0.05, False, "rmse improvement 2.00% below threshold 5.00%"),
        (4.0, "abc", 0.05, True, "rmse improved by 20.00%"),
        (9.0, "new", 0.05, True, "candidate was trained on a new verified dataset version"),
    ]
    for score, mark, threshold, promoted, reason in steps:
        row = lifecycle.new_candidate(candidates, "ridge", metrics(score), _dataset(spark, mark))
        candidates = spark.createDataFrame(candidates.collect() + row.collect(), candidates.schema)
        decided = lifecycle.promote_candidate(candidates, decisions, min_improvement=threshold)
        assert (decided.first()["promoted"], decided.first()["reason"]) == (promoted, reason)
        decisions = spark.createDataFrame(decisions.collect() + decided.collect(), decisions.schema)
    status = {r["version"]: r["status"] for r in lifecycle.candidate_status(candidates, decisions).collect()}
    assert status == {1: "archived", 2: "candidate", 3: "archived", 4: "production"}
    assert lifecycle.active_model(candidates, decisions).first()["version"] == 4
    row = lifecycle.registry_status(candidates, decisions).first()
    assert (row["candidate_count"], row["latest_version"], row["production_version"]) == (4, 4, 4)
    with pytest.raises(ValueError, match="version 9"):
        lifecycle.promote_candidate(candidates, decisions, version=9)


def test_moving_average_needs_its_column(daily):
    with pytest.raises(ValueError, match="sales_rolling_mean_7"):
        baseline.moving_average(daily(1, 1, 5))


def test_unseen_series_has_no_prediction(daily):
    train, test = daily(1, 1, 10), daily(2, 1, 10, "2024-01-11")
    rows = baseline.seasonal_naive(train, test).where("store = '2'")
    assert rows.where("prediction IS NOT NULL").count() == 0
    assert math.isclose(baseline.seasonal_naive(train, test).where("store = '1' AND date = '2024-01-11'").first()["prediction"], 3.0)
