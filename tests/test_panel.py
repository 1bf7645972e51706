"""Intake, splits and quality checks on tiny frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.config import FeatureConfig, load_config
from shelfcast.operators import eda, features, normalize, quality
from shelfcast.sources import tables


def test_aliases_and_key_text(spark):
    raw = spark.createDataFrame([("2024-01-01", 1, 10, 5)], "Date string, Store int, Product int, Quantity int")
    panel = normalize.normalize_schema(raw)
    assert panel.columns == ["date", "store", "item", "sales"]
    row = panel.first()
    assert (row["store"], row["item"], row["sales"]) == ("1", "10", 5.0)


def test_two_columns_with_one_name_fail(spark):
    raw = spark.createDataFrame([("2024-01-01", "1", "2", "3", 5)], "date string, store string, sku string, product string, sales int")
    with pytest.raises(ValueError, match="item"):
        normalize.normalize_schema(raw)


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match=r"\['item', 'sales'\]"):
        normalize.normalize_schema(spark.createDataFrame([("2024-01-01", "1")], "date string, store string"))


def test_numbers_are_lenient_dates_are_strict(spark):
    schema = "date string, store string, item string, sales string, price string"
    rows = [("2024-01-01", "1", "1", v, "x") for v in ("5", " 7 ", "1d", "nan", "", None, "abc")]
    panel = normalize.normalize_schema(spark.createDataFrame(rows, schema))
    assert sorted(r["sales"] for r in panel.collect()) == [5.0, 7.0]
    assert {r["price"] for r in panel.collect()} == {0.0}
    bad = spark.createDataFrame([("no date", "1", "1", "5", "1")], schema)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        normalize.normalize_schema(bad).collect()


def test_null_key_fails(spark):
    raw = spark.createDataFrame([("2024-01-01", None, "1", 5.0)], "date string, store string, item string, sales double")
    with pytest.raises(Exception, match="null store key"):
        normalize.normalize_schema(raw).collect()


def test_split_is_chronological(daily):
    parts = normalize.split_parts(daily(1, 1, 30), 5, 5)
    ends = [p.agg(F.min("date"), F.max("date"), F.count("date")).first() for p in parts]
    assert ends[0][1] < ends[1][0] and ends[1][1] < ends[2][0]
    assert [e[2] for e in ends] == [20, 5, 5]


def test_empty_split_fails(daily):
    with pytest.raises(ValueError, match="without rows"):
        normalize.require_split(normalize.chronological_split(daily(1, 1, 8), 5, 5))


def test_bad_rows_do_not_pass(spark):
    rows = [("2024-01-01", "1", "1", 10.0), ("2024-01-01", "1", "1", -1.0)]
    df = spark.createDataFrame(rows, "date string, store string, item string, sales double")
    report = quality.quality_report(df)
    assert {"duplicate_keys", "target_non_negative"} <= {r["check"] for r in report.collect()}
    with pytest.raises(ValueError, match="duplicate_keys"):
        quality.raise_for_errors(report)


def test_warnings_pass_the_gate(daily):
    gap = daily(1, 1, 30).where(F.col("sales") != 4)
    report = quality.quality_report(gap, check_shape=True)
    assert {r["check"] for r in report.collect()} == {"daily_continuity", "store_count", "item_count", "history_length"}
    quality.raise_for_errors(report)


def test_missing_columns_end_the_report(spark):
    report = quality.quality_report(spark.createDataFrame([("1",)], "store string")).collect()
    assert [r["check"] for r in report] == ["required_columns"]


def test_small_dataset_is_flagged(daily):
    checks = {r["name"]: r["passed"] for r in quality.verify_dataset(daily(1, 1, 10, "2021-01-01", "1")).collect()}
    assert not checks["real_dataset_row_count"] and not checks["store_count"] and not checks["item_count"]
    verdict = quality.verification_verdict(quality.verify_dataset(daily(1, 1, 10))).first()
    assert verdict["status"] == "not_verified" and verdict["likely_sample_data"]


def test_contract_takes_own_rules(daily):
    rules = [quality.Rule("small", F.col("sales") < 5, "warning")]
    row = quality.check_contract(daily(1, 1, 10), rules, unique=None).first()
    assert (row["check"], row["violations"], row["passed"]) == ("small", 5, False)


def test_csv_stays_text_and_round_trips(spark, daily, tmp_path):
    panel = daily(2, 2, 5)
    tables.write_table(panel, str(tmp_path / "csv"), "csv")
    raw = tables.scan_sales(spark, str(tmp_path / "csv"))
    assert {t for _, t in raw.dtypes} == {"string"}
    again = normalize.normalize_schema(raw)
    mark, copy = (tables.table_fingerprint(t).first() for t in (panel, again))
    assert mark == copy
    assert tables.table_fingerprint(panel.unionByName(panel)).first() != mark


def test_partitioned_write_prunes(spark, daily, tmp_path):
    path = str(tmp_path / "features")
    tables.write_table(tables.with_month(daily(1, 1, 60)), path, partition_by=["sales_month"])
    read = tables.read_table(spark, path).where("sales_month = '2024-02'")
    assert read.count() == 29
    assert "PartitionFilters: [isnotnull(sales_month" in read._jdf.queryExecution().toString()


def test_logs_append(spark, tmp_path):
    row = spark.createDataFrame([(1, True)], "candidate_version int, promoted boolean")
    for _ in range(2):
        tables.append_log(row, str(tmp_path / "log"))
    assert tables.read_log(spark, str(tmp_path / "log"), row.schema).count() == 2
    document = tables.json_documents(row).first()["document"]
    assert document == '{"candidate_version":1,"promoted":true}'


def test_config_overrides(tmp_path):
    path = tmp_path / "c.json"
    path.write_text('{"features": {"lags": [1, 7]}, "backtest": {"folds": 2}}')
    config = load_config(path)
    assert config.features.lags == (1, 7) and config.backtest.folds == 2 and config.data.test_days == 90
    with pytest.raises(ValueError, match="Unknown"):
        load_config({"data": {"days": 1}})


def test_published_settings_load(tmp_path):
    """The published file's keys and values, which are the defaults."""
    published = {
        "data": {"validation_days": 90, "test_days": 90},
        "features": {
            "lags": [1, 7, 14, 28, 56], "rolling_windows": [7, 14, 28, 56],
            "enable_hierarchical_features": True, "enable_demand_pattern_features": True,
        },
        "model": {
            "forecast_horizon": 1, "random_state": 42,
            "xgboost": {"n_estimators": 250, "max_depth": 6, "learning_rate": 0.05, "subsample": 0.9, "colsample_bytree": 0.9},
        },
        "backtest": {"folds": 3, "horizon_days": 28, "step_days": 28},
        "registry": {
            "primary_metric": "rmse", "minimum_relative_improvement": 0.0, "required_backtest_folds": 1,
            "max_slice_rmse_regression": 0.10,
        },
        "monitoring": {
            "psi_threshold": 0.20, "mean_shift_threshold": 2.0, "missing_rate_shift_threshold": 0.05,
            "new_category_rate_threshold": 0.01,
        },
    }
    assert load_config(published) == load_config()
    published["model"]["xgboost"]["colsample_bytree"] = 0.5
    assert load_config(published).boosting.colsample == 0.5
    with pytest.raises(ValueError, match="Unknown"):
        load_config({"model": {"trees": 1}})


def test_feature_families_can_be_left_out(daily):
    plain = features.build_features(daily(1, 1, 70), config=FeatureConfig(enable_hierarchical_features=False))
    assert "store_historical_mean" not in plain.columns and "sales_momentum_7_28" in plain.columns
    bare = features.build_features(daily(1, 1, 70), config=FeatureConfig(enable_demand_pattern_features=False))
    assert "store_historical_mean" in bare.columns and "sales_momentum_7_28" not in bare.columns


def test_split_bounds(daily):
    row = normalize.split_bounds(daily(1, 1, 30), 5, 5).first()
    assert row["test_start"] == dt.date(2024, 1, 26) and row["validation_start"] == dt.date(2024, 1, 21)


def test_approximate_summary_agrees_on_small_data(daily):
    panel = daily(3, 4, 31)
    exact, rough = (eda.sales_summary(panel, approximate=a).first().asDict() for a in (False, True))
    assert exact == rough and exact["median_sales"] == 15.0


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame(
        [("2024-01-01", "1", "1", float("nan"))], "date string, store string, item string, sales double"
    )
    assert {r["check"] for r in quality.quality_report(df).collect()} == {"target_missing", "missingness"}
    assert quality.missing_rates(df).where("column = 'sales'").first()["missing_rate"] == 1.0
