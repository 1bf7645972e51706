"""Features, state and forecasts: exact values and the published row counts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.functions.calendar import us_holidays
from shelfcast.operators import backtest, features, forecast, history, lag, models, normalize, ranking, state
from shelfcast.sources import tables


def test_lags_use_past_sales_only(daily):
    built = features.build_features(daily(1, 1, 40), drop_missing=False)
    row = built.where("date = DATE'2024-01-29'").first()
    assert (row["sales_lag_7"], row["sales_lag_14"], row["sales_lag_28"]) == (21, 14, 0)


def test_minimum_counts(daily):
    built = features.build_features(daily(1, 1, 40), drop_missing=False).orderBy("date").collect()
    first = {c: next((i for i, r in enumerate(built) if r[c] is not None), None) for c in built[0].asDict()}
    assert first["sales_rolling_mean_7"] == 3 and first["sales_rolling_mean_28"] == 14
    assert first["recent_zero_sales_28"] == 6 and first["sales_trend_28"] == 14
    assert first["store_item_historical_mean"] == 7 and first["store_day_of_week_historical_mean"] == 21
    assert built[39]["sales_trend_28"] == 1.0


def test_state_serves_business_requests(spark, daily):
    kept = state.feature_state(daily(1, 1, 40))
    requests = spark.createDataFrame([("1", "1", "2024-02-10")], "store string, item string, forecast_date string")
    row = forecast.serving_features(requests, kept).first()
    assert row["sales_lag_7"] == 33 and row["sales_rolling_mean_7"] == 36
    assert row["year_index"] == 0 and row["price"] == 0.0


def test_unknown_pairs(spark, daily, tmp_path):
    tables.write_state(state.feature_state(daily(2, 2, 40, sales="100 * s + d")), str(tmp_path / "state"))
    kept = tables.load_state(spark, str(tmp_path / "state"))
    requests = spark.createDataFrame([("1", "9", "2024-02-10")], "store string, item string, forecast_date string")
    pair = forecast.serving_features(requests, kept).first()
    assert pair["store_historical_mean"] == pair["sales_lag_7"] == pytest.approx(169.5)
    level = forecast.serving_features(requests, kept, cold_start="hierarchical").first()
    assert level["store_historical_mean"] == pytest.approx(119.5)
    assert level["item_historical_mean"] == pytest.approx(169.5)


def test_short_history_and_zero_rows(spark, daily):
    kept = state.feature_state(daily(1, 1, 1, sales="0"))
    requests = spark.createDataFrame(
        [("1", "1", "2024-01-02"), ("1", "1", "2023-12-01")], "store string, item string, forecast_date string"
    )
    after, before = forecast.serving_features(requests, kept).orderBy(F.desc("forecast_date")).collect()
    assert after["recent_zero_sales_28"] == 1 and after["sales_rolling_std_7"] == 0.0
    assert after["sales_lag_1"] == 0.0 and after["sales_cv_28"] == 0.0
    assert before["recent_zero_sales_28"] == 0 and before["sales_rolling_mean_7"] == 0.0


def test_forecast_grid_has_every_series_and_day(daily):
    kept = state.feature_state(daily(2, 3, 30))
    rows = forecast.forecast_next_days(kept, lambda f: f.withColumn("prediction", F.lit(-1.0)), days=5)
    assert rows.count() == 2 * 3 * 5
    assert rows.agg(F.min("prediction")).first()[0] == 0.0
    assert rows.agg(F.min("forecast_date")).first()[0] == dt.date(2024, 1, 31)
    with pytest.raises(ValueError, match="between 1 and 90"):
        forecast.forecast_series(kept, "1", "1", lambda f: f, days=91)
    with pytest.raises(ValueError, match="lack columns"):
        forecast.score_features(daily(1, 1, 1), lambda f: f)


def test_horizon_target(daily):
    ahead = lag.add_horizon_target(daily(1, 1, 10), 3)
    assert ahead.count() == 7 and ahead.orderBy("date").first()["sales"] == 3.0
    with pytest.raises(ValueError):
        lag.add_horizon_target(daily(1, 1, 10), 0)


def test_known_holidays(spark):
    years = spark.createDataFrame([(2020, 2022)], "first_year int, last_year int")
    days = {(r["date"].isoformat(), r["name"]) for r in us_holidays(years).collect()}
    for expected in [
        ("2020-01-01", "New Year's Day"),
        ("2020-01-20", "Martin Luther King Jr. Day"),
        ("2021-02-15", "Washington's Birthday"),
        ("2021-05-31", "Memorial Day"),
        ("2021-06-18", "Juneteenth (observed)"),
        ("2020-07-03", "Independence Day (observed)"),
        ("2021-07-05", "Independence Day (observed)"),
        ("2022-09-05", "Labor Day"),
        ("2022-10-10", "Columbus Day"),
        ("2020-11-11", "Veterans Day"),
        ("2020-11-26", "Thanksgiving"),
        ("2021-12-31", "New Year's Day (observed)"),
        ("2022-12-26", "Christmas Day (observed)"),
    ]:
        assert expected in days
    assert not any(d.startswith("2020-06") for d, _ in days)


def test_published_row_counts(daily):
    """10 x 50 series of 1,826 days: complete cases, their first day and the split sizes."""
    panel = daily(10, 50, 1826, "2013-01-01", "1 + (s * 7 + i * 3 + d) % 50")
    built = features.build_features(panel, holidays=None)
    split = normalize.split_windows(normalize.chronological_split(built.select("date")))
    rows = {r["split"]: r for r in split.collect()}
    assert {s: r["rows"] for s, r in rows.items()} == {"train": 793_230, "validation": 45_000, "test": 45_000}
    assert rows["train"]["start_date"] == dt.date(2013, 2, 26)
    folds = backtest.fold_windows(panel).orderBy("fold").collect()
    assert [f["test_start"].isoformat() for f in folds] == ["2017-09-11", "2017-10-09", "2017-11-06"]
    assert {f["rows"] for f in folds} == {14_000}


def _totals(rows, ranges):
    columns = ["g", "o", "v", "v_before", "v_total"]
    return sorted(ranking.running_totals(rows, ["g"], "o", ["v"], ranges).select(columns).collect())


@pytest.mark.parametrize("value", ["id", "double(id) / 7"])
def test_ranges_do_not_change_the_totals(spark, value):
    """A third of all rows in one group, whole numbers and sevenths: the same bits from 1, 8 and 64 ranges."""
    rows = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('g', id % 7) END AS g",
        "lpad(id * 7919 % 3001, 5, '0') AS o",
        f"{value} AS v",
    )
    one = _totals(rows, 1)
    assert one == _totals(rows, 64) == _totals(rows, 8)
    expected, running = {}, {}
    for r in sorted(rows.collect(), key=lambda r: (r.g, r.o)):
        expected[r.g, r.o] = running.get(r.g, 0)
        running[r.g] = running.get(r.g, 0) + r.v
    assert all(abs(r.v_before - expected[r.g, r.o]) < 1e-6 and abs(r.v_total - running[r.g]) < 1e-6 for r in one)


def test_many_ranges_of_one_group(spark):
    rows = spark.range(4000).selectExpr("'a' AS g", "double(id * 37 % 4001) AS o", "1L AS v")
    cut = ranking.running_totals(rows, ["g"], "o", ["v"], ranges=400)
    ordered = [r["v_before"] for r in cut.orderBy("o").select("v_before").collect()]
    assert ordered == list(range(4000))


def test_quantiles_interpolate(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 2, 10)] + [("b", 5.0), ("b", None)], "k string, v double")
    found = {r["k"]: r["quantiles"] for r in ranking.exact_quantiles(df, "v", [0.0, 0.5, 0.75, 1.0], ["k"]).collect()}
    assert found == {"a": [1.0, 2.0, 4.0, 10.0], "b": [5.0] * 4}


def test_pooled_history_does_not_depend_on_ranges(daily, monkeypatch):
    panel = daily(3, 9, 30, sales="(s * 5 + i * 3 + d) % 11 / 7")
    plain = sorted(map(str, history.add_history_aggregates(panel).collect()))
    totals = ranking.running_totals
    monkeypatch.setattr(history, "running_totals", lambda *args: totals(*args, ranges=13))
    assert sorted(map(str, history.add_history_aggregates(panel).collect())) == plain


def test_chronological_history_never_looks_ahead(daily):
    panel = daily(2, 2, 20, sales="s * 100 + d")
    changed = panel.withColumn("sales", F.when(F.col("date") >= "2024-01-15", 0.0).otherwise(F.col("sales")))
    before = [
        sorted(
            map(str, history.add_history_aggregates(p, "chronological").where("date <= '2024-01-15'").drop("sales").collect())
        )
        for p in (panel, changed)
    ]
    assert before[0] == before[1]


def test_feature_columns_are_model_inputs(daily):
    built = features.build_features(daily(1, 1, 5), drop_missing=False, holidays=None)
    names = models.feature_columns(built)
    assert "date" not in names and "sales" not in names and {"store", "item", "sales_lag_1"} <= set(names)
