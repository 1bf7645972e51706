"""The stored-table runs end to end, and the request stream."""

import pytest
from pyspark.sql import functions as F

from shelfcast.config import load_config
from shelfcast.operators.normalize import normalize_schema
from shelfcast.plans import catalog, runs
from shelfcast.sources import tables
from shelfcast.streaming.requests import refresh_state, score_request_stream

CONFIG = load_config(
    {
        "data": {"validation_days": 15, "test_days": 15},
        "backtest": {"folds": 1, "horizon_days": 7, "step_days": 7},
        "boosting": {"n_estimators": 3, "max_depth": 2},
    }
)


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("run"))
    raw = spark.range(4 * 150).selectExpr(
        "string(date_add(DATE'2024-01-01', int(id % 150))) AS Date",
        "string(id div 300 + 1) AS Store",
        "string((id div 150) % 2 + 1) AS Product",
        "string(20 + (id % 150) % 7 + (id * 37) % 5) AS Units",
    )
    return out, runs.train(spark, raw, out, CONFIG, ["ridge", "boosted_trees"])


def test_training_registers_the_best_model(spark, trained):
    out, chosen = trained
    board = tables.read_table(spark, f"{out}/leaderboard").orderBy("rmse").collect()
    assert {r["model"] for r in board} == {"seasonal_naive_7", "moving_average_7", "ridge", "boosted_trees"}
    assert chosen in ("ridge", "boosted_trees")
    candidates, decisions = runs.registry(spark, out)
    assert candidates.first()["name"] == chosen and candidates.first()["metrics"]["rmse"] > 0
    assert decisions.first()["promoted"]
    scored = tables.read_table(spark, f"{out}/predictions")
    assert scored.where("prediction_p10 < 0 OR prediction_p90 < prediction_p10").count() == 0


def test_forecast_drift_and_backtest(spark, trained):
    out, _ = trained
    assert runs.forecast_run(spark, out, 7).count() == 4 * 7
    assert runs.drift_run(spark, out, config=CONFIG).first()["status"] in ("ok", "warning")
    folds = runs.backtest_run(spark, out, CONFIG, CONFIG.boosting).collect()
    assert {r["model"] for r in folds} == {"seasonal_naive_7", "moving_average_7", "boosted_trees"}
    assert {r["rows"] for r in folds} == {4 * 7}
    shown = runs.monitoring_tables(spark, out)
    assert shown["active_model"].count() == 1 and shown["importance"].count() <= 20


def test_a_bad_delivery_leaves_the_panel(spark, trained):
    out, _ = trained
    before = tables.table_fingerprint(tables.read_table(spark, f"{out}/clean")).collect()
    bad = spark.createDataFrame([("2024-01-01", "1", "1", "5"), ("2024-01-01", "1", "1", "-6")], "Date string, Store string, Product string, Units string")
    with pytest.raises(ValueError, match="duplicate_keys"):
        runs.prepare(spark, bad, out, CONFIG)
    assert tables.table_fingerprint(tables.read_table(spark, f"{out}/clean")).collect() == before


def test_a_delivery_that_repeats_a_key(spark, tmp_path):
    clean, state_path = str(tmp_path / "clean"), str(tmp_path / "state")
    columns = "date string, store string, item string, sales string"
    old = spark.createDataFrame([("2024-01-01", "1", "1", "5")], columns)
    tables.write_table(normalize_schema(old), clean)
    thrice = spark.createDataFrame([("2024-01-02", "1", "1", "7")] * 3, columns)
    refresh_state(spark, clean, thrice, state_path)
    assert tables.read_table(spark, clean).count() == 2
    with pytest.raises(ValueError, match="several values"):
        refresh_state(spark, clean, thrice.unionByName(thrice.withColumn("sales", F.lit("8"))).withColumn("date", F.lit("2024-01-03")), state_path)
    assert tables.read_table(spark, clean).count() == 2


def test_request_stream(spark, trained, tmp_path):
    out, _ = trained
    asked = spark.createDataFrame([("1", "1", "2024-06-01"), ("9", "9", "2024-06-01")], "store string, item string, forecast_date string")
    asked.coalesce(1).write.json(str(tmp_path / "in"))
    query = score_request_stream(
        spark, str(tmp_path / "in"), f"{out}/state", catalog.lag_or_mean, str(tmp_path / "out"), str(tmp_path / "marks")
    )
    query.awaitTermination(120)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r["store"] for r in rows} == {"1", "9"} and all(r["prediction"] > 0 for r in rows)


def test_state_refresh_is_repeatable(spark, daily, tmp_path):
    clean, kept = str(tmp_path / "clean"), str(tmp_path / "state")
    tables.write_table(daily(1, 2, 20), clean)
    new = daily(1, 2, 25).where(F.col("date") >= "2024-01-18")
    for _ in range(2):
        refresh_state(spark, clean, new, kept)
        assert tables.read_table(spark, clean).count() == 50
    assert tables.load_state(spark, kept).totals.first()["last_date"].isoformat() == "2024-01-25"
