import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests"), str(ROOT / "tests" / "llm")]

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from shelfcast.session import local_session

    session = local_session(8, "shelfcast-tests", tmp_path_factory.mktemp("shared").as_uri())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def daily(spark):
    """Panel maker: stores x items x days, sales from (store number, item number, day number)."""
    from pyspark.sql import functions as F

    def make(stores, items, days, start="2024-01-01", sales="d"):
        grid = spark.range(stores * items * days).selectExpr(
            f"id div {items * days} + 1 AS s", f"(id div {days}) % {items} + 1 AS i", f"id % {days} AS d"
        )
        return grid.select(
            F.expr(f"date_add(DATE'{start}', int(d))").alias("date"),
            F.col("s").cast("string").alias("store"),
            F.col("i").cast("string").alias("item"),
            F.expr(f"double({sales})").alias("sales"),
        )

    return make
