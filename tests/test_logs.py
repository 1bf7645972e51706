"""Logs that several writers append to, and marks of tables that add up."""

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import eda, sketches
from shelfcast.sources import tables

SHAPE = "version int, note string"


def test_entries_follow_each_other(spark, tmp_path):
    path = str(tmp_path / "log")
    assert tables.read_entries(spark, path, SHAPE).count() == 0

    def next_one(log):
        return log.agg((F.coalesce(F.max("version"), F.lit(0)) + 1).cast("int").alias("version")).withColumn("note", F.lit("n"))

    for k in (1, 2, 3):
        assert tables.commit_entry(spark, path, SHAPE, next_one).first()["version"] == k
    assert [r.entry for r in tables.read_entries(spark, path, SHAPE).orderBy("entry").collect()] == [1, 2, 3]


def test_two_writers_from_one_snapshot(spark, tmp_path):
    """A writer that was overtaken decides anew on the log with the other's entry; every version is given once."""
    path, seen = str(tmp_path / "log"), []

    def next_one(note):
        def decide(log):
            return log.agg((F.coalesce(F.max("version"), F.lit(0)) + 1).cast("int").alias("version")).withColumn("note", F.lit(note))

        return decide

    def overtaken(log):
        row = next_one("slow")(log).collect()
        if not seen:  # the other writer commits between this one's reading and writing
            seen.append(tables.commit_entry(spark, path, SHAPE, next_one("fast")).first()["version"])
        return spark.createDataFrame(row, SHAPE)

    mine = tables.commit_entry(spark, path, SHAPE, overtaken).first()
    assert (seen, mine["version"], mine["note"]) == ([1], 2, "slow")
    assert [(r.version, r.note) for r in tables.read_entries(spark, path, SHAPE).orderBy("entry").collect()] == [(1, "fast"), (2, "slow")]

    def always_late(log):
        row = next_one("late")(log).collect()
        tables.commit_entry(spark, path, SHAPE, next_one("other"))
        return spark.createDataFrame(row, SHAPE)

    with pytest.raises(tables.Conflict):
        tables.commit_entry(spark, path, SHAPE, always_late, tries=2)
    found = [r.version for r in tables.read_entries(spark, path, SHAPE).collect()]
    assert len(found) == len(set(found)) == 4


def test_fingerprints_add_up(spark):
    shape = "store string, day date, sales double, n long"
    a = spark.sql("SELECT '1' AS store, DATE'2024-01-01' AS day, 1.5D AS sales, 7L AS n UNION ALL SELECT NULL, NULL, NULL, NULL")
    b = spark.sql("SELECT '1' AS store, DATE'2024-01-01' AS day, 1e300D AS sales, 7L AS n UNION ALL SELECT ',', NULL, -0.25D, 1L")
    marks = tables.table_fingerprint(a).unionByName(tables.table_fingerprint(b))
    assert tables.add_fingerprints(marks).first() == tables.table_fingerprint(a.unionByName(b)).first()
    assert tables.table_fingerprint(a.select("n", "sales", "day", "store")).first() == tables.table_fingerprint(a).first()
    assert tables.table_fingerprint(a.unionByName(a)).first() != tables.table_fingerprint(a).first()
    empty = tables.table_fingerprint(spark.createDataFrame([], shape)).first()
    assert tuple(empty) == (0, "0", "0", "0", "0")


def test_autocorrelation_unfolds_no_rows(spark, daily):
    panel = daily(2, 2, 40, sales="CASE WHEN s = 1 THEN 5 ELSE (d * d + i) % 11 END")
    found = eda.lag_autocorrelation(panel, 12)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "posexplode" not in plan and "Window" not in plan
    series = [[(d * d + i) % 11 for d in range(40)] for i in (1, 2)]

    def corr(x, y):
        mx, my = sum(x) / len(x), sum(y) / len(y)
        xy = sum((a - mx) * (b - my) for a, b in zip(x, y))
        return xy / (sum((a - mx) ** 2 for a in x) * sum((b - my) ** 2 for b in y)) ** 0.5

    want = {k: sum(corr(x[k:], x[:-k]) for x in series) / 2 for k in range(1, 13)}
    assert {r.lag: pytest.approx(r.correlation, abs=1e-12) for r in found.collect()} == want


@pytest.mark.parametrize("margin", [0.004, 0.0])
def test_bracketed_quantiles_are_exact(spark, monkeypatch, margin):
    """Also where brackets are too narrow at first, and for columns with ties, gaps, nulls, NaN and no values."""
    monkeypatch.setattr(sketches, "MARGIN", margin)
    monkeypatch.setattr(sketches, "SKETCH", 16)
    rows = spark.range(20_000).selectExpr(
        "double((id * 7919) % 20011) AS spread",
        "double(id % 3) AS ties",
        "CASE WHEN id % 4 = 0 THEN NULL WHEN id % 4 = 1 THEN double('NaN') ELSE 1e-12 * (id % 977) END AS small",
        "1e18 + 1e15 * (id % 101) AS large",
        "CAST(NULL AS double) AS nothing",
        "5.0D AS constant",
    )
    shares = [0.0, 0.05, 1 / 3, 0.5, 0.9, 1.0]
    found = sketches.column_quantiles(rows, rows.columns, shares)
    assert found["nothing"] is None
    for c in ("spread", "ties", "small", "large", "constant"):
        values = sorted(r[0] for r in rows.select(c).collect() if r[0] is not None and r[0] == r[0])
        for p, q in zip(shares, found[c]):
            at = p * (len(values) - 1)
            low = int(at + 1e-9)
            want = values[low] + (values[min(low + 1, len(values) - 1)] - values[low]) * (at - low)
            assert q == pytest.approx(want, rel=1e-12), (c, p)
