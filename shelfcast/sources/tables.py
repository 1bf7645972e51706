"""Readers and writers of panels, results and logs."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators.state import FeatureState


def scan_sales(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A raw sales table. CSV columns stay text: typing is the job of the normalisation."""
    if fmt == "csv":
        return spark.read.option("header", True).csv(path)
    return spark.read.format(fmt).load(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None, fmt: str = "parquet") -> DataFrame:
    """An earlier result; give text formats their schema, it is never inferred."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return (reader.schema(schema) if schema else reader).load(path)


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None, mode: str = "overwrite"
) -> None:
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def with_month(df: DataFrame, date: str = "date") -> DataFrame:
    """Add ``sales_month``, a partition column that lets date filters skip files."""
    return df.withColumn("sales_month", F.date_format(date, "yyyy-MM"))


def write_series_table(df: DataFrame, table: str, buckets: int = 64) -> None:
    """Save a panel bucketed and sorted by series: later windows and joins need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, "store", "item").sortBy("store", "item", "date").saveAsTable(table)


def json_documents(df: DataFrame) -> DataFrame:
    """Each row as one JSON text column ``document``."""
    return df.select(F.to_json(F.struct("*")).alias("document"))


def write_document(df: DataFrame, path: str) -> None:
    """A report of a few rows as JSON lines in one file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def read_log(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_state(state: FeatureState, path: str) -> None:
    """The three state tables under one folder."""
    state.series.write.mode("overwrite").parquet(f"{path}/series")
    state.means.write.mode("overwrite").parquet(f"{path}/means")
    state.totals.write.mode("overwrite").parquet(f"{path}/totals")


def load_state(spark: SparkSession, path: str) -> FeatureState:
    """State tables as written; a missing folder fails with Spark's path error."""
    return FeatureState(*[spark.read.parquet(f"{path}/{part}") for part in ("series", "means", "totals")])


def _as_text(field: T.StructField) -> Column:
    """A cell as text that engines agree on: numbers with a point to ten places, its length before it, null told apart."""
    cell = F.col(f"`{field.name}`")
    text = cell.cast("string")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        # Beyond the decimal's range the number's own text stands for it.
        text = F.coalesce(cell.try_cast("decimal(38,10)").cast("string"), text)
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("null"))


LANES = 4


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Order-insensitive content mark that adds up: rows, and the sums of four 32-bit lanes of the rows' MD5 digests.

    The mark of two tables together is the sum of their marks (``add_fingerprints``), so a delivery is marked by itself.
    A row that is added twice shows in the sums. Columns count in the order of their names.
    """
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    digest = F.md5(F.concat_ws(",", *[_as_text(f) for f in fields]))
    lanes = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("decimal(20,0)") for k in range(LANES)]
    sums = [F.coalesce(F.sum(lane), F.lit(0)).cast("decimal(38,0)").cast("string").alias(f"lane_{k}") for k, lane in enumerate(lanes)]
    return df.agg(F.count(F.lit(1)).alias("rows"), *sums)


def add_fingerprints(marks: DataFrame) -> DataFrame:
    """The mark of several tables together from a table of their marks."""
    lanes = [F.coalesce(F.sum(F.col(f"lane_{k}").cast("decimal(38,0)")), F.lit(0)) for k in range(LANES)]
    return marks.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        *[lane.cast("decimal(38,0)").cast("string").alias(f"lane_{k}") for k, lane in enumerate(lanes)],
    )


# ---- logs that several writers append to --------------------------------------------------------


class Conflict(RuntimeError):
    """Other writers were first, again and again."""


def read_entries(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The entries of a log in effect: of those with one number the first written; (entry, token, columns of the log)."""
    shape = f"entry long, token string, row struct<{_struct(spark, schema)}>"
    try:
        written = spark.read.schema(shape).json(path)
    except AnalysisException:  # nothing was written yet
        written = spark.createDataFrame([], shape)
    first = written.groupBy("entry").agg(F.min("token").alias("token"), F.min_by("row", "token").alias("row"))
    return first.select("entry", "token", "row.*")


def _struct(spark: SparkSession, schema: T.StructType | str) -> str:
    names = schema if isinstance(schema, T.StructType) else spark.createDataFrame([], schema).schema
    return ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in names)


def commit_entry(
    spark: SparkSession, path: str, schema: T.StructType | str, decide: Callable[[DataFrame], DataFrame], tries: int = 8
) -> DataFrame:
    """Append the one row that ``decide`` makes of the log so far, so that it followed exactly those entries.

    The row is written under the next number with a token of its time and writer. Where another writer took the same
    number first, that entry counts and this one does not: the decision is made anew on the log with it. Nothing is
    locked or rewritten, and a writer that is lost leaves the log as it was. Returns the entry that counts.
    """
    for _ in range(tries):
        log = read_entries(spark, path, schema)
        number = (log.agg(F.max("entry")).first()[0] or 0) + 1
        row = decide(log.drop("entry", "token"))
        row = spark.createDataFrame(row.collect(), row.schema)  # one row; its token is of the time when it is there
        token = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        entry = row.select(F.lit(number).alias("entry"), F.lit(token).alias("token"), F.struct("*").alias("row"))
        entry.coalesce(1).write.mode("append").json(path)
        kept = read_entries(spark, path, schema).where(F.col("entry") == number)
        if kept.where(F.col("token") == token).count():
            return kept.drop("entry", "token")
    raise Conflict(f"No entry of {tries} was the first of its number.")
