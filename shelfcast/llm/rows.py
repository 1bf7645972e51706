"""Small helpers that several text operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words in the plain splitting of a text (space, tab to carriage return).
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain_words(text: Column) -> Column:
    """Array of the maximal runs of characters other than blanks; empty for null and blank texts."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^{BLANKS}|{BLANKS}\z", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANKS))


def text_key(text: Column) -> Column:
    """Tells apart rows that repeat an id with another text; null and empty texts differ."""
    return F.when(text.isNull(), F.lit(0)).otherwise(F.xxhash64(text))
