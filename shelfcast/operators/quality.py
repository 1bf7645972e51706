"""Data-quality reports. Each is one aggregate pass turned into a small table of findings."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions.scalars import lenient_double
from shelfcast.schema import DATE, ITEM, KEY, REQUIRED, SALES, SERIES, STORE

# Thresholds of the warnings.
MISSING_RATE_LIMIT = 0.05
MIN_SPAN_DAYS = 365

ISSUE_SCHEMA = "severity string, check string, message string"


def duplicate_keys(df: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Repeated keys with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def _is_missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN in a floating-point column."""
    value = F.col(column)
    floating = isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))
    return value.isNull() | F.isnan(value) if floating else value.isNull()


def missing_rates(df: DataFrame) -> DataFrame:
    """Null rate of every column, one row per column, from one pass."""
    rates = df.agg(*[F.avg(_is_missing(df, c).cast("double")).alias(c) for c in df.columns])
    return rates.unpivot([], df.columns, "column", "missing_rate")


def _parsed_date() -> Column:
    return F.col(DATE).try_cast("date")


def series_coverage(df: DataFrame) -> DataFrame:
    """Per series: first and last day, rows, distinct days and calendar days in between."""
    day = _parsed_date()
    return df.groupBy(*SERIES).agg(
        F.min(day).alias("first_date"),
        F.max(day).alias("last_date"),
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(day).alias("distinct_days"),
        (F.datediff(F.max(day), F.min(day)) + 1).cast("long").alias("calendar_days"),
    )


def continuity_gaps(df: DataFrame) -> DataFrame:
    """Series whose distinct days do not fill their calendar range."""
    gaps = F.col("calendar_days") - F.col("distinct_days")
    return series_coverage(df).withColumn("missing_days", gaps).where(gaps != 0)


def _issues(facts: DataFrame, rules: Sequence[tuple[str, str, Column, Column | str]]) -> DataFrame:
    """One output row per rule whose condition holds on the one-row ``facts``."""
    rows = F.array(
        *[
            F.struct(
                F.lit(severity).alias("severity"),
                F.lit(check).alias("check"),
                (F.lit(message) if isinstance(message, str) else message).alias("message"),
                F.coalesce(condition, F.lit(False)).alias("hit"),
            )
            for severity, check, condition, message in rules
        ]
    )
    return (
        facts.select(F.explode(rows).alias("r")).where("r.hit").select("r.severity", "r.check", "r.message")
    )


def quality_report(
    df: DataFrame, require_daily_continuity: bool = False, check_shape: bool = False
) -> DataFrame:
    """Findings as (severity, check, message); an empty table means a clean panel.

    Missing required columns end the report at once. The gap check is skipped while any date
    does not parse, and always runs as part of the shape check.
    """
    missing = sorted(set(REQUIRED) - set(df.columns))
    if missing:
        return df.sparkSession.createDataFrame(
            [("error", "required_columns", f"Missing {missing}")], ISSUE_SCHEMA
        )

    day = _parsed_date()
    number = F.col(SALES).try_cast("double")
    facts = df.agg(
        F.count_if(_is_missing(df, SALES)).alias("null_sales"),
        F.count_if(number < 0).alias("negative_sales"),
        F.count_if(day.isNull()).alias("bad_dates"),
        F.greatest(F.lit(0.0), *[F.avg(_is_missing(df, c).cast("double")) for c in df.columns]).alias("null_rate"),
        F.coalesce(F.min(STORE) == F.max(STORE), F.lit(True)).alias("one_store"),
        F.coalesce(F.min(ITEM) == F.max(ITEM), F.lit(True)).alias("one_item"),
        F.datediff(F.max(day), F.min(day)).alias("span"),
    ).withColumn("duplicates", duplicate_keys(df).agg(F.count(F.lit(1))).scalar())
    rules: list[tuple[str, str, Column, Column | str]] = [
        # Names and texts of the findings, as published.
        ("error", "duplicate_keys", F.col("duplicates") > 0, "Duplicate date/store/item observations found"),
        ("error", "target_missing", F.col("null_sales") > 0, "Sales contains missing values"),
        ("error", "target_non_negative", F.col("negative_sales") > 0, "Sales contains negative values"),
        ("error", "date_parse", F.col("bad_dates") > 0, "Some dates could not be parsed"),
        (
            "warning",
            "missingness",
            F.col("null_rate") > MISSING_RATE_LIMIT,
            F.format_string("At least one column has %.1f%% missing values", F.col("null_rate") * 100),
        ),
    ]
    if require_daily_continuity or check_shape:
        facts = facts.withColumn("gap_series", continuity_gaps(df).agg(F.count(F.lit(1))).scalar())
        rules.append(
            (
                "warning",
                "daily_continuity",
                (F.col("bad_dates") == 0) & (F.col("gap_series") > 0),
                F.format_string("%d store/item series have date gaps", "gap_series"),
            )
        )
    if check_shape:
        rules += [
            ("warning", "store_count", F.col("one_store"), "Dataset has fewer than 2 stores"),
            ("warning", "item_count", F.col("one_item"), "Dataset has fewer than 2 items"),
            (
                "warning",
                "history_length",
                F.col("span") < MIN_SPAN_DAYS,
                "Dataset has less than one year of history",
            ),
        ]
    return _issues(facts, rules)


def raise_for_errors(report: DataFrame) -> None:
    """Gate: fail on error findings, let warnings pass."""
    errors = report.where(F.col("severity") == "error").orderBy("check").collect()
    if errors:
        details = "; ".join(f"{r['check']}: {r['message']}" for r in errors)
        raise ValueError(f"The table breaks its checks. {details}")


@dataclass(frozen=True)
class Rule:
    """A named row predicate that must hold; null counts as a violation."""

    name: str
    holds: Column
    severity: str = "error"


def panel_contract() -> list[Rule]:
    number = lenient_double(F.col(SALES).cast("string"))
    return [
        Rule("date_not_null", _parsed_date().isNotNull()),
        Rule("store_not_null", F.col(STORE).isNotNull()),
        Rule("item_not_null", F.col(ITEM).isNotNull()),
        Rule("sales_numeric", number.isNotNull()),
        Rule("sales_non_negative", number >= 0),
    ]


def check_contract(
    df: DataFrame, rules: Sequence[Rule] | None = None, unique: Sequence[str] | None = KEY
) -> DataFrame:
    """Violations per rule as (check, severity, violations, passed); all row rules share one pass."""
    rules = panel_contract() if rules is None else rules
    facts = df.agg(
        *[F.count_if(~F.coalesce(r.holds, F.lit(False))).alias(f"_r{i}") for i, r in enumerate(rules)]
    )
    entries = [(r.name, r.severity, f"_r{i}") for i, r in enumerate(rules)]
    if unique:
        surplus = duplicate_keys(df, unique).agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)))
        facts = facts.withColumn("_unique", surplus.scalar())
        entries.append(("unique_key", "error", "_unique"))
    table = F.array(
        *[
            F.struct(
                F.lit(name).alias("check"),
                F.lit(severity).alias("severity"),
                F.col(column).cast("long").alias("violations"),
                (F.col(column) == 0).alias("passed"),
            )
            for name, severity, column in entries
        ]
    )
    return facts.select(F.inline(table))


@dataclass(frozen=True)
class DatasetExpectation:
    # The full public training panel.
    min_rows: int = 900_000
    stores: int = 10
    items: int = 50
    start: str = "2013-01-01"
    end: str = "2017-12-31"


def verify_dataset(df: DataFrame, expected: DatasetExpectation | None = None) -> DataFrame:
    """(name, passed, detail) checks of a raw table against the expected dataset."""
    expected = expected or DatasetExpectation()
    missing = sorted(set(REQUIRED) - set(df.columns))
    if missing:
        return df.sparkSession.createDataFrame(
            [("required_columns", False, f"Missing columns: {missing}")],
            "name string, passed boolean, detail string",
        )
    day = _parsed_date()
    number = lenient_double(F.col(SALES).cast("string"))
    bounds = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.min(day).cast("string"), F.lit("unknown")).alias("first"),
        F.coalesce(F.max(day).cast("string"), F.lit("unknown")).alias("last"),
        F.count_if(F.coalesce(number < 0, F.lit(True))).alias("bad_sales"),
    )
    facts = bounds.withColumns(
        {
            "stores": distinct_levels(df, STORE).scalar(),
            "items": distinct_levels(df, ITEM).scalar(),
        }
    )

    def entry(name: str, passed: Column, detail: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), passed.alias("passed"), detail.alias("detail"))

    checks = [
        entry("required_columns", F.lit(True), F.lit("All required columns present.")),
        entry(
            "real_dataset_row_count",
            F.col("rows") >= expected.min_rows,
            F.concat(
                F.lit("Rows="),
                F.format_number("rows", 0),
                F.lit(f"; expected at least {expected.min_rows:,} rows."),
            ),
        ),
        entry(
            "store_count",
            F.col("stores") == expected.stores,
            F.format_string(f"Stores=%d; expected {expected.stores}.", "stores"),
        ),
        entry(
            "item_count",
            F.col("items") == expected.items,
            F.format_string(f"Items=%d; expected {expected.items}.", "items"),
        ),
        entry(
            "date_range",
            (F.col("first") == expected.start) & (F.col("last") == expected.end),
            F.format_string(
                f"Date range=%s to %s; expected {expected.start} to {expected.end}.", "first", "last"
            ),
        ),
        entry("non_negative_sales", F.col("bad_sales") == 0, F.lit("Sales are non-negative.")),
    ]
    return facts.select(F.inline(F.array(*checks)))


def distinct_levels(df: DataFrame, column: str) -> DataFrame:
    """Exact distinct count as one row; levels are deduplicated before the shuffle."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().agg(F.count(F.lit(1)))


def verification_verdict(checks: DataFrame) -> DataFrame:
    """One row: status, passed, and whether the table looks like a sample."""
    row_check = F.bool_or((F.col("name") == "real_dataset_row_count") & ~F.col("passed"))
    return checks.agg(F.bool_and("passed").alias("passed"), row_check.alias("likely_sample_data")).select(
        F.when(F.col("passed"), "verified").otherwise("not_verified").alias("status"),
        "passed",
        "likely_sample_data",
    )
