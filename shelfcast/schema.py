"""Column names and contract values of the demand panel."""

from pyspark.sql import types as T

# The public column names, aliases and feature settings of the panel.
DATE = "date"
STORE = "store"
ITEM = "item"
SALES = "sales"
SERIES = [STORE, ITEM]
KEY = [DATE, STORE, ITEM]
REQUIRED = [DATE, STORE, ITEM, SALES]
ALIASES = {
    "product": "item",
    "sku": "item",
    "quantity": "sales",
    "demand": "sales",
    "units": "sales",
}
OPTIONAL = ["price", "promotion_flag", "stockout_flag", "inventory_on_hand"]
CATEGORICAL = ["store", "item", "day_of_week", "month", "quarter", "is_us_holiday"]
LAGS = [1, 7, 14, 28, 56]
WINDOWS = [7, 14, 28, 56]
SHAPE_WINDOWS = [7, 28]
# Days kept per series in the serving state: the longest lag or window plus a month.
STATE_ROWS = max(LAGS + WINDOWS) + 31

PANEL_SCHEMA = T.StructType(
    [
        T.StructField(DATE, T.DateType(), False),
        T.StructField(STORE, T.StringType(), False),
        T.StructField(ITEM, T.StringType(), False),
        T.StructField(SALES, T.DoubleType(), False),
    ]
)


def feature_columns(df) -> list[str]:
    """Model inputs of a feature table: everything but the date and the target."""
    return [c for c in df.columns if c not in (DATE, SALES)]


def require_columns(df, columns) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
