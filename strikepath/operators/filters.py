"""Optional filters and option lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALL = "All"
FILTER_COLUMNS = {
    "time_to_close": "time_to_close_bucket",
    "moneyness": "moneyness_bucket",
    "source": "data_source_period",
}


def apply_filters(df: DataFrame, **chosen: str) -> DataFrame:
    """Keep rows equal to each chosen value; ``"All"`` or a missing column filters nothing."""
    for name, value in chosen.items():
        column = FILTER_COLUMNS[name]
        if value != ALL and column in df.columns:
            df = df.where(F.col(column).cast("string") == value)
    return df


def options(df: DataFrame, column: str, *keys: str) -> DataFrame:
    """Distinct known values of a column."""
    return df.where(F.col(column).isNotNull()).select(*keys, F.col(column).cast("string").alias("option")).distinct()
