"""Output form shared by all registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strikepath.functions.prices import snap

# Counts that an outer join leaves NULL on some rows are given as doubles, so
# that every reader shows the same value for them.
SPARSE_COUNTS = ("outcome_yes", "trade_count_sum", "large_move_rows", "underlying_trade_count")


def present(df: DataFrame) -> DataFrame:
    """Doubles at six places, whole numbers as bigint, dates as text, timestamps without a zone (UTC)."""
    return df.select(*[_cell(f) for f in df.schema])


def _cell(field: T.StructField):
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        column = snap(column)
    elif isinstance(field.dataType, T.IntegralType):
        column = column.cast("double" if field.name in SPARSE_COUNTS else "bigint")
    elif isinstance(field.dataType, T.DateType):
        column = F.date_format(column, "yyyy-MM-dd")
    elif isinstance(field.dataType, T.TimestampType):
        column = column.cast("timestamp_ntz")
    return column.alias(field.name)


def _text(field: T.StructField):
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        column = snap(column).cast("decimal(38,6)")
    elif isinstance(field.dataType, T.TimestampType):
        column = F.unix_micros(column)
    return F.coalesce(column.cast("string"), F.lit("~"))


def content(df: DataFrame, product: str) -> DataFrame:
    """Per week of a product its rows, its columns and a digest over all values of all rows, whatever their order."""
    fields = sorted((f for f in df.schema if f.name != "week_id"), key=lambda f: f.name)
    row = F.md5(F.concat_ws("|", *[_text(f) for f in fields]))
    number = F.conv(F.substring(row, 1, 15), 16, 10).cast("decimal(20,0)")
    return df.groupBy("week_id").agg(
        F.lit(product).alias("product"),
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(",".join(f.name for f in fields)).alias("columns"),
        F.sum(number).cast("string").alias("digest"),
    )
