"""Profiles of tables and files: rows, ranges, samples, keys and coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strikepath.functions.aggregates import rows

# Name parts that mark a column.
TIME_PARTS = ("time", "timestamp", "ts", "date", "second")
ID_PARTS = ("ticker", "market", "contract", "event", "symbol")
PRICE_PARTS = (
    "price",
    "bid",
    "ask",
    "mid",
    "yes",
    "no",
    "spread",
    "threshold",
    "strike",
    "distance",
    "underlying",
    "futures",
)


def _named(df: DataFrame, parts: Sequence[str], *kinds: type) -> list[str]:
    return [
        f.name
        for f in df.schema
        if any(p in f.name.lower() for p in parts) and (not kinds or isinstance(f.dataType, kinds))
    ]


def time_columns(df: DataFrame) -> list[str]:
    return _named(df, TIME_PARTS, T.TimestampType, T.DateType)


def id_columns(df: DataFrame) -> list[str]:
    return _named(df, ID_PARTS, T.StringType)


def numeric_columns(df: DataFrame) -> list[str]:
    return _named(df, PRICE_PARTS, T.NumericType)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(rows().alias("n_rows"))


def _stack(wide: DataFrame, columns: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One row per column from ``<column>|<field>`` aggregates."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}|{f}`").alias(f) for f in fields])
            for c in columns
        ]
    )
    return wide.select(F.inline(cells))


def time_ranges(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """First and last value of each time column, from one pass."""
    names = list(columns or time_columns(df))
    wide = df.agg(
        *[F.min(c).cast("timestamp").alias(f"{c}|min") for c in names],
        *[F.max(c).cast("timestamp").alias(f"{c}|max") for c in names],
    )
    return _stack(wide, names, ("min", "max"))


def numeric_ranges(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Minimum, maximum and mean of each price-like column, from one pass."""
    names = list(columns or numeric_columns(df))
    wide = df.agg(
        *[F.min(c).cast("double").alias(f"{c}|min") for c in names],
        *[F.max(c).cast("double").alias(f"{c}|max") for c in names],
        *[F.avg(c).alias(f"{c}|mean") for c in names],
    )
    return _stack(wide, names, ("min", "max", "mean"))


def id_samples(df: DataFrame, column: str, n: int) -> DataFrame:
    """The first ``n`` distinct values of an id column and how many there are.

    Distinct values are reduced in parallel; only the ``n`` smallest are ordered.
    """
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct()
    return values.orderBy("value").limit(n)


def distinct_count(df: DataFrame, *columns: str) -> DataFrame:
    wide = df.agg(*[F.count_distinct(c).alias(f"{c}|n_distinct") for c in columns])
    return _stack(wide, columns, ("n_distinct",))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(rows().alias("n_rows")).where(F.col("n_rows") > 1)


# Names that mark the column of a contract.
CONTRACT_NAMES = ("ticker", "contract_ticker", "market_ticker")
# Relative error of the distinct sketches, and from which share of distinct rows on a pair is counted exactly.
SKETCH_ERROR = 0.01
NEARLY = 0.9


def contract_columns(df: DataFrame) -> list[str]:
    """The columns named as a contract's; without any, all id columns."""
    return [c for c in df.columns if c.lower() in CONTRACT_NAMES] or id_columns(df)


def candidate_keys(
    df: DataFrame, contracts: Sequence[str] | None = None, times: Sequence[str] | None = None
) -> DataFrame:
    """Which pairs of a contract-like and a time-like column tell the rows of a table apart.

    One pass over the rows fills a mergeable distinct sketch for every pair, which
    screens out those far from distinct; a second pass counts only the others,
    exactly. One row per pair: its rows, those with a NULL in it, ``duplicates``
    (rows beyond the first of their key, NULL where fewer than nine in ten of the
    rows are distinct) and a verdict: "key", "nearly" or "no".
    """
    pairs = [(c, t) for c in contracts or contract_columns(df) for t in times or time_columns(df) if c != t]
    if not pairs:
        raise ValueError("no pair of a contract-like and a time-like column")
    known = [F.col(c).isNotNull() & F.col(t).isNotNull() for c, t in pairs]
    sketch = [F.approx_count_distinct(F.when(k, F.xxhash64(c, t)), SKETCH_ERROR) for k, (c, t) in zip(known, pairs, strict=True)]
    seen = df.agg(
        rows().alias("n_rows"),
        F.array(*[F.struct(F.lit(i).alias("pair"), F.count_if(k).alias("n_known"), s.alias("about")) for i, (k, s) in enumerate(zip(known, sketch, strict=True))]).alias("p"),
    ).select("n_rows", F.inline("p"))
    # Five errors below the share, so that a pair at it is never screened out; at most as many rows as pairs.
    # Asks for all figures, as the other reader does, so that the sketches are made once for both.
    near = F.col("about") >= F.col("n_known") * (NEARLY - 5 * SKETCH_ERROR)
    worth = seen.where(near & (F.col("n_known") <= F.col("n_rows"))).select("pair")
    cells = [F.struct(F.lit(i).alias("pair"), F.col(c).cast("string").alias("c"), F.col(t).cast("string").alias("t")) for i, (c, t) in enumerate(pairs)]
    taken = df.select(F.inline(F.array(*cells))).where(F.col("c").isNotNull() & F.col("t").isNotNull())
    counted = taken.join(F.broadcast(worth), "pair", "left_semi").groupBy("pair", "c", "t").agg(rows().alias("n"))
    exact = counted.groupBy("pair").agg(F.sum(F.col("n") - 1).alias("extra"))
    found = seen.where("about >= 0").join(exact, "pair", "left").withColumn(
        "duplicates", F.when(F.col("extra") <= F.col("n_known") * F.lit(1 - NEARLY), F.col("extra"))
    )
    names = F.array(*[F.struct(F.lit(c).alias("contract_column"), F.lit(t).alias("time_column")) for c, t in pairs])
    whole = (F.col("n_known") == F.col("n_rows")) & (F.col("duplicates") == 0)
    return found.select(
        F.get(names, "pair").alias("names"),
        "n_rows",
        (F.col("n_rows") - F.col("n_known")).alias("n_null"),
        "duplicates",
        F.when(whole, "key").when(F.col("duplicates").isNotNull() & (F.col("n_known") > 0), "nearly").otherwise("no").alias("verdict"),
    ).select("names.*", "n_rows", "n_null", "duplicates", "verdict")


def statistics_columns(df: DataFrame) -> list[str]:
    """Columns whose extremes Parquet footers hold exactly: whole and floating-point numbers and dates."""
    kinds = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType)
    return [f.name for f in df.schema if isinstance(f.dataType, kinds)]


def file_statistics(footers: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, known values, minimum and maximum of each column, as text, from file footers alone.

    ``footers`` is a frame of ``tables.scan_footers``; a column without such
    statistics is refused, as asking for it would read the data.
    """
    able = statistics_columns(footers)
    names = list(columns or able)
    if lacking := [c for c in names if c not in able]:
        raise ValueError(f"no statistics for {', '.join(lacking)}")
    wide = footers.agg(
        rows().alias("n_rows"), *[f(c).alias(f"{c}|{n}") for c in names for n, f in (("n_known", F.count), ("min", F.min), ("max", F.max))]
    )
    cells = [
        F.struct(F.lit(c).alias("column"), "n_rows", F.col(f"`{c}|n_known`").alias("n_known"), *[F.col(f"`{c}|{n}`").cast("string").alias(n) for n in ("min", "max")])
        for c in names
    ]
    return wide.select(F.inline(F.array(*cells)))


def file_coverage(df: DataFrame, time: str, symbol: str) -> DataFrame:
    """Rows, time range and symbols of each file of one schema.

    Symbols are collapsed first, so a file that holds most rows costs no more to
    finish than any other.
    """
    per_symbol = df.groupBy("file", symbol).agg(
        rows().alias("n"), F.min(time).alias("t0"), F.max(time).alias("t1")
    )
    return per_symbol.groupBy("file").agg(
        F.sum("n").alias("n_rows"),
        F.min("t0").alias("first_time"),
        F.max("t1").alias("last_time"),
        F.count(symbol).alias("n_symbols"),
    )


AUDITED = (
    ("underlying_trade_price", "underlying_trade_price"),
    ("quote_mid", "underlying_quote_mid"),
    ("modeling_underlying", "underlying_modeling"),
)


def series_audit(datasets: dict[str, DataFrame]) -> DataFrame:
    """Per dataset: which price series exist and how many values each has."""
    parts = []
    for name, df in datasets.items():
        cells = [F.lit(name).alias("file")]
        for label, column in AUDITED:
            there = column in df.columns
            cells.append(F.lit(there).alias(f"has_{label}"))
            cells.append((F.count(column) if there else F.lit(0).cast("bigint")).alias(f"non_null_{label}"))
        parts.append(df.agg(*cells))
    combined = parts[0]
    for part in parts[1:]:
        combined = combined.unionByName(part)
    return combined
