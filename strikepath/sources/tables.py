"""Weekly product tables: read, write, rewrite, combine and discover.

A product is one folder of versions partitioned by ``week_id``, and its manifest says
which version of a week counts (``sources/manifest.py``); a job writes all weeks at once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strikepath.functions.aggregates import SOURCE_ROW
from strikepath.sources import manifest
from strikepath.sources.manifest import WEEK


def scan(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """Parquet scan that reads only the asked-for columns."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def scan_footers(spark: SparkSession, path: str) -> DataFrame:
    """A scan whose counts and extremes, asked without a filter, come from Parquet footers.

    Only the second version of the file source pushes aggregates down; it is chosen
    for this one read, and plain scans stay with the first.
    """
    name = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(name)
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    spark.conf.set(name, ",".join(x for x in before.split(",") if x != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(name, before)


def product_path(root: str, product: str) -> str:
    return f"{root.rstrip('/')}/{product}"


def write_product(
    df: DataFrame,
    root: str,
    product: str,
    sort_by: Sequence[str] = (),
    time: str | None = None,
    sources: Mapping[str | None, str] | None = None,
    gone: Iterable[str] = (),
) -> str:
    """Write a new version of one product, replacing only the weeks that ``df`` holds.

    The rebalance hint brings a week's rows together but splits them again at the
    advisory partition size, so there are few files and no task gets a whole
    large week. The manifest switches to the version once its files are complete
    and hold as many rows as the job counted; what no week uses any longer is
    removed after that. ``time``, ``sources`` and ``gone`` go to the manifest.
    """
    spark = df.sparkSession
    version = manifest.next_version(spark, root, product)
    path = manifest.version_path(root, product, version)
    counted = Observation(f"{product}-{version}")
    ordered = df.hint("rebalance", F.col(WEEK)).sortWithinPartitions(WEEK, *sort_by)
    # Files of a run that died may lie there.
    ordered.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy(WEEK).parquet(path)
    n_rows = counted.get["n"]
    found = manifest.measured(spark, path, time) if n_rows else None
    manifest.commit(spark, root, product, version, found, n_rows, sources, gone)
    manifest.remove_unlisted(spark, root, product)
    return product_path(root, product)


def drop_weeks(spark: SparkSession, root: str, product: str, weeks: Iterable[str]) -> None:
    """Weeks that a product no longer holds."""
    version = manifest.next_version(spark, root, product)
    manifest.commit(spark, root, product, version, None, gone=weeks)
    manifest.remove_unlisted(spark, root, product)


def read_product(
    spark: SparkSession, root: str, product: str, contract: T.StructType | None = None, week: str | None = None
) -> DataFrame:
    """One product as its manifest has it now, optionally one week of it (the filter prunes partitions).

    A product that was never written is an empty frame of its declared schema.
    """
    held = manifest.held(spark, root, product)
    if held:
        read = spark.read.option("basePath", product_path(root, product))
        # Weeks written at different times may have different columns.
        read = read.schema(contract) if contract else read.option("mergeSchema", len(set(held.values())) > 1)
        df = read.parquet(*[manifest.week_path(root, product, v, w) for w, v in held.items()]).drop("version")
    elif contract is not None:
        df = spark.createDataFrame([], contract)
    else:
        raise FileNotFoundError(f"{product_path(root, product)} was never written")
    # Partition folders are named by date; keep the id as text.
    df = df.withColumn(WEEK, F.col(WEEK).cast("string"))
    return df.where(F.col(WEEK) == week) if week is not None else df


def write_csv(df: DataFrame, path: str) -> str:
    """A small report (an index, metrics, daily totals) as one CSV with a header.

    One task writes, but it does not make the rows: the exchange keeps what comes
    before it parallel.
    """
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    return spark.read.csv(path, header=True, schema=contract)


def rewrite_product(
    spark: SparkSession,
    root: str,
    product: str,
    change: Callable[[DataFrame], DataFrame],
    sort_by: Sequence[str] = (),
) -> str:
    """Replace a product by ``change(product)``.

    The new version lies beside the one that is read until the manifest switches,
    so a run that ends early changes nothing.
    """
    before = read_product(spark, root, product)
    return write_product(change(before), root, product, sort_by)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; a column one of them lacks is NULL there."""
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame, allowMissingColumns=True)
    return combined


def _usable(sources: Sequence[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """Rows of all sources that have a time and a count, with their source and its place in the order of preference."""
    usable = [
        frame.select(
            WEEK,
            F.col(time).alias("time"),
            F.col(count).alias("trade_count"),
            F.lit(name).alias("source"),
            F.lit(rank).alias("priority"),
        ).where(F.col("time").isNotNull() & F.col("trade_count").isNotNull())
        for rank, (name, frame, time, count) in enumerate(sources)
        if time in frame.columns and count in frame.columns
    ]
    if not usable:
        raise ValueError("no source has both a time and a count column")
    return union_all(usable)


def first_source_per_week(sources: Sequence[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """Per week, the rows of the first source that has usable values.

    ``sources`` lists ``(name, frame, time column, count column)`` in order of
    preference. A source counts for a week if it has a row with a time there;
    a source that lacks either column is passed over.
    """
    rows = _usable(sources)
    best = rows.groupBy(WEEK).agg(F.min("priority").alias("priority"))
    # One row per week: a century of weeks is about 5,200 rows.
    return rows.join(F.broadcast(best), [WEEK, "priority"], "left_semi")


def first_source_totals(sources: Sequence[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """Per week, the rows and the trades of the first source that has usable values; each source is read once.

    Every source is reduced to one row a week before the choice is made.
    """
    totals = _usable(sources).groupBy(WEEK, "source", "priority").agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("trade_count"), F.lit(0)).alias("trade_count")
    )
    best = F.min("priority").over(Window.partitionBy(WEEK))
    return totals.withColumn("best", best).where(F.col("priority") == F.col("best")).drop("priority", "best")


def discover_files(
    spark: SparkSession,
    root: str,
    keywords: Sequence[str] = (),
    skip: Sequence[str] = ("site-packages", ".venv"),
    glob: str = "*.parquet",
) -> DataFrame:
    """Data files below ``root`` whose path has a keyword and no skipped part.

    Only paths and lengths are read, so files of any schema may lie together.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", "length", F.element_at(F.split("path", "/"), -1).alias("file"))
    )
    lowered = F.lower("path")
    if keywords:
        files = files.where(F.greatest(*[lowered.contains(k.lower()) for k in keywords], F.lit(False)))
    for part in skip:
        files = files.where(~lowered.contains(part))
    return files


def with_source_row(df: DataFrame) -> DataFrame:
    """Add ``source_row``: a row's place in its file, files in the order of their paths.

    Sorting by time leaves rows of one moment in this order, whatever tasks read them.
    """
    files = sorted(df.inputFiles())
    place = F.col("_metadata.row_index")
    if len(files) < 2:
        return df.withColumn(SOURCE_ROW, place)
    # One row per file. Its list and its rows may write an empty authority differently (file:/ and file:///).
    scheme = "^[A-Za-z][A-Za-z0-9+.-]*:/*"
    names = [(k, re.sub(scheme, "/", f)) for k, f in enumerate(files)]
    numbers = df.sparkSession.createDataFrame(names, "_file_no long, _file_path string")
    numbered = df.withColumns({"_path": F.regexp_replace(F.col("_metadata.file_path"), scheme, "/"), "_place": place})
    joined = numbered.join(F.broadcast(numbers), F.col("_path") == F.col("_file_path"), "left")
    missing = F.raise_error(F.concat(F.lit("not in the list of files: "), F.col("_path"))).cast("bigint")
    row = F.coalesce("_file_no", missing) * F.lit(1 << 40) + F.col("_place")
    return joined.withColumn(SOURCE_ROW, row).drop("_path", "_place", "_file_no", "_file_path")


def with_file(df: DataFrame) -> DataFrame:
    """Add the path and name of the file each row came from."""
    path = F.col("_metadata.file_path")
    return df.withColumns({"file_path": path, "file": F.element_at(F.split(path, "/"), -1)})

