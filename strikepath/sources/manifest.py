"""What a weekly product holds: one entry per week and version.

Nothing is written over. A write puts its files into a version folder of its own,
``<root>/<product>/version=<n>/week_id=<week>``, and ends by appending one small
file of entries to ``<root>/_manifest/<product>``. That file appears whole or not
at all, and it is the only thing that makes the version count: a product is, for
every week, the newest version listed. A run that dies earlier leaves files that
nobody reads and that the next write removes. One writer per product at a time.

Besides its rows an entry keeps the extremes of a time column and the
fingerprint of the source it was made from, so questions about what is there
read entries and no product.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

WEEK = "week_id"
#: Spark's folder name for a NULL partition value.
NO_WEEK = "__HIVE_DEFAULT_PARTITION__"
ENTRY = T.StructType(
    [
        T.StructField("week_id", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("first_time", T.TimestampType()),
        T.StructField("last_time", T.TimestampType()),
        T.StructField("source", T.StringType()),
    ]
)
MISSING_PATH = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _path(root: str, product: str) -> str:
    return f"{root.rstrip('/')}/_manifest/{product}"


def entries(spark: SparkSession, root: str, product: str) -> DataFrame:
    """All entries of a product, of every version; none if it was never written."""
    try:
        return spark.read.schema(ENTRY).parquet(_path(root, product))
    except AnalysisException as error:
        if error.getCondition() not in MISSING_PATH:
            raise
        return spark.createDataFrame([], ENTRY)


def current(spark: SparkSession, root: str, product: str) -> DataFrame:
    """The newest entry of every week that was ever written; ``n_rows`` is 0 where the week holds nothing."""
    newest = F.max_by(F.struct(*[c for c in ENTRY.names if c != WEEK]), "version").alias("e")
    return entries(spark, root, product).groupBy(WEEK).agg(newest).select(WEEK, "e.*")


def held(spark: SparkSession, root: str, product: str) -> dict[str | None, int]:
    """Version of each week that holds rows. A century of weeks is about 5,200 entries."""
    return {r[WEEK]: r["version"] for r in current(spark, root, product).where("n_rows > 0").collect()}


def next_version(spark: SparkSession, root: str, product: str) -> int:
    return (entries(spark, root, product).agg(F.max("version")).first()[0] or 0) + 1


def version_path(root: str, product: str, version: int) -> str:
    return f"{root.rstrip('/')}/{product}/version={version}"


def week_path(root: str, product: str, version: int, week: str | None) -> str:
    return f"{version_path(root, product, version)}/{WEEK}={NO_WEEK if week is None else week}"


def measured(spark: SparkSession, path: str, time: str | None) -> DataFrame:
    """Entries of the files below a version folder, from their footers where a row count suffices."""
    df = spark.read.parquet(path)
    ends = (F.min(time), F.max(time)) if time and time in df.columns else (F.lit(None), F.lit(None))
    return df.groupBy(F.col(WEEK).cast("string").alias(WEEK)).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[c.cast("timestamp").alias(n) for c, n in zip(ends, ("first_time", "last_time"), strict=True)],
    )


def commit(
    spark: SparkSession,
    root: str,
    product: str,
    version: int,
    found: DataFrame | None,
    n_rows: int | None = None,
    sources: Mapping[str | None, str] | None = None,
    gone: Iterable[str] = (),
) -> None:
    """Append a version's entries as one file: the switch to that version.

    ``sources`` names weeks whose source was read; one of them without rows gets
    an empty entry, as do the weeks in ``gone``. ``n_rows`` is what the writing
    job counted; files that hold another number never become current.
    """
    rows = [tuple(r) for r in found.select(WEEK, "n_rows", "first_time", "last_time").collect()] if found else []
    listed = sum(r[1] for r in rows)
    if n_rows is not None and listed != n_rows:
        raise RuntimeError(f"{product}: wrote {n_rows} rows but the files hold {listed}")
    sources = dict(sources or {})
    have = {r[0] for r in rows}
    rows += [(w, 0, None, None) for w in [*sources, *gone] if w not in have]
    if rows:
        data = [(w, version, n, a, b, sources.get(w)) for w, n, a, b in rows]
        spark.createDataFrame(data, ENTRY).coalesce(1).write.mode("append").parquet(_path(root, product))


def remove_unlisted(spark: SparkSession, root: str, product: str) -> int:
    """Delete the week folders that are no week's current version; how many went.

    A reader that planned before the switch and runs after this fails and has to plan again.
    """
    keep = {(v, NO_WEEK if w is None else w) for w, v in held(spark, root, product).items()}
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{product}")
    files = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    removed = 0
    for version in _folders(files, base, "version="):
        left = 0
        number = int(version.getName().removeprefix("version="))
        for week in _folders(files, version, f"{WEEK}="):
            if (number, week.getName().removeprefix(f"{WEEK}=")) in keep:
                left += 1
            else:
                files.delete(week, True)
                removed += 1
        if not left:
            files.delete(version, True)
    return removed


def _folders(files, base, prefix: str) -> list:
    if not files.exists(base):
        return []
    return [s.getPath() for s in files.listStatus(base) if s.isDirectory() and s.getPath().getName().startswith(prefix)]


def fingerprints(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(week_id, source): a digest of every week's rows that does not depend on their order."""
    # The week itself and the folder it came from say nothing about the rows.
    names = sorted(columns or [c for c in df.columns if c != WEEK])
    row = F.xxhash64(*[F.struct(F.col(f"`{c}`").isNull(), F.col(f"`{c}`")) for c in names])
    parts = (F.count(F.lit(1)), F.sum(F.col("_row").cast("decimal(20,0)")), F.bit_xor("_row"))
    digest = F.concat_ws(":", *[p.cast("string") for p in parts])
    return df.withColumn("_row", row).groupBy(WEEK).agg(digest.alias("source"))
