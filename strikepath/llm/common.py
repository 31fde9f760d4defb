"""Reading, scratch tables and small helpers shared by the operators here."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Only the given columns, cast to their types; a missing one is null.

    Every operator starts here, so further columns of its input, whatever
    their names, never meet the names it uses itself.
    """
    present = set(df.columns)
    return df.select(
        *[(F.col(f"`{c}`") if c in present else F.lit(None)).cast(kind).alias(c) for c, kind in columns.items()]
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Where it is unset a session on one machine gets a folder of its own, which
    is then set as the session's checkpoint folder; a cluster is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_transfers(spark: SparkSession, size: str = "8m") -> Iterator[None]:
    """Jobs run inside hand rows to Python workers, and take them back, in pieces of about ``size``: for wide rows."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500, chars: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of bounded size, so that long texts never meet in memory."""
    for batch in batches:
        step = max(1, min(rows, int(batch.num_rows * chars / max(1, batch.nbytes))))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A column's texts; null counts as empty."""
    return [x or "" for x in batch.column(name).to_pylist()]
