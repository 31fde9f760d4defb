"""Products whose rows lie by key in as many files as another's, so that a join of the two exchanges neither.

Worth its one exchange when written where the same join is asked again and
again. A key that holds most rows makes one large file; such products are better
joined by ``operators/skew.py``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_colocated(df: DataFrame, path: str, keys: Sequence[str], buckets: int, sort_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to ``path`` in ``buckets`` files by ``keys``, each sorted, and read it back.

    Rows are dealt out by the hash that names the files, so each task writes one
    file. The table's name is needed only until the frame knows its files.
    """
    spark = df.sparkSession
    name = f"colocated_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys, *[c for c in sort_by if c not in keys]).option("path", path).saveAsTable(name)
    read = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return read
