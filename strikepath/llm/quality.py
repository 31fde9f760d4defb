"""Quality rules: likelihood ratio of hashed n-grams between trusted and raw text.

Texts are lower-cased and cut into runs of letters and digits and runs of other
marks. Single runs and adjacent pairs are hashed into ``BUCKETS`` buckets. Over
all documents one multinomial is counted, over the trusted documents (labels
with quality 1 and not toxic) another. A text's score is the mean over its
n-grams of log(trusted share / raw share), and every text below ``threshold``
is rejected, besides those that fail the base rules.

Everything runs as DataFrame expressions. The bucket weights reach the scoring
scan as a scalar subquery of ``BUCKETS`` doubles. The trusted documents are a
bounded sample of labelled rows, at most ``MAX_LABELLED``, the first by a hash
of their id; corpus counts and scores cover every document whole.

Defined results: a null, empty or blank text has no words, fails the base rules
and scores 0; labels without a document, repeated labels and null labels add
nothing; without any trusted document every score is 0 and the base rules alone
decide; repeated rows each get a row; an empty input gives no row; further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strikepath.llm.common import DOCUMENT_COLUMNS, pick

BUCKETS = 1 << 14
MAX_LABELLED = 20_000
#: Held-out labels: rejected texts score below -0.8, others above -0.2 (tests/llm/test_quality.py).
THRESHOLD = -0.4
SMOOTHING = 1.0
RUNS = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"


def _hashed(df: DataFrame) -> DataFrame:
    """Adds ``runs``, the hashes of the text's runs."""
    return df.withColumn("runs", F.transform(F.regexp_extract_all(F.lower("text"), F.lit(RUNS), F.lit(0)), lambda w: F.xxhash64(w)))


def _grams(buckets: int) -> Column:
    pairs = F.zip_with("runs", F.slice("runs", F.lit(2), F.size("runs")), lambda a, b: F.xxhash64(a, b))
    return F.transform(F.concat("runs", pairs), lambda h: F.pmod(h, F.lit(buckets)).cast("int"))


def weights(documents: DataFrame, labels: DataFrame, buckets: int = BUCKETS, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """One row (weights array<double>): the log ratio of trusted and raw share of each bucket."""
    spark = documents.sparkSession
    labels = pick(labels, {"doc_id": "bigint", "quality": "int", "toxic": "int"})
    trusted = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()
    trusted = trusted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled).withColumn("trusted", F.lit(1))
    texts = pick(documents, {"doc_id": "bigint", "text": "string"}).where("text is not null")
    # At most max_labelled ids are broadcast.
    grams = _hashed(texts.join(F.broadcast(trusted), "doc_id", "left")).select("trusted", F.explode(_grams(buckets)).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("trusted").alias("trusted"))
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")
    total = every.agg(
        F.sort_array(F.collect_list(F.struct("bucket", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("trusted", F.lit(0)).alias("trusted")))).alias("counts"),
        F.coalesce(F.sum("raw"), F.lit(0)).alias("all_raw"),
        F.coalesce(F.sum("trusted"), F.lit(0)).alias("all_trusted"),
    )

    def ratio(x: Column) -> Column:
        trusted_share = (x["trusted"] + SMOOTHING) / (F.col("all_trusted") + SMOOTHING * buckets)
        raw_share = (x["raw"] + SMOOTHING) / (F.col("all_raw") + SMOOTHING * buckets)
        return F.when(F.col("all_trusted") > 0, F.log(trusted_share / raw_share)).otherwise(F.lit(0.0))

    return total.select(F.transform("counts", ratio).alias("weights"))


def judge(
    documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS, max_labelled: int = MAX_LABELLED
) -> DataFrame:
    """The columns of documents with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score and kept."""
    table = weights(documents, labels, buckets, max_labelled)
    df = pick(documents, DOCUMENT_COLUMNS).withColumn("own", F.col("text")).withColumn("text", F.coalesce("text", F.lit("")))
    df = _hashed(df).withColumn("weights", table.scalar())
    df = df.withColumn("score_sum", F.aggregate(_grams(buckets), F.lit(0.0), lambda s, g: s + F.get("weights", g)))
    df = df.withColumn("score", F.when(F.size("runs") > 0, F.col("score_sum") / (2 * F.size("runs"))).otherwise(F.lit(0.0)))
    df = df.withColumn("words", F.array_remove(F.split("text", SPACE, -1), ""))
    df = df.withColumn("lines", F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = _repeats(df).select(
        *DOCUMENT_COLUMNS, "own", "score",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.col("n_repeat_words").cast("bigint").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return df.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= threshold)).withColumn("text", F.col("own")).drop("own")


def _repeats(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words inside windows of three words that occur twice or more in the text.

    Windows are compared by 64-bit hashes. Every array an inner function looks
    into is a column of its own, so that it is made once for each row.
    """
    df = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    n = F.size("hashes")
    df = df.withColumn(
        "windows",
        F.transform(
            F.slice("hashes", F.lit(1), F.greatest(n - 2, F.lit(0))),
            lambda h, i: F.xxhash64(h, F.get("hashes", i + 1), F.get("hashes", i + 2)),
        ),
    )
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("placed", F.when(some, placed).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    twice = F.filter("placed", lambda x, k: (x["h"] == F.get("placed", k - 1)["h"]) | (x["h"] == F.get("placed", k + 1)["h"]))
    df = df.withColumn("starts", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.transform("starts", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("starts", k + 1) - p, F.lit(3))))
    # The partition id, which is never below 0, keeps later filters above this step: pushed below it they would
    # repeat the arrays inside the functions over them.
    return df.withColumn("n_repeat_words", F.when(F.spark_partition_id() >= 0, F.aggregate(covered, F.lit(0), lambda s, x: s + x)))


def keep_good(documents: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """Documents that the rules keep, unchanged."""
    return judge(documents, labels, **settings).where("kept").select(*DOCUMENT_COLUMNS)
