"""URL filters: host and path rules first, then logistic regression on hashed character n-grams.

A rule is a host suffix and a path prefix with a verdict; the longest that fits
decides. Other urls go to a model trained on a small labelled url table: rows
(url, blocked, weight), at most ``MAX_LABELLED`` of each verdict, the first by a
hash of the url. Its features are the character
n-grams of host and path, hashed into ``FEATURES`` counts. Training and scoring
run inside Spark's own library, on the JVM.

The registered query's table has urls made of words of unwanted and of ordinary
sites, and a bounded sample of the pages' own urls as ordinary ones, since far
the most are.

Defined results: a null url or one without ``://`` has an empty host and path,
fits no rule and is judged by the model like any other; where the labelled table
lacks one of the two verdicts, no model is trained and such urls are allowed;
repeated rows each get a row; an empty input gives no row; further columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strikepath.llm.common import pick

FEATURES = 1 << 14
SIZES = (3, 4)
MAX_LABELLED = 20_000
MAX_OWN = 1_000
OWN_WEIGHT = 0.05
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


# Words in names of unwanted and of ordinary sites, and forms of urls for either.
UNWANTED = (
    "casino poker bet bets betting slots jackpot lottery roulette pills pharmacy viagra cialis adult porn sex xxx escort cams nude spam spams phishing malware "
    "warez crack keygen torrent ads adserver track tracker tracking clicks popunder loans payday replica cheap free win winner farm"
)
ORDINARY = (
    "news docs wiki recipes weather library school museum health travel science history music garden forum university city theatre sports market "
    "research journal photo books kitchen village church art film radio energy water forest river bridge station hospital council open data"
)
FORMS = (
    "https://{}.example.com/en/1",
    "http://www.{}.example.org/de/23.html",
    "https://blog.{}.example.net/es/456/",
    "http://m.my-{}.example.com/fr/78",
    "https://{}-online.example.org/en/9",
    "http://the-{}.example.net/",
)


def seed_table(spark: SparkSession) -> DataFrame:
    """(url, blocked): every form with every word."""

    def made(words: str, blocked: bool) -> DataFrame:
        word, form = F.split(F.lit(words), " "), F.array(*[F.lit(f) for f in FORMS])
        pairs = spark.range(1).select(F.explode(word).alias("word"), F.lit(blocked).alias("blocked")).withColumn("form", F.explode(form))
        return pairs.select(F.replace("form", F.lit("{}"), "word").alias("url"), "blocked")

    return made(UNWANTED, True).union(made(ORDINARY, False))


def default_labels(pages: DataFrame) -> DataFrame:
    """(url, blocked, weight): the seed table, and at most ``MAX_OWN`` of the pages' urls as ordinary ones.

    The sample tells what urls of this corpus look like. As some of it is
    unwanted after all, together it weighs ``OWN_WEIGHT`` of the seeds.
    """
    seeds = seed_table(pages.sparkSession)
    own = _first(pages.select("url").where("url is not null").distinct(), MAX_OWN)
    each = OWN_WEIGHT * seeds.count() / max(1, own.count())
    return seeds.withColumn("weight", F.lit(1.0)).union(own.select("url", F.lit(False), F.lit(each)))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z in lower case, and path; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _fits(rule: Rule) -> Column:
    host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
    return host & F.col("path").startswith(rule.path)


def with_rule(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds host, path, rule and ruled, the longest fitting rule's verdict; both null where none fits."""
    host, path = split_url(F.coalesce("url", F.lit("")))
    out = pages.withColumn("host", host).withColumn("path", path)
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        name, verdict = F.when(_fits(r), r.name).otherwise(name), F.when(_fits(r), r.verdict).otherwise(verdict)
    return out.withColumn("rule", name).withColumn("ruled", verdict)


def _ngrams(column: str, mark: str) -> Column:
    text = F.concat(F.lit("^"), F.col(column), F.lit("$"))

    def of_size(n: int) -> Column:
        places = F.sequence(F.lit(1), F.length(text) - n + 1)
        grams = F.transform(places, lambda i: F.concat(F.lit(mark), F.substring(text, i, F.lit(n))))
        return F.when(F.length(text) >= n, grams).otherwise(F.array().cast("array<string>"))

    return F.concat(*map(of_size, SIZES))


def _featured(df: DataFrame, features: int) -> DataFrame:
    grams = df.withColumn("grams", F.concat(_ngrams("host", "h:"), _ngrams("path", "p:")))
    return HashingTF(numFeatures=features, inputCol="grams", outputCol="features").transform(grams)


def _first(rows: DataFrame, n: int) -> DataFrame:
    return rows.orderBy(F.xxhash64("url"), "url").limit(n)


def train(labelled: DataFrame, features: int = FEATURES, max_labelled: int = MAX_LABELLED) -> LogisticRegressionModel | None:
    """Fit on ``labelled(url, blocked, weight)``, a null weight counting as 1; None where one of the verdicts is missing."""
    rows = pick(labelled, {"url": "string", "blocked": "boolean", "weight": "double"}).where("url is not null and blocked is not null")
    rows = rows.groupBy("url", "blocked").agg(F.max(F.coalesce("weight", F.lit(1.0))).alias("weight"))
    rows = _first(rows.where("blocked"), max_labelled).union(_first(rows.where("not blocked"), max_labelled))
    if rows.select("blocked").distinct().count() < 2:
        return None
    host, path = split_url(F.col("url"))
    rows = rows.select(host.alias("host"), path.alias("path"), F.col("blocked").cast("double").alias("label"), "weight")
    return LogisticRegression(maxIter=50, regParam=0.002, standardization=False, weightCol="weight").fit(_featured(rows, features))


def judge(pages: DataFrame, labelled: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, features: int = FEATURES) -> DataFrame:
    """(page_id, host, path, rule, verdict, blocked_share) of ``pages(page_id, url)``.

    Without a labelled table the model learns from ``seed_table`` and a sample of the pages' urls.
    ``blocked_share`` is the model's probability, null where a rule decided.
    """
    ruled = with_rule(pick(pages, {"page_id": "bigint", "url": "string"}), rules)
    if labelled is None:
        labelled = default_labels(ruled)
    model = train(labelled, features)
    if model is None:
        return ruled.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("blocked_share"))
    open_rows = model.transform(_featured(ruled, features))
    verdict = F.coalesce("ruled", F.when(F.col("prediction") == 1.0, "block").otherwise("allow"))
    share = F.when(F.col("ruled").isNull(), F.get(vector_to_array("probability"), 1))
    return open_rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), share.alias("blocked_share"))
