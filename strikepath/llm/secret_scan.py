"""Secret scans by an incremental blob ledger.

Every version of every file is named by the SHA-256 of its content (a blob).
The ledger remembers which rules, in which version, have read which blob. A run
scans only pairs of blob and rule version that the ledger lacks, appends what it
found, and joins the findings back to every path that ever held the blob.

Defined results: a null text is the empty blob; copies share one blob and are
read once; null or repeated paths each get their findings; an empty input gives
an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strikepath.llm.common import DOCUMENT_COLUMNS, pick, slices, stored, texts_of

SPAN = "array<struct<kind:string,start:int,end:int>>"
LEDGER = f"blob string, scanned array<string>, spans {SPAN}"

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_BEGIN = re.compile(r"-----BEGIN ((?:[A-Z0-9]{1,20} ){0,4}PRIVATE KEY(?: BLOCK)?)-----")
# A line of a key that lost its end: a header, base64, or nothing.
_KEY_LINE = re.compile(r"[\x20\t]*(?:[A-Za-z][A-Za-z-]*:[^\n]*|[A-Za-z0-9+/]{16,}={0,2}|=[A-Za-z0-9+/]{4}|[A-Za-z0-9+/]{1,15}={1,2})?[\x20\t\r]*(?:\n|\Z)")
_ISSUED = re.compile(r"(?<![A-Za-z0-9_])(?:gh[pousr]_[A-Za-z0-9]{30,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{30,})")
_JWT = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")


def _spans(pattern: re.Pattern) -> Callable[[str], Iterable[tuple[int, int]]]:
    return lambda text: [m.span() for m in pattern.finditer(text)]


def _assign(text: str) -> list[tuple[int, int]]:
    # A failing match still uses up its characters, so length is tested afterwards.
    return [m.span() for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]


def _private_key(text: str) -> list[tuple[int, int]]:
    """From a BEGIN line to the next END line of the same label, however far; what lies between is not looked at.

    A key without an end, or with another BEGIN before it, ends with the last line
    that looks like a part of one.
    """
    begins = [(m.start(), m.end(), m.group(1)) for m in _BEGIN.finditer(text)]
    ends: dict[str, int] = {}
    out = []
    for k, (start, body, label) in enumerate(begins):
        if out and start < out[-1][1]:
            continue
        mark = f"-----END {label}-----"
        # A search that came back empty, or from beyond this place, is not made again.
        if ends.get(label, 0) >= 0 and ends.get(label, 0) <= body:
            ends[label] = text.find(mark, body)
        at = ends[label]
        if at >= 0 and (k + 1 == len(begins) or at < begins[k + 1][0]):
            out.append((start, at + len(mark)))
            continue
        last = end = body
        line = _KEY_LINE.match(text, body)
        while line and line.end() > end:
            end = line.end()
            last = end if line.group().strip() else last
            line = _KEY_LINE.match(text, end)
        out.append((start, body + len(text[body:last].rstrip())))
    return out


#: Kinds in the order in which equal starts are listed, each with its version and finder.
RULES: dict[str, tuple[int, Callable[[str], Iterable[tuple[int, int]]]]] = {
    "assign": (1, _assign),
    "access": (1, _spans(_ACCESS)),
    "hex": (1, _spans(_HEX)),
    "private_key": (2, _private_key),
    "issued": (1, _spans(_ISSUED)),
    "jwt": (1, _spans(_JWT)),
}
BASE = ("assign", "access", "hex")


def rule_names(rules: dict = RULES) -> list[str]:
    return [f"{kind}@{version}" for kind, (version, _) in rules.items()]


def find(text: str, kinds: Iterable[str] = tuple(RULES), rules: dict = RULES) -> list[tuple[str, int, int]]:
    """Spans of one text by start, then by the order of the kinds."""
    order = {k: i for i, k in enumerate(rules)}
    found = [(k, a, b) for k in kinds for a, b in rules[k][1](text)]
    return sorted(found, key=lambda s: (s[1], order[s[0]]))


def _scan(rules: dict) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            pending = batch.column("pending").to_pylist()
            spans = [
                [{"kind": k, "start": a, "end": b} for k, a, b in find(text, [p.split("@")[0] for p in todo], rules)]
                for text, todo in zip(texts_of(batch), pending, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("blob"), pa.array(pending, pa.list_(pa.string())), pa.array(spans, span)],
                names=["blob", "scanned", "spans"],
            )

    return run


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _with_blob(versions: DataFrame, text: str) -> DataFrame:
    return versions.withColumn("blob", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def extend_ledger(versions: DataFrame, path: str, rules: dict = RULES) -> DataFrame:
    """Scan what the ledger at ``path`` has not seen of ``versions(text)``; return the whole ledger."""
    spark = versions.sparkSession
    names = F.array(*[F.lit(n) for n in rule_names(rules)])
    ledger = read_ledger(spark, path)
    texts = _with_blob(pick(versions, {"text": "string"}), "text")
    if ledger is None:
        todo = texts.withColumn("pending", names)
    else:
        seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("scanned"))).alias("seen"))
        left = texts.select("blob").distinct().join(seen, "blob", "left")
        left = left.withColumn("pending", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>"))))
        todo = texts.join(left.where(F.size("pending") > 0).select("blob", "pending"), "blob")
    # One row for each blob; copies meet in the map tasks before anything is shuffled.
    todo.dropDuplicates(["blob"]).select("blob", "text", "pending").mapInArrow(_scan(rules), LEDGER).write.mode(
        "append"
    ).parquet(path)
    return read_ledger(spark, path)


def findings(ledger: DataFrame, rules: dict = RULES) -> DataFrame:
    """(blob, spans) of blobs that hold a secret by the present rule versions; one row each, stored.

    Rows of the ledger made by an older version of a rule do not count.
    """
    now = F.array(*[F.lit(n) for n in rule_names(rules)])
    kinds = F.array(*[F.lit(k) for k in rules])
    at = lambda s: F.array_position(kinds, s["kind"]).cast("int")
    fresh = F.filter("spans", lambda s: (at(s) > 0) & F.array_contains("scanned", F.get(now, at(s) - 1)))
    flat = F.flatten(F.collect_list(fresh))
    ordered = F.transform(
        F.array_sort(
            F.transform(
                flat,
                lambda s: F.struct(
                    s["start"].alias("start"), at(s).alias("at"), s["end"].alias("end"), s["kind"].alias("kind")
                ),
            )
        ),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    per_blob = ledger.where(F.size("spans") > 0).groupBy("blob").agg(ordered.alias("spans")).where(F.size("spans") > 0)
    return stored(per_blob, "secret-findings")


def scan(versions: DataFrame, path: str, rules: dict = RULES) -> DataFrame:
    """Bring the ledger at ``path`` up to date with ``versions(path, version, text)``; return (path, version, blob, spans).

    One row for each row of the input; ``spans`` is empty where nothing was found.
    """
    versions = pick(versions, {"path": "bigint", "version": "bigint", "text": "string"})
    found = findings(extend_ledger(versions, path, rules), rules)
    named = _with_blob(versions, "text").select("path", "version", "blob")
    return named.join(found, "blob", "left").select(
        "path", "version", "blob", F.coalesce("spans", F.array().cast(SPAN)).alias("spans")
    )


def redact(documents: DataFrame, path: str, rules: dict = RULES, mark: str = "<secret>") -> DataFrame:
    """``documents`` with every span of a secret in ``text`` replaced by ``mark``; overlapping spans become one mark.

    No row goes. Only texts that hold a secret change, in which case ``n_chars`` is their new length.
    The columns of documents come back, without any others.
    """
    documents = pick(documents, DOCUMENT_COLUMNS)
    found = findings(extend_ledger(documents, path, rules), rules)
    joined = _with_blob(documents, "text").join(found, "blob", "left")
    # Spans are ordered by start: keep the text up to each start that lies beyond all spans before it.
    state = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit("").alias("text")),
        lambda s, x: F.when(
            x["start"] >= s["end"],
            F.struct(
                x["end"].alias("end"),
                F.concat(s["text"], F.substring(F.col("text"), s["end"] + 1, x["start"] - s["end"]), F.lit(mark)).alias("text"),
            ),
        ).otherwise(F.struct(F.greatest(s["end"], x["end"]).alias("end"), s["text"].alias("text"))),
    )
    joined = joined.withColumn("state", F.when(F.col("spans").isNotNull(), state))
    joined = joined.withColumn("clean", F.concat(F.col("state.text"), F.expr("substring(text, state.end + 1)")))
    cells = {c: F.col(c) for c in DOCUMENT_COLUMNS}
    cells["text"] = F.coalesce("clean", "text")
    cells["n_chars"] = F.when(F.col("clean").isNotNull(), F.length("clean").cast("bigint")).otherwise(F.col("n_chars"))
    return joined.select(*[v.alias(c) for c, v in cells.items()])
