"""The registered queries of the operators here, with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strikepath.llm import bpe, lexical, licenses, line_dedup, near_dup, packing, preference, quality, repair, repeats, secret_scan, spotsigs, urls
from strikepath.llm.common import read, scratch


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps of its lines, and whom the deleted ones align with."""
    out = line_dedup.dedup(read(spark, sf_dir, "documents"))
    kept = F.coalesce("kept_text", F.lit(""))
    return out.select(
        "doc_id",
        F.col("n_lines").cast("bigint").alias("n_lines"),
        F.size("cut").cast("bigint").alias("n_deleted"),
        F.array_join(F.transform("cut", lambda i: i.cast("string")), ",").alias("deleted_lines"),
        "partners",
        F.length(kept).cast("bigint").alias("kept_chars"),
        F.sha2(kept, 256).alias("kept_sha256"),
    )


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of every document."""
    found = licenses.scan(read(spark, sf_dir, "documents"), licenses.QUERY_TEMPLATES)
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return bpe.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, through a fresh ledger."""
    documents = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.lit(1).alias("version"), "text")
    found = secret_scan.scan(documents, scratch(spark, "secret-ledger"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        F.col("path").alias("doc_id"),
        *[count(k) for k in secret_scan.BASE],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    return urls.judge(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, score and verdict of every document."""
    out = quality.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return out.select("doc_id", *counts, "base_failed", "kept", "score")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into windows of 1024 ids."""
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered turns of every preference pair."""
    return preference.format_preferences(read(spark, sf_dir, "conversations"))


def op9_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint beside its edited text's and the next document's."""
    return spotsigs.followed(read(spark, sf_dir, "documents"))


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    found = near_dup.groups(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps of its bytes when strings of earlier documents go."""
    out = repeats.removed(read(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        "n_bytes",
        F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["first"]).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item's 20 highest-scoring documents."""
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("item_digest")


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    return repair.repair(read(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_licenses": op2_licenses,
    "op3_bpe": op3_bpe,
    "op4_secret_scan": op4_secret_scan,
    "op5_urls": op5_urls,
    "op6_quality": op6_quality,
    "op7_packing": op7_packing,
    "op8_preferences": op8_preferences,
    "op9_spotsigs": op9_spotsigs,
    "op10_near_dup": op10_near_dup,
    "op11_repeats": op11_repeats,
    "op12_lexical": op12_lexical,
    "op13_repair": op13_repair,
}

ORACLE_SQL = {
    "op11_repeats": r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s
      FROM (SELECT doc_id, h, unnest(generate_series(0, length(h) // 2 - 50)) AS p FROM d WHERE length(h) >= 100)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
r AS (SELECT w.doc_id, w.p FROM w JOIN f USING (s) WHERE w.doc_id > f.first),
b AS (SELECT doc_id, p, CASE WHEN p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 THEN 1 ELSE 0 END AS new FROM r),
g AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM b),
x AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS z FROM g GROUP BY doc_id, span),
y AS (SELECT x.*, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM x),
k AS (SELECT doc_id, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS kept, max(z) AS last,
             sum(z - a) AS n_removed, count(*) AS n_spans FROM y JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
""",
    "op12_lexical": r"""
WITH w AS (
  SELECT 'd' AS side, doc_id AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
  UNION ALL
  SELECT 'i', item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) FROM benchmark),
p AS (SELECT side, id, term, count(*) AS tf FROM w GROUP BY ALL),
n AS (SELECT id, CAST(sum(tf) AS BIGINT) AS n FROM p WHERE side = 'd' GROUP BY id),
t AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
m AS (SELECT id, 100 - 25 + (25 * n * docs) // terms AS m FROM n, t),
v AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM p, t WHERE side = 'd' GROUP BY term),
s AS (SELECT i.id AS item_id, d.id AS doc_id, CAST(sum(i.tf * v.weight * ((1000000000 * d.tf) // (1000 * d.tf + 12 * m.m))) AS BIGINT) AS score
      FROM p i JOIN v USING (term) JOIN p d ON d.term = i.term AND d.side = 'd' JOIN m ON m.id = d.id WHERE i.side = 'i' GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20
""",
    "op10_near_dup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
g AS (
  SELECT doc_id, CASE WHEN len(ws) >= 5 THEN list_distinct([array_to_string(ws[i:i + 4], ' ') for i in range(1, len(ws) - 3)])
                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS sh FROM w),
s AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM g),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id
      GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r(doc_id, reach) AS (SELECT doc_id, doc_id FROM g UNION SELECT e.b, r.reach FROM r JOIN e ON e.a = r.doc_id WHERE r.reach < e.b),
c AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY 1)
SELECT g.doc_id, len(g.sh) AS n_shingles, c.component_id, g.doc_id = c.component_id AS kept FROM g JOIN c USING (doc_id)
""",
    "op8_preferences": r"""
WITH d AS (SELECT DISTINCT conv_id, coalesce(turn, 9223372036854775807) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
r AS (SELECT *, '<|' || role || '|>' || chr(10) || text || chr(10) AS rendered FROM d),
t AS (SELECT *, CAST(sum(length(rendered)) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS BIGINT)
             - length(rendered) AS start FROM r),
o AS (SELECT conv_id, count(*) AS n, min({'turn': turn, 'opening': sha256(role || chr(10) || text)}).opening AS opening FROM d GROUP BY 1),
b AS (SELECT opening, min({'n': n, 'conv_id': conv_id}).conv_id AS chosen_id FROM o GROUP BY 1),
p AS (SELECT b.chosen_id, o.conv_id AS rejected_id FROM o JOIN b USING (opening) WHERE o.conv_id <> b.chosen_id
      UNION SELECT x.conv_id, y.conv_id FROM o x JOIN o y ON y.conv_id = x.conv_id + 1 WHERE y.conv_id % 2 = 1),
m AS (SELECT p.*, coalesce(min(CASE WHEN c.start IS NULL OR c.role <> t.role OR c.text <> t.text THEN t.start END),
                           max(t.start + length(t.rendered))) AS prefix
      FROM p JOIN t ON t.conv_id = p.rejected_id LEFT JOIN t c ON c.conv_id = p.chosen_id AND c.start = t.start GROUP BY 1, 2),
x AS (SELECT m.*, t.*, CASE WHEN t.start < prefix THEN 'prompt' ELSE 'rejected' END AS part FROM m JOIN t ON t.conv_id = m.rejected_id
      UNION ALL SELECT m.*, t.*, 'chosen' FROM m JOIN t ON t.conv_id = m.chosen_id AND t.start >= prefix),
y AS (SELECT *, CASE WHEN part = 'prompt' THEN start ELSE start - prefix END AS pos FROM x)
SELECT chosen_id, rejected_id, part, turn, role, rendered, pos AS start,
       CASE WHEN part <> 'prompt' AND role = 'assistant' THEN pos + length(role) + 5 ELSE pos END AS loss_start,
       CASE WHEN part <> 'prompt' AND role = 'assistant' THEN pos + length(role) + 5 + length(text) ELSE pos END AS loss_end
FROM y
""",
}
