"""Preference formatting of chosen and rejected conversations.

For each pair the longest common prefix of turns is found and rendered once as
the prompt; the turns after it are the two completions. The result has one row
for each rendered turn, so that a conversation may have any number of turns, with
its place in its part and the characters that count for the loss: the texts of
assistant turns in completions.

Turns are ordered by ``turn``, then role and text, and are the same if role and
text are. Defined results: a null turn
comes last, a null role or text is empty; repeated rows count once; rows without
a conv_id belong to no conversation; a pair of which one side has no turn has an
empty prompt and that side no rows; an empty input gives no row; further columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strikepath.llm.common import pick, stored

LAST_TURN = (1 << 63) - 1
BLOCK_BITS = 10


def head(role: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"))


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, rendered, start): each turn rendered, and how many characters stand before it.

    Places are summed up within blocks of turns and over the blocks before, so
    that a very long conversation is not ordered in one task.
    """
    rows = pick(conversations, {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"}).where("conv_id is not null")
    rows = rows.select("conv_id", F.coalesce("turn", F.lit(LAST_TURN)).alias("turn"), *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")]).distinct()
    rows = rows.withColumn("rendered", F.concat(head(F.col("role")), F.col("text"), F.lit("\n")))
    rows = rows.withColumn("block", F.shiftright("turn", BLOCK_BITS)).withColumn("size", F.length("rendered").cast("bigint"))
    blocks = rows.groupBy("conv_id", "block").agg(F.sum("size").alias("block_size"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv_id", "block", F.coalesce(F.sum("block_size").over(before), F.lit(0)).alias("before"))
    inner = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("upto", F.sum("size").over(inner)).join(blocks, ["conv_id", "block"])
    return rows.select("conv_id", "turn", "role", "text", "rendered", (F.col("before") + F.col("upto") - F.col("size")).alias("start"))


def pairs_of(conversations: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id): conversations with one opening turn are pairs with the shortest of them; besides, 2n is paired with 2n + 1.

    The shortest conversation of a group has no more turns than any other, so
    all pairs together have no more turns than a few times the table.
    """
    rows = pick(conversations, {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"}).where("conv_id is not null").distinct()
    opening = F.sha2(F.concat(F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit(""))), 256)
    first = F.min(F.struct(F.coalesce("turn", F.lit(LAST_TURN)).alias("turn"), opening.alias("opening"))).alias("first")
    each = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), first).select("conv_id", F.col("first.opening").alias("opening"), "n")
    each = stored(each, "preference-openings")
    best = each.groupBy("opening").agg(F.min(F.struct("n", "conv_id")).alias("best")).select("opening", F.col("best.conv_id").alias("chosen_id"))
    same = each.join(best, "opening").where("conv_id <> chosen_id").select("chosen_id", F.col("conv_id").alias("rejected_id"))
    odd = each.where("pmod(conv_id, 2) = 1").select((F.col("conv_id") - 1).alias("chosen_id"), F.col("conv_id").alias("rejected_id"))
    odd = odd.join(each.select(F.col("conv_id").alias("chosen_id")), "chosen_id", "left_semi")
    return same.union(odd).distinct()


def format_pairs(conversations: DataFrame, pairs: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id, part, turn, role, rendered, start, loss_start, loss_end) of ``pairs(chosen_id, rejected_id)``.

    ``part`` is prompt, chosen or rejected; ``start`` is the turn's place in its
    part; characters [loss_start, loss_end) of the part count for the loss.
    """
    turns = stored(turns_of(conversations), "preference-turns")
    pairs = pick(pairs, {"chosen_id": "bigint", "rejected_id": "bigint"}).where("chosen_id is not null and rejected_id is not null").distinct()
    key = ["chosen_id", "rejected_id"]
    theirs = turns.select(F.col("conv_id").alias("chosen_id"), "start", F.struct("role", "text").alias("other"))
    mine = turns.withColumnRenamed("conv_id", "rejected_id")
    # As long as the turns are the same they start at the same places, so the first turn without its like ends the prefix.
    met = pairs.join(mine, "rejected_id").join(theirs, ["chosen_id", "start"], "left")
    differs = F.min(F.when(~F.coalesce(F.struct("role", "text") == F.col("other"), F.lit(False)), F.col("start")))
    prefix = met.groupBy(*key).agg(F.coalesce(differs, F.max(F.col("start") + F.length("rendered"))).alias("prefix"))
    pairs = stored(pairs.join(prefix, key, "left").fillna(0, ["prefix"]), "preference-pairs")
    columns = [*key, "prefix", "turn", "role", "text", "rendered", "start"]
    rejected = pairs.join(mine, "rejected_id").select(*columns, F.when(F.col("start") < F.col("prefix"), "prompt").otherwise("rejected").alias("part"))
    chosen = pairs.join(turns.withColumnRenamed("conv_id", "chosen_id"), "chosen_id").where("start >= prefix").select(*columns, F.lit("chosen").alias("part"))
    start = F.when(F.col("part") == "prompt", F.col("start")).otherwise(F.col("start") - F.col("prefix"))
    counts = (F.col("part") != "prompt") & (F.col("role") == "assistant")
    begin = F.when(counts, start + F.length(head(F.col("role")))).otherwise(start)
    return rejected.union(chosen).select(
        *key, "part", "turn", "role", "rendered", start.alias("start"), begin.alias("loss_start"), F.when(counts, begin + F.length("text")).otherwise(start).alias("loss_end")
    )


def format_preferences(conversations: DataFrame) -> DataFrame:
    """``format_pairs`` of ``pairs_of``."""
    return format_pairs(conversations, pairs_of(conversations))
