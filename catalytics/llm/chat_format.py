"""Chat formatting after collapsing cumulative snapshots (operator 10); built-in functions only.

A logging service that stores a conversation after every turn leaves many prefixes of
each one.  Every turn gets a hash of its place, role and text; the running sums of two
such hashes identify the prefix that ends there.  A conversation goes when another one
is longer and has its whole as a prefix (an anti-join of whole conversations against
proper prefixes), or is equal and has a smaller id.  What stays is rendered.

Running sums are taken in two levels: sums of blocks of BLOCK turns, running sums of
those blocks, then inside each block; a conversation with a third of all turns is many
blocks.  Keys of prefixes are made distinct with map-side combine before the join, so a
first turn shared by a third of all conversations is one row there, and equal
conversations are one row too: no pairs.

The key is 128 bits (two 64-bit hash sums) and the number of turns; different prefixes
agree on it with a chance of 2 ** -128 for each pair.

Defined results: turns are taken in order of ``turn``, then role and text, nulls first; a
null role is "user" and a null text empty.  Rows that repeat a (conversation, turn)
exactly are one turn.  Rows without conv_id are left out, as they belong to none.  An
empty table gives an empty result.  Only conv_id, turn, role and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from catalytics.llm.common import cut_lineage

BLOCK = 512
START, END = "<|im_start|>", "<|im_end|>"
MAX_SUM = "decimal(38,0)"


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, block, turn, role, text, place (1, 2, ... in the conversation)."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-(2**63))).alias("turn"),
        F.coalesce("role", F.lit("user")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).filter("conv_id is not null")
    rows = rows.distinct().withColumn("block", F.floor(F.col("turn") / BLOCK))
    sizes = rows.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    sizes = sizes.select("conv_id", "block", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(W.partitionBy("conv_id", "block").orderBy("turn", "role", "text"))
    rows = rows.withColumn("inside", inside).join(sizes, ["conv_id", "block"])
    return rows.select("conv_id", "block", "turn", "role", "text", (F.col("before") + F.col("inside")).alias("place"))


def _wrapped(c: Column) -> Column:
    """A sum of longs, back in 64 bits (running sums may not overflow)."""
    return F.pmod(c, F.lit(str(2**64)).cast(MAX_SUM))


def prefixes(rows: DataFrame) -> DataFrame:
    """conv_id, place, h1, h2: the hashes of the prefix that ends at each turn."""
    hashed = rows.select(
        "conv_id", "block", "place",
        F.xxhash64("place", "role", "text").cast(MAX_SUM).alias("x1"),
        F.xxhash64("text", F.lit("second"), "role", "place").cast(MAX_SUM).alias("x2"),
    )
    blocks = hashed.groupBy("conv_id", "block").agg(F.sum("x1").alias("s1"), F.sum("x2").alias("s2"))
    until = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast(MAX_SUM)
    blocks = blocks.select("conv_id", "block", *(F.coalesce(F.sum(f"s{i}").over(until), zero).alias(f"s{i}") for i in (1, 2)))
    inside = W.partitionBy("conv_id", "block").orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    hashed = hashed.select("conv_id", "block", "place", *(F.sum(f"x{i}").over(inside).alias(f"x{i}") for i in (1, 2)))
    return hashed.join(blocks, ["conv_id", "block"]).select(
        "conv_id", "place", *(_wrapped(F.col(f"x{i}") + F.col(f"s{i}")).alias(f"h{i}") for i in (1, 2))
    )


def maximal(rows: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_equal of the conversations that no other one continues."""
    ends = rows.groupBy("conv_id").agg(F.max("place").alias("n_turns"))
    marked = cut_lineage(prefixes(rows).join(ends, "conv_id"), "prefixes")
    whole = marked.filter("place = n_turns").groupBy("place", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_equal"))
    proper = marked.filter("place < n_turns").select("place", "h1", "h2").distinct()
    return whole.join(proper, ["place", "h1", "h2"], "left_anti").select("conv_id", F.col("place").alias("n_turns"), "n_equal")


def rendered_turn() -> Column:
    return F.concat(F.lit(START), F.col("role"), F.lit("\n"), F.col("text"), F.lit(END + "\n"))


def render(rows: DataFrame) -> DataFrame:
    """conv_id, chat: one text of each conversation, its turns in order.

    The turns of a block are put together first and the blocks then, so tasks share
    the work on a long conversation until its text, one value by nature, is whole.
    """
    blocks = rows.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("place", rendered_turn().alias("t")))).alias("parts"))
    blocks = blocks.select("conv_id", F.struct("block", F.array_join("parts.t", "").alias("t")).alias("part"))
    chats = blocks.groupBy("conv_id").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    return chats.select("conv_id", F.array_join("parts.t", "").alias("chat"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_equal, chat of every maximal conversation."""
    rows = cut_lineage(turns(conversations), "turns")
    kept = cut_lineage(maximal(rows), "maximal")
    return kept.join(render(rows.join(kept.select("conv_id"), "conv_id", "left_semi")), "conv_id").select("conv_id", "n_turns", "n_equal", "chat")
