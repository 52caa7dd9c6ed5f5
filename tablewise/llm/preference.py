"""Preference formatting of chosen and rejected conversations (native expressions only).

A pair's turns are collected in order on each side; the longest common prefix of
turns (equal role and text) is rendered once as the prompt, and what follows on
either side as a completion.  Masks are spans of a completion that are trained
on: the texts of assistant turns and their end marks, not the other turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewise.functions.core import q

#: The ChatML marks around a turn.
START, BREAK, STOP = "<|im_start|>", "\n", "<|im_end|>\n"


def conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(conv, turns): turns as an array of (role, text) in turn order.

    Null roles and texts count as empty.  Rows that repeat a conversation's
    turn number with equal role and text are one turn; differing ones follow
    each other by role and text.  A null turn number comes first.  A null
    conversation id is a conversation.
    """
    rows = df.select(q(conv_col).alias("conv"), q(turn_col).alias("turn"), F.coalesce(q(role_col), F.lit("")).alias("role"),
                     F.coalesce(q(text_col), F.lit("")).alias("text"))
    return rows.groupBy("conv").agg(F.array_sort(F.collect_set(F.struct("turn", "role", "text"))).alias("t")).select(
        "conv", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def common_prefix(a: Column, b: Column) -> Column:
    """Number of leading turns that both arrays share."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, F.lit(False))
    return F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda x: F.concat(
        F.lit(START), x["role"], F.lit(BREAK), x["text"], F.lit(STOP))), "")


def mask(turns: Column, trained: str = "assistant") -> Column:
    """[(start, end)] in code points of ``render(turns)``: texts of the trained
    role with their end marks."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        begin = s["at"] + F.length(x["role"]) + len(START) + len(BREAK)
        end = begin + F.length(x["text"]) + len(STOP)
        return F.struct(end.alias("at"), F.when(x["role"] == trained, F.concat(
            s["out"], F.array(F.struct(begin.alias("start"), end.alias("end"))))).otherwise(s["out"]).alias("out"))
    return F.aggregate(turns, start, step)["out"]


def format_preferences(pairs: DataFrame, id_col: str = "pair", chosen_col: str = "chosen",
                       rejected_col: str = "rejected") -> DataFrame:
    """One row per pair of turn arrays: id, n_common, prompt, chosen, rejected,
    chosen_mask, rejected_mask.

    A null side counts as no turns.  Equal sides leave two empty completions; a
    side that is a prefix of the other leaves one.  Repeated rows are rendered
    alike, and an empty table gives an empty result.
    """
    none = F.array().cast("array<struct<role:string,text:string>>")
    both = pairs.select(q(id_col).alias("id"), F.coalesce(q(chosen_col), none).alias("a"), F.coalesce(q(rejected_col), none).alias("b"))
    both = both.withColumn("n", common_prefix(F.col("a"), F.col("b")))
    rest = lambda c: F.slice(c, F.col("n") + 1, F.greatest(F.size(c) - F.col("n"), F.lit(0)))
    both = both.select("id", "n", F.slice("a", F.lit(1), F.col("n")).alias("p"), rest(F.col("a")).alias("a"), rest(F.col("b")).alias("b"))
    return both.select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_common"), render(F.col("p")).alias("prompt"),
        render(F.col("a")).alias("chosen"), render(F.col("b")).alias("rejected"),
        mask(F.col("a")).alias("chosen_mask"), mask(F.col("b")).alias("rejected_mask"))


def swapped_endings(convs: DataFrame) -> DataFrame:
    """Preference pairs from plain conversations: chosen is a conversation up to
    its last assistant turn, rejected the same with the last assistant turn of
    the conversation before it in its block of 1,000 ids (the block's first
    takes the last one's).  Conversations without such a turn give no pair."""
    last = F.aggregate(F.transform("turns", lambda x, i: F.when(x["role"] == "assistant", i + 1).otherwise(0)),
                       F.lit(0), lambda a, x: F.greatest(a, x))
    ended = convs.where("conv is not null").withColumn("n", last).where("n > 0").withColumn("turns", F.slice("turns", F.lit(1), F.col("n")))
    ended = ended.withColumn("block", F.floor(F.col("conv") / 1000)).withColumn("end", F.element_at("turns", -1))
    near = W.partitionBy("block").orderBy("conv")
    whole = near.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    other = F.coalesce(F.lag("end").over(near), F.last("end").over(whole))
    return ended.withColumn("other", other).select(
        F.col("conv").alias("pair"), F.col("turns").alias("chosen"),
        F.concat(F.slice("turns", F.lit(1), F.col("n") - 1), F.array("other")).alias("rejected"))
