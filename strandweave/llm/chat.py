"""Preference formatting with DataFrame functions only.

The longest common turn prefix of a chosen and a rejected conversation is rendered once as the
prompt; the turns after it become two completions, each with the character ranges that a loss may
see: what assistants say after the prefix, end mark included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, END = "<|im_start|>", "<|im_end|>"


def conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's (role, text) in order of turn, then role and text.

    Null roles and texts count as empty. Turns with a null conversation form no conversation.
    A row is one conversation, so a group is only as large as a conversation is.
    """
    one = F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    rows = turns.where(F.col(conv_col).isNotNull()).groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    return rows.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def common_prefix(a: Column, b: Column) -> Column:
    """Number of leading turns that two arrays of turns share."""
    shorter = F.least(F.size(a), F.size(b))
    differs = F.filter(F.sequence(F.lit(1), F.greatest(shorter, F.lit(1))), lambda i: (i > shorter) | ~F.try_element_at(a, i).eqNullSafe(F.try_element_at(b, i)))
    return F.coalesce(F.try_element_at(differs, F.lit(1)) - 1, shorter)


def _safe(text: Column) -> Column:
    """Text in which the marks of the format can't occur."""
    return F.replace(text, F.lit("<|im_"), F.lit("<\\|im_"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(BEGIN), _safe(turn["role"]), F.lit("\n"))


def _tail(turn: Column) -> Column:
    return F.concat(_safe(turn["text"]), F.lit(END + "\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _tail(t))), "")


def loss_ranges(turns: Column) -> Column:
    """(start, end) characters, in the rendered turns, of what assistants say with its end mark."""
    parts = F.transform(
        turns,
        lambda t: F.struct(F.char_length(_head(t)).alias("head"), (F.char_length(_tail(t)) - 1).alias("own"), (t["role"] == "assistant").alias("seen")),
    )
    none = F.array().cast("array<struct<start:int,end:int>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("ranges"))

    def step(acc, p):
        begin = acc["at"] + p["head"]
        end = begin + p["own"]
        one = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct((end + 1).alias("at"), F.when(p["seen"], F.concat(acc["ranges"], one)).otherwise(acc["ranges"]).alias("ranges"))

    return F.aggregate(parts, start, step, lambda acc: acc["ranges"])


def format_preferences(pairs: DataFrame, id_col: str = "pair_id", chosen_col: str = "chosen", rejected_col: str = "rejected") -> DataFrame:
    """``pairs``: an id and two arrays of (role, text). One row per pair, repeated ones too:

    (id_col, n_prompt_turns, prompt, chosen, chosen_loss, rejected, rejected_loss). Null arrays count
    as empty: their completion is empty without loss. Where one conversation is the other's
    beginning, or both are equal, a completion is empty. Other columns are ignored.
    """
    none = F.array().cast("array<struct<role:string,text:string>>")
    rows = pairs.select(F.col(id_col).alias("id"), F.coalesce(chosen_col, none).alias("a"), F.coalesce(rejected_col, none).alias("b"))
    rows = rows.withColumn("n", common_prefix(F.col("a"), F.col("b")))
    rest = [F.slice(c, F.col("n") + 1, F.greatest(F.size(c) - F.col("n"), F.lit(0))) for c in ("a", "b")]
    rows = rows.select("id", "n", F.slice("a", 1, F.col("n")).alias("p"), rest[0].alias("a"), rest[1].alias("b"))
    return rows.select(
        F.col("id").alias(id_col), F.col("n").alias("n_prompt_turns"), render(F.col("p")).alias("prompt"),
        render(F.col("a")).alias("chosen"), loss_ranges(F.col("a")).alias("chosen_loss"),
        render(F.col("b")).alias("rejected"), loss_ranges(F.col("b")).alias("rejected_loss"),
    )


def spliced_pairs(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(pair_id, chosen, rejected) for integer conversation ids: each whole conversation against its
    own beginning, gone on with by its partner, the id that differs in the last bit.

    Of n assistant turns the one numbered id mod n is where the conversations part: the rejected side
    has the turns before it and then the partner's turns from the partner's own such turn to its end.
    So prefixes differ in length, and are longer where partners go on alike. A conversation without
    assistant turns parts after its end, a partner without them gives all its turns; no turn of
    either is left off. A conversation whose partner doesn't exist has a null rejected side.
    """
    convs = conversations(turns, conv_col, turn_col, role_col, text_col)
    spots = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: F.try_element_at("turns", i)["role"] == "assistant")
    rows = convs.withColumn("spots", spots)
    at = F.try_element_at("spots", (F.pmod("conv_id", F.size("spots")) + 1).cast("int"))
    some = F.size("spots") > 0
    mine = rows.select("conv_id", "turns", F.when(some, at - 1).otherwise(F.size("turns")).alias("own"))
    start = F.when(some, at).otherwise(F.lit(1))
    tail = rows.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.slice("turns", start, F.size("turns")).alias("tail"))
    both = mine.join(tail, "conv_id", "left")
    return both.select(F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen"), F.concat(F.slice("turns", F.lit(1), F.col("own")), "tail").alias("rejected"))
