"""Preference formatting: chosen and rejected conversations as one prompt and two masked completions.

Method. The longest common prefix of turns is rendered once, as the prompt. What is left of either conversation is its
completion, a list of segments each marked with whether it is trained on: the words of the assistant and the mark that
ends its turn are, headers and the turns of others are not.

All is DataFrame expressions. A conversation is one example and one row; its turns come together in one shuffle by
conversation, and pairing takes one more by id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, TURN_END = "<|im_start|>", "<|im_end|>", "\n"
TRAINED_ROLE = "assistant"
#: Text that could be taken for a mark is parted by a zero-width space.
_MARK, _PARTED = "<|", "<​|"


def conversations(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): role and text in the order of turns. Nulls become empty text; a null turn number comes first, equal ones in the order of
    role and text, and repeated rows stay. Rows without an id belong to no conversation."""
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    grouped = turns.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("conv_id")).agg(F.array_sort(F.collect_list(one)).alias("turns"))
    return grouped.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def last_replies(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, reply): each conversation's last reply, chosen in parts before the shuffle."""
    said = F.coalesce(F.col(text), F.lit(""))
    replies = turns.where(F.col(key).isNotNull() & (F.col(role) == TRAINED_ROLE))
    return replies.groupBy(F.col(key).alias("conv_id")).agg(F.max(F.struct(F.col(turn).alias("turn"), said.alias("text")))["text"].alias("reply"))


def reply_pairs(convs: DataFrame, replies: DataFrame) -> DataFrame:
    """(pair_id, chosen, rejected) for every conversation with a reply: chosen ends with its last reply, rejected has in
    its place the last reply of the conversation with the next id, or an empty one where there is none."""
    last = F.size("turns") - F.array_position(F.transform(F.reverse("turns"), lambda t: t["role"] == TRAINED_ROLE), True) + 1
    ended = convs.withColumn("n", last.cast("int")).where(F.exists("turns", lambda t: t["role"] == TRAINED_ROLE)).select(
        F.col("conv_id").alias("pair_id"), F.slice("turns", F.lit(1), F.col("n")).alias("chosen"))
    other = replies.select(F.try_subtract("conv_id", F.lit(1)).alias("pair_id"), F.col("reply").alias("other"))
    reply = F.struct(F.lit(TRAINED_ROLE).alias("role"), F.coalesce("other", F.lit("")).alias("text"))
    return ended.join(other, "pair_id", "left").select(
        "pair_id", "chosen", F.concat(F.slice("chosen", F.lit(1), F.size("chosen") - 1), F.array(reply)).alias("rejected"))


def branched_pairs(convs: DataFrame) -> DataFrame:
    """(pair_id, chosen, rejected) for every conversation: chosen is the whole of it, rejected leaves it after some turns, of which a hash of the id tells how
    many, and goes on as the conversation with the next id does from there.

    None is left out: where there is no next id, or it has no more turns, rejected just ends. Ids that repeat in `convs` pair each with each.
    """
    other = convs.select(F.try_subtract("conv_id", F.lit(1)).alias("pair_id"), F.col("turns").alias("other"))
    own = convs.select(F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen"))
    kept = F.pmod(F.conv(F.substring(F.md5(F.col("pair_id").cast("string")), 1, 8), 16, 10).cast("long"), F.size("chosen") + 1).cast("int")
    paired = own.join(other, "pair_id", "left").withColumn("kept", kept)
    rest = F.coalesce(F.slice("other", F.col("kept") + 1, F.greatest(F.size("other") - F.col("kept"), F.lit(0))), F.slice("chosen", 1, 0))
    return paired.select("pair_id", "chosen", F.concat(F.slice("chosen", F.lit(1), F.col("kept")), rest).alias("rejected"))


def common_turns(chosen: Column, rejected: Column) -> Column:
    """How many turns both begin with."""
    first_other = F.array_position(F.zip_with(chosen, rejected, lambda a, b: a.eqNullSafe(b)), False)
    return F.when(first_other > 0, first_other - 1).otherwise(F.size(chosen)).cast("int")


def _safe(text):
    return F.replace(text, F.lit(_MARK), F.lit(_PARTED))


def segments(turns: Column) -> Column:
    """Array of (text, trained): two for each turn."""
    def of(t):
        header = F.struct(F.concat(F.lit(OPEN), _safe(t["role"]), F.lit("\n")).alias("text"), F.lit(False).alias("trained"))
        body = F.struct(F.concat(_safe(t["text"]), F.lit(CLOSE + TURN_END)).alias("text"), (t["role"] == TRAINED_ROLE).alias("trained"))
        return F.array(header, body)

    return F.flatten(F.transform(turns, of))


def rendered(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda s: s["text"]), "")


def preference_rows(pairs: DataFrame) -> DataFrame:
    """One row per pair: pair_id, n_common, prompt, chosen and rejected (segments).

    Null conversations are empty ones. Equal conversations leave two empty completions; where one begins the other, its completion is empty. An empty table gives an empty
    result; other columns are left out.
    """
    empty = F.array().cast("array<struct<role:string,text:string>>")
    both = pairs.select("pair_id", *[F.coalesce(c, empty).alias(c) for c in ("chosen", "rejected")])
    both = both.withColumn("n_common", common_turns(F.col("chosen"), F.col("rejected")))

    def rest(c):
        return segments(F.slice(c, F.col("n_common") + 1, F.greatest(F.size(c) - F.col("n_common"), F.lit(0))))

    return both.select("pair_id", "n_common", rendered(segments(F.slice("chosen", F.lit(1), F.col("n_common")))).alias("prompt"),
                       rest("chosen").alias("chosen"), rest("rejected").alias("rejected"))


def trained_text(parts: Column) -> Column:
    return rendered(F.filter(parts, lambda s: s["trained"]))
