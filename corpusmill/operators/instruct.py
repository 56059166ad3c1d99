"""Instruction, preference and chat data.

Turn pairing is an equi-join on the position in the global (conversation, turn)
order, so one huge conversation spreads over all shuffle partitions instead of
landing in one window partition, and turn numbers may have gaps or repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .ordering import prefix_sum, range_prefix_sum

CHAT_MODEL = "corpusmill-chat"


def conversation_pairs(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                       role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Each user turn directly followed by an assistant turn -> ``(conv_id, turn, prompt, response)``.

    The next turn is the one with the next larger turn number of the conversation; equal
    numbers are ordered by role and a hash of the text.
    """
    d = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                     F.col(text_col).alias("text"))
    d = range_prefix_sum(d, ["conv_id", "turn", "role", F.xxhash64("text")], {"__pos": F.lit(1)}, "turn-order")
    u = d.filter(F.col("role") == "user").select("conv_id", "turn", (F.col("__pos") + 1).alias("__next"),
                                                 F.col("text").alias("prompt"))
    a = d.filter(F.col("role") == "assistant").select("conv_id", F.col("__pos").alias("__next"),
                                                      F.col("text").alias("response"))
    return u.join(a, ["conv_id", "__next"]).select("conv_id", "turn", "prompt", "response")


def sft_format(pairs: DataFrame, with_rejects: bool = False):
    """Add ``text`` = instruction template; rows with a null side are quarantined."""
    ok = F.col("prompt").isNotNull() & F.col("response").isNotNull()
    good = pairs.filter(ok).withColumn("text", T.sft_text("prompt", "response"))
    if not with_rejects:
        return good
    bad = pairs.filter(~ok).withColumn("reject_reason", F.lit("null prompt or response"))
    return good, bad


def preference_triples(pairs: DataFrame) -> DataFrame:
    """Synthetic preference rows: ``rejected`` is the response of the next pair by
    ``(conv_id, turn)``, the last wrapping to the first.  Positions come from the
    three-level global rank and the neighbour is found by an equi-join."""
    # buckets (conv_id, turn range): a conversation holding a third of all pairs is
    # split by turn range; the coarse level groups 4096 conversation ids
    bucket = [F.col("conv_id"), F.floor(F.col("turn") / 1024)]
    ranked = prefix_sum(pairs, ["conv_id", "turn"], bucket, None, "__pos0",
                        coarse=F.floor(F.col("__b0") / 4096)).withColumn("__pos", F.col("__pos0") + 1)
    n = pairs.count()
    nxt = ranked.select(F.when(F.col("__pos") == 1, F.lit(n)).otherwise(F.col("__pos") - 1)
                        .alias("__pos"), F.col("response").alias("rejected"))
    return ranked.drop("__pos0").join(nxt, "__pos").select("conv_id", "turn", "prompt",
                                            F.col("response").alias("chosen"), "rejected")


def dpo_project(triples: DataFrame) -> DataFrame:
    """Exactly ``prompt, chosen, rejected``, none null."""
    return triples.select("prompt", "chosen", "rejected").filter(
        F.col("prompt").isNotNull() & F.col("chosen").isNotNull() & F.col("rejected").isNotNull())


MESSAGE_SCHEMA = "array<struct<role:string,content:string>>"
PAYLOAD_SCHEMA = f"struct<model:string,messages:{MESSAGE_SCHEMA}>"


def conversation_messages(turns: DataFrame, model: str = CHAT_MODEL) -> DataFrame:
    """``(conv_id, payload)``: one chat request per conversation, messages in turn order.

    A chat request is one record by definition; its size is bounded by the
    serving API, not by the corpus.
    """
    msgs = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
        .alias("__m"))
    payload = F.struct(F.lit(model).alias("model"),
                       F.transform("__m", lambda m: F.struct(m["role"].alias("role"),
                                                             m["content"].alias("content")))
                       .alias("messages"))
    return msgs.select("conv_id", F.to_json(payload).alias("payload"))


def chat_flatten(payloads: DataFrame, payload_col: str = "payload", key_cols=("conv_id",)) -> DataFrame:
    """Chat payload -> one row per message ``(*keys, msg_no, role, content)``."""
    parsed = payloads.select(*key_cols, F.from_json(payload_col, PAYLOAD_SCHEMA).alias("__p"))
    ex = parsed.select(*key_cols, F.posexplode("__p.messages").alias("msg_no", "__m"))
    return ex.select(*key_cols, F.col("msg_no").cast("long").alias("msg_no"), F.col("__m.role").alias("role"),
                     F.col("__m.content").alias("content"))
