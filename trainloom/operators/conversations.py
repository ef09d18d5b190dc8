"""Conversation tables (one row per turn) -> message arrays, bounded memory
windows, answer-only history and supervision spans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trainloom import config as C
from trainloom.functions import messages as M
from trainloom.functions import text as T


def to_messages(turns: DataFrame, key: str = "conv_id", order: str = "turn",
                role: str = "role", content: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Gather ordered turns into ``messages`` (one row per conversation). Columns of
    ``carry`` hold one value per conversation."""
    carry = carry or []
    return (turns.groupBy(key)
            .agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(role).alias("role"),
                                                      F.col(content).alias("content")))).alias("_m"),
                 *[F.max(c).alias(c) for c in carry])
            .select(key, *carry, F.transform("_m", lambda s: F.struct(s.getField("role").alias("role"),
                                                              s.getField("content").alias("content")))
                    .alias("messages")))


def after_last_reset(turns: DataFrame, key: str = "conv_id", order: str = "turn",
                     reset_text: str = "/reset") -> DataFrame:
    """T3 batch form: only turns after the conversation's last ``/reset``; a reset
    clears the history but never the system turn."""
    resets = (turns.filter(T.strip_py("text") == reset_text).groupBy(key)
              .agg(F.max(order).alias("_reset_at")))
    kept = turns.join(resets, key, "left")
    stays = F.col("_reset_at").isNull() | (F.col(order) > F.col("_reset_at")) | F.col("role").eqNullSafe(F.lit("system"))
    return kept.filter(stays).drop("_reset_at")


def user_inputs(turns: DataFrame, role: str = "role", content: str = "text") -> DataFrame:
    """User turns trimmed; blank ones are ignored. Other turns stay as they are."""
    text = F.when(F.col(role) == "user", T.strip_py(content)).otherwise(F.col(content))
    return turns.withColumn(content, text).filter(~((F.col(role) == "user") & (F.col(content) == "")) | F.col(role).isNull()
                                                  | F.col(content).isNull())


def memory_window(turns: DataFrame, max_turns: int = C.MAX_TURNS, key: str = "conv_id",
                  order: str = "turn", role: str = "role") -> DataFrame:
    """The last ``2 * max_turns`` non-system turns of each conversation plus
    its system turn(s); ``max_turns = 0`` keeps everything.

    ``row_number() <= k`` lets Spark insert a per-partition group limit before
    the shuffle, so a long conversation ships only its last ``2k`` turns.
    """
    if max_turns <= 0:
        return turns
    is_sys = F.col(role) == F.lit("system")
    rest = turns.filter(~is_sys | F.col(role).isNull())
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    recent = rest.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= 2 * max_turns).drop("_rn")
    return turns.filter(is_sys).unionByName(recent)


def answer_only_history(turns: DataFrame, role: str = "role", content: str = "text") -> DataFrame:
    """Assistant turns keep only their answer channel, trimmed."""
    return turns.withColumn(content, F.when(F.col(role) == "assistant", T.strip_py(T.answer_text(content)))
                            .otherwise(F.col(content)))


def supervision_spans(records: DataFrame, key: str = "conv_id", msgs: str = "messages") -> DataFrame:
    """Per message its character span in the rendered text and whether it
    is learned from (assistant responses only). Offsets are a running sum
    inside the row (one ``aggregate`` pass) -- no shuffle."""
    bos = len(C.TEMPLATE_BOS)
    start = F.struct(F.array().cast("array<bigint>").alias("acc"), F.lit(bos).cast("bigint").alias("pos"))

    def step(s, m):
        ln = M.rendered_piece_length(m.getField("role"), m.getField("content")).cast("bigint")
        return F.struct(F.array_append(s.getField("acc"), s.getField("pos")).alias("acc"),
                        (s.getField("pos") + ln).alias("pos"))

    offsets = F.aggregate(F.col(msgs), start, step).getField("acc")
    spans = F.zip_with(F.col(msgs), offsets, lambda m, o: F.struct(
        m.getField("role").alias("role"), o.alias("start"),
        M.rendered_piece_length(m.getField("role"), m.getField("content")).alias("length"),
        (m.getField("role") == "assistant").alias("is_target")))
    return (records.select(key, F.posexplode(spans).alias("pos", "s"))
            .select(key, "pos", "s.role", "s.start", "s.length", "s.is_target"))
