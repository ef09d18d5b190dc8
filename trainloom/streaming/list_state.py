"""T1 and T3 on list state in RocksDB: what is remembered, and what waits beyond a few rows,
is appended, not rewritten, and can be evicted by time.

T1 splits streamed reply chunks; T3 keeps bounded chat memory. Both give the same rows as
``think_stream`` and ``memory`` on the same input (see there for the rules).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from trainloom import config as C
from trainloom.streaming.memory import OUT_SCHEMA, _answer_only
from trainloom.streaming.think_stream import SEGMENT_SCHEMA, ThinkSplitter


INLINE = 32  # rows that wait in the value itself


class _InOrder(StatefulProcessor):
    """Rows numbered without gaps, taken in order; early ones wait.

    One value per key holds the next number (null: ended), how many rows wait in the list
    state, the few that came since, and what the subclass carries along; it is read and
    written once per micro-batch. A key with at most ``INLINE`` rows waiting never asks for its list.
    """

    waiting, carried, fresh = "", "", ()

    def __init__(self, first: int, ttl_ms: int | None):
        self.first, self.ttl_ms = first, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.value = handle.getValueState("value", f"next long, listed long, few array<struct<{self.waiting}>>, {self.carried}", self.ttl_ms)
        self.early = handle.getListState("early", self.waiting, self.ttl_ms)

    def take(self, key: tuple, at: int, row: tuple, carry: list, out: list[Row]) -> bool:
        """Handle the row whose turn it is; False ends the key."""
        raise NotImplementedError

    def handleInputRows(self, key, rows: Iterator[Row], timer_values) -> Iterator[Row]:
        held = self.value.get()
        at, listed, few, *carry = held or (self.first, 0, [], *self.fresh)
        new: dict[int, tuple] = {}
        for r in rows:  # the first delivery of a number counts
            if at is not None and r[1] >= at:
                new.setdefault(r[1], tuple(r[2:]))
        if not new:
            return
        if at not in new:
            few = [*map(tuple, few), *((n, *row) for n, row in sorted(new.items()))]
            if len(few) > INLINE:
                self.early.appendList(few)
                listed, few = listed + len(few), []
            self.value.update((at, listed, few, *carry))
            return
        # The list's rows came before the few.
        new |= {row[0]: tuple(row[1:]) for row in reversed([*(self.early.get() if listed else ()), *few]) if row[0] >= at}
        out: list[Row] = []
        while at in new:
            if not self.take(key, at, new.pop(at), carry, out):
                at, new, carry = None, {}, self.fresh
                break
            at += 1
        few = [(n, *row) for n, row in sorted(new.items())]
        if len(few) > INLINE:
            self.early.put(few)
            self.value.update((at, len(few), [], *carry))
        else:
            if listed:
                self.early.clear()
            self.value.update((at, 0, few, *carry))
        yield from out

    def close(self) -> None:
        pass


class ThinkProcessor(_InOrder):
    waiting, carried, fresh = "seq long, chunk string, is_final boolean", "pending string, in_think boolean, out_seq int", ("", False, 0)

    def take(self, key: tuple, at: int, row: tuple, carry: list, out: list[Row]) -> bool:
        chunk, final = row
        splitter = ThinkSplitter(carry[0], carry[1])
        segments = [(c, t, False) for c, t in splitter.feed(chunk or "", final=final)] + ([("end", "", True)] if final else [])
        out += [Row(reply_id=key[0], out_seq=carry[2] + i, channel=c, text=t, is_last=last) for i, (c, t, last) in enumerate(segments)]
        carry[:] = splitter.pending, splitter.in_think, carry[2] + len(segments)
        return not final


class MemoryProcessor(_InOrder):
    waiting, carried, fresh = "turn long, role string, text string", "held long", (0,)

    def __init__(self, max_turns: int, system_prompt: str, first: int, ttl_ms: int | None):
        super().__init__(first, ttl_ms)
        self.keep, self.system_prompt = 2 * max_turns, system_prompt

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.history = handle.getListState("history", "role string, content string", self.ttl_ms)

    def _remember(self, role: str, content: str, carry: list) -> None:
        self.history.appendValue((role, content))
        carry[0] += 1
        if self.keep and carry[0] >= 2 * self.keep:  # cut now and then, not at each turn
            self.history.put(list(self.history.get())[-self.keep:])
            carry[0] = self.keep

    def take(self, key: tuple, at: int, row: tuple, carry: list, out: list[Row]) -> bool:
        role, text = row
        message = (text or "").strip()
        if role == "assistant":
            self._remember(role, _answer_only(text), carry)
        elif role == "user" and message in ("/reset", "/exit"):
            self.history.clear()
            carry[0] = 0
            return message == "/reset"
        elif role == "user" and message:
            self._remember(role, message, carry)
            context = [("system", self.system_prompt), *list(self.history.get())[-self.keep:]]
            out += [Row(conv_id=key[0], at_turn=at, pos=i, role=r, content=c) for i, (r, c) in enumerate(context)]
        return True


def _keyed(df: DataFrame, key: str, processor: StatefulProcessor, schema: str, ttl_ms: int | None) -> DataFrame:
    return df.groupBy(key).transformWithState(processor, schema, "append", "ProcessingTime" if ttl_ms else "None")


def stream_think_segments(chunks: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """T1 over (reply_id, seq, chunk, is_final): (reply_id, out_seq, channel, text, is_last)
    segments as soon as they are final. A closed reply keeps one small value, so that what
    is delivered again is ignored. ``ttl_ms`` evicts a reply without news for so long."""
    rows = chunks.where("seq is not null").select("reply_id", F.col("seq").cast("long").alias("seq"), "chunk", F.coalesce("is_final", F.lit(False)).alias("is_final"))
    return _keyed(rows, "reply_id", ThinkProcessor(0, ttl_ms), SEGMENT_SCHEMA, ttl_ms)


def stream_chat_context(turns: DataFrame, max_turns: int = C.MAX_TURNS, system_prompt: str = C.CHAT_SYSTEM_PROMPT, first_turn: int = 0,
                        ttl_ms: int | None = None) -> DataFrame:
    """T3 over (conv_id, turn, role, text): after each user turn the model's context, a row
    per message. ``max_turns`` of 0 keeps the whole history."""
    rows = turns.where("turn is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return _keyed(rows, "conv_id", MemoryProcessor(max_turns, system_prompt, first_turn, ttl_ms), OUT_SCHEMA, ttl_ms)
