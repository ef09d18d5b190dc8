"""Split streamed reply chunks into reasoning and answer channels.

Tags may straddle chunk boundaries: up to ``len('</think>') - 1`` trailing
characters are held back until the next chunk (or the end of the reply). The
concatenated channels never depend on where the chunks were cut and equal the
batch split (``functions.text.think_text`` / ``answer_text``).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from trainloom import config as C
from trainloom.functions.text import answer_text, col_, think_text
from trainloom.sources.shared import SHORT_ROWS, materialise, short_rows

HOLD_BACK = max(len(C.THINK_OPEN), len(C.THINK_CLOSE)) - 1
LONG_CHUNK = (64 << 20) // SHORT_ROWS  # bytes


class ThinkSplitter:
    """Incremental splitter. ``feed`` returns the (channel, text) pieces that
    are final; ``final=True`` releases everything still held back."""

    def __init__(self, pending: str = "", in_think: bool = False):
        self.pending = pending
        self.in_think = in_think

    def feed(self, delta: str, final: bool = False) -> list[tuple[str, str]]:
        self.pending += delta or ""
        out: list[tuple[str, str]] = []
        if not final and len(self.pending) <= HOLD_BACK:
            return out
        while True:
            tag = C.THINK_CLOSE if self.in_think else C.THINK_OPEN
            channel = "think" if self.in_think else "answer"
            at = self.pending.find(tag)
            if at < 0:
                break
            if at:
                out.append((channel, self.pending[:at]))
            self.pending = self.pending[at + len(tag):]
            self.in_think = not self.in_think
        channel = "think" if self.in_think else "answer"
        cut = len(self.pending) if final else max(0, len(self.pending) - HOLD_BACK)
        if cut:
            out.append((channel, self.pending[:cut]))
            self.pending = self.pending[cut:]
        return out


def chunk_text(text, size) -> Column:
    """Cut a string into pieces of ``size`` characters (an empty string gives
    one empty piece). One regex pass per row, linear in the text length."""
    t = F.coalesce(col_(text), F.lit(""))
    pat = F.concat(F.lit("(?s).{1,"), col_(size).cast("string"), F.lit("}"))
    pieces = F.regexp_extract_all(t, pat, 0)
    return F.when(F.length(t) == 0, F.array(F.lit(""))).otherwise(pieces)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows of a reply whose numbers follow each other, as one row (reply_id, seq,
    text, sizes): their text lies in one piece already, so only its ends are looked up."""
    for batch in batches:
        if not batch.num_rows:
            continue
        reply, seq, chunk = batch.columns
        same = pc.and_(pc.equal(reply.slice(1), reply.slice(0, len(reply) - 1)), pc.equal(seq.slice(1), pc.add(seq.slice(0, len(seq) - 1), 1)))
        cut = np.flatnonzero(~same.fill_null(False).to_numpy(zero_copy_only=False)) + 1
        first = pa.array(np.concatenate([[0], cut]), pa.int64())
        ends = np.concatenate([[0], cut, [batch.num_rows]])
        text = chunk.cast(pa.large_string())
        at = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, 8 * text.offset)[ends]
        joined = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(np.ascontiguousarray(at)), text.buffers()[2])
        sizes = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pc.utf8_length(chunk).cast(pa.int32()))
        yield pa.RecordBatch.from_arrays([reply.take(first), seq.take(first), joined.cast(chunk.type), sizes], ["reply_id", "seq", "text", "sizes"])


def split_chunked_replies(chunks: DataFrame) -> DataFrame:
    """Batch form: (reply_id, seq, chunk) -> (reply_id, think, answer).

    A reply is one bounded value: its chunks are gathered, joined in order and split by the
    batch expressions. Chunks that lie beside their successor are joined before the shuffle,
    which then moves runs of text rather than a row per chunk; where runs of a reply
    overlap (numbers repeat), they are taken apart again and joined chunk by chunk. The runs are
    written and read again, since the batches of short rows are a setting of the job that joins them."""
    rows = chunks.select("reply_id", F.col("seq").cast("long").alias("seq"), F.coalesce("chunk", F.lit("")).alias("chunk"))
    runs = rows.where(F.octet_length("chunk") <= LONG_CHUNK).mapInArrow(_runs, f"reply_id {rows.schema['reply_id'].dataType.simpleString()}, seq long, text string, sizes array<int>")
    # A long chunk is a run of its own, made in the JVM: a batch of chunks for Python stays below 64 MB.
    long = rows.where(F.octet_length("chunk") > LONG_CHUNK).select("reply_id", "seq", F.col("chunk").alias("text"), F.array(F.length("chunk")).alias("sizes"))
    with short_rows(chunks.sparkSession):
        runs = materialise(runs.union(long), "chunk-runs")
    whole = runs.groupBy("reply_id").agg(F.sort_array(F.collect_list(F.struct("seq", "text", "sizes"))).alias("runs"))
    ends = F.transform("runs", lambda r: r.getField("seq") + F.size(r.getField("sizes")))
    apart = F.forall(F.sequence(F.lit(1), F.size("runs") - 1), lambda i: F.coalesce(
        F.get(F.col("runs.seq"), i) >= F.get(ends, i - 1), F.lit(True)))
    # A run as its chunks: each starts where the sizes before it end.
    pieces = F.flatten(F.transform("runs", lambda r: F.transform(r.getField("sizes"), lambda n, i: F.struct(
        (r.getField("seq") + i).alias("seq"),
        F.substr(r.getField("text"), F.aggregate(F.slice(r.getField("sizes"), F.lit(1), i), F.lit(1), lambda a, x: a + x), n).alias("chunk")))))
    joined = F.when((F.size("runs") == 1) | apart, F.array_join(F.col("runs.text"), "")).otherwise(
        F.array_join(F.transform(F.sort_array(pieces), lambda p: p.getField("chunk")), ""))
    # The split happens above the gather, so the text is joined once per reply.
    whole = whole.select("reply_id", joined.alias("reply"))
    return whole.select("reply_id", think_text("reply").alias("think"), answer_text("reply").alias("answer"))


SEGMENT_SCHEMA = "reply_id string, out_seq int, channel string, text string, is_last boolean"
STATE_SCHEMA = "pending string, in_think boolean, next_seq int, out_seq int, parked string"


CLOSED = -1  # ``next_seq`` of a reply whose final chunk was seen


def _stream_group(key, batches: Iterator[pd.DataFrame], state: GroupState, idle_ms: int | None = None) -> Iterator[pd.DataFrame]:
    """Keyed state per reply: held-back text, channel, next expected chunk and
    chunks that arrived early. A chunk delivered twice is ignored, also after the
    reply's end: of a closed reply a marker of a few bytes stays.

    With ``idle_ms``, a reply without news for that long is closed: what it holds
    is emitted in order, an open reply gets its end row, and the state goes.
    """
    if state.exists:
        pending, in_think, next_seq, out_seq, parked_json = state.get
        parked = {int(k): v for k, v in json.loads(parked_json).items()}
    else:
        pending, in_think, next_seq, out_seq, parked = "", False, 0, 0, {}
    sp = ThinkSplitter(pending, in_think)
    rows = []

    def emit(chunk: str, final: bool) -> None:
        for channel, text in sp.feed(chunk, final=final):
            rows.append((key[0], out_seq + len(rows), channel, text, False))
        if final:
            rows.append((key[0], out_seq + len(rows), "end", "", True))

    if state.hasTimedOut:
        if next_seq != CLOSED:
            for at in sorted(parked):
                emit(parked[at][0], False)
            emit("", True)
        state.remove()
    else:
        for pdf in batches:
            for seq, chunk, fin in zip(pdf["seq"], pdf["chunk"], pdf["is_final"]):
                if next_seq != CLOSED and int(seq) >= next_seq:
                    parked[int(seq)] = (chunk if isinstance(chunk, str) else "", bool(fin))
        while next_seq in parked:
            chunk, fin = parked.pop(next_seq)
            emit(chunk, fin)
            next_seq += 1
            if fin:
                sp, next_seq, parked = ThinkSplitter(), CLOSED, {}
        state.update((sp.pending, sp.in_think, next_seq, out_seq + len(rows),
                      json.dumps({str(k): list(v) for k, v in parked.items()})))
        if idle_ms:
            state.setTimeoutDuration(idle_ms)
    if rows:
        yield pd.DataFrame(rows, columns=["reply_id", "out_seq", "channel", "text", "is_last"])


def stream_think_split(chunks: DataFrame, idle_ms: int | None = None) -> DataFrame:
    """Streaming form over (reply_id, seq, chunk, is_final): emits channel
    segments as soon as they are final. ``idle_ms`` bounds the state by time (see
    ``_stream_group``); None keeps a marker per reply. Output mode: append."""
    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout
    return (chunks.select("reply_id", "seq", "chunk", "is_final")
            .groupBy("reply_id")
            .applyInPandasWithState(partial(_stream_group, idle_ms=idle_ms), SEGMENT_SCHEMA, STATE_SCHEMA, "append", timeout))
