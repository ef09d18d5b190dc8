"""Bounded conversation memory over a stream of chat turns.

Keyed state per conversation holds at most ``2 * max_turns`` messages (plus
the system prompt, which is not stored). ``/reset`` clears it, blank user
input is ignored, assistant turns keep their answer channel only, trimmed.
After every user turn the model context (system + window) is emitted, one row
per message. ``max_turns = 0`` keeps the whole history. ``/exit`` ends the
conversation.

A conversation's turns are numbered without gaps from ``first_turn``. A turn that
arrives early waits in the state for those before it; a turn delivered twice is
ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from trainloom import config as C
from trainloom.streaming.think_stream import ThinkSplitter

OUT_SCHEMA = "conv_id long, at_turn long, pos int, role string, content string"
STATE_SCHEMA = "history string, next_turn long, parked string"
ENDED = (1 << 63) - 1


def _answer_only(text: str) -> str:
    sp = ThinkSplitter()
    parts = [t for ch, t in sp.feed(text or "", final=True) if ch == "answer"]
    return "".join(parts).strip()


def _make_fn(max_turns: int, system_prompt: str, first_turn: int = 0):
    keep = 2 * max_turns

    def fn(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        history, turn, parked = [], first_turn, {}
        if state.exists:
            history, turn = json.loads(state.get[0]), int(state.get[1])
            parked = {int(k): v for k, v in json.loads(state.get[2]).items()}
        for rows in batches:
            for at, role, text in zip(rows["turn"].tolist(), rows["role"].tolist(), rows["text"].tolist()):
                if at >= turn:
                    parked[int(at)] = [role, text if isinstance(text, str) else ""]
        out = []
        while turn in parked:
            role, text = parked.pop(turn)
            if role == "assistant":
                history.append(["assistant", _answer_only(text)])
            elif role == "user" and text.strip():
                msg = text.strip()
                if msg == "/exit":
                    history, parked, turn = [], {}, ENDED
                    break
                history = [] if msg == "/reset" else history + [["user", msg]]
            if keep:
                history = history[-keep:]
            if role == "user" and history and text.strip():
                out.append((key[0], turn, 0, "system", system_prompt))
                out.extend((key[0], turn, i + 1, r, c) for i, (r, c) in enumerate(history))
            turn += 1
        state.update((json.dumps(history), turn, json.dumps(parked)))
        if out:
            yield pd.DataFrame(out, columns=["conv_id", "at_turn", "pos", "role", "content"])

    return fn


def stream_memory(turns: DataFrame, max_turns: int = C.MAX_TURNS,
                  system_prompt: str = C.CHAT_SYSTEM_PROMPT, first_turn: int = 0) -> DataFrame:
    """Streaming T3 over (conv_id, turn, role, text); output mode append."""
    t = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return t.groupBy("conv_id").applyInPandasWithState(_make_fn(max_turns, system_prompt, first_turn), OUT_SCHEMA,
                                                       STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)
