"""M10 and M11 with a real tokenizer: exact lengths and the tokens learned from.

A tokenizer is named by ``load`` and its file; each Python worker loads it once. The
file must be there on every worker, like the library.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trainloom import config as C
from trainloom.functions import messages as M
from trainloom.functions.text import col_

# A batch of texts -> for each text its (start, stop) character span by token.
Encoder = Callable[[list[str]], list[list[tuple[int, int]]]]
_LOADED: dict[tuple, Encoder] = {}


def load_tokenizer(path: str) -> Encoder:
    """A ``tokenizers`` file; strings of special tokens in a text are ordinary text."""
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda texts: [e.offsets for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def _encoder(load: Callable[[str], Encoder], path: str) -> Encoder:
    key = (load.__module__, load.__qualname__, path)
    if key not in _LOADED:
        _LOADED[key] = load(path)
    return _LOADED[key]


class ByteCache:
    """Least recently used values by text, bounded by the bytes of the texts; longer
    texts than a hundredth of the bound are not kept."""

    def __init__(self, bound: int):
        self.bound, self.held, self.values = bound, 0, OrderedDict()

    def get(self, text: str):
        if text in self.values:
            self.values.move_to_end(text)
            return self.values[text]
        return None

    def put(self, text: str, value) -> None:
        size = 4 * len(text) + 200  # at most
        if size > self.bound // 100 or text in self.values:
            return
        self.values[text] = value
        self.held += size
        while self.held > self.bound:
            old, _ = self.values.popitem(last=False)
            self.held -= 4 * len(old) + 200


def token_length(text, path: str, load: Callable[[str], Encoder] = load_tokenizer, cache_bytes: int = 32 << 20, batch: int = 64) -> Column:
    """Number of tokens of a text; null counts as empty. Repeated texts are encoded once
    while the cache holds them."""
    caches: list[ByteCache] = []

    @F.arrow_udf(T.LongType())
    def lengths(texts: pa.Array) -> pa.Array:
        if not caches:
            caches.append(ByteCache(cache_bytes))
        cache, encode, values = caches[0], _encoder(load, path), [t or "" for t in texts.to_pylist()]
        out = [cache.get(t) for t in values]
        missing = [i for i, n in enumerate(out) if n is None]
        for at in range(0, len(missing), batch):
            some = missing[at:at + batch]
            for i, spans in zip(some, encode([values[i] for i in some])):
                out[i] = len(spans)
                cache.put(values[i], out[i])
        return pa.array(out, pa.int64())

    return lengths(col_(text))


def learned_characters(msgs) -> Column:
    """[start, stop) in the rendered text of each assistant message after its header,
    end mark included."""
    def step(s, m):
        length = M.rendered_piece_length(m.getField("role"), m.getField("content")).cast("bigint")
        header = F.length(M.header(m.getField("role"))).cast("bigint")
        span = F.struct((s.getField("pos") + header).alias("start"), (s.getField("pos") + length).alias("stop"))
        own = F.coalesce(m.getField("role") == "assistant", F.lit(False))
        return F.struct(F.when(own, F.array_append(s.getField("acc"), span)).otherwise(s.getField("acc")).alias("acc"), (s.getField("pos") + length).alias("pos"))

    start = F.struct(F.array().cast("array<struct<start:bigint,stop:bigint>>").alias("acc"), F.lit(len(C.TEMPLATE_BOS)).cast("bigint").alias("pos"))
    return F.aggregate(col_(msgs), start, step).getField("acc")


def align(spans: list[tuple[int, int]], ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Token ranges [first, last) whose tokens begin inside the character ranges (both in order)."""
    out, at = [], 0
    for start, stop in ranges:
        while at < len(spans) and spans[at][0] < start:
            at += 1
        first = at
        while at < len(spans) and spans[at][0] < stop:
            at += 1
        if at > first:
            out.append((first, at))
    return out


MASK = "n_tokens bigint, learned array<struct<start:bigint,stop:bigint>>"


def token_mask(text, ranges, path: str, load: Callable[[str], Encoder] = load_tokenizer, batch: int = 64) -> Column:
    """A record's token count and the ranges of tokens it is learned from, by aligning
    ``ranges`` of characters with the tokenizer's offsets."""
    arrow = pa.struct([("n_tokens", pa.int64()), ("learned", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])

    @F.arrow_udf(T.StructType.fromDDL(MASK))
    def masks(texts: pa.Array, characters: pa.Array) -> pa.Array:
        encode, values, spans = _encoder(load, path), [t or "" for t in texts.to_pylist()], characters.to_pylist()
        out = []
        for at in range(0, len(values), batch):
            for tokens, own in zip(encode(values[at:at + batch]), spans[at:at + batch]):
                learned = align(tokens, [(r["start"], r["stop"]) for r in own or []])
                out.append({"n_tokens": len(tokens), "learned": [{"start": a, "stop": b} for a, b in learned]})
        return pa.array(out, arrow)

    return masks(col_(text), col_(ranges))
