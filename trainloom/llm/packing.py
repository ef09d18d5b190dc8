"""Cost-balanced packing of documents into fixed-length training sequences.

A piece of L tokens costs ``linear * L + quadratic * L**2`` (dense layers plus
attention). Pieces go, longest first, to the sequence of lowest cost that still
has room for them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from trainloom.llm import wordbpe

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, cost double"


def assign(lengths: np.ndarray, max_tokens: int, linear: float, quadratic: float) -> list[list[tuple[int, int, int]]]:
    """Sequences of (piece, first token, tokens) for pieces shorter than ``max_tokens``.

    As many full sequences are opened as the tokens fill. Descending pieces join
    the cheapest sequence that can hold them whole; what fits nowhere whole is
    cut to fill the gaps, and the rest (less than one sequence) is cut into
    sequences of a power of two, which need no padding.
    """
    total = int(lengths.sum())
    n = total // max_tokens
    sequences: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
    room = np.full(n, max_tokens, np.int64)
    cost = np.zeros(n)
    left: list[tuple[int, int, int]] = []
    order = np.argsort(-lengths, kind="stable")
    for p in order.tolist():
        size = int(lengths[p])
        s = -1
        if n:
            open_cost = np.where(room >= size, cost, np.inf)
            s = int(open_cost.argmin())
            if room[s] < size:
                s = -1
        if s < 0:
            left.append((p, 0, size))
        else:
            sequences[s].append((p, 0, size))
            room[s] -= size
            cost[s] += linear * size + quadratic * size * size
    for s in np.argsort(cost, kind="stable").tolist():
        while room[s]:
            p, at, size = left.pop(0)
            take = min(size, int(room[s]))
            sequences[s].append((p, at, take))
            room[s] -= take
            if take < size:
                left.insert(0, (p, at + take, size - take))
    while left:
        rest = sum(x[2] for x in left)
        want, tail = 1 << (rest.bit_length() - 1), []
        while want:
            p, at, size = left.pop(0)
            take = min(size, want)
            tail.append((p, at, take))
            want -= take
            if take < size:
                left.insert(0, (p, at + take, size - take))
        sequences.append(tail)
    return sequences


def _pack(batches: Iterator[pa.RecordBatch], path: str, end_id: int | None, max_tokens: int, block_tokens: int,
          linear: float, quadratic: float) -> Iterator[pa.RecordBatch]:
    table = wordbpe.load(path)
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
    base, made = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40, 0
    rows: list[tuple] = []
    # Remainders wait here: (doc, first token, ids, tokens of the document).
    waiting: list[tuple[int | None, int, bytes, int]] = []
    held = 0

    def price(size: int) -> float:
        return linear * size + quadratic * size * size

    def flush() -> None:
        nonlocal made, held
        for sequence in assign(np.array([len(w[2]) // 4 for w in waiting], np.int64), max_tokens, linear, quadratic):
            total, offset = sum(price(size) for _, _, size in sequence), 0
            for p, at, size in sequence:
                doc, first, ids, n = waiting[p]
                rows.append((doc, first + at, size, zlib.crc32(ids[4 * at:4 * (at + size)]), n, base + made, offset, total))
                offset += size
            made += 1
        waiting.clear()
        held = 0

    def out() -> pa.RecordBatch:
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        types = [pa.float64() if f.endswith("double") else pa.int64() for f in SCHEMA.split(", ")]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
        rows.clear()
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = table.encode(text.as_py() or "") + end
            n, whole = len(ids) // 4, 0
            while n - whole >= max_tokens:
                part = ids[4 * whole:4 * (whole + max_tokens)]
                rows.append((doc, whole, max_tokens, zlib.crc32(part), n, base + made, 0, price(max_tokens)))
                made += 1
                whole += max_tokens
            if n > whole:
                waiting.append((doc, whole, ids[4 * whole:], n))
                held += n - whole
            if held >= block_tokens:
                flush()
            if len(rows) >= 20_000:
                yield out()
    flush()
    if rows:
        yield out()


def pack(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = 2,
         max_tokens: int = 4096, block_tokens: int = 2_000_000, linear: float = 12.0, quadratic: float = 1.0 / 512) -> DataFrame:
    """One row per piece: where its tokens lie in the document and in a sequence.

    Each task tokenises its documents and packs them in blocks of at most about
    ``block_tokens`` waiting tokens, so there is no shuffle, memory is bounded
    and a lost task is simply run again. A document of ``max_tokens`` or more
    fills sequences of its own; its remainder is packed with the others.

    Null text counts as empty (with ``end_id`` it still gives one token; without,
    no row). Null and repeated ids, repeated rows and ties are packed like any
    other row, in input order; an empty table gives no row; other columns of
    ``df`` are not read.
    """
    if block_tokens < max_tokens:
        raise ValueError("block_tokens must be at least max_tokens")
    run = partial(_pack, path=tokenizer_path, end_id=end_id, max_tokens=max_tokens, block_tokens=block_tokens,
                  linear=linear, quadratic=quadratic)
    ids = df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"))
    return ids.mapInArrow(run, SCHEMA)
