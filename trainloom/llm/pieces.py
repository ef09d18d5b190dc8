"""SentencePiece encoding and decoding through a table of distinct marked chunks.

The model marks white space with U+2581 and none of its pieces has a mark after
another character. A merge therefore never crosses from a word to the next
mark, so the text splits into chunks "marks + word" that segment independently.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

MARK = "▁"
_CROSSES = regex.compile(f"[^{MARK}]{MARK}")
# Chunks once their first mark (the one that stands for a single space) is cut off.
_RUNS = regex.compile(r" *[^ ]*")


KEPT_CHARS = 64


class ChunkTable(dict):
    """chunk without its first mark -> (ids as text, number of ids, decoded text).

    Encoding a chunk alone adds that mark again as the dummy prefix, and decoding
    takes it off, so ids concatenate and decoded chunks join by single spaces.
    At most ``limit`` chunks of ``KEPT_CHARS`` are kept, which bounds the table's bytes;
    others are segmented when they occur, once for each group of documents.
    """

    def __init__(self, path: str, limit: int = 200_000):
        import sentencepiece
        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.limit = limit
        probe = f"a  b\n {MARK}c"
        # Exactness rests on these properties of the model.
        self.splits = (not any(_CROSSES.search(self.model.id_to_piece(i)) for i in range(self.model.get_piece_size()))
                       and self.model.decode(self.model.encode(probe)) == probe.replace(MARK, " "))

    def add(self, chunks: list[str]) -> dict[str, tuple[str, int, str]]:
        """Segment each of these distinct chunks once."""
        # An empty chunk is a lone mark, which an empty text alone would not give.
        ids = self.model.encode([c or " " for c in chunks], num_threads=1)
        ids = [i if c else self._lone(i) for c, i in zip(chunks, ids)]
        texts = self.model.decode(ids, num_threads=1)
        new = {c: (",".join(map(str, i)), len(i), t) for c, i, t in zip(chunks, ids, texts)}
        short = {c: v for c, v in new.items() if len(c) <= KEPT_CHARS}
        if room := self.limit - len(self):
            self.update(list(short.items())[:room] if len(short) > room else short)
        return new

    def _lone(self, two_marks: list[int]) -> list[int]:
        return [self.model.piece_to_id(MARK)]


_LOADED: dict[str, ChunkTable] = {}


def _table(path: str) -> ChunkTable:
    if path not in _LOADED:
        _LOADED[path] = ChunkTable(path)
    return _LOADED[path]


def chunks_of(text: str) -> list[str]:
    """Marked chunks in order, each without its first mark; none for an empty text."""
    if not text:
        return []
    if MARK in text:
        text = text.replace(MARK, " ")
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    # The dummy prefix stands before the text; runs of marks belong to the word after them.
    return [c[1:] for c in _RUNS.findall(" " + text) if c]


def _encode(batches: Iterator[pa.RecordBatch], path: str, full: bool, group: int) -> Iterator[pa.RecordBatch]:
    table = _table(path)
    for batch in batches:
        for at in range(0, batch.num_rows, group):
            part = batch.slice(at, group)
            texts = [t or "" for t in part.column(1).to_pylist()]
            n, ids_sha, text_sha, ids_out, decoded_out = [], [], [], [], []
            if table.splits:
                positions = [chunks_of(t) for t in texts]
                distinct = set().union(*positions) if positions else set()
                fresh = table.add([c for c in distinct if c not in table])
                found = {c: fresh[c] if c in fresh else table[c] for c in distinct}
                for chunks in positions:
                    hits = [found[c] for c in chunks]
                    joined = ",".join([h[0] for h in hits])
                    decoded = " ".join([h[2] for h in hits])
                    n.append(sum([h[1] for h in hits]))
                    ids_sha.append(hashlib.sha256(joined.encode()).hexdigest())
                    text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
                    if full:
                        ids_out.append([int(i) for i in joined.split(",")] if joined else [])
                        decoded_out.append(decoded)
            else:  # pieces may cross marks: the whole text is one chunk
                for t in texts:
                    ids = table.model.encode(t)
                    decoded = table.model.decode(ids) if ids else ""
                    n.append(len(ids))
                    ids_sha.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                    text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
                    if full:
                        ids_out.append(ids)
                        decoded_out.append(decoded)
            columns = [part.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if full:
                columns += [pa.array(ids_out, pa.list_(pa.int32())), pa.array(decoded_out, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)


def encode_decode(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", full: bool = True,
                  group: int = 500) -> DataFrame:
    """Ids of every whole text and the text decoded from them.

    Per document: doc_id, n_tokens, ids_sha256, decoded_sha256 and, with
    ``full``, ids (array) and decoded (string). For each group of documents the
    distinct chunks are collected, those not yet in the worker's table are
    segmented once, and ids are joined back by position; there is no shuffle and
    the table is bounded. A model whose pieces may cross marks is applied to
    whole texts instead.

    Null text counts as empty and gives no id. Null and repeated ids and repeated
    rows give one row each; an empty table gives none; other columns are ignored.
    """
    run = partial(_encode, path=model_path, full=full, group=group)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if full else "")
    return df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text")).mapInArrow(run, schema)
