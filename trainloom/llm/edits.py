"""Edit-aware token counts: a segment tree of pre-token chunks per document.

The leaves of a tree are chunks of the text that tokenise independently: a chunk
starts at a space between two non-space characters, where every pre-token of the
vocabulary's split pattern starts or ends. Inner nodes hold the characters and
tokens below them. An edit re-encodes the chunks it touches and one more on each
side (its boundaries may move), then updates the sums on the way to the root.

Trees are kept as a table of leaves. A round of edits reads it, unpacks only the blocks
that an edit touches, and may write the next table, on which another round can go on.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trainloom.llm.common import write_shared

_BOUNDARY = re.compile(r"(?<=\S) (?=\S)")
EDIT_TYPE = "array<struct<start:int,end:int,replacement:string>>"
# What the default edits take out, and what they put there.
REDACTIONS = [(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+", "<EMAIL>"), (r"\b\d{1,3}(?:\.\d{1,3}){3}\b", "<IP>"), (r"\b\d{12,}\b", "<NUMBER>")]


# Longer chunks are encoded each time, so that a table's bytes are bounded with its entries.
KEPT_CHARS = 64


class ChunkCounts(dict):
    """chunk -> number of tokens, kept for at most ``limit`` chunks of ``KEPT_CHARS`` per worker."""

    def __init__(self, path: str, limit: int = 200_000):
        import public_tokenizers
        import tiktoken
        super().__init__()
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.limit = limit

    def __missing__(self, chunk: str) -> int:
        n = len(self.encoding.encode_ordinary(chunk))
        if len(self) < self.limit and len(chunk) <= KEPT_CHARS:
            self[chunk] = n
        return n


_LOADED: dict[str, ChunkCounts] = {}


def load(path: str) -> ChunkCounts:
    if path not in _LOADED:
        _LOADED[path] = ChunkCounts(path)
    return _LOADED[path]


def chunks_of(text: str) -> list[str]:
    """The leaves of a text, each but the first with its leading space."""
    if not text:
        return []
    first, *rest = _BOUNDARY.split(text)
    return [first, *[" " + r for r in rest]]


FANOUT = 64


def block_sums(leaves: np.ndarray, fanout: int = FANOUT) -> np.ndarray:
    return np.add.reduceat(leaves, np.arange(0, len(leaves), fanout)) if len(leaves) else np.asarray(leaves)


class SegmentTree:
    """Characters and tokens of a document by blocks of leaves.

    ``sums`` is a binary tree in an array (node i has children 2i and 2i+1) over
    blocks of ``fanout`` leaves; blocks change their leaves but not their number.
    """

    def __init__(self, lengths: np.ndarray, tokens: np.ndarray, fanout: int = 64):
        lengths = np.asarray(lengths, np.int64)
        self._start(block_sums(lengths, fanout), tokens, fanout, lambda b: lengths[b * fanout:(b + 1) * fanout].tolist())

    @classmethod
    def stored(cls, text: str, block_chars: np.ndarray, tokens: np.ndarray) -> SegmentTree:
        """The tree of a kept row. The lengths of a block's leaves are read off its part of the text."""
        ends = np.cumsum(block_chars).tolist()
        tree = cls.__new__(cls)
        tree._start(block_chars, tokens, FANOUT, lambda b: [len(c) for c in chunks_of(text[ends[b] - int(block_chars[b]):ends[b]])])
        return tree

    def _start(self, block_chars: np.ndarray, tokens: np.ndarray, fanout: int, lengths_of) -> None:
        self.tokens_of, self.fanout, self.lengths_of = np.asarray(tokens, np.int64), fanout, lengths_of
        self.touched: dict[int, tuple[list[int], list[int]]] = {}
        n = max(1, len(block_chars))
        self.width = 1 << (n - 1).bit_length()
        self.sums = [(0, 0)] * (2 * self.width)
        if len(block_chars):
            self.sums[self.width:self.width + n] = zip(block_chars.tolist(), block_sums(self.tokens_of, fanout).tolist())
        for i in range(self.width - 1, 0, -1):
            self.sums[i] = self._join(i)

    def block(self, b: int) -> tuple[list[int], list[int]]:
        """Lengths and tokens of a block's leaves; unpacked when first asked for."""
        if b not in self.touched:
            tokens = self.tokens_of[b * self.fanout:(b + 1) * self.fanout].tolist()
            self.touched[b] = (self.lengths_of(b) if tokens else [], tokens)
        return self.touched[b]

    def leaf_tokens(self) -> np.ndarray:
        """Tokens of all leaves as they are now."""
        parts, at = [], 0
        for b in sorted(self.touched):
            parts += [self.tokens_of[at:b * self.fanout], np.array(self.touched[b][1], np.int64)]
            at = (b + 1) * self.fanout
        return np.concatenate([*parts, self.tokens_of[at:]])

    def _block_sum(self, b: int) -> tuple[int, int]:
        return sum(self.block(b)[0]), sum(self.block(b)[1])

    def _join(self, i: int) -> tuple[int, int]:
        (a, x), (b, y) = self.sums[2 * i], self.sums[2 * i + 1]
        return a + b, x + y

    @property
    def tokens(self) -> int:
        return self.sums[1][1]

    def find(self, position: int) -> tuple[int, int, int]:
        """(block, leaf, first character) of the leaf that holds ``position``; the last leaf for the end."""
        at, i = 0, 1
        while i < self.width:
            i *= 2
            if position >= at + self.sums[i][0] and self.sums[i + 1][0]:
                at += self.sums[i][0]
                i += 1
        b = i - self.width
        lengths = self.block(b)[0]
        for leaf, n in enumerate(lengths):
            if position < at + n or leaf == len(lengths) - 1:
                return b, leaf, at
            at += n
        return b, 0, at

    def replace(self, first: tuple[int, int], last: tuple[int, int], lengths: list[int], tokens: list[int]) -> None:
        """Put new leaves in place of those from ``first`` to ``last`` (block, leaf), both included."""
        (b0, l0), (b1, l1) = first, last
        tail_n, tail_t = (x[l1 + 1:] for x in self.block(b1))
        head_n, head_t = (x[:l0] for x in self.block(b0))
        for b in range(b0, b1 + 1):
            self.touched[b] = ([], [])
        if b0 == b1:
            self.touched[b0] = (head_n + lengths + tail_n, head_t + tokens + tail_t)
        else:
            self.touched[b0] = (head_n + lengths, head_t + tokens)
            self.touched[b1] = (tail_n, tail_t)
        changed = set()
        for b in range(b0, b1 + 1):
            self.sums[self.width + b] = self._block_sum(b)
            changed.add((self.width + b) // 2)
        while changed:
            for i in changed:
                if i:
                    self.sums[i] = self._join(i)
            changed = {i // 2 for i in changed if i > 1}


def apply_edits(text: str, tree: SegmentTree, edits: list[tuple[int, int, str]], counts: dict[str, int]) -> tuple[str, int]:
    """(edited text, characters encoded anew); ``tree`` is updated in place.

    Edits are (start, end, replacement) in characters of the original text and
    must not overlap; the last is applied first, so earlier positions stay valid.
    """
    encoded = 0
    for start, end, replacement in sorted(edits, reverse=True):
        if not 0 <= start <= end <= len(text):
            raise ValueError(f"edit {start}..{end} lies outside a text of {len(text)} characters")
        b0, l0, at = tree.find(start)
        # Context: the leaf before the first touched and the leaf after the last.
        b0, l0, at = tree.find(at - 1) if at else (b0, l0, at)
        b1, l1, last_at = tree.find(max(start, end - 1))
        stop = last_at + (tree.block(b1)[0][l1] if tree.block(b1)[0] else 0)
        if stop < len(text):
            b1, l1, last_at = tree.find(stop)
            stop = last_at + tree.block(b1)[0][l1]
        region = text[at:start] + replacement + text[end:stop]
        leaves = chunks_of(region)
        tree.replace((b0, l0), (b1, l1), [len(c) for c in leaves], [counts[c] for c in leaves])
        encoded += len(region)
        text = text[:at] + region + text[stop:]
    return text, encoded


def redactions(text: str | None) -> list[tuple[int, int, str]]:
    """Default edits: personal data by ``REDACTIONS``; of overlapping matches the first stays."""
    found = sorted((m.start(), m.end(), r) for pattern, r in REDACTIONS for m in re.finditer(pattern, text or ""))
    kept: list[tuple[int, int, str]] = []
    for edit in found:
        if not kept or edit[0] >= kept[-1][1]:
            kept.append(edit)
    return kept


def _redact(texts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("replacement", pa.string())]))
    for batch in texts:
        edits = [[{"start": s, "end": e, "replacement": r} for s, e, r in redactions(t.as_py())] for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(edits, kind)], [*batch.schema.names, "edits"])


def with_redactions(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, edits: the default edits of every document."""
    return df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text")).mapInArrow(
        _redact, f"doc_id long, text string, edits {EDIT_TYPE}")


def redacted(trees: DataFrame) -> DataFrame:
    """Kept trees with the default edits of every document."""
    return trees.select("doc_id", "text", "block_chars", "leaf_tokens").mapInArrow(_redact, f"{TREES}, edits {EDIT_TYPE}")


# Characters by block of leaves and tokens by leaf; the text itself has the leaves' lengths.
TREES = "doc_id long, text string, block_chars array<int>, leaf_tokens array<int>"


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(arrays) if arrays else [], pa.int32()))


def _build(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    counts = load(path)
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            lengths, tokens = [], []
            for t in part.column(part.schema.get_field_index("text")):
                leaves = chunks_of(t.as_py() or "")
                lengths.append(block_sums(np.fromiter(map(len, leaves), np.int32, len(leaves))))
                tokens.append(np.fromiter(map(counts.__getitem__, leaves), np.int32, len(leaves)))
            yield pa.RecordBatch.from_arrays([*part.columns, _lists(lengths), _lists(tokens)], [*part.schema.names, "block_chars", "leaf_tokens"])


def build_trees(df: DataFrame, ranks_path: str) -> DataFrame:
    """Add each document's tree (block_chars, leaf_tokens) to doc_id, text, edits.

    Null text counts as empty and has no leaf; null and repeated ids and repeated rows
    give one tree each; an empty table gives none; other columns are not read.
    """
    rows = df.select("doc_id", "text", "edits")
    return rows.mapInArrow(partial(_build, path=ranks_path), f"doc_id long, text string, edits {EDIT_TYPE}, block_chars array<int>, leaf_tokens array<int>")


def keep_trees(df: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The trees of all documents, written to the shared folder and read back: doc_id, text,
    block_chars, leaf_tokens. The only step that encodes whole texts; rows as in ``build_trees``."""
    rows = df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"))
    return write_shared(rows.mapInArrow(partial(_build, path=ranks_path), TREES), "trees")


COUNTS = "doc_id long, n_edits long, tokens_before long, tokens_after long, leaves long, encoded_chars long"


def _recount(batches: Iterator[pa.RecordBatch], path: str, full: bool, trees: bool = False) -> Iterator[pa.RecordBatch]:
    counts = load(path)
    names = [c.split()[0] for c in COUNTS.split(", ")]
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            rows, texts, kept = [], [], ([], [])
            part = batch.slice(at, 500)
            columns = [part.column(n) for n in ("doc_id", "text", "edits", "block_chars", "leaf_tokens")]
            for doc, text, edits, *own in zip(*columns):
                doc, text, edits = doc.as_py(), text.as_py() or "", edits.as_py() or []
                chars, tokens = (x.values.to_numpy() if x.values is not None else np.empty(0, np.int32) for x in own)
                after = before = int(tokens.sum())
                n, encoded = len(tokens), 0
                if edits:
                    tree = SegmentTree.stored(text, chars, tokens)
                    text, encoded = apply_edits(text, tree, [(e["start"], e["end"], e["replacement"] or "") for e in edits], counts)
                    after = tree.tokens
                    if trees:  # leaves are dealt into even blocks again
                        tokens = tree.leaf_tokens()
                        chars = block_sums(np.array([len(c) for c in chunks_of(text)], np.int64))
                        assert len(chars) == -(-len(tokens) // FANOUT)
                rows.append((doc, len(edits), before, after, n, encoded))
                texts.append(text)
                kept[0].append(chars)
                kept[1].append(tokens)
            arrays = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * len(names)
            if trees:
                yield pa.RecordBatch.from_arrays([arrays[0], pa.array(texts, pa.string()), *map(_lists, kept)], ["doc_id", "text", "block_chars", "leaf_tokens"])
            else:
                yield pa.RecordBatch.from_arrays([*arrays, *([pa.array(texts, pa.string())] if full else [])], [*names, *(["text"] if full else [])])


def count_after_edits(trees: DataFrame, ranks_path: str, full: bool = True) -> DataFrame:
    """doc_id, n_edits, tokens_before, tokens_after, leaves, encoded_chars and, with ``full``, the edited text.

    ``trees`` has doc_id, text, edits and the leaves. Null text counts as empty (no leaf, no
    token), null edits as none, a null replacement as a deletion; an edit outside its text
    raises an error, as its count would be wrong. Null and repeated ids and repeated rows
    give one row each; an empty table gives none.
    """
    return trees.mapInArrow(partial(_recount, path=ranks_path, full=full), COUNTS + (", text string" if full else ""))


def edit_trees(trees: DataFrame, ranks_path: str) -> DataFrame:
    """The trees after their edits (doc_id, text, block_chars, leaf_tokens), written to the shared
    folder: the table that the next round of edits starts from. Only regions that an edit
    touches are encoded; rows as in ``count_after_edits``."""
    return write_shared(trees.mapInArrow(partial(_recount, path=ranks_path, full=False, trees=True), TREES), "trees")
