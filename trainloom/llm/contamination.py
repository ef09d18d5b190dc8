"""Benchmark passages in documents, found with an FM-index for each training shard.

1. A task cuts its documents into shards of bounded size; equal texts of a shard are
   indexed once. The words of a shard are numbered, its suffixes sorted, and the last
   column of the sorted rotations goes into a wavelet tree (in matrix form, one bit
   vector for each bit of a word's number). Every text start and every ``rate``-th
   word of a text keeps its suffix position. Indexes are written to the shared folder.
2. The windows of the benchmark are spread over blocks of bounded size. A block is sent
   to all shards, which search its windows backwards, all at once, through wavelet-tree
   ranks, and locate each occurrence by walking to a kept position.
3. The spans of a document are merged, and its items collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainloom.llm.common import shared_path

WIDTH, SHARD_WORDS, BLOCK_WINDOWS = 10, 1 << 20, 20_000
# Fixed value: words are runs of digits, letters a to z and characters beyond ASCII; only A to Z change case.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_ONE = np.uint64(1)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORDS).split() if text else []


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Places of all suffixes in order; their ends must differ. Doubles the compared length over what is still tied."""
    n = len(s)
    if n < 2:
        return np.arange(n)
    bits = max(1, int(s.max()).bit_length())
    depth = max(1, 62 // bits)
    padded, key = np.concatenate((s, np.zeros(depth, np.int64))), np.zeros(n, np.int64)
    for i in range(depth):
        key = key << bits | padded[i:i + n]
    sa = np.argsort(key)
    key = key[sa]
    head = np.ones(n, bool)
    np.not_equal(key[1:], key[:-1], out=head[1:])
    starts = np.flatnonzero(head)
    group, size = starts[np.cumsum(head) - 1], np.diff(np.append(starts, n))
    rank = np.empty(n, np.int64)
    rank[sa] = group
    tied = np.flatnonzero(np.repeat(size > 1, size))
    while len(tied):
        row, own = sa[tied], group[tied]
        after = row + depth
        then = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        order = np.argsort(own << 32 | then)
        row, then = row[order], then[order]
        sa[tied] = row
        head = np.ones(len(row), bool)
        head[1:] = (own[1:] != own[:-1]) | (then[1:] != then[:-1])
        starts = np.flatnonzero(head)
        size = np.diff(np.append(starts, len(row)))
        group[tied] = tied[starts][np.cumsum(head) - 1]
        rank[row] = group[tied]
        tied = tied[np.repeat(size > 1, size)]
        depth *= 2
    return sa


class Bits:
    """Bit vector with the number of ones before a place."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    @staticmethod
    def pack(flags: np.ndarray) -> np.ndarray:
        padded = np.zeros(len(flags) // 64 * 64 + 64, bool)
        padded[:len(flags)] = flags
        return np.packbits(padded, bitorder="little").view(np.uint64)

    def rank(self, i: np.ndarray) -> np.ndarray:
        low = (i & 63).astype(np.uint64)
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & ((_ONE << low) - _ONE))

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64) & _ONE).astype(bool)


class Index:
    """FM-index of texts over word numbers 1 to ``n_words``; 0 ends a text."""

    def __init__(self, levels: list[Bits], zeros: list[int], first: np.ndarray, marked: Bits, kept: np.ndarray, starts: np.ndarray):
        self.levels, self.zeros, self.first, self.marked, self.kept, self.starts = levels, zeros, first, marked, kept, starts

    @staticmethod
    def build(words: np.ndarray, lengths: np.ndarray, n_words: int, rate: int) -> dict[str, bytes | list[bytes]]:
        """Parts of the index of texts that lie one after the other in ``words``."""
        n_texts, n = len(lengths), len(words) + len(lengths)
        ends = np.cumsum(lengths + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1)).astype(np.int64) if n_texts else np.empty(0, np.int64)
        inner = np.ones(n, bool)
        inner[ends] = False
        s, order = np.zeros(n, np.int64), np.empty(n, np.int64)
        s[inner] = words
        # To the sort, every end is a symbol of its own.
        order[inner], order[ends] = words + (n_texts - 1), np.arange(n_texts)
        sa = suffix_array(order)
        last = s[sa - 1].astype(np.uint32)
        levels = []
        for bit in range(max(1, int(n_words).bit_length()) - 1, -1, -1):
            flags = (last >> np.uint32(bit) & np.uint32(1)).astype(bool)
            levels.append(Bits.pack(flags).tobytes())
            last = np.concatenate((last[~flags], last[flags]))
        sampled = (sa - starts[np.searchsorted(starts, sa, "right") - 1]) % rate == 0 if n else np.empty(0, bool)
        first = np.concatenate(([0], np.cumsum(np.bincount(s, minlength=n_words + 1)))).astype(np.int64)
        return {"levels": levels, "first": first.tobytes(), "marked": Bits.pack(sampled).tobytes(),
                "kept": sa[sampled].astype(np.int32).tobytes(), "starts": starts.tobytes()}

    @staticmethod
    def load(parts: dict) -> Index:
        first = np.frombuffer(parts["first"], np.int64)
        levels = [Bits(np.frombuffer(b, np.uint64)) for b in parts["levels"]]
        n = int(first[-1])
        return Index(levels, [n - int(x.before[-1]) for x in levels], first, Bits(np.frombuffer(parts["marked"], np.uint64)),
                     np.frombuffer(parts["kept"], np.int32).astype(np.int64), np.frombuffer(parts["starts"], np.int64))

    def _down(self, symbol: np.ndarray, places: list[np.ndarray]) -> list[np.ndarray]:
        """Where the given places of the last column lie among equal symbols, level by level."""
        for depth, (level, zeros) in enumerate(zip(self.levels, self.zeros)):
            one = (symbol >> (len(self.levels) - 1 - depth) & 1).astype(bool)
            ranks = [level.rank(i) for i in places]
            places = [np.where(one, zeros + r, i - r) for i, r in zip(places, ranks)]
        return places

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of patterns, whose word numbers stand at the right of each line."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.first[-1], np.int64)
        for back in range(1, patterns.shape[1] + 1):
            go = np.flatnonzero((lengths >= back) & (high > low))
            word = patterns[go, -back]
            base, a, b = self._down(word, [np.zeros(len(go), np.int64), low[go], high[go]])
            low[go], high[go] = self.first[word] + a - base, self.first[word] + b - base
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes of rows: steps back to the next kept one."""
        place, steps, out = rows.copy(), 0, np.empty(len(rows), np.int64)
        open_rows = np.arange(len(rows))
        while len(open_rows):
            there = self.marked.get(place)
            out[open_rows[there]] = self.kept[self.marked.rank(place[there])] + steps
            open_rows, place = open_rows[~there], place[~there]
            symbol, at, base = np.zeros(len(place), np.int64), place, np.zeros(len(place), np.int64)
            for level, zeros in zip(self.levels, self.zeros):
                one = level.get(at)
                symbol = symbol << 1 | one
                r, rb = level.rank(at), level.rank(base)
                at, base = np.where(one, zeros + r, at - r), np.where(one, zeros + rb, base - rb)
            place = self.first[symbol] + at - base
            steps += 1
        return out


DOC = "struct<rid:bigint,doc_id:bigint,n_words:bigint,text:int,start:bigint>"
SHARD = f"docs array<{DOC}>, words array<binary>, levels array<binary>, first binary, marked binary, kept binary, starts binary"
_DOC = pa.struct([("rid", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("text", pa.int32()), ("start", pa.int64())])
_SHARD = pa.schema([("docs", pa.list_(_DOC)), ("words", pa.list_(pa.binary())), ("levels", pa.list_(pa.binary()))] +
                   [(c, pa.binary()) for c in ("first", "marked", "kept", "starts")])


def _shards(batches: Iterator[pa.RecordBatch], shard_words: int, width: int, rate: int) -> Iterator[pa.RecordBatch]:
    """rid, doc_id, text -> one row for each shard."""
    docs, texts, lengths, flat = [], {}, [], []

    def out() -> pa.RecordBatch:
        coded = pa.array(flat, pa.binary()).dictionary_encode()
        parts = Index.build(coded.indices.to_numpy().astype(np.int64) + 1, np.array(lengths, np.int64), len(coded.dictionary), rate)
        row = {"docs": docs, "words": coded.dictionary, **parts}
        batch = pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in _SHARD], schema=_SHARD)
        for x in (docs, texts, lengths, flat):
            x.clear()
        return batch

    for batch in batches:
        for rid, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            words = words_of(text.as_py())
            # A very long text is cut with an overlap, so that no window is lost.
            for start in range(0, max(1, len(words) - width + 1), shard_words):
                piece = words[start:start + shard_words + width - 1]
                key, at = b" ".join(piece), None
                if piece:
                    at = texts.get(key)
                    if at is None:
                        at = texts[key] = len(texts)
                        flat += piece
                        lengths.append(len(piece))
                docs.append((rid, doc, len(words), at, start))
                if len(flat) >= shard_words or len(docs) >= 100_000:
                    yield out()
    if docs:
        yield out()


def build_shards(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, shard_words: int = SHARD_WORDS,
                 rate: int = 16) -> DataFrame:
    """The FM-indexes of the documents, a row for each shard, written to the shared folder.

    They serve any later search for windows of at most ``width`` words.
    """
    spark = df.sparkSession
    source = df.select(F.monotonically_increasing_id().alias("rid"), df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").cast("binary").alias("text"))
    shards = source.mapInArrow(partial(_shards, shard_words=shard_words, width=width, rate=rate), SHARD)
    path = shared_path(spark, "fm-index")
    # Small row groups bound what a reader holds: an index is some megabytes.
    shards.write.option("compression", "zstd").option("parquet.block.size", str(16 << 20)).parquet(path)
    return spark.read.schema(shards.schema).parquet(path)


def _windows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        items, windows = [], []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = words_of(text.as_py())
            own = {b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else ()
            items += [item] * len(own)
            windows += own
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(windows, pa.binary())], ["item", "window"])


HITS = "rid long, spans array<struct<start:bigint,stop:bigint>>, items array<string>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


class Windows:
    """Distinct windows of a block: their words, lengths and items."""

    def __init__(self, table: pa.Table):
        coded = table["window"].combine_chunks().dictionary_encode()
        split = [w.split(b" ") for w in coded.dictionary.to_pylist()]
        self.lengths = np.array([len(w) for w in split], np.int64)
        words = pa.array([w for line in split for w in line], pa.binary()).dictionary_encode()
        self.vocabulary = words.dictionary
        ids = words.indices.to_numpy()
        width = int(self.lengths.max())
        # Word places in the vocabulary, at the right of each line.
        self.lines = np.zeros((len(split), width), np.int64)
        self.lines[np.arange(width) >= width - self.lengths[:, None]] = ids
        names = table["item"].combine_chunks().dictionary_encode()
        self.items = names.dictionary.to_pylist()
        order = np.argsort(coded.indices.to_numpy(), kind="stable")
        self.item_of = names.indices.to_numpy()[order]
        self.bounds = np.searchsorted(coded.indices.to_numpy()[order], np.arange(len(split) + 1))


def _expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, value) for every value of every range."""
    size = high - low
    owner = np.repeat(np.arange(len(low)), size)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)


def merged(owner: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Disjoint spans of each owner, in order; spans that meet become one."""
    order = np.lexsort((start, owner))
    owner, start, stop = owner[order], start[order], stop[order]
    if not len(owner):
        return owner, start, stop
    reach = int(stop.max()) + 1
    far = np.maximum.accumulate(owner * reach + stop)
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (owner[1:] * reach + start[1:] > far[:-1])
    ends = np.append(np.flatnonzero(new)[1:] - 1, len(owner) - 1)
    return owner[new], start[new], far[ends] - owner[new] * reach


def _search(batches: Iterator[pa.RecordBatch], windows: Windows) -> Iterator[pa.RecordBatch]:
    """Shards -> spans and items of the documents that hold a window of the block."""
    for batch in batches:
        for r in range(batch.num_rows):
            parts = {c: batch.column(c)[r].as_py() for c in ("levels", "first", "marked", "kept", "starts")}
            index = Index.load(parts)
            if not len(index.starts):
                continue
            own = pc.index_in(windows.vocabulary, value_set=batch.column("words")[r].values)
            number = own.fill_null(-1).to_numpy().astype(np.int64) + 1
            lines = np.where(np.arange(windows.lines.shape[1]) >= windows.lines.shape[1] - windows.lengths[:, None], number[windows.lines], -1)
            some = np.flatnonzero((lines != 0).all(1))  # a word that the shard lacks rules a window out
            low, high = index.search(lines[some], windows.lengths[some])
            owner, rows = _expand(low, high)
            if not len(rows):
                continue
            at, owner = index.locate(rows), some[owner]
            text = np.searchsorted(index.starts, at, "right") - 1
            begin = at - index.starts[text]
            pairs = np.unique(text * len(windows.lengths) + owner)
            holder, window = pairs // len(windows.lengths), pairs % len(windows.lengths)
            which, place = _expand(windows.bounds[window], windows.bounds[window + 1])
            pairs = np.unique(holder[which] * len(windows.items) + windows.item_of[place])
            items: dict[int, list] = {}
            for t, i in zip((pairs // len(windows.items)).tolist(), (pairs % len(windows.items)).tolist()):
                items.setdefault(t, []).append(windows.items[i])
            spans: dict[int, list] = {}
            for t, a, b in zip(*(x.tolist() for x in merged(text, begin, begin + windows.lengths[owner]))):
                spans.setdefault(t, []).append((a, b))
            out = [(d["rid"], [(d["start"] + a, d["start"] + b) for a, b in spans[d["text"]]], items[d["text"]])
                   for d in batch.column("docs")[r].as_py() if d["text"] in spans]
            for i in range(0, len(out), 5_000):
                rid, s, x = zip(*out[i:i + 5_000])
                yield pa.RecordBatch.from_arrays([pa.array(rid, pa.int64()), pa.array(s, _SPANS), pa.array(x, pa.list_(pa.string()))], ["rid", "spans", "items"])


FOUND = "rid long, spans array<struct<start:bigint,stop:bigint>>, items array<string>, n_hit long, items_sha256 string"


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans and items of a document from all blocks and pieces, merged."""
    for batch in batches:
        out = []
        for rid, spans, items in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            start, stop = (spans.values.field(i).to_numpy() for i in (0, 1))
            _, start, stop = merged(np.zeros(len(start), np.int64), start, stop)
            names = sorted({i.encode() for i in items.as_py()})
            out.append((rid, list(zip(start.tolist(), stop.tolist())), [n.decode() for n in names], int((stop - start).sum()), hashlib.sha256(b",".join(names)).hexdigest()))
        columns = list(zip(*out)) if out else [[]] * 5
        types = [pa.int64(), _SPANS, pa.list_(pa.string()), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [c.split()[0] for c in ("rid", "spans", "items", "n_hit", "items_sha256")])


def search_shards(spark: SparkSession, shards: DataFrame, benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
                  width: int = WIDTH, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """rid, spans, items, n_hit, items_sha256 of the documents that hold a window of the benchmark."""
    windows = (benchmark.select(benchmark[item_col].cast("string").alias("item"), benchmark[text_col].cast("string").cast("binary").alias("text"))
               .where("item is not null").mapInArrow(partial(_windows, width=width), "item string, window binary").distinct())
    # Windows are spread by hash, so a block has about block_windows rows; one block at a time is sent out.
    blocks = -(-windows.count() // block_windows)
    found = None
    for b in range(blocks):
        table = windows.where(F.pmod(F.xxhash64("item", "window"), F.lit(blocks)) == b).toArrow()
        if table.num_rows:
            hits = shards.mapInArrow(partial(_search, windows=Windows(table)), HITS)
            found = hits if found is None else found.unionByName(hits)
    if found is None:
        return spark.createDataFrame([], FOUND)
    return found.groupBy("rid").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items")).mapInArrow(_merge, FOUND)


def find_leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", bench_col: str = "text",
               width: int = WIDTH, shard_words: int = SHARD_WORDS, block_windows: int = BLOCK_WINDOWS, rate: int = 16) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and the leaks themselves: spans, items.

    A window is ``width`` consecutive words of an item; an item of fewer words, but
    not none, is one window. ``spans`` are the merged word ranges [start, stop) that
    windows cover, ``items`` the ids (as strings, sorted) with a window in the text; both
    are empty arrays in a clean document. Null text has no words. A null document id stays
    null; repeated rows give one row each. Items with a null id take no part; rows that
    repeat an item's id add windows to it. An empty table of documents gives no row, an
    empty benchmark leaves all documents clean. Other columns are not read.
    """
    shards = build_shards(df, id_col, text_col, width, shard_words, rate)
    found = search_shards(df.sparkSession, shards, benchmark, item_col, bench_col, width, block_windows)
    docs = shards.select(F.explode("docs").alias("d")).select("d.*").where("start = 0").select("rid", "doc_id", "n_words")
    spans = F.coalesce("spans", F.array().cast("array<struct<start:bigint,stop:bigint>>"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return docs.join(found, "rid", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), spans.alias("spans"), items.alias("items"))
