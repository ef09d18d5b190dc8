"""Removal of long repeated passages with prefix-partitioned suffix trees.

A window is ``width`` consecutive words. Every suffix that could share a window
with another text is reached through a sampled start: the place of the window's word of
smallest hash (the leftmost of equal ones), modulo the number of ``prefix``-word
strings in a window, names the string that is the window's anchor. Equal windows
have equal anchors at equal places, and neighbours mostly share theirs.

1. Prefix partition: count the texts that hold each anchor prefix. A prefix in
   one text only cannot lead to a repeat and goes.
2. Suffixes at the other anchors carry the words around them, and are grouped by
   prefix. A group of up to ``group_rows`` suffixes is small: its suffix tree, cut at
   depth ``width``, is built by sorting the suffixes that start up to ``width - prefix``
   words left of the anchor; neighbours with a common prefix of ``width`` words lie under
   one deep internal node. A node with leaves from several documents is a repeat;
   its leaves outside the smallest document are covered.
3. The prefixes of larger groups are lengthened, longest first. Neighbouring anchors of
   a text form runs, cut at places that the words choose; equal runs of all texts meet as
   one key, combined on the map side. Whoever is not the smallest document of a run is
   covered over the whole run and done; one document of each distinct run goes on, with
   the words of each anchor's windows as the key, and then with each window.
   The smallest document of any window is the smallest of every run that holds
   it, so it always goes on.
4. Covered words are cut out of their documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from trainloom.llm.common import mix64, salted, window_hashes, write_shared

WIDTH, PREFIX, GROUP_ROWS, RUN = 13, 7, 4_000, 8
# Fixed value: words are runs of anything but these characters.
_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_ODD = np.uint64(0x9DDFEA08EB382D69)


def words_of(text: bytes | None) -> list[bytes]:
    return text.split() if text else []  # bytes are split at those characters alone


def hashed_words(raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes, first bytes) of the words in UTF-8 bytes of texts that begin at ``begins``.

    A polynomial over the bytes of each word, mixed with its length.
    """
    inside = ~_SPACE[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = begins[begins < len(raw)]
    first[begins] = inside[begins]  # a word ends with its text
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    # Only the bytes of words go on, each with its place in its word.
    at = np.flatnonzero(inside)
    begin = np.flatnonzero(first[at])
    size = np.diff(np.append(begin, len(at)))
    place = np.arange(len(at), dtype=np.int32) - np.repeat(begin.astype(np.int32), size)
    powers = np.full(int(size.max()), _ODD, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    value = (raw[at] + np.uint64(1)) * powers[place]
    return mix64(np.add.reduceat(value, begin) + size.astype(np.uint64) * salted(3)), starts


def hashed_texts(texts: pa.Array, chunk_bytes: int = 1 << 17) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, text after the last, word hashes, first byte of each word, first byte of each text) of
    neighbouring texts (binary) of some ``chunk_bytes`` in all."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data, at = np.frombuffer(texts.buffers()[2] or b"", np.uint8), 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + chunk_bytes, "right")) - 1)
        begins = offsets[at:end] - offsets[at]
        h, starts = hashed_words(data[offsets[at]:offsets[end]], begins)
        yield at, end, h, starts, begins
        at = end


def first_minimum(h: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width``, the distance to its smallest value, the leftmost of equal ones."""
    value, place, reach = h, np.zeros(len(h), np.int64), 1
    while reach < width:
        step = min(reach, width - reach)
        n = len(value) - step
        later = value[step:] < value[:n]
        place = np.where(later, place[step:] + step, place[:n])
        value = np.where(later, value[step:], value[:n])
        reach += step
    return place


def anchors(h: np.ndarray, width: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor of each window start, distinct anchor positions, their prefix hashes)."""
    if len(h) < width:
        empty = np.empty(0, np.int64)
        return empty, empty, np.empty(0, np.uint64)
    first = first_minimum(h, width)
    at = np.arange(len(first)) + first % (width - prefix + 1)
    distinct = _distinct(at)
    return at, distinct, window_hashes(h, prefix)[distinct]


def _distinct(rising: np.ndarray) -> np.ndarray:
    """Values of an array that never falls, once each (anchors move to the right with their windows)."""
    return rising[np.append(True, rising[1:] != rising[:-1])] if len(rising) else rising


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, sha = [], []
        for text in batch.column(2).to_pylist():
            w = words_of(text)
            n.append(len(w))
            sha.append(hashlib.sha256(b" ".join(w)).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(sha, pa.string())],
                                         ["doc_id", "text_key", "n_words", "sha"])


def _prefixes(batches: Iterator[pa.RecordBatch], width: int, prefix: int) -> Iterator[pa.RecordBatch]:
    """(prefix hash, text key, places) once per text and prefix."""
    for batch in batches:
        keys = batch.column(0).to_numpy()
        for at, end, h, starts, begins in hashed_texts(batch.column(1)):
            if len(h) < width:
                continue
            owner = np.searchsorted(begins, starts, "right") - 1
            inside = owner[:len(h) - width + 1] == owner[width - 1:]
            place = _distinct((np.arange(len(inside)) + first_minimum(h, width) % (width - prefix + 1))[inside])
            hashes, text = window_hashes(h, prefix)[place].view(np.int64), owner[place]
            order = np.lexsort((hashes, text))
            hashes, text = hashes[order], text[order]
            new = np.append(True, (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])) if len(order) else np.empty(0, bool)
            count = np.diff(np.append(np.flatnonzero(new), len(order))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(hashes[new]), pa.array(keys[at:end][text[new]]), pa.array(count)], ["prefix", "text_key", "places"])


SUFFIX = "prefix long, doc_id long, text_key long, position int, windows int, around binary"
WINDOWS = "array<struct<a:bigint,b:bigint>>"
PLACES = f"array<struct<a:bigint,b:bigint,off:int,n:int,windows:{WINDOWS}>>"
RUNS = f"a long, b long, doc_id long, text_key long, starts array<int>, n int, places {PLACES}"


def _digests(raw: bytes, starts: np.ndarray, stops: np.ndarray) -> list[bytes]:
    """128 hash bits of each range of 64-bit word hashes."""
    return [xxhash.xxh3_128_digest(raw[8 * i:8 * j]) for i, j in zip(starts.tolist(), stops.tolist())]


def _halves(digests: list[bytes]) -> list[pa.Array]:
    both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    return [pa.array(both[:, 0]), pa.array(both[:, 1])]


def _list(values: pa.Array, first: np.ndarray, total: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(first, total).astype(np.int32)), values)


def _suffixes_of(h: np.ndarray, at: np.ndarray, distinct: np.ndarray, keys: np.ndarray, own: np.ndarray, reach: int, span: int) -> tuple:
    """prefixes, positions, windows (bit l: the one that starts l words before the anchor) and
    32-bit hashes of the words around, for the anchors where ``own`` holds."""
    small = distinct[own]
    starts = np.flatnonzero(np.isin(at, small))
    bits = np.zeros(len(small), np.int32)
    np.bitwise_or.at(bits, np.searchsorted(small, at[starts]), (1 << (at[starts] - starts)).astype(np.int32))
    edge = np.zeros(reach, np.uint32)
    short = np.concatenate((edge, (h >> np.uint64(32)).astype(np.uint32), edge))
    around = np.ascontiguousarray(sliding_window_view(short, span)[small]).tobytes()
    return keys[own], small.astype(np.int32), bits, around


def _runs_of(h: np.ndarray, at: np.ndarray, distinct: np.ndarray, hashes: np.ndarray, hot: np.ndarray, width: int) -> list[pa.Array]:
    """Columns a, b, starts, n, places of the distinct runs of neighbouring anchors among the places ``hot``.

    Each level has 128 hash bits of the words that its windows cover and the number of
    windows. A run that a text repeats is one row with the starts of all; places and
    windows are told by their distance from the run's start.
    """
    # An anchor's windows start one after the other.
    start, stop = np.searchsorted(at, distinct[hot], "left"), np.searchsorted(at, distinct[hot], "right")
    ends_run = (hashes[hot] >> np.uint64(7)) % np.uint64(RUN) == 0
    new = np.ones(len(hot), bool)
    new[1:] = (np.diff(hot) != 1) | ends_run[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(hot)) - 1
    raw = h.tobytes()
    found: dict[bytes, list[int]] = {}
    for i, digest in enumerate(_digests(raw, start[first], stop[last] + width - 1)):
        found.setdefault(digest, []).append(i)
    own = np.array([runs[0] for runs in found.values()])
    starts = [start[first[runs]] for runs in found.values()]
    # From here on one run of each kind counts.
    anchors_in = last[own] - first[own] + 1
    begin_run = np.cumsum(anchors_in) - anchors_in
    pick = np.arange(anchors_in.sum()) - np.repeat(begin_run - first[own], anchors_in)
    size = stop[pick] - start[pick]
    total = int(size.sum())
    begin = np.cumsum(size) - size
    window = np.arange(total) - np.repeat(begin - start[pick], size)
    pair = [pa.array(window_hashes(h, width, seed)[window].view(np.int64)) for seed in (1, 2)]
    windows = _list(pa.StructArray.from_arrays(pair, ["a", "b"]), begin, total)
    off = start[pick] - np.repeat(start[first[own]], anchors_in)
    columns = [*_halves(_digests(raw, start[pick], stop[pick] + width - 1)), pa.array(off.astype(np.int32)), pa.array(size.astype(np.int32)), windows]
    places = _list(pa.StructArray.from_arrays(columns, ["a", "b", "off", "n", "windows"]), begin_run, len(pick))
    many = np.cumsum([0, *map(len, starts)])
    return [*_halves(list(found)), _list(pa.array(np.concatenate(starts).astype(np.int32)), many[:-1], int(many[-1])),
            pa.array((stop[last] - start[first])[own].astype(np.int32)), places]


def _shared(batches: Iterator[pa.RecordBatch], width: int, prefix: int, schema: pa.Schema, runs: bool) -> Iterator[pa.RecordBatch]:
    """Texts with their shared prefixes -> suffixes of small groups, or ``runs`` of overfull ones."""
    reach = width - prefix
    span, held, none = 2 * reach + prefix, [], np.empty(0, np.int64)

    def suffixes() -> pa.RecordBatch:
        prefixes, docs, keys, places, bits, near = zip(*held)
        held.clear()
        numbers = [pa.array(np.concatenate(c)) for c in (prefixes, docs, keys, places, bits)]
        n = len(numbers[0])
        offsets = (np.arange(n + 1) * (4 * span)).astype(np.int32)
        around = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(near))])
        return pa.RecordBatch.from_arrays([*numbers, around], schema=schema)

    for batch in batches:
        docs, text_keys = (batch.column(c).to_pylist() for c in ("doc_id", "text_key"))
        for begin, end, every, starts, begins in hashed_texts(batch.column("text")):
            bounds = np.append(np.searchsorted(starts, begins), len(every)).tolist()
            for i in range(begin, end):
                h, doc, text_key = every[bounds[i - begin]:bounds[i - begin + 1]], docs[i], text_keys[i]
                chosen = batch.column("prefixes")[i].values.to_numpy()
                large = batch.column("overfull")[i].values.to_numpy(zero_copy_only=False).astype(bool)
                at, distinct, hashes = anchors(h, width, prefix)
                keys = hashes.view(np.int64)
                own = none if runs else np.isin(keys, chosen[~large])
                if own.any():
                    k, position, bits, around = _suffixes_of(h, at, distinct, keys, own, reach, span)
                    held.append((k, np.full(len(k), doc, np.int64), np.full(len(k), text_key, np.int64), position, bits, around))
                if len(held) >= 256:
                    yield suffixes()
                hot = np.flatnonzero(np.isin(keys, chosen[large])) if runs else none
                if len(hot):
                    a, b, *rest = _runs_of(h, at, distinct, hashes, hot, width)
                    ids = [pa.array(np.full(len(a), x, np.int64)) for x in (doc, text_key)]
                    yield pa.RecordBatch.from_arrays([a, b, *ids, *rest], schema=schema)
        if held:
            yield suffixes()


def covered_by_tree(group: np.ndarray, doc: np.ndarray, windows: np.ndarray, around: np.ndarray, width: int, reach: int) -> np.ndarray:
    """Bit l of a row: the window that starts l words left of its anchor repeats one of a smaller document.

    Builds the trees of whole groups at once: the suffixes are sorted by group,
    offset, words and document; runs with a common prefix of ``width`` words are
    the nodes at that depth.
    """
    rows, offsets = [], []
    for left in range(reach + 1):
        r = np.flatnonzero(windows >> left & 1)
        rows.append(r)
        offsets.append(np.full(len(r), left))
    row, left = np.concatenate(rows), np.concatenate(offsets)
    words = np.empty((len(row), width), np.uint32)
    for i in range(width):
        words[:, i] = around[row, reach - left + i]
    order = np.lexsort((doc[row], *[words[:, i] for i in range(width - 1, -1, -1)], left, group[row]))
    row, left, words = row[order], left[order], words[order]
    g, d = group[row], doc[row]
    # Depth of the node that joins a suffix with the one before it: all words equal or not.
    deep = np.zeros(len(row), bool)
    deep[1:] = (g[1:] == g[:-1]) & (left[1:] == left[:-1]) & (words[1:] == words[:-1]).all(axis=1)
    node = np.cumsum(~deep) - 1
    smallest = d[~deep][node] if len(row) else d
    out = np.zeros(len(doc), np.int32)
    hit = d > smallest
    np.bitwise_or.at(out, row[hit], (1 << left[hit]).astype(np.int32))
    return out


def _trees(batches: Iterator[pa.RecordBatch], width: int, prefix: int, chunk_rows: int = 40_000) -> Iterator[pa.RecordBatch]:
    """Suffixes sorted by prefix -> (doc, position, covered windows); whole groups at a time."""
    reach = width - prefix
    held: list[pa.RecordBatch] = []

    def grow(table: pa.Table) -> pa.RecordBatch | None:
        around = np.frombuffer(b"".join(table["around"].to_pylist()), np.uint32).reshape(table.num_rows, 2 * reach + prefix)
        doc, text_key, position = (table[c].to_numpy() for c in ("doc_id", "text_key", "position"))
        hit = covered_by_tree(table["prefix"].to_numpy(), doc, table["windows"].to_numpy(), around, width, reach)
        keep = np.flatnonzero(hit)
        if len(keep):
            return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (doc, text_key, position, hit)], ["doc_id", "text_key", "position", "covered"])
        return None

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= chunk_rows:
            table = pa.Table.from_batches(held)
            key = table["prefix"].to_numpy()
            cut = len(key) - int((key == key[-1]).sum())  # the last group may go on
            if cut:
                if (out := grow(table.slice(0, cut))) is not None:
                    yield out
                held = table.slice(cut).combine_chunks().to_batches()
    if held and sum(b.num_rows for b in held):
        if (out := grow(pa.Table.from_batches(held))) is not None:
            yield out


def _cut(batches: Iterator[pa.RecordBatch], width: int, prefix: int, full: bool) -> Iterator[pa.RecordBatch]:
    reach = width - prefix
    for batch in batches:
        rows = []
        for doc, key, text, marks in zip(*[batch.column(n) for n in ("doc_id", "text_key", "text", "marks")]):
            w = words_of(text.as_py())
            edge = np.zeros(len(w) + 1, np.int64)
            positions = marks.values.field("positions")
            many = positions.value_lengths().to_numpy(zero_copy_only=False)
            at = positions.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            bits, runs = (np.repeat(marks.values.field(c).to_numpy(zero_copy_only=False).astype(np.int64), many) for c in ("covered", "n"))
            np.add.at(edge, at[runs > 0], 1)
            np.add.at(edge, (at + runs + width - 1)[runs > 0], -1)
            for left in range(reach + 1):
                starts = at[bits >> left & 1 == 1] - left
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + width, -1)
            stays = np.cumsum(edge[:-1]) == 0
            kept = b" ".join([x for x, s in zip(w, stays.tolist()) if s])
            rows.append((doc.as_py(), key.as_py(), int(len(w) - stays.sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if full else None))
        columns = list(zip(*rows)) if rows else [[]] * 5
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "text_key", "n_removed", "kept_sha256", "kept_text"])


def _text_key(text: Column) -> Column:
    return F.xxhash64(text, F.lit(29))


def _smallest(rows: DataFrame) -> DataFrame:
    """The smallest document of each key that several documents have; a table of its own, so that
    a join with it may split the rows of a frequent key."""
    low = rows.groupBy("a", "b").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").drop("high")
    return write_shared(low, "smallest")


def _settle(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(rows that a smaller document has as well, rows that go on to shorter keys)."""
    known = write_shared(rows.join(_smallest(rows), ["a", "b"], "left"), name)
    return known.where("doc_id > low"), known.where("low is null or doc_id <= low").drop("low")


def repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, prefix: int = PREFIX,
            group_rows: int = GROUP_ROWS, full: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records of all rows with the first document of their words, cut texts).

    records: doc_id, text_key, n_words, sha, first (smallest id with the same
    words). cut: doc_id, text_key, n_removed, kept_sha256, kept_text for the
    first documents that lose words to windows.
    """
    if not 0 < prefix <= width or width - prefix > 30:
        raise ValueError("prefix must be from 1 to width and at most 30 words shorter")
    text = F.coalesce(df[text_col].cast("string"), F.lit(""))
    source = df.select(df[id_col].cast("long").alias("doc_id"), _text_key(text).alias("text_key"), text.cast("binary").alias("text"))
    records = write_shared(source.mapInArrow(_records, "doc_id long, text_key long, n_words long, sha string"), "records")
    firsts = records.where("doc_id is not null").groupBy("sha").agg(F.min(F.struct("doc_id", "text_key")).alias("first"), F.max("n_words").alias("n"))
    starts = source.where("doc_id is not null").select("text_key", "text").mapInArrow(
        partial(_prefixes, width=width, prefix=prefix), "prefix long, text_key long, places int")
    # Texts are told apart by their key, so copies of one text share nothing with each other here.
    shared = starts.groupBy("prefix").agg(F.min("text_key").alias("low"), F.max("text_key").alias("high"), F.sum("places").alias("n")).where("low <> high")
    wanted = (starts.select("prefix", "text_key").join(shared.select("prefix", (F.col("n") > group_rows).alias("overfull")), "prefix")
              .groupBy("text_key").agg(F.collect_set(F.struct("prefix", "overfull")).alias("p")))
    wanted = firsts.select("first.doc_id", "first.text_key").join(wanted, "text_key").select(
        "doc_id", "text_key", F.col("p.prefix").alias("prefixes"), F.col("p.overfull").alias("overfull"))
    texts = write_shared(source.join(wanted, ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"]), "suffix-texts")

    def shared_of(rows: DataFrame, ddl: str, runs: bool) -> DataFrame:
        fields = T.StructType.fromDDL(ddl)
        return rows.mapInArrow(partial(_shared, width=width, prefix=prefix, schema=to_arrow_schema(fields), runs=runs), fields)

    # Two passes over the texts cost less disk than a table of both.
    small = (shared_of(texts.where(F.exists("overfull", lambda x: ~x)), SUFFIX, False)
             .repartition("prefix").sortWithinPartitions("prefix")
             .mapInArrow(partial(_trees, width=width, prefix=prefix), "doc_id long, text_key long, position int, covered int"))
    hot = write_shared(shared_of(texts.where(F.exists("overfull", lambda x: x)), RUNS, True), "runs")
    covered, rest = _settle(hot, "runs")
    inner = rest.select("doc_id", "text_key", "starts", F.explode("places").alias("p")).select(
        "p.a", "p.b", "doc_id", "text_key", F.expr("transform(starts, s -> s + p.off)").alias("starts"), "p.n", "p.windows")
    covered_places, rest = _settle(inner, "places")
    inner = rest.select("doc_id", "text_key", "starts", F.posexplode("windows").alias("i", "w")).select(
        "w.a", "w.b", "doc_id", "text_key", F.expr("transform(starts, s -> s + i)").alias("starts"), F.lit(1).alias("n"))
    covered_windows = inner.join(_smallest(inner), ["a", "b"]).where("doc_id > low")
    marks = small.select("doc_id", "text_key", F.array("position").alias("positions"), "covered", F.lit(0).alias("n"))
    for rows in (covered, covered_places, covered_windows):
        marks = marks.unionByName(rows.select("doc_id", "text_key", F.col("starts").alias("positions"), F.lit(0).alias("covered"), "n"))
    marks = marks.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("positions", "covered", "n")).alias("marks"))
    cut = texts.select("doc_id", "text_key", "text").join(marks, ["doc_id", "text_key"]).mapInArrow(
        partial(_cut, width=width, prefix=prefix, full=full), "doc_id long, text_key long, n_removed long, kept_sha256 string, kept_text string")
    return records.join(firsts.select("sha", F.col("first.doc_id").alias("first"), F.col("first.text_key").alias("first_key")), "sha", "left"), cut


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", full: bool = False, width: int = WIDTH, **options) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 (and text_key, kept_text if ``full``).

    A word goes if a window that covers it, as a sequence of words, also starts in
    a document of smaller id; windows are judged on the input. A text whose words
    are those of a smaller document loses all of them (if they make a window).
    Windows within one document, or in rows of equal id, do not count against it.
    Null text has no words. Rows with a null id keep all words and remove none.
    Repeated rows give one row each; an empty table gives none; other columns are
    not read. ``kept_text`` is null where nothing was removed.
    """
    records, cut = repeats(df, id_col, text_col, width=width, full=full, **options)
    cut = cut.select(F.col("doc_id").alias("first"), F.col("text_key").alias("first_key"), "n_removed", "kept_sha256", "kept_text")
    whole = (F.col("doc_id") > F.col("first")) & (F.col("n_words") >= width)
    own = F.col("n_removed").isNotNull() & (F.col("doc_id") == F.col("first"))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    out = records.join(cut, ["first", "first_key"], "left").select(
        "doc_id", "text_key", "n_words",
        F.when(whole, F.col("n_words")).when(own, F.col("n_removed")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(whole, empty).when(own, F.col("kept_sha256")).otherwise(F.col("sha")).alias("kept_sha256"),
        F.when(whole, F.lit("")).when(own, F.col("kept_text")).alias("kept_text"))
    return out if full else out.drop("text_key", "kept_text")


def cut_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", **options) -> DataFrame:
    """``df`` with the repeated words cut out of its texts; every row stays.

    Texts that lose words become their kept words joined by one space (``length_col``
    is set to the new length), all others stay as they are.
    """
    changed = remove_repeats(df, id_col, text_col, full=True, **options).where("n_removed > 0").select(
        "doc_id", "text_key", "kept_text").dropDuplicates(["doc_id", "text_key"])
    key = _text_key(F.coalesce(df[text_col].cast("string"), F.lit("")))
    rows = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), df[id_col].cast("long").alias("doc_id"), key.alias("text_key"))
    rows = rows.join(changed, ["doc_id", "text_key"], "left")
    kept, cell = F.col("kept_text"), lambda c: F.col("row").getField(c)
    columns = [F.coalesce(kept, cell(c)).alias(c) if c == text_col
               else F.when(kept.isNotNull(), F.length(kept).cast(t)).otherwise(cell(c)).alias(c) if c == length_col else cell(c).alias(c)
               for c, t in df.dtypes]
    return rows.select(*columns)
