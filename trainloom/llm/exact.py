"""Exact duplicates through an extendible-hash index kept in shared files.

1. Each task hashes its documents and, per Arrow batch, lets one row stand for
   all byte-equal texts (the head); only heads travel with their text.
2. The directory grows as in extendible hashing: a bucket with more bytes than
   its capacity splits on its next hash bit, doubling the directory if needed.
3. Owner tasks take the buckets, read heads in hash order, chain texts whose
   hash collides and compare bytes, and write one index entry per text.
4. Documents look their entry up in the index (a join that AQE can split).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trainloom.llm.common import write_shared

# Fixed value: the characters [\x20\x09-\x0D], which do not count.
IGNORED = b" \t\n\x0b\x0c\r"


def normalise(text: str | None) -> bytes:
    return (text or "").encode().translate(None, IGNORED)


class Directory:
    """Extendible-hash directory over the leading bits of an unsigned 64-bit hash.

    ``cells`` maps each prefix of ``depth`` bits to its bucket; a bucket of
    smaller local depth owns several neighbouring cells, that is, one key range.
    """

    def __init__(self, sizes: dict[int, int], bits: int, capacity: int):
        """sizes: bytes by the leading ``bits`` bits; buckets split while over ``capacity``."""
        self.bits, self.capacity, self.depth = bits, capacity, 0
        self.local = [0]
        self.cells = [0]
        prefixes = [0]  # the leading ``local`` bits of each bucket's cells
        weights = [dict(sizes)]
        open_buckets = [0]
        while open_buckets:
            b = open_buckets.pop()
            if sum(weights[b].values()) <= capacity or self.local[b] == bits or len(weights[b]) < 2:
                continue
            if self.local[b] == self.depth:  # double: every cell becomes two
                self.cells = [c for c in self.cells for _ in (0, 1)]
                self.depth += 1
            self.local[b] += 1
            shift, new = bits - self.local[b], len(self.local)
            self.local.append(self.local[b])
            weights.append({p: n for p, n in weights[b].items() if p >> shift & 1})
            weights[b] = {p: n for p, n in weights[b].items() if not p >> shift & 1}
            # The bucket's cells are one range; its upper half goes to the new bucket.
            prefixes[b], upper = 2 * prefixes[b], 2 * prefixes[b] + 1
            prefixes.append(upper)
            size = 1 << (self.depth - self.local[b])
            self.cells[upper * size:(upper + 1) * size] = [new] * size
            open_buckets += [b, new]


def _heads(batches: Iterator[pa.RecordBatch], id_at: int, text_at: int, key_bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rid, row = batch.column(0).to_pylist(), batch.column(1)
        ids, texts = row.field(id_at), row.field(text_at)
        keys, shas, points, copies = [], [], [], [0] * len(rid)
        best: dict[bytes, int] = {}
        ids = ids.to_pylist()
        for i, text in enumerate(texts):
            text = text.as_py() or ""
            norm = normalise(text)
            digest = hashlib.sha256(norm)
            keys.append(int.from_bytes(digest.digest()[:8], "big", signed=True) >> (64 - key_bits) << (64 - key_bits))
            shas.append(digest.hexdigest())
            points.append(len(text))
            # The head is the row that would stay among the batch's copies.
            j = best.setdefault(norm, i)
            if j != i and _order(points[i], ids[i], rid[i]) < _order(points[j], ids[j], rid[j]):
                copies[i], copies[j] = copies[j], 0
                best[norm] = j = i
            copies[j] += 1
        taken = pa.array([i if n else None for i, n in enumerate(copies)], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(shas), pa.array(points, pa.int32()),
             pa.array(copies, pa.int64()), row.take(taken)], ["rid", "doc_id", "key", "sha", "points", "copies", "row"])


def _order(points: int, doc: int | None, rid: int) -> tuple:
    """Smallest first: most code points, then smallest id (null last), then input order."""
    return -points, doc is None, doc or 0, rid


def _own(batches: Iterator[pa.RecordBatch], text_at: int, with_row: bool) -> Iterator[pa.RecordBatch]:
    """Heads sorted by key -> index entries; holds the texts of one key at a time."""
    key, chain = None, []
    out: list[tuple] = []
    rows: list[pa.Array] = []

    def close() -> None:
        for n, (_, sha, order, size, row) in enumerate(chain):
            out.append((key, n, sha, None if order[1] else order[2], order[3], size))
            rows.append(row)
        chain.clear()

    def emit() -> pa.RecordBatch:
        types = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
        names = ["key", "chain", "sha", "keep_id", "keep_rid", "group_size"]
        if with_row:
            columns.append(pa.concat_arrays(rows))
            names.append("row")
        out.clear()
        rows.clear()
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("key", "sha", "points", "doc_id", "rid", "copies")]
        row = batch.column("row")
        texts = row.field(text_at)
        for i, (k, sha, points, doc, rid, copies) in enumerate(zip(*columns)):
            if k != key:
                close()
                key = k
            norm, order = normalise(texts[i].as_py()), _order(points, doc, rid)
            for entry in chain:
                if entry[0] == norm:
                    entry[3] += copies
                    if order < entry[2]:
                        entry[2], entry[4] = order, row.slice(i, 1)
                    break
            else:
                chain.append([norm, sha, order, copies, row.slice(i, 1)])
        if len(out) >= 2_000:
            yield emit()
    close()
    if out:
        yield emit()


def build_index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_rows: bool = False,
                bucket_bytes: int = 16 << 20, key_bits: int = 64, max_depth: int = 16) -> tuple[DataFrame, DataFrame]:
    """(records, index) tables in the shared folder.

    records: rid, doc_id, key, sha for every row. index: key, chain, sha, keep_id,
    keep_rid, group_size per distinct normalised text and, with ``keep_rows``,
    ``row`` (the whole row that stays).
    """
    columns = df.columns if keep_rows else [id_col, text_col]
    row = F.struct(*[df[c].cast("long").alias(c) if c == id_col else df[c].cast("string").alias(c) if c == text_col else df[c] for c in columns])
    source = df.select(F.monotonically_increasing_id().alias("rid"), row.alias("row"))
    id_at, text_at = columns.index(id_col), columns.index(text_col)
    schema = T.StructType.fromDDL("rid long, doc_id long, key long, sha string, points int, copies long").add("row", source.schema["row"].dataType)
    records = write_shared(source.mapInArrow(partial(_heads, id_at=id_at, text_at=text_at, key_bits=key_bits), schema), "records")
    heads = records.where("copies > 0")
    prefix = F.shiftrightunsigned("key", 64 - max_depth)
    # At most 2**max_depth sums reach the driver.
    sizes = heads.groupBy(prefix.alias("prefix")).agg(F.sum(F.octet_length(F.col("row")[text_col]) + 64).alias("bytes")).collect()
    directory = Directory({int(r["prefix"]): int(r["bytes"] or 64) for r in sizes}, max_depth, bucket_bytes)
    cells = df.sparkSession.range(1).select(F.posexplode(F.split(F.lit(",".join(map(str, directory.cells))), ",")).alias("cell", "bucket"))
    cell = F.shiftrightunsigned("key", 64 - directory.depth).cast("int") if directory.depth else F.lit(0)
    owned = (heads.withColumn("cell", cell).join(F.broadcast(cells), "cell").repartition("bucket").sortWithinPartitions("key")
             .select("key", "sha", "points", "doc_id", "rid", "copies", "row"))
    entry = T.StructType.fromDDL("key long, chain int, sha string, keep_id long, keep_rid long, group_size long")
    if keep_rows:
        entry = entry.add("row", source.schema["row"].dataType)
    index = write_shared(owned.mapInArrow(partial(_own, text_at=text_at, with_row=keep_rows), entry), "index")
    return records.select("rid", "doc_id", "key", "sha"), index


def find_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, chain.

    Texts are equal when identical without the ignored white space. The row with
    the most code points stays, then the smallest id (null ids last), then the
    first in the input, so exactly one row of each group stays even if rows
    repeat. Null text counts as empty; empty texts form one group. An empty table
    gives no row; other columns are not read.
    """
    records, index = build_index(df, id_col, text_col, **options)
    entries = index.select("key", "sha", "chain", "keep_id", "keep_rid", "group_size")
    return (records.join(entries, ["key", "sha"])
            .select("doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"),
                    F.col("sha").alias("text_sha256"), "chain"))


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``df`` with one row of each group of equal texts (the one ``find_copies`` keeps)."""
    _, index = build_index(df, id_col, text_col, keep_rows=True, **options)
    return index.select(*[F.col("row")[c].cast(t).alias(c) for c, t in df.dtypes])

