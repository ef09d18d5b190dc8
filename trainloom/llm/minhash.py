"""Near duplicates by DartMinHash signatures of weighted word shingles.

A document is a weighted set: its word shingles with their number of
occurrences. Occurrence c of a shingle is the unit region [c, c+1) of the
shingle's weight axis. Darts hit each unit region as a Poisson process of rate
one along the rank axis, derived from hashes alone, so equal regions get equal
darts in every document. Each dart names a coordinate; the signature holds the
earliest dart of each coordinate, and two documents agree in a coordinate with
the probability of their weighted Jaccard similarity.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainloom.llm.common import components, mix64, salted, window_hashes, write_shared

_WORD = re.compile(r"\w+")
SHINGLE, BANDS, ROWS, THRESHOLD = 5, 25, 5, 0.8
PIVOT_ROUNDS, BLOCK_TEXTS, BLOCK_UNITS = 2, 1_000, 1_000_000


def units(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the unit regions: one per (shingle, occurrence).

    Words are runs of letters and digits in lower case. A text of fewer than
    ``width`` words has one shingle, all its words; a text without words has none.
    """
    words = _WORD.findall((text or "").lower())
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    s = np.sort(window_hashes(h, min(width, len(h)), min(width, len(h))))
    first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    if len(first) == len(s):
        return s
    runs = np.diff(np.append(first, len(s)))
    occurrence = np.arange(len(s)) - np.repeat(first, runs)
    return np.sort(np.where(occurrence == 0, s, mix64(s + occurrence.astype(np.uint64) * salted(7))))


def darts(sets: list[np.ndarray], k: int) -> np.ndarray:
    """Signatures (len(sets), k); every set must have a unit region.

    Darts are thrown up to rank t / weight with t = k ln k + 4k, about t per
    document whatever its length; a document that misses a coordinate is thrown
    again to twice the rank, which only adds later darts.
    """
    out = np.zeros((len(sets), k), np.uint64)
    todo, reach = np.arange(len(sets)), k * np.log(k) + 4.0 * k
    while len(todo):
        unit = np.concatenate([sets[i] for i in todo])
        sizes = np.array([len(sets[i]) for i in todo])
        doc = np.repeat(np.arange(len(todo)), sizes)
        limit = np.repeat(reach / sizes, sizes)
        rank = np.zeros(len(unit))
        slots, ranks, names = [], [], []
        n = 0
        while len(unit):
            draw = mix64(unit ^ salted(2 * n + 1))
            # Gaps of a unit-rate process; the top 53 bits give a uniform in (0, 1].
            rank = rank - np.log(((draw >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0 ** -53)
            alive = rank <= limit
            if not alive.all():
                unit, doc, limit, rank, draw = unit[alive], doc[alive], limit[alive], rank[alive], draw[alive]
            name = mix64(draw ^ salted(2 * n + 2) ^ unit)
            slots.append(doc * k + (name % np.uint64(k)).astype(np.int64))
            ranks.append(rank)
            names.append(name)
            n += 1
        slot, rank_all, name_all = np.concatenate(slots), np.concatenate(ranks), np.concatenate(names)
        earliest = np.full(len(todo) * k, np.inf)
        np.minimum.at(earliest, slot, rank_all)
        hit = rank_all == earliest[slot]
        signature = np.zeros(len(todo) * k, np.uint64)
        signature[slot[hit]] = name_all[hit]
        missing = np.isinf(earliest.reshape(-1, k)).any(axis=1)
        out[todo[~missing]] = signature.reshape(-1, k)[~missing]
        todo, reach = todo[missing], reach * 2
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    s = signatures.reshape(len(signatures), bands, rows)
    key = np.broadcast_to(np.array([salted(1000 + b) for b in range(bands)]), s.shape[:2]).copy()
    for r in range(rows):
        key = mix64(key + s[:, :, r])
    return key


def _sign(batches: Iterator[pa.RecordBatch], width: int, bands: int, rows: int, group: int = 1_000, group_units: int = 400_000) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests, texts = batch.column(1), batch.column(2)
        at = 0
        while at < batch.num_rows:
            sets, held, end = [], 0, at
            while end < batch.num_rows and len(sets) < group and held < group_units:
                sets.append(units(texts[end].as_py(), width))
                held += len(sets[-1])
                end += 1
            full = [i for i, s in enumerate(sets) if len(s)]
            keys: list[np.ndarray] = [np.empty(0, np.int64)] * len(sets)
            if full:
                for i, row in zip(full, band_keys(darts([sets[i] for i in full], bands * rows), bands, rows).view(np.int64)):
                    keys[i] = row
            offsets = np.cumsum([0, *map(len, keys)])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(keys)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), digests.slice(at, end - at), lists], ["doc_id", "digest", "bands"])
            at = end


def _units(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            sets = [units(t, width).view(np.int64) for t in part.column(1).to_pylist()]
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()), pa.array(np.concatenate(sets)))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], ["digest", "units"])


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """pairs (a, b) with their exact weighted Jaccard distance ``d`` and ``linked``."""
    left = sets.select(F.col("digest").alias("a"), F.col("units").alias("ua"))
    right = sets.select(F.col("digest").alias("b"), F.col("units").alias("ub"))
    common = F.size(F.array_intersect("ua", "ub"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", common.alias("n"), (F.size("ua") + F.size("ub") - common).alias("u"))
    return both.select("a", "b", (1 - F.col("n") / F.col("u")).alias("d"), (F.col("n") >= threshold * F.col("u") - 1e-9).alias("linked"))


def _cross(group: pa.Table, threshold: float) -> pa.Table:
    """Linked texts of different classes in a group, one link for each text and class.

    Intersections come from an inverted index over the group's unit regions.
    """
    digest, label = group["digest"].to_pylist(), group["label"].to_pylist()
    lists = group["units"].combine_chunks()
    flat = lists.flatten().to_numpy()
    ends = np.cumsum([len(x) for x in lists])
    begins = np.concatenate(([0], ends[:-1]))
    sizes = ends - begins
    _, unit = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)[np.argsort(unit, kind="stable")]
    post = np.concatenate(([0], np.cumsum(np.bincount(unit))))
    _, kind = np.unique(np.array(label, object), return_inverse=True)
    a, b = [], []
    for x in range(len(sizes)):
        mine = unit[begins[x]:ends[x]]
        n = post[mine + 1] - post[mine]
        at = np.arange(n.sum()) + np.repeat(post[mine] - np.concatenate(([0], np.cumsum(n)[:-1])), n)
        common = np.bincount(owner[at], minlength=len(sizes))
        hits = np.flatnonzero((common >= threshold * (sizes + sizes[x] - common) - 1e-9) & (kind != kind[x]) & (sizes > 0))
        for y in hits[np.unique(kind[hits], return_index=True)[1]].tolist():
            a.append(min(digest[x], digest[y]))
            b.append(max(digest[x], digest[y]))
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) after new links: only the classes that they join are relabelled.

    Links become edges between labels, which are far fewer than the links so far
    and near stars, so that few rounds settle them.
    """
    def named(column: str) -> DataFrame:
        return labels.select(F.col("node").alias(column), F.col("label").alias("l" + column))

    edges = links.select("a", "b").join(named("a"), "a", "left").join(named("b"), "b", "left").select(
        F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).where("a <> b")
    moved = components(edges).select(F.col("node").alias("label"), F.col("label").alias("to"))
    old = labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    # A text without links so far is its own label; a class's name is listed under its members.
    fresh = moved.select(F.col("label").alias("node"), F.col("to").alias("label")).join(labels.select("node"), "node", "left_anti")
    return write_shared(old.unionByName(fresh).distinct(), "labels")


def _cross_links(rows: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between texts of different classes that are joined by shared buckets.

    Buckets that still mix classes hang together in clumps. A clump is dealt into
    blocks of about ``BLOCK_TEXTS`` texts or ``BLOCK_UNITS`` unit regions; each pair
    of blocks is compared in one task, so no task holds a whole clump and no pair
    of unlinked texts leaves its task.
    """
    def compare(group: pa.Table) -> pa.Table:
        return _cross(group, threshold)

    hubs = rows.groupBy("band").agg(F.min("digest").alias("hub"))
    clumps = components(rows.join(hubs, "band").where("digest <> hub").select(F.col("digest").alias("a"), F.col("hub").alias("b")))
    texts = (rows.select("digest", "label").distinct()
             .join(clumps.select(F.col("node").alias("digest"), F.col("label").alias("clump")), "digest", "left")
             .select("digest", "label", F.coalesce("clump", "digest").alias("clump")).join(sets, "digest"))
    texts = write_shared(texts, "clumps")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_TEXTS, F.sum(F.size("units")) / BLOCK_UNITS)).cast("int")
    sized = texts.groupBy("clump").agg(blocks.alias("blocks"))
    dealt = texts.join(sized, "clump").withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int")).withColumn(
        "with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return (dealt.select("clump", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "digest", "label", "units")
            .groupBy("clump", "i", "j").applyInArrow(compare, "a binary, b binary"))


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, bands: int = BANDS,
            rows: int = ROWS, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(documents with their digest, nodes with their class) in the shared folder.

    documents: doc_id, digest. nodes: digest, doc (smallest id of that exact
    text), copies, label (digest that names the class). Distinct texts are the
    nodes, so copies cost one row each. Links are exact: two texts that share a
    band and reach the threshold end in one class.

    Rounds: every text of a shared bucket is compared with one pivot (one pair per
    text, not all pairs). Texts in buckets that still mix classes are then compared
    with a member of the bucket's largest class, another one in each round. What is
    still mixed is compared block by block (``_cross_links``).
    """
    digest = F.unhex(F.md5(F.coalesce(df[text_col].cast("string"), F.lit("")).cast("binary")))
    source = df.select(df[id_col].cast("long").alias("doc_id"), digest.alias("digest"), df[text_col].cast("string").alias("text"))
    signed = write_shared(source.mapInArrow(partial(_sign, width=width, bands=bands, rows=rows),
                                            "doc_id long, digest binary, bands array<long>"), "signatures")
    nodes = signed.groupBy("digest").agg(F.min("doc_id").alias("doc"), F.count("*").alias("copies"), F.first("bands").alias("bands"))
    banded = nodes.select("digest", F.explode("bands").alias("band"))
    sized = banded.groupBy("band").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("digest"), "digest"))["digest"].alias("pivot"))
    # Only buckets with two distinct texts matter from here on.
    members = write_shared(banded.join(sized.where("n > 1"), "band").select("band", "digest", "pivot", "n"), "members")
    candidates = members.select("digest").distinct()
    sets = write_shared(source.select("digest", "text").join(candidates, "digest", "left_semi").dropDuplicates(["digest"])
                        .mapInArrow(partial(_units, width=width), "digest binary, units array<long>"), "units")

    def pair_up(x: str, y: str) -> list:
        return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]

    # Each text meets the pivot of smallest hash among those of its buckets.
    nearest = members.groupBy("digest").agg(F.min(F.struct(F.xxhash64("pivot"), "pivot"))["pivot"].alias("pivot"))
    first = nearest.where("digest <> pivot").select(*pair_up("digest", "pivot")).distinct()
    checked = write_shared(_verified(first, sets, threshold), "checked")
    labels = components(checked.where("linked"))
    for turn in range(PIVOT_ROUNDS + 1):
        named = members.join(labels.withColumnRenamed("node", "digest"), "digest", "left").select(
            "band", "digest", F.coalesce("label", "digest").alias("label"))
        per_class = named.groupBy("band", "label").agg(
            F.count("*").alias("m"), F.min(F.struct(F.xxhash64("digest", F.lit(turn)), "digest"))["digest"].alias("other"))
        mixed = per_class.groupBy("band").agg(F.max(F.struct("m", "label", "other")).alias("top"), F.count("*").alias("k")).where("k > 1")
        open_rows = named.join(mixed.select("band", F.col("top.label").alias("big"), F.col("top.other").alias("other")), "band")
        stray = open_rows.where("label <> big")
        if turn < PIVOT_ROUNDS:
            # One member of each class a stray text meets, another in each round.
            met = stray.groupBy("digest", "big").agg(F.min(F.struct(F.xxhash64("other", F.lit(turn)), "other"))["other"].alias("other"))
            pairs = met.select(*pair_up("digest", "other"))
        else:
            linked = write_shared(_cross_links(open_rows.select("band", "digest", "label"), sets, threshold), "cross-links")
            if not linked.isEmpty():
                labels = _merged(labels, linked)
            break
        more = write_shared(_verified(pairs.distinct().join(checked, ["a", "b"], "left_anti"), sets, threshold), "checked")
        checked = checked.unionByName(more)
        if not more.where("linked").isEmpty():
            labels = _merged(labels, more.where("linked"))
    nodes = nodes.select("digest", "doc", "copies").join(labels.withColumnRenamed("node", "digest"), "digest", "left")
    return signed.select("doc_id", "digest"), nodes.select("digest", "doc", "copies", F.coalesce("label", "digest").alias("label"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, class_id (smallest id of its class), class_size, kept.

    Exact copies are in one class. A text without words is alike to nothing but
    its exact copies. Null text counts as empty. A class of null ids only has a
    null class_id; ``kept`` holds for the rows whose id is the class_id (rows
    repeated in id and text count as one document). An empty table gives no row;
    other columns are not read.
    """
    docs, nodes = classes(df, id_col, text_col, **options)
    named = nodes.groupBy("label").agg(F.min("doc").alias("class_id"), F.sum("copies").alias("class_size"))
    nodes = nodes.join(named, "label").select("digest", "class_id", "class_size")
    return docs.select("doc_id", "digest").join(nodes, "digest").select(
        "doc_id", "class_id", F.col("class_size").cast("long").alias("class_size"), F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``df`` with one document of each class: the one with the smallest id (null ids last).

    Null text counts as empty; texts without words are alike to their exact copies only.
    Rows repeated in id and text count as one document, and all of them stay. All columns
    are returned, whatever their names; an empty table gives no row.
    """
    _, nodes = classes(df, id_col, text_col, **options)
    best = nodes.groupBy("label").agg(F.min(F.struct(F.col("doc").isNull(), "doc", "digest")).alias("best"))
    # Only texts that lose a row are listed: members that are not the best, and texts with copies.
    first = F.col("digest") == F.col("best.digest")
    listed = nodes.join(best, "label").where("copies > 1 or digest <> best.digest").select(
        "digest", F.when(first, F.col("doc")).alias("keep"), first.alias("is_best"))
    text = F.coalesce(df[text_col].cast("string"), F.lit("")).cast("binary")
    rows = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), F.unhex(F.md5(text)).alias("digest"))
    stays = F.col("is_best").isNull() | (F.col("is_best") & F.col("row").getField(id_col).eqNullSafe(F.col("keep")))
    return rows.join(listed, "digest", "left").where(stays).select(*[F.col("row").getField(c).alias(c) for c in df.columns])
