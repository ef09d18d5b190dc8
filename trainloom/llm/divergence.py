"""How far the sources of a language differ in their terms, exactly.

1. Tasks count terms by language and source (and the documents that hold them);
   counts are summed by language and term, and rare terms go.
2. Part ``pair``: most terms are missing from one source of a pair or from both. For
   these the sum needs only how many terms of a source have each rate; the terms that
   several sources share add a correction, computed in blocks of whole terms.
3. Part ``term``: the value rises with the group's count and falls with the language's
   count, so a term that ``k`` others dominate (higher group count, lower language
   count, earlier in UTF-8) is not among the first ``k``. Partitions keep their
   skyband, skybands are merged, and what is left is ranked exactly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trainloom.llm.common import write_shared

SCALE, K = 1_000_000_000, 200
# Fixed value: terms are runs of the letters a to z and of characters beyond ASCII; only A to Z change case.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


COUNTS = "lang string, source string, term string, n long, docs long"


def _counts(batches: Iterator[pa.RecordBatch], held_entries: int = 700_000) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents by language, source and term, summed over part of a task."""
    held: dict[tuple, tuple[Counter, Counter]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            if n:
                terms = list(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(terms)), pa.array([source] * len(terms)), pa.array(terms, pa.binary()).cast(pa.string()),
                     pa.array(n.values(), pa.int64()), pa.array([docs[t] for t in terms], pa.int64())], ["lang", "source", "term", "n", "docs"])
        held.clear()

    size = 0
    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            terms, before = terms_of(text.as_py()), len(n)
            n.update(terms)
            docs.update(set(terms))
            size += len(n) - before
            if size >= held_entries:
                yield from out()
                size = 0
    yield from out()


def skyband(group: np.ndarray, lang: np.ndarray, place: np.ndarray, k: int, block: int = 1_024, cells: int = 64) -> np.ndarray:
    """Rows that fewer than ``k`` others dominate.

    A row is dominated by one with at least its ``group`` value, at most its ``lang``
    value, and a smaller ``place`` (places differ). Rows are taken in order of falling
    group value; what dominates a row comes before it. If ``k`` rows dominate it, then
    ``k`` kept ones do, so each block is held against kept rows and itself only: first
    through a coarse grid of counts, then one by one.
    """
    order = np.lexsort((place, lang, -group))
    at = np.linspace(0, max(0, len(order) - 1), cells).astype(np.int64)
    edge_l, edge_p = np.sort(lang)[at] if len(order) else lang, np.sort(place)[at] if len(order) else place
    grid = np.zeros((cells + 1, cells + 1), np.int64)
    kept_l, kept_p, kept = np.empty(0, lang.dtype), np.empty(0, place.dtype), []
    for start in range(0, len(order), block):
        rows = order[start:start + block]
        # Kept rows in lower cells dominate for certain.
        sure = grid.cumsum(0).cumsum(1)
        i, j = np.searchsorted(edge_l, lang[rows], "right"), np.searchsorted(edge_p, place[rows], "left")
        n = np.where((i > 0) & (j > 0), sure[i - 1, j - 1], 0)
        rows = rows[n < k]
        x, y = lang[rows], place[rows]
        n = ((kept_l <= x[:, None]) & (kept_p < y[:, None])).sum(1)
        n += ((x <= x[:, None]) & (y < y[:, None]) & np.tri(len(rows), k=-1, dtype=bool)).sum(1)
        new = rows[n < k]
        kept.append(new)
        kept_l, kept_p = np.concatenate((kept_l, lang[new])), np.concatenate((kept_p, place[new]))
        np.add.at(grid, (np.searchsorted(edge_l, lang[new], "left"), np.searchsorted(edge_p, place[new], "left")), 1)
    return np.concatenate(kept) if kept else np.empty(0, np.int64)


def _skybands(batches: Iterator[pa.RecordBatch], k: int, chunk_rows: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """The skyband of each (lang, source) among the rows of a task; holds a chunk and the rows kept so far."""
    held: list[pa.RecordBatch] = []

    def reduce() -> pa.Table:
        table = pa.Table.from_batches(held).combine_chunks()
        place = pc.rank(table["term"], tiebreaker="first").to_numpy().astype(np.int64)
        key = [pc.rank(table[c], tiebreaker="dense").to_numpy().astype(np.int64) for c in ("lang", "source")]
        key = key[0] << 32 | key[1]
        order = np.argsort(key, kind="stable")
        n, of_lang, rows = table["n"].to_numpy(), table["of_lang"].to_numpy(), []
        for own in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
            rows.append(own[skyband(n[own], of_lang[own], place[own], k)])
        return table.take(np.concatenate(rows))

    new = 0
    for batch in batches:
        held.append(batch)
        new += batch.num_rows
        if new >= chunk_rows:
            table = reduce()
            # What many groups have kept goes on as it is; the next merge sees it again.
            if table.num_rows >= 4 * chunk_rows:
                yield from table.to_batches(max_chunksize=20_000)
                held, new = [], 0
            else:
                held, new = table.to_batches(), 0
    if sum(b.num_rows for b in held):
        yield from reduce().to_batches(max_chunksize=20_000)


PAIR = "lang string, source string, item string, value long"


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _shared(batches: Iterator[pa.RecordBatch], chunk_rows: int = 100_000, tile: int = 128, cells: int = 500_000) -> Iterator[pa.RecordBatch]:
    """Correction by pair of sources for the terms that both have; rows come sorted by language and term."""
    held: list[pa.RecordBatch] = []

    def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for lang in table["lang"].unique().to_pylist():
            own = table.filter(pc.equal(table["lang"], lang))
            names, terms = own["source"].combine_chunks().dictionary_encode(), own["term"].combine_chunks().dictionary_encode()
            source, term = names.indices.to_numpy(), terms.indices.to_numpy()
            p, absent = own["p"].to_numpy(), np.zeros(len(names.dictionary), np.int64)
            absent[source] = own["p0"].to_numpy()
            n_sources, total = len(absent), {}
            step = max(1, cells // n_sources)
            for start in range(0, len(terms.dictionary), step):
                here = (term >= start) & (term < start + step)
                rate = np.repeat(absent[:, None], min(step, len(terms.dictionary) - start), 1)
                rate[source[here], term[here] - start] = p[here]
                some = rate != absent[:, None]
                for a in range(n_sources):
                    for b in range(0, n_sources, tile):
                        q, q0 = rate[b:b + tile], absent[b:b + tile, None]
                        seen = np.flatnonzero((some[a] & some[b:b + tile]).any(0))
                        x, q = rate[a, seen], q[:, seen]
                        extra = (_gap(x, q) - _gap(x, q0) - _gap(absent[a], q) + _gap(absent[a], q0)).sum(1)
                        total[a, b] = total.get((a, b), 0) + extra
            for (a, b), extra in total.items():
                keep = [i for i in range(len(extra)) if extra[i] and b + i != a]
                if keep:
                    items = names.dictionary.take([b + i for i in keep])
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keep)), pa.array([names.dictionary[a].as_py()] * len(keep)), items,
                                                      pa.array(extra[keep])], ["lang", "source", "item", "value"])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= chunk_rows:
            table = pa.Table.from_batches(held)
            last = table.slice(table.num_rows - 1)
            end = pc.and_(pc.equal(table["term"], last["term"][0]), pc.equal(table["lang"], last["lang"][0]))
            cut = table.num_rows - pc.sum(end).as_py()  # the last term may go on
            if cut:
                yield from pairs(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
    if sum(b.num_rows for b in held):
        yield from pairs(pa.Table.from_batches(held))


def _rate(n: Column | str, total: Column | str, kept: Column | str) -> Column:
    n, total, kept = (F.col(c) if isinstance(c, str) else c for c in (n, total, kept))
    return F.lit(1) + F.call_function("div", F.lit(SCALE).cast("long") * (n + 1), total + kept)


def _value(p: str, q: str) -> Column:
    p, q = F.col(p), F.col(q)
    return F.call_function("div", (p - q) * (p - q), q)


def audit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = 3, k: int = K, salts: int = 8) -> DataFrame:
    """Rows of two parts: lang, source, part, item, value, rank.

    Null text, language and source count as empty. A language keeps the terms that
    are in at least ``min_docs`` of its documents (every row counts as a document,
    repeated ones too). Each group (language and source that occur, even without
    terms) and each language gives a kept term the rate p = 1 + floor(10**9 * (n + 1) /
    (N + V)), with n its occurrences there, N the sum over kept terms, V their number.
    ``pair``: each other source of the language and the sum of floor((p - q)**2 / q) over
    all kept terms (0 without any). ``term``: the first ``k`` terms with p above the
    language's q. Ranks fall with the value; ties go to the item that is earlier in
    UTF-8. A language with one source has no pair; an empty table gives no row. All
    arithmetic is in whole numbers; other columns are not read.
    """
    part = {c: F.coalesce(df[x].cast("string"), F.lit("")) for c, x in (("lang", lang_col), ("source", source_col))}
    text = F.coalesce(df[text_col].cast("string"), F.lit("")).cast("binary")
    docs = df.select(part["lang"].alias("lang"), part["source"].alias("source"), text.alias("text"))
    # One exchange by language and term serves both the sums by source and those over the sources.
    counts = docs.mapInArrow(_counts, COUNTS).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    kept = (counts.select("lang", "source", "term", "n", F.sum("docs").over(term).alias("docs"), F.sum("n").over(term).alias("of_lang"),
                          F.count("*").over(term).alias("sources"), (F.min("source").over(term) == F.col("source")).alias("first"))
            .where(F.col("docs") >= min_docs).drop("docs"))
    kept = write_shared(kept, "terms")
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if("first").alias("firsts"))
    langs = sums.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("firsts").alias("kept"))
    zero = {"total": 0, "lang_total": 0, "kept": 0}
    groups = (docs.select("lang", "source").distinct().join(sums.drop("firsts"), ["lang", "source"], "left").join(langs, "lang", "left").na.fill(zero))
    groups = write_shared(groups.withColumn("p0", F.when(F.col("kept") > 0, _rate(F.lit(0), "total", "kept"))), "groups")

    rated = kept.join(groups, ["lang", "source"]).withColumn("p", _rate("n", "total", "kept"))
    above = rated.withColumn("q", _rate("of_lang", "lang_total", "kept")).where("p > q").select("lang", "source", "term", "n", "of_lang", _value("p", "q").alias("value"))
    bands = partial(_skybands, k=k)
    first = above.mapInArrow(bands, above.schema).repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(salts)))
    merged = first.mapInArrow(bands, above.schema).repartition("lang", "source").mapInArrow(bands, above.schema)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (merged.select("lang", "source", F.col("term").alias("item"), "value").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
             .select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))

    # Sum over all kept terms as if neither source had any, ...
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    none = F.coalesce(F.col("kept") * _value("p0", "q0"), F.lit(0))
    neither = groups.join(other, "lang").where("source <> item").select("lang", "source", "item", none.alias("value"))
    # ... corrected for the terms of either source as if the other had none of them, ...
    rates = rated.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("terms"))
    either = (rates.join(other, "lang").where("source <> item").groupBy("lang", "source", "item")
              .agg(F.sum(F.col("terms") * (_value("p", "q0") - _value("p0", "q0"))).alias("there"), F.sum(F.col("terms") * (_value("q0", "p") - _value("q0", "p0"))).alias("back")))
    either = either.select("lang", F.explode(F.array(F.struct("source", "item", F.col("there").alias("value")),
                                                     F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("back").alias("value")))).alias("x")).select("lang", "x.*")
    # ... and for those that both have.
    both = (rated.where("sources > 1").select("lang", "term", "source", "p", "p0").repartition("lang", "term").sortWithinPartitions("lang", "term")
            .mapInArrow(_shared, PAIR))
    sums = neither.unionByName(either).unionByName(both).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = sums.withColumn("rank", F.row_number().over(order)).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    return pairs.unionByName(terms)
