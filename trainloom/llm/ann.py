"""Approximate nearest neighbours with a hash-prefix forest (LSH forest).

Rows are dealt into blocks of bounded size, and the distinct vectors of a block
into bands of similar length. In each band every tree is a sorted
array of long hash strings (signs of random projections). A query descends each
tree to its longest matching prefix, then all trees ascend together, one bit at a
time, until enough distinct candidates share a prefix with the query. Candidates
are scored exactly. Rows the trees did not give are scored too unless an upper
bound of their inner product lies below the k-th best found, so none of the k
nearest is missed; the best of all blocks are merged.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trainloom.llm.common import write_shared

TREES, BITS, BLOCK_ROWS, CANDIDATES, QUERY_ROWS = 128, 24, 8192, 3600, 2048
# A band goes down to this share of its longest row, but has some rows at least.
BAND, BAND_ROWS, SKETCH = 0.8, 256, 16


class Forest:
    """Sorted hash strings of the rows of ``x`` for each tree."""

    def __init__(self, x: np.ndarray, trees: int, bits: int, seed: int = 17):
        self.x, self.trees, self.bits = x, trees, bits
        norms = np.sqrt((x * x).sum(axis=1))
        self.longest = norms.max()
        # One more dimension makes all rows equally long, so that the angle to a
        # query orders rows as the inner product does.
        rest = np.sqrt(np.maximum(0.0, 1.0 - (norms / self.longest) ** 2))
        rng = np.random.default_rng(seed)
        self.planes = rng.standard_normal((x.shape[1] + 1, trees * bits)).astype(np.float32)
        codes = self._codes(np.column_stack([x / self.longest, rest])).T
        self.order = np.argsort(codes, axis=1, kind="stable")  # (trees, rows)
        self.codes = np.take_along_axis(codes, self.order, axis=1)

    def _codes(self, y: np.ndarray) -> np.ndarray:
        """Hash strings as integers, most significant bit first: (rows, trees)."""
        weights = (1 << np.arange(self.bits - 1, -1, -1)).astype(np.int64)
        out = np.empty((len(y), self.trees), np.int64)
        for at in range(0, len(y), 1024):
            signs = (y[at:at + 1024].astype(np.float32) @ self.planes > 0).reshape(-1, self.trees, self.bits)
            out[at:at + 1024] = signs @ weights
        return out

    def candidates(self, queries: np.ndarray, wanted: int):
        """Yield, per query, the row numbers found by descending and ascending."""
        norms = np.maximum(np.sqrt((queries * queries).sum(axis=1)), 1e-300)
        codes = np.ascontiguousarray(self._codes(np.column_stack([queries / norms[:, None], np.zeros(len(queries))])).T)
        # By bits dropped from the end of the prefix; longer prefixes than any query needs are left out.
        low, high, total = {}, {}, {}
        for drop in range(self.bits, -1, -1):
            first = codes >> drop << drop
            low[drop] = np.stack([np.searchsorted(c, f, "left") for c, f in zip(self.codes, first)], 1)
            high[drop] = np.stack([np.searchsorted(c, f, "left") for c, f in zip(self.codes, first + (1 << drop))], 1)
            total[drop] = (high[drop] - low[drop]).sum(axis=1)
            if (total[drop] < wanted).all():
                break
        for q in range(len(queries)):
            seen = np.zeros(len(self.x), bool)
            for drop in sorted(low):
                if total[drop][q] < wanted:
                    continue
                for order, b, h in zip(self.order, low[drop][q].tolist(), high[drop][q].tolist()):
                    seen[order[b:h]] = True
                if np.count_nonzero(seen) >= wanted:
                    break
            yield np.flatnonzero(seen)


def bands(norms: np.ndarray) -> list[np.ndarray]:
    """Row numbers by length, longest band first."""
    order = np.argsort(-norms, kind="stable")
    falling, out, at = -norms[order], [], 0
    while at < len(order):
        end = max(int(np.searchsorted(falling, falling[at] * BAND, "right")), at + BAND_ROWS)
        end = len(order) if len(order) - end < BAND_ROWS else end
        out.append(np.sort(order[at:end]))
        at = end
    return out


def sketches(x: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Short rows whose inner products bound those of ``x`` and ``queries`` from above:
    the leading directions of ``x``, and the length of what these leave."""
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :SKETCH]

    def short(y: np.ndarray) -> np.ndarray:
        part = y @ axes
        return np.column_stack([part, np.sqrt(np.square(y - part @ axes.T).sum(axis=1))])

    return short(x), short(queries)


def shortlists(x: np.ndarray, queries: np.ndarray, k: int, trees: int, bits: int, share: float) -> list[np.ndarray]:
    """Per query, numbers of rows of ``x`` (distinct) that hold its ``k`` nearest.

    Each band's forest gives ``share`` of the band or more. The k-th best so far is
    the floor: bands and rows that cannot reach it are left out.
    """
    norms, lengths = np.sqrt((x * x).sum(axis=1)), np.sqrt((queries * queries).sum(axis=1))
    out: list[list[np.ndarray]] = [[] for _ in queries]
    tops, floors = [np.empty(0)] * len(queries), np.full(len(queries), -np.inf)
    for rows in bands(norms):
        y = x[rows]
        slack = 1e-9 * norms[rows].max() * lengths
        near = np.flatnonzero(norms[rows].max() * lengths + slack >= floors)
        if not len(near):
            continue
        left, right = sketches(y, queries[near])
        for i, (q, found) in enumerate(zip(near.tolist(), Forest(y, trees, bits).candidates(queries[near], int(np.ceil(share * len(y)))))):
            unseen = np.ones(len(y), bool)
            for _ in range(2):  # what the trees gave, then what they may have missed
                unseen[found] = False
                scores = y[found] @ queries[q]
                merged = np.concatenate([tops[q], scores])
                tops[q] = np.partition(merged, len(merged) - k)[len(merged) - k:] if len(merged) > k else merged
                floors[q] = tops[q].min() if len(tops[q]) == k else -np.inf
                out[q].append(rows[found[scores + slack[q] >= floors[q]]])
                found = np.flatnonzero(unseen & (left @ right[i] + slack[q] >= floors[q]))
    return [np.concatenate(r) for r in out]


def best(x: np.ndarray, ids: np.ndarray, rows: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k rows of largest inner product with ``q`` (ties: smaller id), and those products."""
    quick = x[rows] @ q
    if len(rows) > k:
        floor = np.partition(quick, len(quick) - k)[len(quick) - k]
        rows = rows[quick >= floor - 1e-9 * (1.0 + abs(floor))]
    exact = (x[rows] * q).sum(axis=1)
    order = np.lexsort((ids[rows], -exact))[:k]
    return rows[order], exact[order]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _search(items: pa.Table, queries: pa.Table, k: int, trees: int, bits: int, share: float) -> pa.Table:
    out: dict[str, list] = {"query_rid": [], "query_id": [], "vec_id": [], "score": []}
    if items.num_rows and queries.num_rows:
        items = items.sort_by("rid")
        x, ids, rids = _matrix(items["vec"]), items["vec_id"].to_numpy(), items["rid"].to_numpy()
        qs, q_ids, q_rids = _matrix(queries["vec"]), queries["vec_id"].to_pylist(), queries["rid"].to_pylist()
        # Copies count once in the forest; of each vector the k + 1 smallest ids can be among the results.
        _, vector = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, x.itemsize * x.shape[1]))).ravel(), return_inverse=True)
        order = np.lexsort((ids, vector))
        starts = np.searchsorted(vector[order], np.arange(vector.max() + 2))
        for i, found in enumerate(shortlists(x[order[starts[:-1]]], qs, k + 1, trees, bits, share)):
            nth = np.arange(k + 1) + starts[found][:, None]
            rows = order[nth[nth < starts[found + 1][:, None]]]
            rows = rows[rids[rows] != q_rids[i]]
            rows, scores = best(x, ids, rows, qs[i], k)
            out["query_rid"] += [q_rids[i]] * len(rows)
            out["query_id"] += [q_ids[i]] * len(rows)
            out["vec_id"] += ids[rows].tolist()
            out["score"] += scores.tolist()
    types = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
    return pa.table({n: pa.array(v, t) for (n, v), t in zip(out.items(), types)})


def search(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
           trees: int = TREES, bits: int = BITS, block_rows: int = BLOCK_ROWS, candidates: int = CANDIDATES) -> DataFrame:
    """The ``k`` nearest rows by inner product of each row where ``is_query`` holds.

    Returns query_id, rank (from 1), vec_id, score (inner product in double
    precision on the original vectors). Every row but the query's own is a
    candidate, rows of equal id included; ties go to the smaller id. The trees give
    ``candidates`` of ``block_rows`` rows, the same share of smaller blocks and bands.

    Rows take no part if the id or the vector is null, if a component is null or
    not finite, if all are zero, or if the length differs from the commonest one
    (ties: the larger). Fewer than ``k`` others give all of them; an empty table
    gives no row; other columns are not read.

    The query set meets all rows block by block, so each row of the result needs
    one block in memory; blocks are formed from pinned row numbers.
    """
    vector = df[vector_col].cast("array<double>")
    usable = (df[id_col].isNotNull() & vector.isNotNull() & (F.size(vector) > 0)
              & F.forall(vector, lambda c: c.isNotNull() & (F.abs(c) < float("inf"))) & F.exists(vector, lambda c: c != 0))
    rows = write_shared(df.where(usable).select(df[id_col].cast("long").alias("vec_id"), vector.alias("vec"),
                                                F.monotonically_increasing_id().alias("rid"), is_query.alias("is_query")), "vectors")
    lengths = rows.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n"), F.count(F.when(F.col("is_query"), 1)).alias("q"))
    top = lengths.orderBy(F.desc("n"), F.desc("dim")).first()
    dim, n, n_queries = (top["dim"], top["n"], top["q"]) if top else (0, 0, 0)
    blocks, query_blocks = max(1, -(-n // block_rows)), max(1, -(-n_queries // QUERY_ROWS))
    rows = rows.where(F.size("vec") == dim)

    def each(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    items = rows.select("vec_id", "vec", "rid", F.pmod("rid", F.lit(blocks)).cast("int").alias("block"), each(query_blocks).alias("query_block"))
    queries = rows.where("is_query").select("vec_id", "vec", "rid", F.pmod(F.xxhash64("rid"), F.lit(query_blocks)).cast("int").alias("query_block"),
                                            each(blocks).alias("block"))
    found = items.groupBy("block", "query_block").cogroup(queries.groupBy("block", "query_block")).applyInArrow(
        partial(_search, k=k, trees=trees, bits=bits, share=min(1.0, candidates / block_rows)), "query_rid long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query_rid").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
