"""Hard negatives by exact integer products in a residue number system.

1. Usable rows are written once; a row id tells repeated rows apart.
2. Rows are cut into strips and anchors into blocks; a task gets one block and one
   strip. Its components are split into residues modulo several small primes, the
   residue matrices multiplied in float32 (whose sums stay whole numbers), and the
   signed scores rebuilt from the remainders.
3. First pass: the best rows of the anchor's label in each strip, then the best of
   all strips. Second pass: the best rows of other labels within the score window
   of each positive, by strip, then of all strips.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trainloom.llm.common import write_shared

# Components of one product; a residue is at most 127 then, and 1,024 * 127 ** 2 < 2 ** 24.
SPAN = 1_024
_FLOAT_WHOLE = 1 << 24


def primes_for(bound: int) -> list[int]:
    """Primes under 256, largest first, whose product exceeds twice ``bound`` (numbers from -bound to bound)."""
    chosen, product = [], 1
    for p in range(255, 2, -2):
        if product > 2 * bound:
            break
        if all(p % q for q in range(3, math.isqrt(p) + 1, 2)):
            chosen.append(p)
            product *= p
    if product <= 2 * bound:
        raise ValueError("scores are too large")
    return chosen


def _balanced(x: np.ndarray, p: int) -> np.ndarray:
    """The remainder nearest to zero; for an odd p it lies within (p - 1) / 2."""
    half = p // 2
    return (x + half) % p - half


def residue_product(a: np.ndarray, b: np.ndarray, primes: list[int]) -> np.ndarray:
    """``a @ b.T`` of whole numbers, exact where the primes' product covers twice the largest score."""
    remainders = []
    for p in primes:
        assert SPAN * (p // 2) ** 2 < _FLOAT_WHOLE
        left, right = _balanced(a, p).astype(np.float32), _balanced(b, p).astype(np.float32)
        total = np.zeros((len(a), len(b)), np.int32)
        for at in range(0, a.shape[1], SPAN):
            total += _balanced((left[:, at:at + SPAN] @ right[:, at:at + SPAN].T).astype(np.int32), p)
        remainders.append(_balanced(total, p))
    # Chinese remainders in mixed radix with digits around zero, so that the sum is signed at once.
    score, digits = np.zeros((len(a), len(b)), np.int64), []
    weight = 1
    for i, p in enumerate(primes):
        digit = remainders[i]
        for q, d in zip(primes, digits):
            digit = _balanced((digit - d) * pow(q, -1, p), p)
        digits.append(digit)
        # Products beyond 2**63 wrap around, as do the sums; the score itself fits.
        score += digit.astype(np.int64) * np.int64((weight + (1 << 63)) % (1 << 64) - (1 << 63))
        weight *= p
    return score


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        x = v.values.to_numpy(zero_copy_only=False)
        out[i, :len(x)] = x
    return out


class Cell:
    """Rows of a strip in order of id, to be scored against anchors."""

    def __init__(self, rows: pa.Table, width: int, primes: list[int]):
        rows = rows.sort_by([("id", "ascending"), ("rid", "ascending")])
        self.rid, self.id, self.label = (rows[c].to_numpy() for c in ("rid", "id", "label"))
        self.vectors, self.width, self.primes = _matrix(rows["vector"], width), width, primes

    def scored(self, anchors: pa.Table, step: int = 256):
        """(anchor's place, its score with every row) for each anchor."""
        for at in range(0, anchors.num_rows, step):
            scores = residue_product(_matrix(anchors["vector"].slice(at, step), self.width), self.vectors, self.primes)
            for i, s in enumerate(scores):
                yield at + i, s


def _batch(columns: list[list], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(np.concatenate(c) if c else [], t) for c, t in zip(columns, schema.types)], schema=schema)


NEAR = "anchor_rid long, positive_rid long, positive_id long, score long"
_NEAR = pa.schema([(c.split()[0], pa.int64()) for c in NEAR.split(", ")])


def _nearest(anchors: pa.Table, rows: pa.Table, width: int, primes: list[int], k: int) -> pa.Table:
    """The ``k`` best other rows of the same label for each anchor."""
    out: list[list] = [[], [], [], []]
    cell = Cell(rows, width, primes)
    rid, label = anchors["rid"].to_numpy(), anchors["label"].to_numpy()
    order = np.argsort(label, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(label[order])) + 1) if len(order) else []:
        same = np.flatnonzero(cell.label == label[own[0]])
        for start in range(0, len(own) if len(same) else 0, 256):
            chosen = own[start:start + 256]
            scores = residue_product(_matrix(anchors["vector"].take(chosen), width), cell.vectors[same], primes)
            for i, s in zip(chosen, scores):
                others = np.flatnonzero(cell.rid[same] != rid[i])
                best = others[np.argsort(-s[others], kind="stable")[:k]]
                for c, x in zip(out, (np.full(len(best), rid[i]), cell.rid[same][best], cell.id[same][best], s[best])):
                    c.append(x)
    return _batch(out, _NEAR)


HARD = "anchor_rid long, place int, negative_rid long, negative_id long, score long"
_HARD = pa.schema([(c.split()[0], pa.int32() if c.endswith("int") else pa.int64()) for c in HARD.split(", ")])


def _hardest(anchors: pa.Table, rows: pa.Table, width: int, primes: list[int], k: int, low: int, high: int) -> pa.Table:
    """The ``k`` best rows of other labels for each anchor and positive, within the window."""
    out: list[list] = [[], [], [], [], []]
    cell = Cell(rows, width, primes)
    rid, label, targets = anchors["rid"].to_numpy(), anchors["label"].to_numpy(), anchors["targets"].to_pylist()
    for i, s in cell.scored(anchors):
        # Whole numbers: low% and high% of the positive's score, rounded inwards.
        windows = [(t["place"], -(-low * t["score"] // 100), high * t["score"] // 100) for t in targets[i]]
        windows = [w for w in windows if w[1] <= w[2]]
        if not windows:
            continue
        fit = np.flatnonzero((cell.label != label[i]) & (s >= min(w[1] for w in windows)) & (s <= max(w[2] for w in windows)))
        fit = fit[np.argsort(-s[fit], kind="stable")]
        down = -s[fit]
        for place, least, most in windows:
            start = np.searchsorted(down, -most, "left")
            best = fit[start:min(start + k, np.searchsorted(down, -least, "right"))]
            for c, x in zip(out, (np.full(len(best), rid[i]), np.full(len(best), place), cell.rid[best], cell.id[best], s[best])):
                c.append(x)
    return _batch(out, _HARD)


def mine(df: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "vector", label_col: str = "label",
         positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, strip_rows: int = 8_192, block_rows: int = 4_096) -> DataFrame:
    """Negatives for each anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vector_col`` holds whole numbers. A score is the inner product; higher is
    better, ties go to the smaller id, then to the row read first. The positives of
    an anchor are its ``positives`` best other rows of its label. Negatives are the
    ``negatives`` best rows of another label with ``low`` % to ``high`` % of the
    positive's score.

    Rows with a null id, label, vector or component take no part, nor do vectors
    whose square length is 2**62 or more (their scores may not fit a long). A shorter
    vector is filled with zeros; an empty one scores 0 with all. Repeated rows are
    rows of their own: each may be an anchor, a positive and a negative. An anchor
    without positives or without fitting rows gives no row, and so does an empty
    table. Other columns are not read.
    """
    named = df.select(F.monotonically_increasing_id().alias("rid"), df[id_col].cast("long").alias("id"), df[label_col].cast("long").alias("label"),
                      df[vector_col].cast("array<bigint>").alias("vector"), F.coalesce(anchors, F.lit(False)).alias("is_anchor"))
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    usable = named.where("id is not null and label is not null and vector is not null").where(F.forall("vector", lambda x: x.isNotNull()))
    rows = write_shared(usable.withColumn("square", square).where(F.col("square") < float(1 << 62)), "vectors")
    n, n_anchors, square, width = rows.agg(F.count("*"), F.count_if("is_anchor"), F.max("square"), F.max(F.size("vector"))).first()
    # |a.b| <= |a| |b|; the square length was summed in floating point.
    bound = math.ceil((square or 0) * (1 + 1e-9)) + 1
    shape = {"width": max(1, width or 0), "primes": primes_for(bound)}
    strips, blocks = -(-n // strip_rows) or 1, -(-n_anchors // block_rows) or 1
    all_of = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    mine_of = lambda k: F.pmod(F.xxhash64("rid"), F.lit(k)).cast("int")
    chosen = rows.where("is_anchor").select("rid", "id", "label", "vector", mine_of(blocks).alias("block"))
    strip = rows.select("rid", "id", "label", "vector", mine_of(strips).alias("strip"), all_of(blocks).alias("block"))

    def cells(left: DataFrame, fn, schema: str) -> DataFrame:
        left = left.withColumn("strip", all_of(strips))
        left = left.toDF(*left.columns)  # columns of its own: both sides come from the same rows
        return left.groupBy("block", "strip").cogroup(strip.groupBy("block", "strip")).applyInArrow(fn, schema)

    best = Window.partitionBy("anchor_rid").orderBy(F.desc("score"), "positive_id", "positive_rid")
    near = (cells(chosen, partial(_nearest, k=positives, **shape), NEAR)
            .withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives))
    near = write_shared(near, "positives")
    targets = near.groupBy(F.col("anchor_rid").alias("rid")).agg(F.collect_list(F.struct("place", "score")).alias("targets"))
    hard = cells(chosen.join(targets, "rid"), partial(_hardest, k=negatives, low=low, high=high, **shape), HARD)
    best = Window.partitionBy("anchor_rid", "place").orderBy(F.desc("score"), "negative_id", "negative_rid")
    hard = hard.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    return (hard.withColumnRenamed("score", "negative_score")
            .join(near.withColumnRenamed("score", "positive_score"), ["anchor_rid", "place"])
            .join(rows.where("is_anchor").select(F.col("rid").alias("anchor_rid"), F.col("id").alias("anchor_id")), "anchor_rid")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
