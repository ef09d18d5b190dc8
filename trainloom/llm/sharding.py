"""Sharding through fixed virtual slots and a versioned slot-to-shard map.

Records hash into ``SLOTS`` virtual slots for good. Only the map from slots to
shards depends on the data: it is made from the bytes of each slot, stored with
its version, and edited (never rebuilt) when sizes or the number of shards change.
"""

from __future__ import annotations

import bisect
import heapq
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trainloom.llm.common import shared_path, write_shared

SLOTS = 8192
# Each slot is counted in this many parts, so that no task numbers a whole slot.
PARTS = 256
ROW_BYTES = 16
# An edit goes on until no shard holds more than this multiple of the mean, or until neither a
# move nor a swap of slots between the fullest and the emptiest shard lowers the fuller one.
DRIFT = 1.002


def best_change(full: list[int], empty: list[int], gap: int) -> tuple[int, int | None] | None:
    """The place in ``full`` of a size to move to ``empty``, and of one to get back (or None), that
    brings two loads ``gap`` apart closest together; None if nothing does."""
    other = sorted((size, i) for i, size in enumerate(empty))
    other = [(0, None), *other]
    small, best = [size for size, _ in other], None
    for i, size in enumerate(full):
        # What moves on balance should be near half the gap.
        at = bisect.bisect_left(small, size - gap / 2)
        for j in (at - 1, at):
            if 0 <= j < len(other) and 0 < size - small[j] < gap:
                worse = abs(size - small[j] - gap / 2)
                if best is None or worse < best[0]:
                    best = worse, i, other[j][1]
    return best and best[1:]


@dataclass(frozen=True)
class SlotMap:
    version: int
    n_shards: int
    shards: tuple[int, ...]  # by virtual slot

    @classmethod
    def balanced(cls, sizes: dict[int, int], n_shards: int, slots: int = SLOTS) -> SlotMap:
        """Version 1: slots, largest first, go to the shard with the fewest bytes."""
        load = [(0, s) for s in range(n_shards)]
        shards = [0] * slots
        for slot in sorted(range(slots), key=lambda v: (-sizes.get(v, 0), v)):
            size, s = heapq.heappop(load)
            shards[slot] = s
            heapq.heappush(load, (size + sizes.get(slot, 0), s))
        return cls(1, n_shards, tuple(shards))

    def grown(self, sizes: dict[int, int], n_shards: int) -> SlotMap:
        """The next version with more shards: slots move to new shards only."""
        shards, load = list(self.shards), [0] * n_shards
        for slot, s in enumerate(shards):
            load[s] += sizes.get(slot, 0)
        target = sum(load) / n_shards
        for new in range(self.n_shards, n_shards):
            for slot in sorted(range(len(shards)), key=lambda v: (-sizes.get(v, 0), v)):
                size, old = sizes.get(slot, 0), shards[slot]
                if old < self.n_shards and load[old] - size >= target * 0.999 and load[new] + size <= target * 1.001:
                    shards[slot] = new
                    load[old] -= size
                    load[new] += size
        return SlotMap(self.version + 1, n_shards, tuple(shards))

    def edited(self, sizes: dict[int, int], n_shards: int) -> SlotMap:
        """The map for these sizes and shards: itself if it still fits, else the next version with few slots moved."""
        new = self.grown(sizes, n_shards) if n_shards > self.n_shards else self
        shards, load = list(new.shards), [0] * n_shards
        gone = [slot for slot, s in enumerate(shards) if s >= n_shards]
        for slot, s in enumerate(shards):
            if s < n_shards:
                load[s] += sizes.get(slot, 0)

        def move(slot: int, to: int) -> None:
            shards[slot] = to
            load[to] += sizes.get(slot, 0)

        for slot in sorted(gone, key=lambda v: (-sizes.get(v, 0), v)):
            move(slot, load.index(min(load)))
        mean = sum(load) / n_shards
        held: list[list[int]] = [[] for _ in range(n_shards)]
        for slot, s in enumerate(shards):
            if sizes.get(slot, 0):
                held[s].append(slot)
        for _ in range(4 * len(shards)):
            full, empty = (f(range(n_shards), key=lambda s: (load[s], -s)) for f in (max, min))
            if load[full] <= mean * DRIFT:
                break
            change = best_change([sizes[v] for v in held[full]], [sizes[v] for v in held[empty]], load[full] - load[empty])
            if change is None:
                break
            out, back = held[full][change[0]], None if change[1] is None else held[empty][change[1]]
            for slot, a, b in ((out, full, empty), (back, empty, full)):
                if slot is not None:
                    held[a].remove(slot)
                    held[b].append(slot)
                    load[a] -= sizes[slot]
                    move(slot, b)
        if n_shards == self.n_shards and tuple(shards) == self.shards:
            return self
        return SlotMap(self.version + 1, n_shards, tuple(shards))

    def frame(self, spark: SparkSession) -> DataFrame:
        """version, slot, shard: one row per virtual slot."""
        text = F.lit(",".join(map(str, self.shards)))
        return (spark.range(1).select(F.posexplode(F.split(text, ",")).alias("vslot", "shard"))
                .select(F.lit(self.version).alias("version"), "vslot", F.col("shard").cast("int").alias("shard")))

    def save(self, spark: SparkSession, path: str | None = None) -> str:
        """Write this version beside the others, as one file in a folder of its own. A version that
        is there already fails, so of two runs that edit one map the second is told."""
        path = path or shared_path(spark, "slot-map")
        self.frame(spark).withColumn("n_shards", F.lit(self.n_shards)).coalesce(1).write.mode("errorifexists").parquet(f"{path}/map-{self.version}")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
        version = version or max(versions(spark, path))
        rows = spark.read.parquet(f"{path}/map-{version}").orderBy("vslot").collect()  # SLOTS rows
        if [r["vslot"] for r in rows] != list(range(len(rows))) or {r["version"] for r in rows} != {version}:
            raise ValueError(f"version {version} of the slot map at {path} is not whole")
        return cls(version, rows[0]["n_shards"], tuple(r["shard"] for r in rows))


def versions(spark: SparkSession, path: str) -> list[int]:
    """The finished versions of the map at ``path``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [(s.getPath(), s.getPath().getName()) for s in fs.listStatus(folder)]
    return sorted(int(n[4:]) for at, n in names if n.startswith("map-") and fs.exists(at.suffix("/_SUCCESS")))


def current_map(spark: SparkSession, path: str, sizes: dict[int, int], n_shards: int) -> SlotMap:
    """The latest version at ``path`` edited for these sizes; a new version is added."""
    old = SlotMap.load(spark, path) if versions(spark, path) else None
    new = old.edited(sizes, n_shards) if old else SlotMap.balanced(sizes, n_shards)
    if new is not old:
        new.save(spark, path)
    return new


def records(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, vslot, part for every row, written to the shared folder."""
    text = F.coalesce(df[text_col].cast("string"), F.lit(""))
    light = df.select(df[id_col].cast("long").alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
                      F.crc32(text.cast("binary")).alias("text_crc32"))
    light = light.select("*", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int").alias("vslot"),
                         F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(PARTS)).cast("int").alias("part"))
    return write_shared(light, "shard-records")


def slot_sizes(rows: DataFrame) -> dict[int, int]:
    """Bytes by virtual slot; at most ``SLOTS`` sums reach the driver."""
    return {r["vslot"]: r["bytes"] for r in rows.groupBy("vslot").agg(F.sum("size").alias("bytes")).collect()}


def place(rows: DataFrame, slot_map: SlotMap, map_path: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, vslot, map_version.

    ``slot`` numbers the rows of a shard from 0 without gaps: the rows of earlier
    parts of the shard (a running sum over the bounded table of parts) plus the
    row's number in its own part.
    """
    spark = rows.sparkSession
    mapped = spark.read.parquet(f"{map_path}/map-{slot_map.version}").select("vslot", "shard", F.col("version").alias("map_version"))
    parts = rows.groupBy("vslot", "part").agg(F.count("*").alias("n")).join(F.broadcast(mapped), "vslot")
    before = Window.partitionBy("shard").orderBy("vslot", "part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("vslot", "part", "shard", "map_version", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("vslot", "part").orderBy("doc_id", "text_crc32")
    return (rows.join(parts, ["vslot", "part"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("before") + F.row_number().over(own) - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "vslot", "map_version"))


def shard(df: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text", map_path: str | None = None) -> DataFrame:
    """Every row's shard under the law ``bytes``: shards of nearly equal size.

    A row's size is the UTF-8 bytes of its text (null: none) plus 16. Null ids
    hash by their text alone; rows equal in id and text share a slot. Ties in
    slot size go to the smaller slot. An empty table gives no row. Other columns
    are not read.

    The slot map at ``map_path`` is loaded, edited for the sizes and ``n_shards`` if
    it no longer fits, and the next version added; without a path, or a map there, it
    starts with version 1. A path outside of the checkpoint folder of one application
    keeps the map for later ones. Of two runs that add one version the second fails.
    """
    rows, path = records(df, id_col, text_col), map_path or shared_path(df.sparkSession, "slot-map")
    return place(rows, current_map(df.sparkSession, path, slot_sizes(rows), n_shards), path)
