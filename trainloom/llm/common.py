"""Helpers shared by the text operators: tables in the shared folder, hashing, components."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trainloom.session import ensure_checkpoint_dir

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = 0x9E3779B97F4A7C15


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir`` that every executor can reach."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_RECORD: list[list[str]] = []


@contextmanager
def recorded(paths: list[str]):
    """Within the block, note the shared tables that are written in ``paths``."""
    _RECORD.append(paths)
    try:
        yield
    finally:
        _RECORD.pop()


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete shared tables that nothing reads any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(conf).delete(path, True)


def write_shared(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage and pins values such as row ids: a lost executor
    rereads the table instead of computing it anew.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    for paths in _RECORD:
        paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def remainder(id_col: str) -> Column:
    """crc32 of the id as text, modulo 4; a null id gives -1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4, F.lit(-1))


def mix64(x: np.ndarray) -> np.ndarray:
    """Splitmix finaliser over uint64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def salted(seed: int) -> np.uint64:
    return np.uint64((seed * _GOLD + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)


def window_hashes(h: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``width`` consecutive word hashes (order matters)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    # Multilinear in the words with odd factors, then mixed.
    out = np.full(n, salted(seed), np.uint64)
    for i in range(width):
        out += h[i:i + n] * (salted(seed * 64 + i + 101) | np.uint64(1))
    return mix64(out)


def _settled(e: DataFrame) -> bool:
    """Whether every component is a star: a node points to one node, which points nowhere."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("root")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
    return nodes.agg(F.count_if((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("root") == 1)))).first()[0] == 0


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 40) -> DataFrame:
    """Connected components of undirected ``edges``: (node, label), label the smallest node.

    Alternates the large-star and small-star rewirings until every component is a
    star around its smallest node. Each round is an aggregation (combined on the map side, so a hub
    costs one row per task) and a join; edges are written to the shared folder
    after each round. Nothing but one number per round reaches the driver.
    """
    e = write_shared(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
                     .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    for _ in range(max_rounds):
        if _settled(e):
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(low, "u")
        small = (linked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v")
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        e = write_shared(small, "edges")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("label"))
