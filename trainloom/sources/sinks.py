"""Log sinks written batch by batch, and snapshots read as a growing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trainloom.sources.shared import delete


class BatchLog:
    """A log of JSON lines, one folder per batch.

    A batch is written below ``source=<name>/batch=<id>`` and replaces what a failed or
    repeated delivery of the same batch left there, so a replay adds nothing. A batch
    without rows leaves no folder; its rows are counted while it is written. ``write``
    fits ``foreachBatch``; a batch job passes the id of its run. ``compression`` is that of
    the files (gzip, ...); ``read`` takes logs with or without.
    """

    def __init__(self, path: str, source: str = "job", compression: str = "none"):
        self.path, self.source, self.compression = path.rstrip("/"), source, compression

    def write(self, batch: DataFrame, batch_id: int) -> None:
        folder, seen = f"{self.path}/source={self.source}/batch={batch_id}", Observation()
        (batch.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("ignoreNullFields", "false")
         .option("compression", self.compression).json(folder))
        if not seen.get["rows"]:
            delete(batch.sparkSession, folder)

    def read(self, spark: SparkSession, schema: str) -> DataFrame:
        """All rows of the log, of every source and batch."""
        columns = spark.createDataFrame([], schema).columns
        return spark.read.schema(schema).option("recursiveFileLookup", "true").json(self.path).select(*columns)


# completions_00200.parquet, a file or a folder of part files.
_SNAPSHOT = r"^(.*completions_(\d+)[^/]*)"


def snapshot_stream(spark: SparkSession, path: str, schema: str, max_files: int = 100) -> DataFrame:
    """Completion snapshots of a folder that grows, as a stream.

    Adds ``step`` (from the name), ``snapshot`` (its path), ``file`` and ``modified``.
    Each micro-batch takes at most ``max_files`` files.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", "true").parquet(path)
    at = F.col("_metadata.file_path")
    return rows.select(*rows.columns, F.regexp_extract(at, _SNAPSHOT, 2).cast("int").alias("step"), F.regexp_extract(at, _SNAPSHOT, 1).alias("snapshot"),
                       at.alias("file"), F.col("_metadata.file_modification_time").alias("modified"))


def newest_snapshots(rows: DataFrame) -> DataFrame:
    """Of each step the rows of its newest snapshot (the later path on a tie), and of a file that
    was written again those of its last version."""
    versions = rows.groupBy("step", "snapshot", "file").agg(F.max("modified").alias("modified"))
    best = versions.groupBy("step").agg(F.max_by("snapshot", F.struct("modified", "snapshot")).alias("snapshot"))
    chosen = versions.join(best, ["step", "snapshot"])
    return rows.join(chosen, ["step", "snapshot", "file", "modified"], "left_semi")
