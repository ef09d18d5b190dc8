"""Tables and streams that write below the shared checkpoint folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from trainloom.session import ensure_checkpoint_dir

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_PARTITIONS = "spark.sql.shuffle.partitions"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
SHORT_ROWS = 4000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, which every executor can reach."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: lineage ends here, and
    values that depend on the run (partition numbers) are pinned."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """The session has these settings inside, and its own again afterwards."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@contextmanager
def short_rows(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside hand rows to Python in batches bounded by their number alone. Under a limit
    in bytes Spark sizes the whole batch again for each row, which costs several times the row itself
    where rows are short. ``SHORT_ROWS`` of 16 KB are the 64 MB of that limit; not for longer rows."""
    rows = int(spark.conf.get(_BATCH_ROWS))
    with _settings(spark, {_BATCH_BYTES: str(2**31 - 1), _BATCH_ROWS: str(min(rows, SHORT_ROWS) if rows > 0 else SHORT_ROWS)}):
        yield


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB (map and list states need it), in at most
    two partitions per core: each one is a store of its own."""
    cores = spark.sparkContext.defaultParallelism
    with _settings(spark, {_PROVIDER: ROCKSDB, _PARTITIONS: str(min(int(spark.conf.get(_PARTITIONS)), 2 * cores))}):
        yield


def drain(stream: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Run ``stream`` over all that its sources hold now, append to a Parquet table, and read
    that back. With ``path``, a later call goes on where the last one stopped."""
    spark = stream.sparkSession
    path = path or shared_path(spark, name)
    with rocksdb_state(spark):
        query = (stream.writeStream.format("parquet").option("path", f"{path}/table").option("checkpointLocation", f"{path}/progress")
                 .outputMode("append").trigger(availableNow=True).start())
        query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/table")


def as_stream(df: DataFrame, name: str, batches: int = 3, by: str | None = None) -> DataFrame:
    """``df`` as a file stream that comes in about ``batches`` micro-batches; rows are dealt to
    files by the value of ``by``, or stay in the files of their partitions. Only a table of
    fewer files than ``batches`` is then dealt out evenly."""
    spark = df.sparkSession
    path, files = shared_path(spark, name), max(batches, int(spark.conf.get(_PARTITIONS)))
    if by:
        df.repartition(files, by).write.parquet(path)
    else:
        df.write.parquet(path)
        table = spark.read.schema(df.schema).parquet(path)
        written = len(table.inputFiles())
        if written < batches:
            path = shared_path(spark, name)
            table.repartition(files).write.parquet(path)
        else:
            files = written
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", -(-files // batches)).parquet(path)
