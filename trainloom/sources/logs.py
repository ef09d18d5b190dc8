"""Append-only JSON-lines logs of rollouts and step metrics, and their re-read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROLLOUT_LOG_SCHEMA = "completion STRING, test_score DOUBLE"
ROLLOUT_LOG_KEYED_SCHEMA = ("run_id STRING, step INT, task_id STRING, sample_ix INT, "
                            "completion STRING, test_score DOUBLE")
STEP_METRICS_SCHEMA = (
    "step INT, reward_mean DOUBLE, reward_std DOUBLE, zero_variance_groups INT, num_groups INT, "
    "completion_chars_mean DOUBLE, completion_chars_max INT, truncation_rate_approx DOUBLE, "
    "sec_per_step DOUBLE, peak_vram_gb DOUBLE")


def append_jsonl(df: DataFrame, path: str) -> None:
    """Append rows as JSON lines. An empty frame writes no file."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def read_rollout_log(spark: SparkSession, path: str, keyed: bool = True) -> DataFrame:
    schema = ROLLOUT_LOG_KEYED_SCHEMA if keyed else ROLLOUT_LOG_SCHEMA
    return spark.read.schema(schema).json(path)


def read_metrics_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STEP_METRICS_SCHEMA).json(path)


def read_snapshots(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Per-step completion snapshots (``completions_00200.parquet``); the step
    number comes from the file name."""
    df = spark.read.schema(schema).parquet(path)
    step = F.regexp_extract(F.col("_metadata.file_path"), r"completions_(\d+)", 1)
    return df.withColumn("snapshot_step", step.cast("int"))
