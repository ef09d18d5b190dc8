"""Streams, sinks and snapshots over several deliveries, restarts and replays."""

import math
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from trainloom.operators import metrics as ME
from trainloom.plans import jobs, queries
from trainloom.plans.derived import Derived
from trainloom.sources.logs import ROLLOUT_LOG_SCHEMA
from trainloom.sources.shared import as_stream, drain, materialise, rocksdb_state
from trainloom.sources.sinks import BatchLog, newest_snapshots, snapshot_stream
from trainloom.streaming.step_state import GroupFold, record_of, stream_step_records

ROLL = "step int, task_id string, sample_ix int, test_score double, completion string"
TIMING = "step int, elapsed_sec double, peak_gb double, n_rollouts long"
ROWS = [(s, f"t{t}", i, (s * 7 + t * 3 + i) % 4 / 3.0 if s else 0.7, "c" * (10 * i + 3000 * (t == 1))) for s in range(3) for t in range(4) for i in range(6)]


class Feed:
    """Folders that grow, their streams, and a query that goes on at each ``run``."""

    def __init__(self, spark, path, **options):
        self.spark, self.path, self.options = spark, str(path), options
        self.n = 0
        for name in ("roll", "timing"):
            (path / name).mkdir()

    def add(self, name, schema, rows):
        self.spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{self.path}/{name}/{self.n}")
        self.n += 1

    def run(self):
        read = lambda name, schema: self.spark.readStream.schema(schema).option("recursiveFileLookup", "true").option(
            "maxFilesPerTrigger", 1).parquet(f"{self.path}/{name}")
        out = drain(stream_step_records(read("roll", ROLL), read("timing", TIMING), **self.options), "steps", f"{self.path}/run")
        return sorted(out.collect(), key=lambda r: (r.step, r.completion_chars_mean))


def batch_records(spark, rows, timing):
    scored = spark.createDataFrame(rows, ROLL).select("step", "task_id", "sample_ix", F.col("test_score").alias("score"), F.length("completion").alias("completion_chars"))
    return {r.step: r.asDict() for r in ME.step_metrics(scored, spark.createDataFrame(timing, TIMING)).collect()}


@pytest.mark.parametrize("buckets", [1, 5])
def test_step_records_survive_restart_late_and_repeated_rows(spark, tmp_path, buckets):
    timing = [(s, 10.0 + s, 1.5, 24) for s in range(3)] + [(9, 1.0, 1.0, 0)]
    feed = Feed(spark, tmp_path, buckets=buckets)
    feed.add("timing", TIMING, timing)
    feed.add("roll", ROLL, ROWS[:30])
    first = feed.run()
    assert [r.step for r in first] == [0]  # 24 of step 0, 6 of step 1
    # Repeated rows do not stand in for missing ones; rows without a score, sample or step are left out.
    feed.add("roll", ROLL, ROWS[20:40] + ROWS[20:40] + [(1, "t0", 0, None, "x"), (1, "t0", None, 1.0, "x"), (None, "t0", 0, 1.0, "x")])
    assert [r.step for r in feed.run()] == [0]
    feed.add("roll", ROLL, ROWS[38:])
    feed.add("roll", ROLL, [(0, "late", 0, 1.0, "x")])  # step 0 is closed
    got = {r.step: r.asDict() for r in feed.run()}
    want = batch_records(spark, ROWS, timing)
    assert got.keys() == want.keys() == {0, 1, 2}
    for s in got:
        assert got[s] == pytest.approx(want[s])
    assert got[0]["reward_std"] == 0.0


def test_step_records_without_expected_rows_are_corrected(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add("roll", ROLL, ROWS[24:30])
    assert feed.run() == []  # no timing row yet
    feed.add("timing", TIMING, [(1, 2.0, None, None), (2, 2.0, 1.0, None)])
    feed.add("roll", ROLL, ROWS[30:48])
    want = batch_records(spark, ROWS[24:48], [(1, 2.0, None, None)])[1]
    got = [r.asDict() for r in feed.run()]
    assert {r["step"] for r in got} == {1} and any(r == pytest.approx(want) for r in got)


def test_step_records_of_many_buckets_merge_exactly():
    part = {"n": 3, "groups": 1, "flat_groups": 1, "lo": 0.1, "hi": 0.1, "total": 0.1 * 3, "spread": 0.0, "chars": 6, "chars_max": 2, "truncated": 0}
    out = record_of(4, [part, dict(part)], None, None)
    assert out["reward_std"] == 0.0 and out["num_groups"] == 2 and math.isclose(out["reward_mean"], 0.1)


def test_ttl_state_runs_with_a_processing_time_trigger(spark, tmp_path):
    for name, schema, rows in (("roll", ROLL, ROWS[:24]), ("timing", TIMING, [(0, 1.0, 1.0, 24)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / name))
    stream = stream_step_records(spark.readStream.schema(ROLL).parquet(str(tmp_path / "roll")),
                                 spark.readStream.schema(TIMING).parquet(str(tmp_path / "timing")), ttl_ms=3_600_000)
    with rocksdb_state(spark):
        q = stream.writeStream.format("memory").queryName("ttl_steps").outputMode("append").trigger(processingTime="1 second").start()
        try:
            for _ in range(60):
                if q.exception() or spark.table("ttl_steps").count():
                    break
                q.awaitTermination(1)
        finally:
            q.stop()
    assert [r.step for r in spark.table("ttl_steps").collect()] == [0]


def test_log_batch_that_is_delivered_again_adds_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("a", 0.5), ("b", None), (None, 1.0)], ROLLOUT_LOG_SCHEMA)
    log = BatchLog(str(tmp_path / "log"))
    for batch, n in ((rows, 0), (rows.limit(1), 1), (rows, 0), (rows.limit(0), 2)):
        log.write(batch, n)
    BatchLog(str(tmp_path / "log"), "other").write(rows.limit(1), 0)
    back = log.read(spark, ROLLOUT_LOG_SCHEMA)
    assert back.columns == ["completion", "test_score"] and back.count() == 5
    assert not (tmp_path / "log/source=job/batch=2").exists()
    log.write(rows.limit(0), 0)  # the batch turned out empty after all
    assert log.read(spark, ROLLOUT_LOG_SCHEMA).count() == 2


def test_log_stream_that_fails_after_the_write_replays_its_batch(spark, tmp_path):
    rows = spark.range(40).select(F.col("id").cast("string").alias("completion"), (F.col("id") / 40).alias("test_score"))
    rows.repartition(4).write.parquet(str(tmp_path / "in"))
    log, failures = BatchLog(str(tmp_path / "log"), "stream"), [1]

    def deliver(batch, batch_id):
        log.write(batch, batch_id)
        if batch_id == 1 and failures:
            failures.pop()
            raise RuntimeError("lost after the write, before the commit")

    def run():
        stream = spark.readStream.schema(ROLLOUT_LOG_SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        stream.writeStream.foreachBatch(deliver).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()

    with pytest.raises(Exception, match="lost after the write"):
        run()
    run()
    back = log.read(spark, ROLLOUT_LOG_SCHEMA)
    assert back.count() == 40 and back.select("completion").distinct().count() == 40


def test_newest_snapshot_of_a_step_wins(spark, tmp_path):
    schema = "completion string"
    folder = tmp_path / "snap"

    def put(name, *texts):
        spark.createDataFrame([(t,) for t in texts], schema).coalesce(1).write.mode("overwrite").parquet(str(folder / name))

    def read():
        return newest_snapshots(drain(snapshot_stream(spark, str(folder), schema, max_files=1), "snap", str(tmp_path / "run")))

    put("a/completions_00200.parquet", "old", "older")
    put("a/completions_00400.parquet", "only")
    assert sorted((r.step, r.completion) for r in read().collect()) == [(200, "old"), (200, "older"), (400, "only")]
    put("b/completions_00200.parquet", "new")
    assert sorted((r.step, r.completion) for r in read().collect()) == [(200, "new"), (400, "only")]


def test_log_may_be_compressed(spark, tmp_path):
    rows = spark.createDataFrame([("a" * 5000, 0.5), (None, 1.0)], ROLLOUT_LOG_SCHEMA)
    log = BatchLog(str(tmp_path / "log"), compression="gzip")
    log.write(rows, 0)
    log.write(rows, 0)
    files = [f for f in (tmp_path / "log").rglob("part-*")]
    assert files and all(f.name.endswith(".json.gz") and f.stat().st_size < 1000 for f in files)
    assert sorted(log.read(spark, ROLLOUT_LOG_SCHEMA).collect(), key=str) == sorted(rows.collect(), key=str)


class Cell:
    """A value state that counts its reads and writes."""

    def __init__(self):
        self.value, self.reads, self.writes = None, 0, 0

    def get(self):
        self.reads += 1
        return self.value

    def update(self, value):
        self.value, self.writes = value, self.writes + 1


def test_bucket_state_is_read_and_written_once_a_batch():
    fold, cell = GroupFold(4, 500.0, None), Cell()
    fold.init(type("Handle", (), {"getValueState": lambda self, *a: cell})())
    rows = pd.DataFrame([(f"t{i // 6}", i % 6, 0.5 if i < 6 else i % 3 / 2, 7 * i) for i in range(600)], columns=["task_id", "sample_ix", "score", "chars"])
    out = []
    for batch in (rows[300:], rows[:400], rows[10:20]):  # late, repeated in part, repeated as a whole
        out += [f.iloc[0].to_dict() for f in fold.handleInputRows((1, 2), iter([batch[:70], batch[70:]]), None)]
    assert len(out) == 2 and (cell.reads, cell.writes) == (3, 2)
    last = out[-1]
    assert (last["n"], last["groups"], last["flat_groups"], last["chars_max"]) == (600, 200, 2, 7 * 599)
    assert last["total"] == pytest.approx(rows.score.sum()) and last["spread"] == pytest.approx(((rows.score - rows.score.mean()) ** 2).sum())


def test_rows_of_a_stream_stay_in_the_files_of_their_partitions(spark):
    df = spark.range(100, numPartitions=5).withColumn("text", F.lit("x"))
    for rows, files in ((df, 5), (df.coalesce(1), int(spark.conf.get("spark.sql.shuffle.partitions")))):
        stream = as_stream(rows, "rows")
        out = drain(stream.withColumn("file", F.col("_metadata.file_path")), "read")
        assert out.count() == 100 and out.select("file").distinct().count() == files


def test_rollouts_shuffle_keys_and_metrics_are_graded_once(spark, monkeypatch):
    rollouts = Derived(spark, SF).rollouts()
    shuffled = rollouts._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[0]
    assert "Window" in shuffled and "pad " in shuffled.split("Window")[0] and "pad " not in shuffled.split("Window")[1]
    names = []
    monkeypatch.setattr(jobs, "materialise", lambda df, name: names.append(name) or materialise(df, name))
    log = jobs.q_metrics_log(spark, SF)
    assert names == ["step-metrics"] and log.count() == log.select("step").distinct().count() > 0


def test_texts_of_rollouts_are_written_above_the_joins(spark):
    d = Derived(spark, SF)
    for graded in (queries._attempts(d), queries._candidates(d)):
        plan = graded._jdf.queryExecution().optimizedPlan().toString()
        above, _, below = plan.partition("Join ")
        assert below and "pad " in above and "pad " not in below


def _spread(df):
    """What the rows of each shuffle of the plan are spread by."""
    return re.findall(r"Exchange hashpartitioning\((.+?), \d+\)", re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString()))


def test_grading_and_transcripts_stay_where_their_task_is(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spread = _spread(queries.q_revise_transcript(spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Lines for the candidates and for the verdicts (one shuffle, read twice) and four narrow task tables.
    assert len(spread) == 6 and set(spread) == {"task_id"}


def test_pass_at_1_grades_rollouts_once_and_keeps_numbers(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(queries, "materialise", lambda df, name: kept.append(df) or materialise(df, name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = queries.q_pass_at_1(spark, SF)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        graded, = kept
        assert set(_spread(graded)) == {"task_id"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert dict(graded.dtypes)["passed"] == "boolean" and [c for c, t in graded.dtypes if t == "string"] == ["task_id"]
    assert "l_linenumber" not in plan and out.count() == 3
