import pytest

from trainloom.operators.filters import require_rows
from trainloom.sources.catalog import Catalog
from trainloom.sources.logs import append_jsonl, read_metrics_log, read_rollout_log, read_snapshots

from .conftest import SF


def test_catalog_named_tables(spark):
    cat = Catalog(spark, SF)
    assert cat.table("conversations", ["conv_id", "turn"]).columns == ["conv_id", "turn"]
    with pytest.raises(KeyError):
        cat.table("conversations*")


def test_rollout_log_append_and_read_back(spark, tmp_path):
    path = str(tmp_path / "rollouts")
    rows = spark.createDataFrame([("r1", 0, "t1", 0, "code", 0.5), ("r1", 0, "t1", 1, "x", 1.0)],
                                 "run_id string, step int, task_id string, sample_ix int, completion string, "
                                 "test_score double")
    append_jsonl(rows, path)
    append_jsonl(rows.limit(0), path)  # an empty batch adds no rows
    append_jsonl(rows.filter("sample_ix = 1"), path)
    back = read_rollout_log(spark, path)
    assert back.count() == 3
    assert sorted(r.test_score for r in back.collect()) == [0.5, 1.0, 1.0]


def test_metrics_log(spark, tmp_path):
    path = str(tmp_path / "metrics")
    m = spark.createDataFrame([(1, 0.5, 0.1, 0, 2, 10.0, 12, 0.0, 3.25, 1.5)],
                              "step int, reward_mean double, reward_std double, zero_variance_groups int, "
                              "num_groups int, completion_chars_mean double, completion_chars_max int, "
                              "truncation_rate_approx double, sec_per_step double, peak_vram_gb double")
    append_jsonl(m, path)
    assert read_metrics_log(spark, path).first().sec_per_step == 3.25


def test_snapshot_step_from_file_name(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "completion string")
    df.write.parquet(str(tmp_path / "snap" / "completions_00200.parquet"))
    back = read_snapshots(spark, str(tmp_path / "snap" / "*.parquet"), "completion string")
    assert back.first().snapshot_step == 200


def test_require_rows(spark):
    with pytest.raises(RuntimeError):
        require_rows(spark.range(0), "stage")
    assert require_rows(spark.range(2), "stage").count() == 2
