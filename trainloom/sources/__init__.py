from trainloom.sources.catalog import TABLE_SCHEMAS, Catalog, smoke_slice  # noqa: F401
from trainloom.sources.logs import append_jsonl, read_metrics_log, read_rollout_log, read_snapshots  # noqa: F401
