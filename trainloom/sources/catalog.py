"""Named table scans (by name, never by glob) and the smoke-run prefix slice."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainloom.config import SMOKE_MIN_ROWS, SMOKE_ROWS_PER_ITEM

# Explicit read schemas for the input tables; a scan never infers.
TABLE_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                 "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                 "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "benchmark": "item_id BIGINT, text STRING",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
}


class Catalog:
    """Maps a table name to its storage path under one root folder.

    A name must be registered (or present under the root as ``<name>.parquet``);
    unknown names fail instead of falling back to a glob.
    """

    def __init__(self, spark: SparkSession, root: str, schemas: dict | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schemas = dict(TABLE_SCHEMAS if schemas is None else schemas)
        self.paths: dict[str, str] = {}

    def register(self, name: str, path: str, schema: str | None = None) -> None:
        self.paths[name] = path
        if schema:
            self.schemas[name] = schema

    def path(self, name: str) -> str:
        if name in self.paths:
            return self.paths[name]
        if name not in self.schemas:
            raise KeyError(f"unknown table {name!r}")
        return f"{self.root}/{name}.parquet"

    def table(self, name: str, columns: list[str] | None = None) -> DataFrame:
        path = self.path(name)
        reader = self.spark.read
        schema = self.schemas.get(name)
        if schema:
            reader = reader.schema(schema)
        df = reader.parquet(path)
        return df.select(*columns) if columns else df


def smoke_slice(df: DataFrame, order_key: str, n: int | None, smoke: bool) -> DataFrame:
    """Smoke-run prefix: the first ``max(100, 4n)`` rows by key when the smoke
    flag is on and a budget is given; otherwise every row."""
    if smoke and n:
        keep = max(SMOKE_MIN_ROWS, int(n) * SMOKE_ROWS_PER_ITEM)
        return df.orderBy(F.col(order_key)).limit(keep)
    return df
