"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from .conftest import SF


def test_all_queries_match_oracle(spark):
    from check_oracle import compare
    res = compare(spark, SF, verbose=False)
    bad = {k: v for k, v in res.items() if v not in ("match", "no-oracle")}
    assert not bad, bad


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["conv_id", "n_messages", "text", "token_length"]
    assert set(E.oracle_sql()) <= set(E.queries())
