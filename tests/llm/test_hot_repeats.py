"""Passages that very many documents share, lines of one repeated word, and clashing column names."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_llm import brute_repeats
from trainloom.llm import substring


def made_rows():
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(60)]
    passage, base = " ".join(rng.choice(words, 70)), rng.choice(words, 120)
    rows = []
    for i in range(150):
        own = " ".join(rng.choice(words, 25))
        near = base.copy()
        near[rng.integers(0, 120, 2)] = f"edit{i}"
        kind = [f"{own} {passage} {own}", " ".join(near), "a " * 40 + own, own, f"{passage} {passage[:200]}", " ".join(near[30:90])][i % 6]
        rows.append((int(rng.permutation(150)[i]) if i % 10 == 0 else 1_000 + i, kind))
    return [*rows, rows[3], (None, passage), (None, None), (2_000, None), (2_001, "")]


@pytest.mark.parametrize("options", [{"group_rows": 0}, {"group_rows": 20}, {"group_rows": 0, "prefix": 13}])
def test_hot_passages_match_brute_force(spark, options):
    rows = made_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = substring.remove_repeats(df, **options).collect()
    assert collections.Counter(map(tuple, out)) == brute_repeats([(d, t or "") for d, t in rows])


def test_runs_that_many_documents_share_meet_as_one_key(spark):
    # 400 documents hold one passage: rows that are matched grow with runs, not with windows.
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(500)]
    passage = " ".join(rng.choice(words, 400))
    df = spark.createDataFrame([(i, f"{' '.join(rng.choice(words, 20))} {passage}") for i in range(400)], "doc_id long, text string")
    records, cut = substring.repeats(df, group_rows=50)
    assert cut.where("n_removed >= 400").count() == 399 and records.count() == 400


def test_cut_repeats_with_clashing_names_and_an_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(i, text, "a", 1, "b", "c", 7, 9) for i in range(3)],
                               "doc_id long, text string, text_key string, row int, kept_text string, __id string, n_chars int, low int")
    out = substring.cut_repeats(df)
    assert out.dtypes == df.dtypes
    rows = sorted(map(tuple, out.collect()))
    assert rows == [(0, text, "a", 1, "b", "c", 7, 9), (1, "", "a", 1, "b", "c", 0, 9), (2, "", "a", 1, "b", "c", 0, 9)]
    assert substring.cut_repeats(df.limit(0)).count() == 0
    assert substring.cut_repeats(df.withColumn("text", F.lit(None).cast("string"))).count() == 3
