"""A training corpus from ``documents``: five stages, each written and read again.

toxicity -> exact duplicates -> near duplicates -> repeated passages -> packing.
All but the last return the columns of ``documents``, extra ones included.

Null text counts as empty: it scores like a text without telling words, is a copy of empty
texts only, and is packed as the end token alone. Null ids go last where a document is
chosen. A table without rows passes every stage without rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trainloom.llm import exact, minhash, packing, substring, toxicity
from trainloom.llm.common import documents, recorded, release, write_shared

# Tables that the latest stage wrote on its way. A stage's result is written
# before the next stage starts, so that one deletes them.
_SCRATCH: list[str] = []


def _stage(operator):
    """A stage function that first deletes the tables of the stage before."""
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _SCRATCH)
        with recorded(_SCRATCH):
            return operator(spark, docs, sf_dir)
    run_stage.__name__, run_stage.__doc__ = operator.__name__, operator.__doc__
    return run_stage


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the classifier does not predict toxic; it learns from the labels outside the held-out fold."""
    model = toxicity.fit_outside_fold(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


@_stage
def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of texts equal without white space: the longest, then the smallest id."""
    return exact.drop_copies(docs)


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of smallest id of each class of near duplicates (five-word shingles, similarity 0.8)."""
    return minhash.drop_near_duplicates(docs)


@_stage
def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the words that a 13-word window of a document of smaller id covers; every row stays."""
    return substring.cut_repeats(docs)


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the token ids of all texts into sequences of at most 4,096."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("packing", pack),
]

# Training, hashing into signatures and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = write_shared(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
