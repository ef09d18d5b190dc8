"""The pipeline and each of its stages on awkward and on empty tables, with clashing column names."""

import collections

import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 911}" for i in range(5_000))
BASE = " ".join(f"base{i}" for i in range(60))
TEXTS = [None, "", " \n", "a", "a", "A b", BASE, BASE, " " + BASE.replace(" ", "  "), BASE + " tail", f"intro {BASE} outro " + " ".join(f"own{i}" for i in range(200)),
         LONG, LONG + " x", "é ñ 日本語 <|endoftext|>", "x" * 30_000]
EXTRA = ["row", "digest", "rid", "__best", "__digest", "__keep", "__id", "__key", "__kept", "keep", "is_best", "text_key", "kept_text", "low", "bands", "score", "size"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Folders with awkward rows, with no rows, and with rows but no labels."""
    out = {}
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in EXTRA)
    rows = [(i, t, "en" if i % 2 else None, None, len(t or ""), *EXTRA) for i, t in enumerate(TEXTS)]
    rows += [rows[6], (None, BASE, None, None, None, *EXTRA), (None, None, None, None, None, *EXTRA)]
    for name, docs, labels in (("awkward", rows, [(3, 1, 0), (4, None, None), (None, 0, 1), (99, 0, 1)]), ("empty", [], []), ("unlabelled", rows, [])):
        out[name] = str(tmp_path_factory.mktemp(name))
        spark.createDataFrame(docs, schema).write.parquet(f"{out[name]}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out[name]}/labels.parquet")
    return out


def test_stages_return_the_columns_of_documents(spark, tables):
    import corpus_pipeline
    for name in ("awkward", "empty"):
        docs = spark.read.parquet(f"{tables[name]}/documents.parquet")
        for stage, fn in corpus_pipeline.STAGES[:-1]:
            out = fn(spark, docs, tables[name])
            assert out.dtypes == docs.dtypes, stage
            rows = out.collect()
            assert all([r[c] for c in EXTRA] == EXTRA for r in rows) and bool(rows) == (name == "awkward"), stage


def test_pipeline_keeps_one_of_each_and_cuts_the_rest(spark, tables):
    import corpus_pipeline
    for name in ("awkward", "unlabelled"):
        pieces = corpus_pipeline.run(spark, tables[name]).collect()
        ids = collections.Counter(r.doc_id for r in pieces)
        # The longest of the empty texts, one "a", the longest form of the passage (not its near copy), one long text.
        assert set(ids) == {2, 3, 5, 8, 10, 11, 13, 14}
        tokens = {r.doc_id: r.doc_tokens for r in pieces}
        assert tokens[2] == 1 and sum(r.length for r in pieces) == sum(tokens.values())
    assert corpus_pipeline.run(spark, tables["empty"]).count() == 0


def test_each_stage_has_a_statement():
    import corpus_pipeline
    assert all(f.__doc__ for _, f in corpus_pipeline.STAGES) and "Null text" in corpus_pipeline.__doc__


def test_pipeline_cuts_a_shared_passage(spark, tables):
    from trainloom.llm import substring
    docs = spark.read.parquet(f"{tables['awkward']}/documents.parquet").where(F.col("doc_id").isin(6, 10))
    kept = {r.doc_id: r.text for r in substring.cut_repeats(docs).collect()}
    assert kept[6] == BASE and kept[10].startswith("intro outro own0")
