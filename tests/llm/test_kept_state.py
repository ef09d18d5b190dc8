"""What outlives a run: slot maps, stored trees; and bounds of tables and of the directory."""

import os
import subprocess
import sys
import time

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from trainloom.llm import edits, exact, pieces, sharding, wordbpe

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# -- 9 sharding -------------------------------------------------------------------------

APPLICATION = """
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.checkpoint.dir", sys.argv[1]).getOrCreate())
from trainloom.llm import queries, sharding
out = queries.op9_sharding(spark, sys.argv[2])
rows = [tuple(r) for r in out.select("vslot", "shard", "map_version").distinct().collect()]
path = out.sparkSession.sparkContext.getConf().get("spark.checkpoint.dir")
import glob
print("MAP", sorted(rows)[:50], sorted({r[2] for r in rows}), len(glob.glob(sys.argv[1] + "/slot-map-of-*/map-*")))
if len(sys.argv) > 3:
    kept = glob.glob(sys.argv[1] + "/slot-map-of-*")[0]
    grown = sharding.shard(spark.read.parquet(sys.argv[2] + "/documents.parquet"), 41, map_path=kept)
    print("GROWN", grown.select("map_version").distinct().collect()[0][0], sharding.versions(spark, kept))
"""


def test_two_applications_find_one_map(tmp_path):
    def run(*more):
        env = {**os.environ, "PYTHONPATH": REPO}
        out = subprocess.run([sys.executable, "-c", APPLICATION, str(tmp_path), SF, *more], env=env, capture_output=True, text=True, timeout=200, cwd=tmp_path)
        assert out.returncode == 0, out.stderr[-2000:]
        return [line for line in out.stdout.splitlines() if line.startswith(("MAP", "GROWN"))]

    first = run()
    second = run("grow")
    assert first[0] == second[0] and first[0].endswith("[1] 1") and second[1] == "GROWN 2 [1, 2]"


@pytest.mark.parametrize("n", [200, 1_000, 50_000])
def test_an_edit_ends_near_a_fresh_map_for_skewed_sizes(n):
    rng = np.random.default_rng(n)
    slots = lambda sizes: {v: int(sizes[np.flatnonzero(hashed == v)].sum()) for v in np.unique(hashed)}
    hashed = rng.integers(0, sharding.SLOTS, n)
    old = sharding.SlotMap.balanced(slots(rng.lognormal(5, 1.5, n).astype(int)), 40)
    sizes = slots(rng.lognormal(5, 1.5, n).astype(int))

    def largest(m):
        load = np.zeros(m.n_shards)
        np.add.at(load, [m.shards[v] for v in sizes], list(sizes.values()))
        return load.max() / load.mean()

    edited = old.edited(sizes, 40)
    assert edited.version == 2 and largest(edited) <= 1.03 * largest(sharding.SlotMap.balanced(sizes, 40))
    assert edited.edited(sizes, 40) is edited  # nothing more to do
    more = edited.edited(sizes, 43)
    assert more.version == 3 and largest(more) <= 1.03 * largest(sharding.SlotMap.balanced(sizes, 43))


def test_a_version_is_written_once_and_read_whole(spark, tmp_path):
    m, path = sharding.SlotMap.balanced({}, 3), str(tmp_path / "map")
    m.save(spark, path)
    with pytest.raises(Exception, match="already exists"):
        m.save(spark, path)
    m.frame(spark).withColumn("n_shards", F.lit(3)).where("vslot > 5").coalesce(1).write.parquet(f"{path}/map-2")
    with pytest.raises(ValueError, match="not whole"):
        sharding.SlotMap.load(spark, path)
    assert sharding.SlotMap.load(spark, path, 1) == m and sharding.versions(spark, str(tmp_path / "none")) == []


# -- 7 stored trees ---------------------------------------------------------------------

def test_a_second_round_goes_on_with_the_stored_trees(spark):
    ranks = P.path("byte_bpe_50k.tiktoken")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    trees = edits.keep_trees(docs, ranks)
    first = edits.redacted(trees)
    counted = {r.doc_id: r for r in edits.count_after_edits(first, ranks).collect()}
    again = edits.edit_trees(first, ranks)
    assert again.columns == trees.columns
    # Second round: a word in the middle of each text is replaced.
    middle = F.floor(F.length("text") / 2).cast("int")
    edit = F.struct(middle.alias("start"), F.least(middle + 3, F.length("text")).alias("end"), F.lit("new words").alias("replacement"))
    second = edits.count_after_edits(again.withColumn("edits", F.when(F.length("text") > 0, F.array(edit)).cast(edits.EDIT_TYPE)), ranks).collect()
    table = edits.load(ranks)
    whole = lambda text: len(table.encoding.encode_ordinary(text))
    for r in second:
        before = counted[r.doc_id]
        assert r.tokens_before == before.tokens_after == whole(before.text)
        assert r.tokens_after == whole(r.text)
    assert sum(r.encoded_chars for r in second) < 0.2 * sum(len(r.text) for r in second)


def test_tree_unpacks_only_touched_blocks():
    lengths, tokens = np.full(10_000, 5), np.arange(10_000) % 7
    tree = edits.SegmentTree(lengths, tokens)
    b, leaf, at = tree.find(25_003)
    assert (64 * b + leaf, at) == (5_000, 25_000)
    tree.replace((b, leaf), (b, leaf), [3, 4], [10, 20])
    assert len(tree.touched) == 1 and tree.tokens == tokens.sum() - tokens[5_000] + 30
    t = tree.leaf_tokens()
    assert t.tolist() == [*tokens[:5_000], 10, 20, *tokens[5_001:]] and t.sum() == tree.tokens and tree.sums[1][0] == 50_002
    assert edits.SegmentTree(np.empty(0), np.empty(0)).tokens == 0


# -- 1, 3, 4: bounds ----------------------------------------------------------------------

def test_tables_keep_no_long_chunks():
    text = "".join(chr(0x4E00 + i % 3_000) for i in range(9_000))
    words, chunks, counts = wordbpe.load(P.path("word_bpe_49k.json")), pieces.ChunkTable(P.path("piece_bpe_32k.model")), edits.load(P.path("byte_bpe_50k.tiktoken"))
    words.encode(text + " " + text[:50])
    chunks.add([text, text[:50]])
    assert counts[text] == len(counts.encoding.encode_ordinary(text))
    assert max(map(len, words)) <= 64 and max(map(len, words.pieces), default=0) <= 64 and max(map(len, chunks)) <= 64 and text not in counts and text[:50] in chunks


def test_no_space_texts_encode_exactly(spark):
    texts = ["".join(chr(0x4E00 + (i * j) % 2_000) for i in range(1, 700)) for j in range(1, 9)] + ["line\nof\ntext\n" * 400]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = pieces.ChunkTable(P.path("piece_bpe_32k.model")).model
    for r in pieces.encode_decode(df, P.path("piece_bpe_32k.model")).collect():
        assert r.ids == model.encode(texts[r.doc_id]) and r.decoded == model.decode(r.ids)


def test_directory_splits_in_linear_time_and_covers_all_cells():
    rng = np.random.default_rng(8)
    sizes = {int(p): int(rng.integers(1, 3) * 10_000) for p in range(1 << 16)}
    start = time.time()
    d = exact.Directory(sizes, 16, 25_000)
    assert time.time() - start < 20 and len(d.cells) == 1 << d.depth
    load = {}
    for p, n in sizes.items():
        load.setdefault(d.cells[p >> (16 - d.depth)], []).append((p, n))
    for own in load.values():
        assert sum(n for _, n in own) <= 25_000 or len(own) == 1
        assert own[-1][0] - own[0][0] == len(own) - 1  # one key range
