"""Registered queries of the text operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainloom.llm import (ann, contamination, divergence, edits, exact, langid, minhash, negatives, packing, pieces, sharding, substring,
                           toxicity)
from trainloom.llm.common import documents, remainder
from trainloom.session import ensure_checkpoint_dir

HELD_OUT = 2


def held_out():
    return remainder("doc_id") == HELD_OUT


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.train(docs.where(~held_out()))
    return langid.predict(docs, model, held_out())


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.find_copies(documents(spark, sf_dir)).drop("chain")


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_decode(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), full=False)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit_outside_fold(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), fold=HELD_OUT)
    return toxicity.score(docs, model, held_out())


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(documents(spark, sf_dir))


def op7_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents before and after personal data is redacted: trees are
    built and kept, then edited where they are stored."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    trees = edits.keep_trees(documents(spark, sf_dir), ranks)
    return edits.count_after_edits(edits.redacted(trees), ranks, full=False)


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards by the map kept for this input, which later applications find and edit.

    It lies in the folder that ``spark.checkpoint.dir`` names, not in the folder that Spark
    makes there for each application."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or ensure_checkpoint_dir(spark)
    return sharding.shard(documents(spark, sf_dir), 40, map_path=f"{folder.rstrip('/')}/slot-map-of-{xxhash.xxh64_hexdigest(sf_dir)}")


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole components, one label in seven moved on, and every hundredth vector as anchor.

    Rows with a null, infinite or undefined component take no part."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    rows = e.where(finite).select("vec_id", moved.alias("label"), whole.alias("vector"))
    return negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = contamination.find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return leaks.drop("spans", "items")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_packing, op2_language_id, op3_exact_dedup, op4_pieces, op5_toxicity, op6_substring_dedup,
                                   op7_edit_counts, op8_near_dedup, op9_sharding, op10_neighbours, op11_hard_negatives,
                                   op12_decontamination, op13_source_divergence, pipeline)}

ORACLE_SQL = {
    "op3_exact_dedup": r"""
        with d as (select doc_id, coalesce(text, '') as t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm from documents)
        select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by norm) as group_size,
               row_number() over w = 1 as kept, sha256(norm) as text_sha256
        from d window w as (partition by norm order by length(t) desc, doc_id)""",
    "op6_substring_dedup": r"""
        with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
        s as (select doc_id, i as start, array_to_string(w[i:i + 12], ' ') as words from d, unnest(range(1, len(w) - 11)) as u(i)),
        low as (select words, min(doc_id) as low from s group by words having min(doc_id) < max(doc_id)),
        hit as (select distinct s.doc_id, s.start + j as at from s join low on s.words = low.words and s.doc_id > low.low,
                unnest(range(13)) as v(j)),
        pos as (select doc_id, i as at, w[i] as word from d, unnest(range(1, len(w) + 1)) as u(i)),
        kept as (select pos.doc_id, string_agg(word, ' ' order by pos.at) as t, count(*) as n
                 from pos left join hit on hit.doc_id = pos.doc_id and hit.at = pos.at where hit.at is null group by pos.doc_id)
        select d.doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
               sha256(coalesce(t, '')) as kept_sha256
        from d left join kept on kept.doc_id = d.doc_id""",
    "op11_hard_negatives": """
        with e as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                          list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
                   from embeddings where vec_id is not null and label is not null and embedding is not null
                   and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (select a.vec_id as anchor_id, a.label as own, b.vec_id, b.label, cast(list_inner_product(a.v, b.v) as bigint) as score
              from e a join e b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
        p as (select anchor_id, vec_id as positive_id, score as positive_score from s where label = own
              qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
        select p.anchor_id, positive_id, cast(row_number() over w as integer) as rank, vec_id as negative_id, positive_score, score as negative_score
        from p join s on s.anchor_id = p.anchor_id and s.label <> s.own and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
        window w as (partition by p.anchor_id, positive_id order by score desc, vec_id) qualify rank <= 10""",
    "op12_decontamination": r"""
        with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
        b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark where item_id is not null),
        win as (select distinct item_id, least(10, len(w)) as m, array_to_string(w[i:i + 9], ' ') as words
                from b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as u(i) where len(w) > 0),
        widths as (select distinct m from win),
        s as (select doc_id, m, i as start, array_to_string(w[i:i + m - 1], ' ') as words
              from d, widths, unnest(range(1, len(w) - m + 2)) as u(i)),
        found as (select s.doc_id, s.m, s.start, win.item_id from s join win on win.m = s.m and win.words = s.words),
        hit as (select doc_id, count(distinct start + j) as n_hit from found, unnest(range(m)) as v(j) group by doc_id),
        items as (select doc_id, count(*) as n_items, sha256(string_agg(id, ',' order by id)) as sha
                  from (select distinct doc_id, cast(item_id as varchar) as id from found) group by doc_id)
        select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               coalesce(sha, sha256('')) as items_sha256, n_hit is not null as contaminated
        from d left join hit on hit.doc_id = d.doc_id left join items on items.doc_id = d.doc_id""",
    "op13_source_divergence": r"""
        with d as (select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
        t as (select row, lang, source, unnest(w) as term from d),
        kept as (select lang, term, count(*) as n from t group by lang, term having count(distinct row) >= 3),
        c as (select lang, source, term, count(*) as n from t semi join kept on kept.lang = t.lang and kept.term = t.term group by lang, source, term),
        ltot as (select lang, sum(n) as total, count(*) as v from kept group by lang),
        gtot as (select lang, source, sum(n) as total from c group by lang, source),
        g as (select distinct lang, source from d),
        p as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
                     1 + (1000000000 * (coalesce(c.n, 0) + 1)) // cast(coalesce(gtot.total, 0) + l.v as bigint) as p,
                     1 + (1000000000 * (k.n + 1)) // cast(l.total + l.v as bigint) as q
              from g join kept k on k.lang = g.lang join ltot l on l.lang = g.lang
              left join gtot on gtot.lang = g.lang and gtot.source = g.source
              left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
        pairs as (select a.lang, a.source, b.source as item, cast(sum((a.p - b.p) * (a.p - b.p) // b.p) as bigint) as value
                  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by a.lang, a.source, b.source),
        every as (select a.lang, a.source, b.source as item, coalesce(value, 0) as value from g a join g b on a.lang = b.lang and a.source <> b.source
                  left join pairs on pairs.lang = a.lang and pairs.source = a.source and pairs.item = b.source),
        terms as (select lang, source, term as item, (p - q) * (p - q) // q as value from p where n > 0 and p > q)
        select lang, source, 'pair' as part, item, value, cast(row_number() over (partition by lang, source order by value desc, item) as integer) as rank from every
        union all
        select lang, source, 'term', item, value, cast(row_number() over (partition by lang, source order by value desc, item) as integer) as rank
        from terms qualify rank <= 200""",
}
