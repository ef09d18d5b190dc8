"""M8: seeded one-bug mutation as pure column expressions.

Rule order and the mutated occurrence come from md5 of (seed, key, salt), so
the result depends on the row's key only -- never on partitioning or row order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trainloom import config as C
from trainloom.functions.text import col_


def seeded_hash(seed: int, key, salt: str) -> Column:
    """Non-negative 32-bit integer from md5(seed:key:salt)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), col_(key).cast("string"), F.lit(f":{salt}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def seeded_order_key(seed: int, key) -> Column:
    """L1 shuffle key: md5(seed:key) as hex text (same order in any engine)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), col_(key).cast("string")))


def _splice(code: Column, pattern: str, replacement: str, k: Column) -> Column:
    """Replace the k-th (0-based) match of ``pattern`` in ``code``."""
    parts = F.split(code, pattern, -1)
    found = F.regexp_extract_all(code, F.lit(pattern), 0)
    seps = F.transform(found, lambda m, i: F.when(i == k, F.lit(replacement)).otherwise(m))
    joined = F.zip_with(parts, seps, lambda p, s: F.concat(p, F.coalesce(s, F.lit(""))))
    return F.array_join(joined, "")


def mutation_choices(code, key, seed: int = C.SHUFFLE_SEED, rules=C.BUG_RULES) -> Column:
    """Array of at most one struct(rule, k): the first rule (in a seeded order)
    that matches and the seeded occurrence to mutate; empty when no rule
    matches. ``explode`` it to keep only mutable rows without a filter that
    would be pushed below (and re-evaluate) the choice."""
    c = F.coalesce(col_(code), F.lit(""))
    cands = []
    for ix, (pat, _) in enumerate(rules):
        cands.append(F.struct(
            F.md5(F.concat(F.lit(f"{seed}:"), col_(key).cast("string"), F.lit(f":rule{ix}"))).alias("order"),
            F.lit(ix).alias("rule"),
            F.regexp_count(c, F.lit(pat)).alias("n")))
    first = F.slice(F.array_sort(F.filter(F.array(*cands), lambda s: s.getField("n") > 0)), 1, 1)
    occ = seeded_hash(seed, key, "occurrence")
    return F.transform(first, lambda s: F.struct(s.getField("rule").alias("rule"),
                                                  F.pmod(occ, s.getField("n")).alias("k")))


def mutation_choice(code, key, seed: int = C.SHUFFLE_SEED, rules=C.BUG_RULES) -> Column:
    """The single element of ``mutation_choices`` or NULL."""
    return F.try_element_at(mutation_choices(code, key, seed, rules), F.lit(1))


def apply_mutation(code, rule, k, rules=C.BUG_RULES) -> Column:
    """Replace occurrence ``k`` of rule ``rule``'s pattern by its replacement."""
    c = F.coalesce(col_(code), F.lit(""))
    out = None
    for ix, (pat, repl) in enumerate(rules):
        branch = _splice(c, pat, repl, col_(k))
        out = F.when(col_(rule) == ix, branch) if out is None else out.when(col_(rule) == ix, branch)
    return out


def mutate_code(code, key, seed: int = C.SHUFFLE_SEED, rules=C.BUG_RULES) -> Column:
    """M8 in one expression: struct(rule, mutated_code), NULL when no rule
    matches. Plans that filter on the result should use ``mutation_choice``
    first and ``apply_mutation`` after the filter, so the splice runs once."""
    ch = mutation_choice(code, key, seed, rules)
    return F.when(ch.isNotNull(), F.struct(ch.getField("rule").alias("rule"),
                                           apply_mutation(code, ch.getField("rule"), ch.getField("k"), rules)
                                           .alias("mutated_code")))
