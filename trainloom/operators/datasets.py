"""Dataset builders (D3): reasoning SFT, general chat replay, RL prompts,
repair trajectories and rendered SFT records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainloom import config as C
from trainloom.config import JobParams
from trainloom.functions import messages as M
from trainloom.functions import text as T
from trainloom.functions.mutation import apply_mutation, mutation_choices
from trainloom.functions.tokens import token_length
from trainloom.operators.accounting import StageCounts
from trainloom.operators.conversations import to_messages
from trainloom.operators.filters import domain_filter
from trainloom.operators.sampling import chosen_rows, seeded_cap


def _opt(df: DataFrame, name: str) -> Column:
    """A column that may be absent from the source: absent reads as NULL."""
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def reasoning_answer(df: DataFrame) -> Column:
    """M3: problem (+ starter code) as user; tagged reasoning + one fence as assistant."""
    problem = T.strip_py(_opt(df, "problem"))
    starter = T.strip_py(F.coalesce(_opt(df, "starter_code"), F.lit("")))
    user = F.when(starter != "", F.concat(problem, F.lit(C.STARTER_CODE_HEADER), starter, F.lit("\n```"))) \
        .otherwise(problem)
    reasoning = T.strip_py(F.coalesce(_opt(df, "deepseek_reasoning"), F.lit("")))
    solution = T.last_fence_code(_opt(df, "deepseek_solution"))
    answer = F.concat(F.lit("<think>\n"), reasoning, F.lit("\n</think>\n\n```python\n"), solution, F.lit("\n```"))
    return M.messages(("user", user), ("assistant", answer))


def source_messages(df: DataFrame) -> Column:
    """M2: first match wins -- (problem and solution) -> conversations ->
    messages -> generic question/answer; then M4 adds the system prompt."""
    has_pair = T.nonempty(_opt(df, "problem")).isNotNull() & T.nonempty(_opt(df, "deepseek_solution")).isNotNull()
    expr = F.when(has_pair, reasoning_answer(df))
    if "conversations" in df.columns:
        expr = expr.when(F.size(F.coalesce(F.col("conversations"), F.array())) > 0,
                         M.sharegpt_to_messages("conversations"))
    if "messages" in df.columns:
        expr = expr.when(F.size(F.coalesce(F.col("messages"), F.array())) > 0,
                         F.col("messages").cast(M.MESSAGE_TYPE))
    question = T.first_nonempty(_opt(df, "problem"), _opt(df, "question"), _opt(df, "prompt"))
    sol = T.first_nonempty(_opt(df, "solution"), _opt(df, "response"), _opt(df, "answer"))
    expr = expr.otherwise(M.messages(("user", question), ("assistant", sol)))
    return M.ensure_system(expr)


def reasoning_sft(df: DataFrame, key: str = "id", params: JobParams | None = None,
                  n: int | None = None) -> DataFrame:
    """F1 domain filter -> seeded shuffle + cap -> M2/M3 -> M4.

    The source is never pre-sliced (a prefix could fall inside one domain)."""
    p = params or JobParams()
    df = domain_filter(df, p.reasoning_domain)
    df = chosen_rows(df, key, n if n is not None else p.reasoning_max_samples, p.seed)
    return df.select(key, source_messages(df).alias("messages"))


def general_sft(df: DataFrame, key: str = "id", params: JobParams | None = None,
                n: int | None = None) -> DataFrame:
    """Seeded shuffle + cap, keep only ``messages`` (passed through)."""
    p = params or JobParams()
    return seeded_cap(df, key, n if n is not None else p.general_max_samples, p.seed).select(key, "messages")


def split_tests(tests) -> tuple[Column, Column]:
    """M6: public = first test; hidden = the rest, or all when only one."""
    t = F.coalesce(T.col_(tests), F.array().cast("array<string>"))
    public = F.slice(t, 1, 1)
    hidden = F.when(F.size(t) > 1, F.slice(t, 2, F.size(t) - 1)).otherwise(t)
    return public, hidden


def rl_prompts(df: DataFrame, key: str = "task_id", params: JobParams | None = None,
               n: int | None = None) -> DataFrame:
    """M5 (+M6): seeded cap, then prompt/tests/public_tests/setup per task."""
    p = params or JobParams()
    df = chosen_rows(df, key, n if n is not None else p.grpo_max_samples, p.seed)
    problem = T.first_nonempty(_opt(df, "text"), _opt(df, "prompt"))
    public, hidden = split_tests("test_list")
    user = F.concat(T.strip_py(problem), F.lit(C.PUBLIC_EXAMPLE_HEADER), F.array_join(public, "\n"))
    return df.select(
        key,
        M.messages(("system", C.CODE_SYSTEM_PROMPT), ("user", user)).alias("prompt"),
        hidden.alias("tests"), public.alias("public_tests"),
        F.coalesce(_opt(df, "test_setup_code"), F.lit("")).alias("setup"),
        (F.size(F.coalesce(F.col("test_list"), F.array())) == 1).alias("public_is_hidden"))


def repair_sft(df: DataFrame, key: str = "task_id", params: JobParams | None = None,
               n: int | None = None) -> DataFrame:
    """M7: one-bug repair trajectories. Rows without gold code, tests or a
    matching mutation are skipped; the cap comes last (after the filter)."""
    p = params or JobParams()
    gold = T.strip_py(F.coalesce(_opt(df, "code"), F.lit("")))
    tests = F.coalesce(F.col("test_list"), F.array().cast("array<string>"))
    cand = df.select(key, gold.alias("gold"), tests.alias("tests"),
                     T.strip_py(T.first_nonempty(_opt(df, "text"), _opt(df, "prompt"))).alias("problem"))
    cand = cand.filter((F.col("gold") != "") & (F.size("tests") > 0))
    # Rows without a matching rule are skipped (this is the empty-message
    # filter F2: a skipped row has no trajectory). The cap comes after that filter, on
    # keys; the choice is made again, and spliced, for the rows that stay.
    mutable = cand.select(key, F.explode(mutation_choices("gold", key, p.seed)))
    capped = chosen_rows(cand, key, n if n is not None else p.repair_max_samples, p.seed, among=mutable)
    capped = capped.select(key, "gold", "tests", "problem", F.explode(mutation_choices("gold", key, p.seed)).alias("ch"))
    capped = capped.select(key, "gold", "tests", "problem", F.col("ch.rule").alias("rule"),
                           apply_mutation("gold", "ch.rule", "ch.k").alias("mutated_code"))
    public = F.try_element_at("tests", F.lit(1))
    msgs = M.messages(
        ("system", C.CODE_SYSTEM_PROMPT),
        ("user", F.concat(F.col("problem"), F.lit(C.PUBLIC_EXAMPLE_HEADER), public)),
        ("assistant", F.concat(F.lit("```python\n"), F.col("mutated_code"), F.lit("\n```"))),
        ("user", T.failure_trace(public)),
        ("assistant", F.concat(F.lit("<think>\n" + C.REPAIR_RATIONALE + "\n</think>\n\n```python\n"),
                               F.col("gold"), F.lit("\n```"))))
    return capped.select(key, "rule", "mutated_code", msgs.alias("messages"))


def conversation_token_lengths(turns: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """M10 estimate of each conversation's rendered length (system prompt
    added when its first turn is not a system turn), from per-turn lengths
    only: one aggregate row per conversation, combined map-side."""
    sys_len = len(C.TEMPLATE_HEADER_OPEN) + len("system") + len(C.TEMPLATE_HEADER_CLOSE) \
        + len(C.CODE_SYSTEM_PROMPT) + len(C.TEMPLATE_EOT)
    per_conv = turns.groupBy(key).agg(
        F.sum(M.rendered_piece_length("role", "text")).alias("chars"),
        F.min(order).alias("first_turn"),
        F.min(F.when(F.col("role") == "system", F.col(order))).alias("first_system_turn"))
    # numeric aggregates only (hash aggregation): is the first turn a system turn?
    needs_sys = F.coalesce(F.col("first_system_turn") != F.col("first_turn"), F.lit(True))
    total = F.lit(len(C.TEMPLATE_BOS)) + F.col("chars") + F.when(needs_sys, F.lit(sys_len)).otherwise(F.lit(0))
    return per_conv.select(key, F.floor((total + F.lit(3)) / F.lit(4)).cast("bigint").alias("token_length"))


def sft_records(turns: DataFrame, params: JobParams | None = None, n: int | None = None,
                max_tokens: int | None = None, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """Conversations -> rendered SFT records: M4 ensure system -> M9 render ->
    M10 token estimate -> F3 length filter -> L1/L2 seeded cap.

    Plan shape: the rendered length of every conversation is known from
    per-turn lengths, so the length filter and the seeded top-n run on one
    aggregate row per conversation *before* any message array is built. Only
    the selected conversations are gathered and rendered; one join carries
    their token length to the turns, by the strategy AQE picks from its size.
    """
    p = params or JobParams()
    max_tokens = p.max_seq_length if max_tokens is None else max_tokens
    t = turns.select(key, order, "role", "text")
    fits = conversation_token_lengths(t, key, order).filter(F.col("token_length") <= max_tokens)
    chosen = seeded_cap(fits, key, n, p.seed).select(key, "token_length")
    recs = to_messages(t.join(chosen, key), key, order, carry=["token_length"])
    msgs = M.ensure_system("messages")
    return recs.select(key, F.size(msgs).alias("n_messages"), M.render_chat(msgs).alias("text"),
                       "token_length")


def sft_records_exact(turns: DataFrame, tokenizer_path: str, params: JobParams | None = None, n: int | None = None,
                      max_tokens: int | None = None, key: str = "conv_id", order: str = "turn",
                      counts: StageCounts | None = None) -> DataFrame:
    """SFT records by the exact token length of a tokenizer (M10) instead of the estimate:
    M4 -> M9 -> M10 -> F3 -> L1/L2 -> P3. ``counts`` counts the rows of the stages on the way.

    The length needs the rendered text, so all conversations are rendered."""
    p, counts = params or JobParams(), counts or StageCounts()
    msgs = M.ensure_system("messages")
    recs = counts.count(to_messages(turns.select(key, order, "role", "text"), key, order), "rendered")
    recs = recs.select(key, F.size(msgs).alias("n_messages"), M.render_chat(msgs).alias("text"))
    recs = recs.withColumn("token_length", token_length("text", tokenizer_path))
    fits = counts.count(recs.where(F.col("token_length") <= (p.max_seq_length if max_tokens is None else max_tokens)), "fits")
    return counts.count(seeded_cap(fits, key, n, p.seed), "capped").drop("token_length")
