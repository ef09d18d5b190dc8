"""DuckDB SQL of the queries in ``jobs``: what the job must leave, computed in one statement."""

from __future__ import annotations

from trainloom import config as C
from trainloom.plans import oracle as O
from trainloom.plans.derived import CHAT_INPUT_SQL, REPLIES_SQL, duck

ROLLOUT_LOG = f"""{O.BASE}
SELECT run_id, CAST(step AS BIGINT) AS step, task_id, CAST(sample_ix AS BIGINT) AS sample_ix, completion, round(frac, 6) AS test_score FROM scored"""

SNAPSHOTS = f"""
WITH {O.ROLLOUTS}
SELECT CAST(step AS BIGINT) AS step, count(*) AS completions, CAST(sum(length(completion)) AS BIGINT) AS chars FROM rollouts
WHERE step % 10 = 0 AND (step % 20 = 0 OR sample_ix = 0) GROUP BY step"""

_ORDER = f"row_number() OVER (ORDER BY {O.md5key('task_id')}, task_id) - 1"
SHUFFLED_INDEX = f"WITH {O.TASKS} SELECT task_id, {_ORDER} AS row_index FROM tasks"
INDEXED_TASKS = f"WITH {O.TASKS} SELECT task_id, {C.SHUFFLE_SEED} + {_ORDER} AS seed, length(coalesce(code, '')) AS code_chars FROM tasks"
UNPROBED = f"WITH {O.TASKS} SELECT task_id FROM tasks QUALIFY row_number() OVER (ORDER BY task_id) > {C.CURRICULUM_SAMPLE_SIZE}"

STEP_GROUPS = f"""{O.BASE},
p AS (SELECT step, frac AS score, (row_number() OVER (PARTITION BY step ORDER BY task_id, sample_ix) - 1) // {C.NUM_GENERATIONS} AS grp FROM scored)
SELECT CAST(step AS BIGINT) AS step, CAST(grp AS BIGINT) AS grp, count(*) AS n, round(min(score), 6) AS lo, round(max(score), 6) AS hi,
       count(*) > 1 AND max(score) - min(score) < {C.ZERO_VARIANCE_EPS} AS zero_variance FROM p GROUP BY step, grp"""

REPLY_LENGTHS = f"""WITH {O.ROLLOUTS} SELECT task_id, CAST(sample_ix AS BIGINT) AS sample_ix, length(completion) AS chars, length(completion) / 4 AS approx_tokens FROM rollouts"""

# The context after a user turn: the system prompt and the last turns since the last reset before it.
CHAT_CONTEXT = f"""
WITH c AS ({duck(CHAT_INPUT_SQL)}),
f AS (SELECT conv_id, turn, role, CASE WHEN role = 'user' THEN {O.strip('text')} ELSE {O._ANSWER_ONLY} END AS content FROM c
      WHERE role IN ('user', 'assistant') AND NOT (role = 'user' AND {O.strip('text')} = '')),
u AS (SELECT f.conv_id, f.turn AS at_turn, coalesce(max(r.turn), -1) AS reset_at FROM f
      LEFT JOIN f r ON r.conv_id = f.conv_id AND r.turn < f.turn AND r.role = 'user' AND r.content = '/reset'
      WHERE f.role = 'user' AND f.content <> '/reset' GROUP BY ALL),
h AS (SELECT u.conv_id, u.at_turn, f.turn, f.role, f.content FROM u JOIN f ON f.conv_id = u.conv_id AND f.turn > u.reset_at AND f.turn <= u.at_turn
      QUALIFY row_number() OVER (PARTITION BY u.conv_id, u.at_turn ORDER BY f.turn DESC) <= {2 * C.MAX_TURNS})
SELECT conv_id, at_turn, row_number() OVER (PARTITION BY conv_id, at_turn ORDER BY turn) AS pos, role, content FROM h
UNION ALL SELECT conv_id, at_turn, 0, 'system', {O.lit(C.CHAT_SYSTEM_PROMPT)} FROM u"""

STAGE_COUNTS = f"""
WITH {O._token_lengths()},
n AS (SELECT count(*) AS loaded, count_if(token_length <= {C.MAX_SEQ_LENGTH}) AS fits FROM est)
SELECT 'loaded' AS stage, CAST(NULL AS BIGINT) AS rows_in, loaded AS rows_out FROM n
UNION ALL SELECT 'fits', loaded, fits FROM n
UNION ALL SELECT 'records', fits, least(fits, 60) FROM n"""

THINK_SEGMENTS = f"WITH r AS ({duck(REPLIES_SQL)}) SELECT reply_id, {O.think('reply')} AS think, {O.answer('reply')} AS answer FROM r"


def _smoke(sql: str, budget: int, n: int) -> str:
    """A builder's SQL over the first ``max(100, 4 n)`` tasks by key, with a budget of ``n``."""
    head = f"tasks AS (SELECT * FROM alltasks ORDER BY task_id LIMIT {max(100, 4 * n)})"
    return sql.replace(", tasks AS (", ", alltasks AS (", 1).replace(" FROM tasks0)", f" FROM tasks0), {head}", 1).replace(f"LIMIT {budget})", f"LIMIT {n})")


JOBS_SQL = {
    "step_metrics_stream": O.STEP_METRICS,
    "rollout_log": ROLLOUT_LOG,
    "metrics_log": O.STEP_METRICS,
    "snapshots": SNAPSHOTS,
    "think_segments_stream": THINK_SEGMENTS,
    "chat_context_stream": CHAT_CONTEXT,
    "shuffled_index": SHUFFLED_INDEX,
    "unprobed_tasks": UNPROBED,
    "step_groups": STEP_GROUPS,
    "rewards_plugin": O.REWARDS,
    "rl_prompts_mapped": O.uncapped(O.RL_PROMPTS, 374),
    "indexed_tasks": INDEXED_TASKS,
    "reply_lengths_batched": REPLY_LENGTHS,
    "sft_stage_counts": STAGE_COUNTS,
    "smoke_rl_prompts": _smoke(O.RL_PROMPTS, 374, 30),
    "smoke_repair_sft": _smoke(O.REPAIR_SFT, 300, 30),
}
