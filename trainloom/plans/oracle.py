"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark plans: same derived inputs (the shared
derivation SQL), same semantics, DuckDB idioms (lists, lambdas, QUALIFY).
"""

from __future__ import annotations

from trainloom import config as C
from trainloom.functions.text import LINE_BREAK_RE, PY_WHITESPACE, WORD, WS
from trainloom.plans.derived import (BENCH_SQL, CHAT_INPUT_SQL, MIXED_SQL, OUTCOME_PASSED_SQL, OUTCOME_PRESENT_SQL,
                                     PROBE_FAILED_SQL, PROMPTS_SQL, REASONING_SQL, ROLLOUTS_SQL, SHAREGPT_SQL, TASKS_SQL,
                                     TIMING_SQL, duck)


def lit(s: str) -> str:
    """A Python string as a DuckDB expression (newlines via chr(10))."""
    return " || chr(10) || ".join("'" + p.replace("'", "''") + "'" for p in s.split("\n"))


WS_CHARS = " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE)


def strip(x: str) -> str:
    return f"trim({x}, {WS_CHARS})"


FENCE = "(?s)```(?i:python)?" + WS + "*\\n(.*?)```"
DEF_LINE = "(?m)^" + WS + "*(?:async" + WS + "+)?def" + WS + "+" + WORD + "+" + WS + "*\\("
THINK_SEG = "(?s)<think>(.*?)(?:</think>|\\z)"
THINK_BLK = "(?s)<think>.*?(?:</think>|\\z)"
SEED = C.SHUFFLE_SEED
HDR = len(C.TEMPLATE_HEADER_OPEN) + len(C.TEMPLATE_HEADER_CLOSE) + len(C.TEMPLATE_EOT)
BOS = len(C.TEMPLATE_BOS)
SYSLEN = HDR + len("system") + len(C.CODE_SYSTEM_PROMPT)
SYS = lit(C.CODE_SYSTEM_PROMPT)


def md5key(k: str) -> str:
    return f"md5('{SEED}:' || CAST({k} AS VARCHAR))"


def msg(role: str, content: str) -> str:
    return f"struct_pack(role := {role}, content := {content})"


def last_fence(t: str) -> str:
    return strip(f"coalesce(regexp_extract_all(coalesce({t}, ''), '{FENCE}', 1)[-1], coalesce({t}, ''))")


def extract_code(t: str) -> str:
    tt = f"coalesce({t}, '')"
    b = f"regexp_extract_all({tt}, '{FENCE}', 1)"
    after = f"CASE WHEN strpos({tt}, '</think>') > 0 THEN substr({tt}, strpos({tt}, '</think>') + 8) END"
    return strip(f"coalesce(list_filter({b}, lambda x: regexp_matches(x, '{DEF_LINE}'))[1], {b}[1], {after}, {tt})")


def think(t: str) -> str:
    return f"array_to_string(regexp_extract_all(coalesce({t}, ''), '{THINK_SEG}', 1), '')"


def answer(t: str) -> str:
    return f"regexp_replace(coalesce({t}, ''), '{THINK_BLK}', '', 'g')"


def render(m: str) -> str:
    piece = (f"{lit(C.TEMPLATE_HEADER_OPEN)} || x.role || {lit(C.TEMPLATE_HEADER_CLOSE)} || "
             f"coalesce(x.content, '') || {lit(C.TEMPLATE_EOT)}")
    return f"{lit(C.TEMPLATE_BOS)} || array_to_string(list_transform({m}, lambda x: {piece}), '')"


def ensure_system(m: str) -> str:
    return (f"CASE WHEN {m}[1].role = 'system' THEN {m} "
            f"ELSE list_concat([{msg(repr('system'), SYS)}], {m}) END")


def explode(src: str, key: str, extra: str = "") -> str:
    ex = f"{extra}, " if extra else ""
    return (f"SELECT {key}, {ex}CAST(i - 1 AS BIGINT) AS pos, m[i].role AS role, m[i].content AS content "
            f"FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM {src}) e")


TASKS = (f"tasks0 AS ({duck(TASKS_SQL)}), tasks AS (SELECT * EXCLUDE (t1, t2, t3), "
         f"list_slice([t1, t2, t3], 1, n_tests) AS test_list FROM tasks0)")
ROLLOUTS = f"rollouts AS ({duck(ROLLOUTS_SQL)})"
OUTCOMES = (f"outcomes AS (SELECT task_id, sample_ix, test_ix, {OUTCOME_PASSED_SQL} AS passed, test_ix = 0 AS is_public "
            f"FROM (SELECT task_id, sample_ix, l_partkey, l_suppkey, unnest([0, 1, 2]) AS test_ix FROM rollouts) x "
            f"WHERE {OUTCOME_PRESENT_SQL})")
VERDICTS = ("v AS (SELECT task_id, sample_ix, test_ix, bool_or(coalesce(passed, false)) AS passed "
            "FROM outcomes GROUP BY ALL)")


def scored_cte(name: str, tests_expr: str, first: str = "0") -> str:
    """Candidates with pass counts over ``tests_expr`` (a list from tasks t)."""
    return f"""
{name}_c AS (SELECT r.*, coalesce({tests_expr}, []::VARCHAR[]) AS tests, {first} AS first_ix FROM rollouts r LEFT JOIN tasks t USING (task_id)),
{name}_np AS (SELECT c.task_id, c.sample_ix, count(*) AS n_passed FROM {name}_c c JOIN v
   ON c.task_id = v.task_id AND c.sample_ix = v.sample_ix AND v.test_ix >= c.first_ix AND v.test_ix < c.first_ix + len(c.tests) AND v.passed GROUP BY ALL),
{name} AS (SELECT c.*, len(c.tests) AS n_tests, coalesce(np.n_passed, 0) AS n_passed,
   CASE WHEN len(c.tests) > 0 THEN coalesce(np.n_passed, 0) / len(c.tests) ELSE 0.0 END AS frac
   FROM {name}_c c LEFT JOIN {name}_np np USING (task_id, sample_ix))"""


# A task of several tests shows its first one; the others are hidden and alone count for rewards and grades.
HIDDEN_TESTS = "CASE WHEN len(t.test_list) > 1 THEN t.test_list[2:] ELSE t.test_list END"
HIDDEN_FIRST = "CASE WHEN len(t.test_list) > 1 THEN 1 ELSE 0 END"
BASE = f"WITH {TASKS}, {ROLLOUTS}, {OUTCOMES}, {VERDICTS}, {scored_cte('scored', HIDDEN_TESTS, HIDDEN_FIRST)}"


# -- E1 -------------------------------------------------------------------------

def _token_lengths() -> str:
    return f"""
t AS (SELECT conv_id, turn, role, text FROM conversations),
per AS (SELECT conv_id, sum({HDR} + length(role) + coalesce(length(text), 0)) AS chars,
               arg_min(role, turn) AS first_role FROM t GROUP BY conv_id),
est AS (SELECT conv_id, CAST(floor(({BOS} + chars + CASE WHEN coalesce(first_role <> 'system', true)
        THEN {SYSLEN} ELSE 0 END + 3) / 4) AS BIGINT) AS token_length FROM per)"""


def uncapped(sql: str, n: int) -> str:
    """A builder's SQL without its budget of ``n`` rows."""
    return sql.replace(f" LIMIT {n})", ")")


def sft_sql(max_tokens: int, n: int) -> str:
    return f"""
WITH {_token_lengths()},
chosen AS (SELECT * FROM est WHERE token_length <= {max_tokens} ORDER BY {md5key('conv_id')}, conv_id LIMIT {n}),
msgs AS (SELECT conv_id, list({msg('role', 'text')} ORDER BY turn) AS m FROM t
         WHERE conv_id IN (SELECT conv_id FROM chosen) GROUP BY conv_id),
sm AS (SELECT conv_id, {ensure_system('m')} AS m FROM msgs)
SELECT sm.conv_id, CAST(len(sm.m) AS BIGINT) AS n_messages, {render('sm.m')} AS text, chosen.token_length
FROM sm JOIN chosen USING (conv_id)"""


LENGTH_ACCOUNTING = f"""
WITH {_token_lengths()}
SELECT count(*) AS loaded, count_if(token_length <= {C.MAX_SEQ_LENGTH}) AS kept,
       count_if(token_length > {C.MAX_SEQ_LENGTH}) AS removed FROM est"""

MSGS = f"msgs AS (SELECT conv_id, list({msg('role', 'text')} ORDER BY turn) AS m FROM conversations GROUP BY conv_id)"

SFT_SPANS = f"""
WITH {MSGS},
sm AS (SELECT conv_id, {ensure_system('m')} AS m FROM msgs),
l AS (SELECT conv_id, m, list_transform(m, lambda x: {HDR} + length(x.role) + coalesce(length(x.content), 0)) AS lens
      FROM sm),
e AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM l)
SELECT conv_id, CAST(i - 1 AS BIGINT) AS pos, m[i].role AS role,
       CAST({BOS} + coalesce(list_sum(list_slice(lens, 1, i - 1)), 0) AS BIGINT) AS start,
       CAST(lens[i] AS BIGINT) AS length, m[i].role = 'assistant' AS is_target
FROM e"""

GENERAL_SFT = f"""
WITH {MSGS},
cap AS (SELECT * FROM msgs ORDER BY {md5key('conv_id')}, conv_id LIMIT 4000)
{explode('cap', 'conv_id')}"""

SHAREGPT = f"""
WITH s AS ({duck(SHAREGPT_SQL)})
SELECT conv_id AS id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS pos,
  CASE coalesce(nullif(speaker, ''), role_name) WHEN 'human' THEN 'user' WHEN 'user' THEN 'user'
       WHEN 'gpt' THEN 'assistant' WHEN 'assistant' THEN 'assistant' WHEN 'system' THEN 'system'
       ELSE 'user' END AS role,
  coalesce(nullif(value, ''), content, '') AS content
FROM s"""

_STARTER = strip("coalesce(starter_code, '')")
_USER3 = (f"{strip('problem')} || CASE WHEN {_STARTER} <> '' THEN {lit(C.STARTER_CODE_HEADER)} || {_STARTER} "
          f"|| chr(10) || '```' ELSE '' END")
_REASON = strip("coalesce(deepseek_reasoning, '')")
_ANS3 = (f"'<think>' || chr(10) || {_REASON} || chr(10) "
         f"|| '</think>' || chr(10) || chr(10) || '```python' || chr(10) || {last_fence('deepseek_solution')} "
         f"|| chr(10) || '```'")

REASONING_SFT = f"""
WITH r AS ({duck(REASONING_SQL)}),
f AS (SELECT * FROM r WHERE lower(coalesce(CAST(domain AS VARCHAR), 'None')) = 'code'
      ORDER BY {md5key('id')}, id LIMIT 12000),
mm AS (SELECT id, CASE WHEN nullif(problem, '') IS NOT NULL AND nullif(deepseek_solution, '') IS NOT NULL
        THEN [{msg("'user'", _USER3)}, {msg("'assistant'", _ANS3)}]
        ELSE [{msg("'user'", "coalesce(nullif(problem, ''), nullif(question, ''), '')")},
              {msg("'assistant'", "coalesce(nullif(answer, ''), '')")}] END AS m0 FROM f),
fm AS (SELECT id, {ensure_system('m0')} AS m FROM mm)
{explode('fm', 'id')}"""

DOMAIN_COUNTS = f"WITH r AS ({duck(REASONING_SQL)}) SELECT domain, count(*) AS n FROM r GROUP BY domain"

SMOKE_SLICE = "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 100"

_T = "coalesce(test_list, []::VARCHAR[])"
_HIDDEN = f"CASE WHEN len({_T}) > 1 THEN list_slice({_T}, 2, len({_T})) ELSE {_T} END"
RL_PROMPTS = f"""
WITH {TASKS},
cap AS (SELECT * FROM tasks ORDER BY {md5key('task_id')}, task_id LIMIT 374)
SELECT task_id,
  {strip("coalesce(nullif(text, ''), nullif(prompt, ''), '')")} || {lit(C.PUBLIC_EXAMPLE_HEADER)}
    || array_to_string(list_slice({_T}, 1, 1), chr(10)) AS user_content,
  CAST(len({_HIDDEN}) AS BIGINT) AS n_hidden,
  array_to_string({_HIDDEN}, chr(10)) AS hidden_tests,
  coalesce({_T}[1], '') AS public_test,
  coalesce(test_setup_code, '') AS setup,
  len({_T}) = 1 AS public_is_hidden
FROM cap"""

# Mutation rules in DuckDB: the literal each pattern matches, and RE2 patterns.
# Rule 2 (a lookaround pattern in the library) is emulated with a marker pass.
_RULE_ROWS = ", ".join(
    f"({ix}, '{pat}', '{repl}', '{matched}')"
    for ix, ((pat, repl), matched) in enumerate(zip(C.BUG_RULES, [
        "<=", ">=", "==", "return True", "return False", "min(", "max(", "sorted(", "+ 1", "- 1"])))
_MARKED = ("string_split(regexp_replace(regexp_replace(g.gold, '(^|[^=!<>])==', '\\1' || chr(1) || '==', 'g'), "
           "chr(1) || '===', '===', 'g'), chr(1) || '==')")
MUTATION_CTES = f"""
rules AS (SELECT * FROM (VALUES {_RULE_ROWS}) r(ix, pat, repl, matched)),
g AS (SELECT task_id, {strip("coalesce(code, '')")} AS gold, {_T} AS tests,
             {strip("coalesce(nullif(text, ''), nullif(prompt, ''), '')")} AS problem FROM tasks),
mm AS (SELECT g.task_id, g.gold, g.tests, g.problem, r.ix, r.repl, r.matched,
        CASE WHEN r.ix = 2 THEN {_MARKED} ELSE string_split_regex(g.gold, r.pat) END AS parts,
        md5('{SEED}:' || g.task_id || ':rule' || CAST(r.ix AS VARCHAR)) AS ord
       FROM g, rules r WHERE g.gold <> ''),
pick AS (SELECT *, len(parts) - 1 AS n FROM mm WHERE len(parts) > 1
         QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY ord) = 1),
mut AS (SELECT *, CAST(('0x' || substr(md5('{SEED}:' || task_id || ':occurrence'), 1, 8)) AS BIGINT) % n AS k
        FROM pick),
muts AS (SELECT task_id, gold, tests, problem, ix AS rule,
   array_to_string(list_transform(parts, lambda p, i: p || CASE WHEN i <= n THEN
     (CASE WHEN i - 1 = k THEN repl ELSE matched END) ELSE '' END), '') AS mutated_code FROM mut)"""

MUTATIONS = f"""
WITH {TASKS}, {MUTATION_CTES}
SELECT task_id, CAST(rule AS BIGINT) AS rule, mutated_code FROM muts"""

_PUB = "tests[1]"
_TRACE = (f"{lit(C.FAILURE_TRACE_HEAD)} || {_PUB} || {lit(C.FAILURE_TRACE_MID)} || {_PUB} || "
          f"{lit(C.FAILURE_TRACE_TAIL)}")
REPAIR_SFT = f"""
WITH {TASKS}, {MUTATION_CTES},
cap AS (SELECT * FROM muts WHERE len(tests) > 0 ORDER BY {md5key('task_id')}, task_id LIMIT 300),
fm AS (SELECT task_id, rule, mutated_code, [
   {msg("'system'", SYS)},
   {msg("'user'", f"problem || {lit(C.PUBLIC_EXAMPLE_HEADER)} || {_PUB}")},
   {msg("'assistant'", "'```python' || chr(10) || mutated_code || chr(10) || '```'")},
   {msg("'user'", _TRACE)},
   {msg("'assistant'", lit('<think>\n' + C.REPAIR_RATIONALE + '\n</think>\n\n```python\n') + " || gold || chr(10) || '```'")}
 ] AS m FROM cap)
{explode('fm', 'task_id', 'CAST(rule AS BIGINT) AS rule, mutated_code')}"""

# -- text functions over rollouts --------------------------------------------------

_R = f"WITH {ROLLOUTS} SELECT task_id, CAST(sample_ix AS BIGINT) AS sample_ix"
LAST_FENCE = f"{_R}, {last_fence('completion')} AS code FROM rollouts"
EXTRACT_CODE = f"{_R}, {extract_code('completion')} AS code FROM rollouts"
THINK_SPLIT = f"{_R}, {think('completion')} AS think, {answer('completion')} AS answer FROM rollouts"
_FR = ("(CASE WHEN contains(coalesce(completion, ''), '<think>') AND contains(coalesce(completion, ''), '</think>') "
       f"THEN {C.FORMAT_THINK_BONUS} ELSE 0.0 END + CASE WHEN len(string_split(coalesce(completion, ''), "
       f"'{C.FENCE_PYTHON}')) - 1 = 1 THEN {C.FORMAT_FENCE_BONUS} ELSE 0.0 END)")
FORMAT_REWARD = f"{_R}, round(CAST({_FR} AS DOUBLE), 6) AS format_reward FROM rollouts"
COMPLETION_STATS = (f"{_R}, CAST(length(completion) AS BIGINT) AS completion_chars, "
                    f"round(length(completion) / 4, 6) AS approx_tokens, "
                    f"length(completion) / 4 >= {C.MAX_COMPLETION_LENGTH * C.TRUNCATION_FRACTION!r} AS truncated "
                    f"FROM rollouts")

COMPLETION_TEXTS = f"{_R}, CASE WHEN l_partkey % 3 = 0 THEN 'first: ' || completion ELSE completion END AS text FROM rollouts"

SOURCE_MESSAGES = f"""
WITH s AS ({duck(MIXED_SQL)}),
m0 AS (SELECT id, CASE kind
   WHEN 0 THEN [{msg("'user'", "problem")}, {msg("'assistant'", "'<think>' || chr(10) || deepseek_reasoning || chr(10) || '</think>' || chr(10) || chr(10) || '```python' || chr(10) || 'x = ' || CAST(id AS VARCHAR) || chr(10) || '```'")}]
   WHEN 1 THEN [{msg("'user'", "coalesce(text, '')")}, {msg("'assistant'", "coalesce(lang, '')")}, {msg("'user'", "coalesce(source, '')")}]
   WHEN 2 THEN [{msg("'system'", "source")}, {msg("'user'", "text")}, {msg("'assistant'", "lang")}]
   WHEN 3 THEN [{msg("'user'", "text")}, {msg("'assistant'", "source")}]
   ELSE [{msg("'user'", "question")}, {msg("'assistant'", "coalesce(answer, '')")}] END AS m FROM s),
fm AS (SELECT id, {ensure_system('m')} AS m FROM m0)
{explode('fm', 'id')}"""

DOCTEST_CANDIDATES = f"""
WITH p AS ({duck(PROMPTS_SQL)}),
s AS (SELECT doc_id, string_split_regex(coalesce(prompt, ''), '{LINE_BREAK_RE}') AS raw FROM p),
l AS (SELECT doc_id, CASE WHEN raw[-1] = '' THEN list_slice(raw, 1, len(raw) - 1) ELSE raw END AS lines FROM s),
c AS (SELECT doc_id, list_filter(list_transform(lines, lambda x, i: CASE WHEN i < len(lines)
        AND starts_with({strip('x')}, '>>> ') AND {strip('lines[i + 1]')} <> ''
        AND NOT starts_with({strip('lines[i + 1]')}, '>>> ')
        AND NOT starts_with({strip(f"substr({strip('x')}, 5)")}, 'print(')
        THEN 'assert (' || {strip(f"substr({strip('x')}, 5)")} || ') == (' || {strip('lines[i + 1]')} || ')' END),
      lambda y: y IS NOT NULL) AS cands FROM l),
e AS (SELECT doc_id, cands, unnest(range(1, len(cands) + 1)) AS i FROM c)
SELECT doc_id, CAST(i - 1 AS BIGINT) AS test_ix, cands[i] AS assert_text FROM e"""

# -- E2 ------------------------------------------------------------------------------

PASS_FRACTION = f"""{BASE}
SELECT task_id, CAST(sample_ix AS BIGINT) AS sample_ix, CAST(n_tests AS BIGINT) AS n_tests,
       CAST(n_passed AS BIGINT) AS n_passed, round(frac, 6) AS frac, round(3.0 * frac, 6) AS reward FROM scored"""

REWARDS = f"""{BASE}
SELECT task_id, CAST(sample_ix AS BIGINT) AS sample_ix, round({C.CORRECTNESS_WEIGHT} * frac, 6) AS correctness,
       round(CAST({_FR} AS DOUBLE), 6) AS format, round({C.CORRECTNESS_WEIGHT} * frac + {_FR}, 6) AS total
FROM scored"""

_N = C.NUM_GENERATIONS
_TRUNC = C.MAX_COMPLETION_LENGTH * C.TRUNCATION_FRACTION
GROUPS = f"""
base AS (SELECT step, task_id, sample_ix, frac AS score, length(completion) AS chars FROM scored),
grp AS (SELECT step, task_id, sample_ix // {_N} AS grp, count(*) AS n, min(score) AS lo, max(score) AS hi,
        sum(score) AS s1, sum(score * score) AS s2, sum(chars) AS chars, max(chars) AS chars_max,
        count_if(chars / 4 >= {_TRUNC!r}) AS n_trunc FROM base GROUP BY ALL),
timing AS ({duck(TIMING_SQL)}),
sm AS (SELECT step, sum(s1) / sum(n) AS reward_mean,
        CASE WHEN sum(n) > 1 THEN sqrt(greatest(sum(s2) / sum(n) - (sum(s1) / sum(n)) ** 2, 0.0)) ELSE 0.0 END
          AS reward_std,
        count_if(n > 1 AND hi - lo < {C.ZERO_VARIANCE_EPS}) AS zero_variance_groups, count(*) AS num_groups,
        sum(chars) / sum(n) AS completion_chars_mean, max(chars_max) AS completion_chars_max,
        sum(n_trunc) / sum(n) AS truncation_rate_approx
       FROM grp GROUP BY step),
metrics AS (SELECT sm.*, round(timing.elapsed_sec, 3) AS sec_per_step, round(timing.peak_gb, 3) AS peak_vram_gb
            FROM sm LEFT JOIN timing USING (step))"""

ROLLOUT_GROUPS = f"""{BASE}, {GROUPS}
SELECT CAST(step AS BIGINT) AS step, task_id, CAST(grp AS BIGINT) AS grp, CAST(n AS BIGINT) AS n,
       round(lo, 6) AS lo, round(hi, 6) AS hi, n > 1 AND hi - lo < {C.ZERO_VARIANCE_EPS} AS zero_variance FROM grp"""

STEP_METRICS = f"""{BASE}, {GROUPS}
SELECT CAST(step AS BIGINT) AS step, round(reward_mean, 6) AS reward_mean, round(reward_std, 6) AS reward_std,
  CAST(zero_variance_groups AS BIGINT) AS zero_variance_groups, CAST(num_groups AS BIGINT) AS num_groups,
  round(completion_chars_mean, 6) AS completion_chars_mean, CAST(completion_chars_max AS BIGINT) AS completion_chars_max,
  round(truncation_rate_approx, 6) AS truncation_rate_approx, round(sec_per_step, 6) AS sec_per_step,
  round(peak_vram_gb, 6) AS peak_vram_gb FROM metrics"""

RUN_REPORT = f"""{BASE}, {GROUPS},
c1 AS (SELECT max(step) AS cut FROM (SELECT step FROM metrics ORDER BY step LIMIT 20)),
c2 AS (SELECT min(step) AS cut FROM (SELECT step FROM metrics ORDER BY step DESC LIMIT 20))
SELECT CAST(count(*) AS BIGINT) AS steps, round(sum(sec_per_step), 6) AS total_sec,
  round(avg(sec_per_step), 6) AS mean_sec_per_step,
  round(avg(reward_mean) FILTER (WHERE step <= (SELECT cut FROM c1)), 6) AS reward_first_k,
  round(avg(reward_mean) FILTER (WHERE step >= (SELECT cut FROM c2)), 6) AS reward_last_k,
  round(avg(reward_mean), 6) AS reward_all,
  CAST(count_if(reward_std < {C.ZERO_VARIANCE_EPS}) AS BIGINT) AS zero_variance_steps,
  CAST(count_if(reward_mean IS NULL OR isnan(reward_mean) OR isinf(reward_mean)) AS BIGINT) AS non_finite_rows,
  round(avg(truncation_rate_approx) FILTER (WHERE step >= (SELECT cut FROM c2)), 6) AS truncation_last_k,
  round(max(peak_vram_gb), 6) AS peak_vram_gb
FROM metrics"""

# -- curriculum ------------------------------------------------------------------------

_K = C.CURRICULUM_SAMPLE_SIZE
PROBE = f"""
probed AS (SELECT task_id FROM tasks ORDER BY {md5key('task_id')}, task_id LIMIT {_K}),
pv AS (SELECT task_id, min(frac) AS mn, max(frac) AS mx, false AS errored FROM scored
       WHERE sample_ix < 2 AND task_id IN (SELECT task_id FROM probed) GROUP BY task_id),
verdict AS (SELECT *, errored OR NOT (mn >= 1 - {C.ZERO_VARIANCE_EPS} OR mx <= {C.ZERO_VARIANCE_EPS}) AS keep FROM pv)"""

PROBE_VERDICTS = f"""{BASE}, {PROBE}
SELECT task_id, round(mn, 6) AS min_score, round(mx, 6) AS max_score, errored, keep FROM verdict"""

PROBE_VERDICTS_ERRORS = PROBE_VERDICTS.replace("false AS errored", f"bool_or({PROBE_FAILED_SQL}) AS errored")

CURRICULUM_TASKS = f"""{BASE}, {PROBE}
SELECT task_id FROM tasks WHERE task_id NOT IN (SELECT task_id FROM verdict WHERE NOT keep)"""

RL_CURRICULUM = f"""{BASE}, {PROBE},
chain AS (SELECT * FROM ({RL_PROMPTS}) p)
SELECT * FROM chain WHERE task_id NOT IN (SELECT task_id FROM verdict WHERE NOT keep)"""

CURRICULUM_ACCOUNTING = f"""{BASE}, {PROBE},
d AS (SELECT count(*) AS dropped FROM verdict WHERE NOT keep),
p AS (SELECT count(*) AS probed FROM probed),
a AS (SELECT count(*) AS total_all FROM tasks)
SELECT p.probed, d.dropped, p.probed - d.dropped AS kept_probed, a.total_all - p.probed AS unprobed,
       a.total_all - d.dropped AS total FROM p, d, a"""

# -- E3 ---------------------------------------------------------------------------------

EVAL = f"""{BASE}, {scored_cte('pubs', 'list_slice(t.test_list, 1, 1)')},
cand AS (SELECT task_id, sample_ix, {extract_code('completion')} AS code, n_tests > 0 AS has_public,
                frac AS public_frac, ran_ok,
                CASE WHEN n_tests > 0 THEN frac WHEN ran_ok THEN 1.0 ELSE 0.0 END AS select_score FROM pubs),
graded AS (SELECT task_id, sample_ix, n_tests > 0 AND n_passed = n_tests AS ok FROM scored),
best4 AS (SELECT task_id, arg_max(sample_ix, struct_pack(s := select_score, i := -sample_ix)) AS sample_ix,
                 max(select_score) AS select_score FROM cand WHERE sample_ix < 4 GROUP BY task_id),
best1 AS (SELECT task_id, sample_ix FROM cand WHERE sample_ix < 1),
att AS (SELECT s.task_id, s.sample_ix AS iter, {extract_code('s.completion')} AS code, s.frac AS score, s.ran_ok,
               coalesce(len(t.test_list) > 0, false) AS has_tests
        FROM pubs s LEFT JOIN tasks t USING (task_id) WHERE s.sample_ix < {C.MAX_ITERS}),
att2 AS (SELECT *, CASE WHEN has_tests THEN score >= 1.0 ELSE ran_ok END AS success FROM att),
ag AS (SELECT task_id, any_value(has_tests) AS has_tests, min(iter) FILTER (WHERE success) AS success_iter,
          arg_min(code, iter) FILTER (WHERE success) AS success_code,
          arg_max(code, struct_pack(s := score, i := -iter)) AS best_code,
          arg_max(iter, struct_pack(s := score, i := -iter)) AS best_iter,
          max(score) AS best_score, arg_max(code, iter) AS last_code, max(iter) AS last_iter
       FROM att2 GROUP BY task_id),
agent AS (SELECT task_id,
   coalesce(CASE WHEN success_iter IS NOT NULL THEN success_code WHEN has_tests
            THEN coalesce(nullif(best_code, ''), last_code) ELSE last_code END, '') AS code,
   CASE WHEN success_iter IS NOT NULL THEN 1.0 WHEN has_tests THEN greatest(best_score, 0.0) ELSE 0.0 END AS score,
   coalesce(success_iter, last_iter) + 1 AS iterations,
   CASE WHEN success_iter IS NOT NULL THEN success_iter
        WHEN has_tests AND coalesce(best_code, '') <> '' THEN best_iter ELSE last_iter END AS chosen_iter
   FROM ag)"""

BEST_OF_K = f"""{EVAL}
SELECT task_id, CAST(sample_ix AS BIGINT) AS sample_ix, round(select_score, 6) AS select_score FROM best4"""

BEST_ATTEMPT = f"""{EVAL}
SELECT task_id, code, round(score, 6) AS score, CAST(iterations AS BIGINT) AS iterations FROM agent"""

PASS_AT_1 = f"""{EVAL},
won AS (SELECT 'single_shot' AS setting, task_id, sample_ix FROM best1
        UNION ALL SELECT 'best_of_4', task_id, sample_ix FROM best4
        UNION ALL SELECT 'agentic', task_id, chosen_iter FROM agent),
allg AS (SELECT e.setting, t.task_id, coalesce(g.ok, false) AS ok
         FROM tasks t, (SELECT unnest(['single_shot', 'best_of_4', 'agentic']) AS setting) e
         LEFT JOIN won w ON w.setting = e.setting AND w.task_id = t.task_id
         LEFT JOIN graded g ON g.task_id = w.task_id AND g.sample_ix = w.sample_ix),
rates AS (SELECT setting, count_if(ok) / count(*) AS rate, count(*) AS n FROM allg GROUP BY setting)
SELECT setting, round(rate, 6) AS pass_at_1, CAST(n AS BIGINT) AS n, printf('%.1f%%', 100.0 * rate) AS pass_at_1_text
FROM rates"""

_OBS = (f"CASE WHEN has_tests THEN {lit(C.OBS_TESTS_FAILED)} ELSE {lit(C.OBS_EXEC_ERROR)} END || "
        f"substr(coalesce(nullif(stderr, ''), stdout, ''), 1, {C.OBS_MAX_CHARS}) || {lit(C.OBS_FIX_SUFFIX)}")
REVISE_TRANSCRIPT = f"""{BASE}, {scored_cte('pubs', 'list_slice(t.test_list, 1, 1)')},
tk AS (SELECT task_id, {strip("coalesce(nullif(text, ''), nullif(prompt, ''), '')")} AS problem,
              list_slice(coalesce(test_list, []::VARCHAR[]), 1, 1) AS tests, len(coalesce(test_list, []::VARCHAR[])) > 0 AS has_tests
       FROM tasks),
a AS (SELECT s.task_id, s.sample_ix AS iter, s.completion AS reply, tk.has_tests, s.stdout, s.stderr,
             coalesce(CASE WHEN tk.has_tests THEN s.frac >= 1.0 ELSE s.ran_ok END, false) AS success
      FROM pubs s JOIN tk USING (task_id) WHERE s.sample_ix < {C.MAX_ITERS}),
st AS (SELECT task_id, min(iter) FILTER (WHERE success) AS stop FROM a GROUP BY task_id),
k AS (SELECT a.* FROM a JOIN st USING (task_id) WHERE st.stop IS NULL OR a.iter <= st.stop),
rows AS (
  SELECT task_id, 0 AS pos, 'system' AS role, {SYS} AS content FROM tk WHERE task_id IN (SELECT task_id FROM k)
  UNION ALL
  SELECT task_id, 1, 'user', problem || CASE WHEN has_tests THEN {lit(C.TESTS_HEADER)} || array_to_string(tests, chr(10))
         ELSE '' END FROM tk WHERE task_id IN (SELECT task_id FROM k)
  UNION ALL SELECT task_id, 2 + 2 * iter, 'assistant', reply FROM k
  UNION ALL SELECT task_id, 3 + 2 * iter, 'user', {_OBS} FROM k WHERE NOT success)
SELECT task_id, CAST(pos AS BIGINT) AS pos, role, content FROM rows"""

EVAL_PROMPTS = f"""
WITH b AS ({duck(BENCH_SQL)})
SELECT task_id, {lit(C.COMPLETE_FUNCTION_PREFIX)} || coalesce(prompt, '') AS user_content,
       coalesce(code, '') || chr(10) || coalesce(test, '') || chr(10) || 'check(' || coalesce(entry_point, '') || ')'
       || chr(10) AS grading_script
FROM b"""


def _window(src: str, k: int) -> str:
    return f"""
SELECT conv_id, turn, role, text FROM {src} WHERE role = 'system'
UNION ALL
SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn
   FROM {src} WHERE role <> 'system' OR role IS NULL) w WHERE rn <= {2 * k}"""


_ANSWER_ONLY = f"CASE WHEN role = 'assistant' THEN {strip(answer('text'))} ELSE text END"
MEMORY_WINDOW = f"""
WITH a AS (SELECT conv_id, turn, role, {_ANSWER_ONLY} AS text FROM conversations)
{_window('a', 2)}"""

CHAT_MEMORY = f"""
WITH c AS ({duck(CHAT_INPUT_SQL)}),
f AS (SELECT * FROM c WHERE NOT (role = 'user' AND {strip('text')} = '')),
rs AS (SELECT conv_id, max(turn) AS reset_at FROM f WHERE {strip('text')} = '/reset' GROUP BY conv_id),
k AS (SELECT f.* FROM f LEFT JOIN rs USING (conv_id) WHERE rs.reset_at IS NULL OR f.turn > rs.reset_at OR f.role = 'system'),
a AS (SELECT conv_id, turn, role, CASE WHEN role = 'user' THEN {strip('text')} ELSE {_ANSWER_ONLY} END AS text FROM k)
{_window('a', C.MAX_TURNS)}"""

ORACLE_SQL: dict[str, str] = {
    "sft_records": sft_sql(C.MAX_SEQ_LENGTH, 4000),
    "sft_records_all": uncapped(sft_sql(C.MAX_SEQ_LENGTH, 4000), 4000),
    "general_sft_all": uncapped(GENERAL_SFT, 4000),
    "reasoning_sft_all": uncapped(REASONING_SFT, 12000),
    "rl_prompts_all": uncapped(RL_PROMPTS, 374),
    "repair_sft_all": uncapped(REPAIR_SFT, 300),
    "rl_curriculum": RL_CURRICULUM,
    "sft_records_capped": sft_sql(512, 20),
    "length_accounting": LENGTH_ACCOUNTING,
    "sft_spans": SFT_SPANS,
    "general_sft": GENERAL_SFT,
    "sharegpt_messages": SHAREGPT,
    "reasoning_sft": REASONING_SFT,
    "domain_counts": DOMAIN_COUNTS,
    "smoke_slice": SMOKE_SLICE,
    "rl_prompts": RL_PROMPTS,
    "repair_sft": REPAIR_SFT,
    "mutations": MUTATIONS,
    "last_fence": LAST_FENCE,
    "extract_code": EXTRACT_CODE,
    "think_split": THINK_SPLIT,
    "think_stream": THINK_SPLIT,
    "format_reward": FORMAT_REWARD,
    "completion_stats": COMPLETION_STATS,
    "doctest_candidates": DOCTEST_CANDIDATES,
    "pass_fraction": PASS_FRACTION,
    "rewards": REWARDS,
    "rollout_groups": ROLLOUT_GROUPS,
    "step_metrics": STEP_METRICS,
    "run_report": RUN_REPORT,
    "probe_verdicts": PROBE_VERDICTS,
    "probe_verdicts_errors": PROBE_VERDICTS_ERRORS,
    "completion_texts": COMPLETION_TEXTS,
    "source_messages": SOURCE_MESSAGES,
    "curriculum_tasks": CURRICULUM_TASKS,
    "curriculum_accounting": CURRICULUM_ACCOUNTING,
    "best_of_k": BEST_OF_K,
    "best_attempt": BEST_ATTEMPT,
    "pass_at_1": PASS_AT_1,
    "revise_transcript": REVISE_TRANSCRIPT,
    "eval_prompts": EVAL_PROMPTS,
    "memory_window": MEMORY_WINDOW,
    "chat_memory": CHAT_MEMORY,
}
