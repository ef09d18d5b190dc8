"""Inputs derived from the driver tables.

The driver tables hold no code, rollouts or test outcomes, so the fixtures of
each query are derived from them by SQL. The scalar part of each derivation is
one SQL text run verbatim by Spark (``spark.sql`` with DataFrame arguments)
and by DuckDB (the oracle); only array construction differs per engine. Every
derived table grows with its source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainloom.sources.catalog import Catalog

NL = "chr(10)"
Q3 = "repeat(chr(34), 3)"  # a docstring quote


def _s(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


_K = _s("o_orderkey")
_S = _s("o_custkey % 50")
_S1 = _s("o_custkey % 50 + 1")

# code_tasks: one programming task per order.
TASKS_SQL = f"""
SELECT 'o' || {_K} AS task_id,
  CASE WHEN o_orderkey % 7 = 6 THEN ''
       ELSE '  Write a function f' || {_K} || ' for a ' || o_orderpriority || ' order with status '
            || o_orderstatus || '.' || {NL} END AS text,
  'Task ' || {_K} AS prompt,
  CASE o_orderkey % 8
    WHEN 0 THEN 'def f' || {_K} || '(x):' || {NL} || '    return x <= ' || {_S}
    WHEN 1 THEN 'def f' || {_K} || '(x):' || {NL} || '    if x >= ' || {_S} || ':' || {NL}
                || '        return True' || {NL} || '    return False'
    WHEN 2 THEN 'def f' || {_K} || '(a, b):' || {NL} || '    return a == b or a <= ' || {_S}
    WHEN 3 THEN 'def f' || {_K} || '(xs):' || {NL} || '    return sorted(xs)[0] + 1'
    WHEN 4 THEN 'def f' || {_K} || '(xs):' || {NL} || '    return min(xs) - 1 if xs else max(xs)'
    WHEN 5 THEN 'def f' || {_K} || '(a, b):' || {NL} || '    return (a == b) == (b != ' || {_S}
                || ') or a >= b or a === b'
    WHEN 6 THEN 'def f' || {_K} || '(x):' || {NL} || '    return x * ' || {_S}
    ELSE '' END AS code,
  CAST(o_custkey % 4 AS INT) AS n_tests,
  'assert f' || {_K} || '(' || {_S} || ') is not None' AS t1,
  'assert f' || {_K} || '(' || {_S1} || ') == True' AS t2,
  'assert f' || {_K} || '(0) == False' AS t3,
  CASE WHEN o_orderkey % 5 = 0 THEN 'import math' ELSE '' END AS test_setup_code
FROM {{orders}}
"""

_P = _s("l_partkey")
_Q = _s("l_suppkey")

_TASK = f"'o' || {_s('l_orderkey')}"
_RANK = "CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS INT)"

# rollouts: one completion per line item; the order is the prompt (task) and
# the line's rank inside its order is the generation index.
ROLLOUTS_SQL = f"""
SELECT 'r1' AS run_id,
  CAST(l_orderkey % 200 AS INT) AS step,
  {_TASK} AS task_id,
  {_RANK}
    AS sample_ix,
  l_partkey, l_suppkey,
  CASE l_partkey % 6
    WHEN 0 THEN 'The answer is ' || {_Q} || '.'
    WHEN 1 THEN '<think>' || {NL} || 'Compare x with ' || {_Q} || '.' || {NL} || '</think>' || {NL}
                || '```python' || {NL} || 'def g' || {_P} || '(x):' || {NL} || '    return x + ' || {_Q}
                || {NL} || '```'
    WHEN 2 THEN '```python' || {NL} || 'print(g' || {_P} || '(1))' || {NL} || '```' || {NL} || 'Then:' || {NL}
                || '```python' || {NL} || 'def g' || {_P} || '(x):' || {NL} || '    return x' || {NL} || '```'
    WHEN 3 THEN '<think>unclosed reasoning about ' || {_P} || {NL} || '```python' || {NL} || 'def g' || {_P}
                || '(x): return 0' || {NL} || '```'
    WHEN 4 THEN 'Answer first</think> ' || {NL} || '```PYTHON' || {NL} || 'def h' || {_P} || '(x):' || {NL}
                || '  return 1' || {NL} || '```' || {NL}
    ELSE '<think>a <think> nested</think> answer ' || {NL} || '```python' || {NL} || 'async def k' || {_P}
         || '(x):' || {NL} || '    return 2' || {NL} || '```' || {NL} || '```python' || {NL} || 'x = ' || {_Q}
         || {NL} || '```'
  END || CASE WHEN l_suppkey % 10 = 0 THEN repeat('pad ', 600) ELSE '' END AS completion,
  l_suppkey % 3 <> 0 AS ran_ok,
  'out ' || {_P} AS stdout,
  CASE WHEN l_suppkey % 4 = 0 THEN ''
       ELSE 'Traceback: error ' || {_Q} || ' ' || repeat('x', CAST(l_partkey % 900 AS INT)) END AS stderr
FROM {{lineitem}}
"""

# outcomes: verdict of test ``test_ix`` (0..2) for each rollout; some missing.
OUTCOME_PASSED_SQL = ("CASE WHEN l_suppkey % 5 = 0 THEN TRUE WHEN l_suppkey % 5 = 1 THEN FALSE "
                      "ELSE (l_partkey + test_ix) % 2 = 0 END")
OUTCOME_PRESENT_SQL = "(l_suppkey + test_ix) % 7 <> 0"

# Probe generations that failed as such.
PROBE_FAILED_SQL = "NOT ran_ok AND l_suppkey % 4 <> 0"

# step_timing: wall time and peak memory per step.
TIMING_SQL = """
SELECT CAST(o_orderkey % 200 AS INT) AS step, max(o_totalprice) AS elapsed_sec,
       CAST(max(o_custkey) AS DOUBLE) / 1000 AS peak_gb
FROM {orders} GROUP BY CAST(o_orderkey % 200 AS INT)
"""

_D = _s("doc_id")
# reasoning_rows: one reasoning-source row per document (whole text).
REASONING_SQL = f"""
SELECT doc_id AS id,
  CASE lang WHEN 'en' THEN 'code' WHEN 'fr' THEN 'Code' WHEN 'de' THEN NULL ELSE 'math' END AS domain,
  CASE WHEN doc_id % 4 = 3 THEN '' ELSE text END AS problem,
  CASE WHEN doc_id % 3 = 0 THEN 'def s' || {_D} || '(x):' || {NL} || '    pass' END AS starter_code,
  ' ' || source || ' reasoning ' || {_D} || {NL} AS deepseek_reasoning,
  'Here:' || {NL} || '```python' || {NL} || 'def s' || {_D} || '(x):' || {NL} || '    return '
    || {_s("n_chars")} || {NL} || '```' || {NL} || 'Final:' || {NL} || '```Python  ' || {NL} || 'print('
    || {_D} || ')' || {NL} || '```' AS deepseek_solution,
  'Q' || {_D} AS question,
  'A' || {_D} AS answer
FROM {{documents}}
"""

# doctest prompts: each document wrapped as a function docstring with examples.
PROMPTS_SQL = f"""
SELECT doc_id,
  'def d' || {_D} || '(x):' || {NL} || '    ' || {Q3} || text || {NL} ||
  CASE doc_id % 5
    WHEN 0 THEN '    >>> d' || {_D} || '(1)' || {NL} || '    ' || {_s("n_chars")} || {NL} || '    ' || {Q3} || {NL}
    WHEN 1 THEN '    >>> print(d' || {_D} || '(2))' || {NL} || '    2' || {NL} || '    >>> d' || {_D}
                || '(7)' || {NL} || '    [7]' || {NL} || '    ' || {Q3} || {NL}
    WHEN 2 THEN '    >>> d' || {_D} || '(3)' || {NL} || {NL} || '    ' || {Q3} || {NL}
    WHEN 3 THEN '    >>> d' || {_D} || '(4)' || {NL} || '    >>> d' || {_D} || '(5)' || {NL} || '    [1, 2'
                || {NL} || '    ' || {Q3} || {NL}
    ELSE '    ' || {Q3} || {NL} || '>>> d' || {_D} || '(6)' END AS prompt
FROM {{documents}}
"""

# mixed_sources: one training row per document, of five kinds.
MIXED_SQL = f"""
SELECT doc_id AS id, CAST(doc_id % 5 AS INT) AS kind,
  CASE WHEN doc_id % 5 = 0 THEN 'Problem ' || {_D} ELSE '' END AS problem,
  CASE WHEN doc_id % 5 = 0 THEN 'Reasoning on ' || source END AS deepseek_reasoning,
  CASE WHEN doc_id % 5 = 0 THEN '```python' || {NL} || 'x = ' || {_D} || {NL} || '```' END AS deepseek_solution,
  'Question ' || {_D} AS question, 'Answer ' || lang AS answer, text, lang, source
FROM {{documents}}
"""

# document_replies: a chat reply per document, with every arrangement of the reasoning tags.
REPLIES_SQL = f"""
SELECT 'd' || {_D} AS reply_id,
  CASE doc_id % 4 WHEN 0 THEN coalesce(text, '')
       WHEN 1 THEN '<think>' || coalesce(source, '') || {NL} || coalesce(text, '')
       WHEN 2 THEN '<think>' || coalesce(text, '') || '</think>' || {NL} || coalesce(source, '') || '<think>x</think>' || coalesce(lang, '')
       ELSE coalesce(source, '') || '</think>' || coalesce(text, '') || '<think>' || coalesce(lang, '') END AS reply
FROM {{documents}}
"""

_C = _s("conv_id")
# sharegpt_rows: conversation turns in ShareGPT form with both key styles.
SHAREGPT_SQL = """
SELECT conv_id, turn,
  CASE WHEN turn % 3 = 0 THEN NULL
       WHEN role = 'user' AND conv_id % 4 = 0 THEN 'narrator'
       WHEN role = 'user' THEN 'human' WHEN role = 'assistant' THEN 'gpt' ELSE role END AS speaker,
  CASE WHEN turn % 3 = 0 THEN role ELSE NULL END AS role_name,
  CASE WHEN turn % 3 = 0 THEN NULL ELSE text END AS value,
  CASE WHEN turn % 3 = 0 THEN text ELSE '' END AS content
FROM {conversations}
"""

# chat turns with user commands: some users reset or send blank input.
CHAT_INPUT_SQL = """
SELECT conv_id, turn, role,
  CASE WHEN role = 'user' AND conv_id % 5 = 0 AND turn = 2 THEN '/reset'
       WHEN role = 'user' AND conv_id % 7 = 0 AND turn = 4 THEN '   '
       ELSE text END AS text
FROM {conversations}
"""

_I = _s("item_id")
# benchmark_tasks: one function-completion task per benchmark passage.
BENCH_SQL = f"""
SELECT 'b' || {_I} AS task_id,
  'def b' || {_I} || '(x):' || {NL} || '    ' || {Q3} || text || {Q3} || {NL} AS prompt,
  'def check(candidate):' || {NL} || '    assert candidate(' || {_I} || ') is not None' AS test,
  'b' || {_I} AS entry_point,
  'def b' || {_I} || '(x):' || {NL} || '    return x' AS code
FROM {{benchmark}}
"""


class Derived:
    """Spark side of the derived inputs for one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.cat = Catalog(spark, sf_dir)

    def _sql(self, text: str, **tables: str) -> DataFrame:
        return self.spark.sql(text, **{k: self.cat.table(v) for k, v in tables.items()})

    def table(self, name: str) -> DataFrame:
        return self.cat.table(name)

    def tasks(self) -> DataFrame:
        t = self._sql(TASKS_SQL, orders="orders")
        return (t.withColumn("test_list", F.slice(F.array("t1", "t2", "t3"), 1, F.col("n_tests")))
                 .drop("t1", "t2", "t3"))

    def rollout_keys(self) -> DataFrame:
        """Line items as (task_id, sample_ix) with the numbers that a rollout is made of, spread by
        task_id. Every use shuffles the same columns, so that one shuffle serves a plan with several."""
        lines = self.cat.table("lineitem").select(F.expr(_TASK).alias("task_id"), "l_linenumber", "l_partkey", "l_suppkey").repartition("task_id")
        rank = _RANK.replace("PARTITION BY l_orderkey", "PARTITION BY task_id")
        return lines.select("task_id", F.expr(rank).alias("sample_ix"), "l_partkey", "l_suppkey")

    def rollouts(self, keys: DataFrame | None = None) -> DataFrame:
        """``ROLLOUTS_SQL``, its texts written when the ranks are known, so that only keys and
        numbers are shuffled. ``keys`` are rows of ``rollout_keys``; further columns of theirs are kept."""
        keys = self.rollout_keys() if keys is None else keys
        more = "".join(f", {c}" for c in keys.columns if c not in ("task_id", "sample_ix", "l_partkey", "l_suppkey"))
        text = (ROLLOUTS_SQL.replace(f"{_TASK} AS task_id", "task_id").replace(f"{_RANK}\n    AS sample_ix", "sample_ix")
                .replace("FROM {lineitem}", f"{more} FROM {{lineitem}}"))
        return self.spark.sql(text, lineitem=keys.withColumn("l_orderkey", F.expr("CAST(substring(task_id, 2) AS BIGINT)")))

    def outcomes(self, rollouts: DataFrame | None = None) -> DataFrame:
        r = rollouts if rollouts is not None else self.rollouts()
        x = r.select("task_id", "sample_ix", "l_partkey", "l_suppkey",
                     F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("test_ix"))
        return (x.filter(F.expr(OUTCOME_PRESENT_SQL))
                 .select("task_id", "sample_ix", "test_ix", F.expr(OUTCOME_PASSED_SQL).alias("passed"),
                         (F.col("test_ix") == 0).alias("is_public")))

    def timing(self) -> DataFrame:
        return self._sql(TIMING_SQL, orders="orders")

    def reasoning_rows(self) -> DataFrame:
        return self._sql(REASONING_SQL, documents="documents")

    def doctest_prompts(self) -> DataFrame:
        return self._sql(PROMPTS_SQL, documents="documents")

    def mixed_sources(self) -> DataFrame:
        t = self._sql(MIXED_SQL, documents="documents")
        turn = lambda who, what: F.struct(F.lit(who).alias("from"), F.lit(None).cast("string").alias("role"),
                                          F.col(what).alias("value"), F.lit(None).cast("string").alias("content"))
        turns = F.array(turn("human", "text"), turn("gpt", "lang"), turn("narrator", "source"))
        said = lambda role, what: F.struct(F.lit(role).alias("role"), F.col(what).alias("content"))
        return (t.withColumn("conversations", F.when(F.col("kind") == 1, turns).when(F.col("kind") == 4, F.slice(turns, 1, 0)))
                 .withColumn("messages", F.when(F.col("kind") == 2, F.array(said("system", "source"), said("user", "text"), said("assistant", "lang")))
                             .when(F.col("kind") == 3, F.array(said("user", "text"), said("assistant", "source"))))
                 .select("id", "problem", "deepseek_reasoning", "deepseek_solution", "question", "answer", "conversations", "messages"))

    def document_replies(self) -> DataFrame:
        return self._sql(REPLIES_SQL, documents="documents")

    def sharegpt_turns(self) -> DataFrame:
        return self._sql(SHAREGPT_SQL, conversations="conversations")

    def sharegpt_rows(self) -> DataFrame:
        t = self.sharegpt_turns()
        turn = F.struct(F.col("turn").alias("o"), F.col("speaker").alias("from"), F.col("role_name").alias("role"),
                        F.col("value").alias("value"), F.col("content").alias("content"))
        return (t.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("_c"))
                 .select(F.col("conv_id").alias("id"),
                         F.transform("_c", lambda s: s.dropFields("o")).alias("conversations")))

    def chat_inputs(self) -> DataFrame:
        return self._sql(CHAT_INPUT_SQL, conversations="conversations")

    def benchmark_tasks(self) -> DataFrame:
        return self._sql(BENCH_SQL, benchmark="benchmark")


def duck(sql: str, **extra: str) -> str:
    """DuckDB form of a shared derivation: table placeholders -> view names."""
    names = {n: n for n in ("orders", "lineitem", "documents", "conversations", "benchmark", "part")}
    names.update(extra)
    return sql.format(**names)
