from pyspark.sql import functions as F

from trainloom import config as C
from trainloom.functions import messages as M
from trainloom.functions.mutation import mutate_code
from trainloom.operators import conversations as CV
from trainloom.operators import curriculum as CU
from trainloom.operators import datasets as DS
from trainloom.operators import evaluation as EV
from trainloom.operators import scoring as SC
from trainloom.operators.filters import domain_filter, length_filter
from trainloom.operators.sampling import seeded_cap, tail, top1_by
from trainloom.sources.catalog import Catalog, smoke_slice

from .conftest import SF


def test_smoke_slice(spark):
    docs = Catalog(spark, SF).table("documents")
    assert smoke_slice(docs, "doc_id", 24, smoke=True).count() == 100
    assert smoke_slice(docs, "doc_id", 24, smoke=False).count() == docs.count()
    assert smoke_slice(docs, "doc_id", 50, smoke=True).count() == min(200, docs.count())


def test_seeded_cap_independent_of_partitioning(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    a = [r.k for r in seeded_cap(df.repartition(1), "k", 37).collect()]
    b = [r.k for r in seeded_cap(df.repartition(8), "k", 37).collect()]
    assert sorted(a) == sorted(b) and len(a) == 37
    assert seeded_cap(df, "k", None).count() == 500 and seeded_cap(df, "k", 0).count() == 500
    assert seeded_cap(df, "k", 10_000).count() == 500


def test_tail_and_top1(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    assert sorted(r.k for r in tail(df, "k", 7).collect()) == [7, 8, 9]
    d = spark.createDataFrame([("a", 0, 0.5, "x"), ("a", 1, 0.5, "y"), ("a", 2, 0.2, "z")],
                              "g string, ix int, s double, v string")
    r = top1_by(d, ["g"], ["v"], "s", "ix").first()
    assert (r.v, r.ix) == ("x", 0)


def test_domain_filter(spark):
    df = spark.createDataFrame([("Code",), ("code",), (None,), ("math",)], "domain string")
    assert domain_filter(df, "code").count() == 2
    assert domain_filter(df, "none").count() == 1
    assert domain_filter(df.withColumnRenamed("domain", "x"), "code").count() == 4


def test_length_filter_observation(spark):
    from pyspark.sql import Observation
    obs = Observation("len")
    df = spark.range(10).withColumnRenamed("id", "token_length")
    assert length_filter(df, 4, observation=obs).count() == 5
    assert obs.get == {"before": 10, "kept": 5}


def test_pass_fraction_rules(spark):
    cands = spark.createDataFrame([("t1", 0, ["a", "b"]), ("t2", 0, []), ("t3", 0, ["a", "b", "c"])],
                                  "task_id string, sample_ix int, tests array<string>")
    outs = spark.createDataFrame([("t1", 0, 0, True), ("t1", 0, 1, True), ("t3", 0, 0, True),
                                  ("t3", 0, 0, False), ("t3", 0, 5, True)],
                                 "task_id string, sample_ix int, test_ix int, passed boolean")
    got = {r.task_id: r.frac for r in SC.pass_fraction(cands, outs).collect()}
    assert got == {"t1": 1.0, "t2": 0.0, "t3": 1 / 3}


def test_pass_fraction_of_a_part_of_the_tests(spark):
    cands = spark.createDataFrame([("t1", 0, ["b", "c"], 1), ("t2", 0, ["a"], 0)],
                                  "task_id string, sample_ix int, tests array<string>, first_ix int")
    outs = spark.createDataFrame([("t1", 0, 0, True), ("t1", 0, 2, True), ("t1", 0, 2, True), ("t2", 0, 0, True)],
                                 "task_id string, sample_ix int, test_ix int, passed boolean")
    got = {r.task_id: (r.n_tests, r.n_passed) for r in SC.pass_fraction(cands, outs, first_ix="first_ix").collect()}
    assert got == {"t1": (2, 1), "t2": (1, 1)}


def test_pass_fraction_of_repeated_and_null_keys(spark):
    cands = spark.createDataFrame([("t1", 0, ["a"], 7), ("t1", 0, ["a", "b"], 8), ("t1", None, ["a"], 9), (None, 0, ["a"], 10), ("t2", 1, None, 11)],
                                  "task_id string, sample_ix int, tests array<string>, n int")
    outs = spark.createDataFrame([("t1", 0, 0, True), ("t1", 0, 1, None), ("t1", None, 0, True), (None, 0, 0, True), ("t3", 0, 0, True)],
                                 "task_id string, sample_ix long, test_ix long, passed boolean")
    out = SC.pass_fraction(cands, outs, keep=("n",))
    assert [f.dataType.simpleString() for f in out.schema] == ["string", "int", "int", "int", "int", "double"]
    got = sorted((r.n, r.task_id, r.sample_ix, r.n_tests, r.n_passed, r.frac) for r in out.collect())
    assert got == [(7, "t1", 0, 1, 1, 1.0), (8, "t1", 0, 2, 1, 0.5), (9, "t1", None, 1, 0, 0.0), (10, None, 0, 1, 0, 0.0), (11, "t2", 1, None, 0, 0.0)]


def test_pass_fractions_of_two_lists(spark):
    cands = spark.createDataFrame([("t1", 0, ["a"], ["b", "c"], 1), ("t1", 1, ["a"], ["b", "c"], 1), ("t2", 0, [], [], 0)],
                                  "task_id string, sample_ix int, public array<string>, hidden array<string>, first int")
    outs = spark.createDataFrame([("t1", 0, 0, True), ("t1", 0, 2, True), ("t1", 1, 1, True), ("t1", 1, 2, True), ("t2", 0, 0, True)],
                                 "task_id string, sample_ix int, test_ix int, passed boolean")
    out = SC.pass_fractions(cands, outs, {"p_": ("public", 0), "h_": ("hidden", "first")})
    got = {(r.task_id, r.sample_ix): (r.p_n_passed, r.p_frac, r.h_n_tests, r.h_frac) for r in out.collect()}
    assert got == {("t1", 0): (1, 1.0, 2, 0.5), ("t1", 1): (0, 0.0, 2, 1.0), ("t2", 0): (0, 0.0, 0, 0.0)}


def test_the_chosen_attempt_needs_no_text(spark):
    att = spark.createDataFrame([("a", 0, "", 0.5, True), ("a", 1, "x", 0.0, True), ("b", 0, None, 0.0, False), ("c", 1, "y", 1.0, True)],
                                "task_id string, iter int, code string, score double, ran_ok boolean")
    has = spark.createDataFrame([("a", True), ("b", True), ("c", True)], "task_id string, has_tests boolean")
    out = EV.best_attempt(att, has, with_iter=True).select("task_id", "chosen_iter")
    assert {r.task_id: r.chosen_iter for r in out.collect()} == {"a": 1, "b": 0, "c": 1}
    joined = out._jdf.queryExecution().optimizedPlan().toString().split("Join ")[0]
    assert "has_code" in joined and "max_by(code" not in joined


def test_pass_at_1_counts_tasks_without_rollouts(spark):
    from trainloom.operators import evaluation as EV
    tasks = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "task_id string")
    graded = spark.createDataFrame([("s", "a", True), ("s", "b", False)], "setting string, task_id string, ok boolean")
    rates = EV.pass_at_1(EV.graded_tasks(tasks, graded, ["s", "t"])).collect()
    assert {r.setting: (r.pass_at_1, r.n) for r in rates} == {"s": (0.25, 4), "t": (0.0, 4)}


def test_step_deviation_of_equal_scores_is_zero(spark):
    from trainloom.operators import metrics as ME
    df = spark.range(100_000).selectExpr("0 as step", "cast(id % 500 as string) as task_id", "cast(id / 500 as int) as sample_ix",
                                         "0.7D as score", "10 as completion_chars")
    assert ME.step_metrics(df).first().reward_std == 0.0


def test_split_tests(spark):
    df = spark.createDataFrame([([],), (["a"],), (["a", "b"],), (["a", "b", "c"],), (None,)], "t array<string>")
    pub, hid = DS.split_tests("t")
    got = [(r[0], r[1]) for r in df.select(pub, hid).collect()]
    assert got == [([], []), (["a"], ["a"]), (["a"], ["b"]), (["a"], ["b", "c"]), ([], [])]


def _single_changes(code, rule):
    """Every text that differs from ``code`` by one application of the rule."""
    import re
    pattern, replacement = C.BUG_RULES[rule]
    out = set()
    for chosen in range(len(re.findall(pattern, code))):
        places = iter(range(len(code)))
        out.add(re.sub(pattern, lambda m: replacement if next(places) == chosen else m.group(), code))
    return out


def test_mutation_one_occurrence_and_stable(spark):
    codes = [("a", "x <= 1 and y <= 2"), ("b", "a == b == c != d"), ("c", "return x * 2"),
             ("d", "if a >= b:\n    return True\nreturn min(a) + 1"), ("e", "a === b")]
    df = spark.createDataFrame(codes, "task_id string, code string")
    one = {r.task_id: r.m for r in df.repartition(1).select("task_id", mutate_code("code", "task_id").alias("m")).collect()}
    many = {r.task_id: r.m for r in df.repartition(5).select("task_id", mutate_code("code", "task_id").alias("m")).collect()}
    assert one == many
    assert one["c"] is None and one["e"] is None
    for tid, code in codes:
        m = one[tid]
        assert m is None or m.mutated_code in _single_changes(code, m.rule) - {code}


def test_best_attempt_cases(spark):
    att = spark.createDataFrame([
        ("s0", 0, "c0", 1.0, True), ("s0", 1, "c1", 1.0, True),          # success at iteration 0
        ("m", 0, "", 0.5, True), ("m", 1, "c1", 0.5, True), ("m", 2, "c2", 0.2, True),  # best code empty
        ("n", 0, "a", 0.0, False), ("n", 1, "b", 0.0, True),              # no tests: first clean run
        ("z", 0, "a", 0.0, False), ("z", 1, "b", 0.0, False),             # no tests, never clean: last
    ], "task_id string, iter int, code string, score double, ran_ok boolean")
    has = spark.createDataFrame([("s0", True), ("m", True), ("n", False), ("z", False)],
                                "task_id string, has_tests boolean")
    got = {r.task_id: (r.code, r.score, r.iterations) for r in EV.best_attempt(att, has).collect()}
    assert got == {"s0": ("c0", 1.0, 1), "m": ("c2", 0.5, 3), "n": ("b", 1.0, 2), "z": ("b", 0.0, 2)}


def test_best_of_k_first_max_wins(spark):
    c = spark.createDataFrame([("t", 0, "a", True, 0.5, True), ("t", 1, "b", True, 0.5, True),
                               ("u", 0, "x", False, 0.0, False), ("u", 1, "y", False, 0.0, True)],
                              "task_id string, sample_ix int, code string, has_public boolean, "
                              "public_frac double, ran_ok boolean")
    got = {r.task_id: r.code for r in EV.best_of_k(c).collect()}
    assert got == {"t": "a", "u": "y"}


def test_memory_window(spark):
    rows = [(1, 0, "system", "s")] + [(1, i, "user" if i % 2 else "assistant", f"m{i}") for i in range(1, 8)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    kept = sorted(r.turn for r in CV.memory_window(df, max_turns=1).collect())
    assert kept == [0, 6, 7]
    assert CV.memory_window(df, max_turns=0).count() == 8


def test_curriculum_keeps_unprobed(spark):
    tasks = spark.createDataFrame([(f"t{i}",) for i in range(10)], "task_id string")
    scores = spark.createDataFrame([("t0", 1.0, False), ("t0", 1.0, False), ("t1", 0.0, False),
                                    ("t2", 0.0, False), ("t2", 1.0, False), ("t3", 0.0, True),
                                    ("t9", 1.0, False)], "task_id string, score double, errored boolean")
    kept = sorted(r.task_id for r in CU.curriculum_filter(tasks, scores, sample_size=4).collect())
    assert kept == ["t2", "t3", "t4", "t5", "t6", "t7", "t8", "t9"]


def test_sharegpt_roles(spark):
    conv = [("human", None, "hi", None), (None, "assistant", None, "yo"), ("narrator", None, "", "c"),
            (None, None, None, None), ("system", "user", "s", "x")]
    df = spark.createDataFrame([(conv,)], "c array<struct<`from`:string,role:string,value:string,content:string>>")
    msgs = df.select(M.sharegpt_to_messages("c").alias("m")).first().m
    assert [(m.role, m.content) for m in msgs] == [("user", "hi"), ("assistant", "yo"), ("user", "c"),
                                                   ("user", ""), ("system", "s")]


def test_ensure_system(spark):
    df = spark.createDataFrame([([],), ([("system", "x")],), ([("user", "u")],)],
                               "m array<struct<role:string,content:string>>")
    got = [[x.role for x in r[0]] for r in df.select(M.ensure_system("m")).collect()]
    assert got == [["system"], ["system"], ["system", "user"]]
