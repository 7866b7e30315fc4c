"""Text operators against plain-Python restatements of the rules."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from errscope.functions import text as X
from errscope.functions.constants import PLACEHOLDER, SPACER


# The cleaning patterns in Python's dialect, in order.
PY_RULES = [r"(<.*>)", r"([/][^\s]+)+", r"([a-zA-Z0-9]+[_]+[\S]+)", r"([a-zA-Z_.|:;-]*\d+[a-zA-Z_.|:;-]*)+", r"[^\w\s\.-]", " +"]


def py_clean(s: str) -> str:
    """Each rule's matches become one space."""
    for rule in PY_RULES:
        s = re.sub(rule, " ", s)
    return s


HAND_MADE = [
    "",
    "   ",
    "one",
    "!!!...",
    "same message",
    "same message",
    "Ошибка соединения 42 раз",
    "數據 error ١٢٣ done",
    "emoji 😀 outside the BMP 𝒜",
    "Run (first part) then (second part) end",
    "path /a/b/c and host_name_1 at x1y2.z <tag attr='1'> end",
    "tab\tand\nnew line / slash",
    " ".join(f"w{i % 7}" for i in range(250)),
]


def _clean_rows(spark, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, s string")
    return {r.i: r.c for r in df.select("i", X.clean_message("s").alias("c")).collect()}


def test_clean_matches_python_rules(spark):
    got = _clean_rows(spark, HAND_MADE)
    for i, s in enumerate(HAND_MADE):
        assert got[i] == py_clean(s), s


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab_1/ .-<>|:;xé٣\t")), max_size=30), min_size=1, max_size=8))
def test_clean_property(spark, rows):
    got = _clean_rows(spark, rows)
    for i, s in enumerate(rows):
        assert got[i] == py_clean(s)


def test_null_message_cleans_to_null(spark):
    df = spark.createDataFrame([(None,)], "s string")
    assert df.select(X.clean_message("s").alias("c")).first().c is None


def test_split_keeps_edge_tokens(spark):
    df = spark.createDataFrame([(" a  b ",), ("",)], "s string")
    got = [r.t for r in df.select(X.split_tokens("s").alias("t")).collect()]
    assert got == [" a  b ".split(" "), [""]]


def test_tokenize_round_trip(spark):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(HAND_MADE)], "i int, s string")
    out = df.select("i", "s", X.detokenize_pattern(X.tokenize_message("s")).alias("back")).collect()
    for r in out:
        assert r.back == r.s


def test_tokenize_conservative_keeps_numbers_and_hyphens(spark):
    df = spark.createDataFrame([("soft-landing at 2,000.5 now",)], "s string")
    tk = df.select(X.tokenize_message("s").alias("t")).first().t
    assert tk == ["soft-landing", SPACER, "at", SPACER, "2,000.5", SPACER, "now"]


def test_detokenize_drops_spacer_before_placeholder(spark):
    df = spark.createDataFrame([(["a", SPACER, PLACEHOLDER, SPACER, "b"],)], "t array<string>")
    assert df.select(X.detokenize_pattern("t").alias("x")).first().x == "a" + PLACEHOLDER + " b"


def test_dedup_adjacent(spark):
    df = spark.createDataFrame([(["a", "a", "b", "a", "a", "a"],), ([],)], "t array<string>")
    got = [r.x for r in df.select(X.dedup_adjacent_tokens("t").alias("x")).collect()]
    assert got == [["a", "b", "a"], []]


def test_collapse_placeholders(spark):
    rows = ["Run (a) then (b) end", "one (x) only", "Call Run() and (y) ok"]
    df = spark.createDataFrame([(r,) for r in rows], "s string")
    got = [r.x for r in df.select(X.collapse_placeholders("s").alias("x")).collect()]
    assert got == ["Run (.*?) end", "one (x) only", "Call Run(.*?) ok"]


def test_stop_and_alpha(spark):
    df = spark.createDataFrame([(["The", "error", ",", "x1", "Données", SPACER],)], "t array<string>")
    r = df.select(X.remove_stop_tokens("t").alias("a"), X.keep_alpha_tokens("t").alias("b")).first()
    assert r.a == ["error", "Données"]
    assert r.b == ["The", "error", "Données"]


def test_cluster_uuid_is_stable(spark):
    df = spark.createDataFrame([("k",), ("k",)], "s string")
    ids = {r.u for r in df.select(X.cluster_uuid(F.col("s")).alias("u")).collect()}
    assert len(ids) == 1 and len(next(iter(ids))) == 36


def test_common_tokens_of_the_semi_join_are_split(spark):
    """The partition of a token that most rows hold goes to several tasks."""
    from errscope.operators import tokens as K

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        df = spark.range(4000).repartition(8).selectExpr("id AS msg_id", "array('The', concat('w', id % 900), 'gone', 'the') AS tk")
        vocab = spark.range(900).selectExpr("concat('w', id) AS token").unionByName(spark.range(5).selectExpr("'the' AS token"))
        out = K.vocabulary_semi_join(df, "tk", "msg_id", vocab, out="kept")
        assert all(r.kept == ["The", f"w{r.msg_id % 900}", "the"] for r in out.collect())
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in conf:
            spark.conf.unset(key)


def test_cleaning_equals_the_rules_as_written(spark):
    """Rules tried from the start of a run only find what the rules themselves find."""
    import random

    from errscope.functions.constants import CLEANING_RULES

    rnd = random.Random(3)
    texts = ["".join(rnd.choice("aZ_.|:;-9é٣ ß0/<>\n\tx_😀") for _ in range(rnd.randint(0, 30))) for _ in range(20_000)]
    df = spark.createDataFrame([(t,) for t in texts], "m string")
    plain = F.col("m")
    for rule in CLEANING_RULES:
        plain = F.regexp_replace(plain, rule, " ")
    assert df.where(~plain.eqNullSafe(X.clean_message("m"))).count() == 0


def test_cleaning_reads_a_long_run_once(spark):
    import time

    df = spark.createDataFrame([("a" * 200_000 + " b" + ":" * 200_000,)], "m string")
    assert df.select(F.length(X.clean_message(F.lit("warm up")))).first()
    began = time.time()
    assert df.select(F.length(X.clean_message("m")).alias("n")).first().n == 200_003
    assert time.time() - began < 5


def test_semi_join_sends_a_token_of_a_row_once(spark, monkeypatch):
    """What is shuffled follows the distinct tokens of a row; rows of one id, rows without one and long rows come out as before."""
    from errscope.operators import tokens as K

    monkeypatch.setattr(K, "LONG", 6)
    vocab = spark.createDataFrame([("a",), ("b",)], "token string")
    rows = [(1, ["A", " ", "x", " ", "b"]), (2, ["x"]), (3, ["b", "a"]), (3, ["a", "x", "b"]), (None, ["a"]), (4, []), (5, None), (6, ["a", None, "x"] * 4)]
    df = spark.createDataFrame(rows, "id int, tk array<string>")
    got = sorted(((r.id, r.kept) for r in K.vocabulary_semi_join(df, "tk", "id", vocab, out="kept").collect()), key=str)
    both = ["a", "b", "a", "b"]  # by place, then by token
    assert got == sorted([(1, ["A", "b"]), (2, []), (3, both), (3, both), (None, []), (4, []), (5, []), (6, ["a"] * 4)], key=str)

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        many = spark.range(50).selectExpr("id", "array_repeat('a', 100) AS tk")
        monkeypatch.setattr(K, "LONG", 2000)
        out = K.vocabulary_semi_join(many, "tk", "id", vocab, out="kept")
        plan = out._jdf.queryExecution().executedPlan()
        assert all(len(r.kept) == 100 for r in out.collect())
        assert "array_distinct" in plan.toString()
        assert "Exchange" not in K.terms_vocabulary(many, "tk")._jdf.queryExecution().executedPlan().toString().split("Generate")[1]  # no sequence is shuffled
    finally:
        for key in conf:
            spark.conf.unset(key)


def test_terms_vocabulary_counts_over_distinct_sequences(spark):
    from errscope.operators import tokens as K

    rows = [["Once", "x1"], ["Once", "x1"], ["two", "TWO"], ["here", "z"], ["There", "here"], None, [], ["zu", None], [",", ","]]
    got = K.terms_vocabulary(spark.createDataFrame([(r,) for r in rows], "tk array<string>"), "tk").collect()
    assert sorted(r.token for r in got) == ["here", "two"]
