import pytest
from pyspark.sql import functions as F

from helpers import value
from thumbwheel.functions import text as X

WIN = [
    ("x. The answer is [[A]]", "A"),
    ("The answer is \n\t [[B]] tail", "B"),
    ("The answer is [[A]]. The answer is [[C]]", "C"),
    ("[[A]] only", "A"),
    ("The answer is A", "error"),
    ("The answer is ([[A]])", "error"),
    ("The answer is [[D]]", "error"),
    ("I prefer [[A]]. The answer is", "error"),
    ("", "error"),
]


@pytest.mark.parametrize("raw,verdict", WIN)
def test_parse_verdict(spark, raw, verdict):
    assert value(spark, X.parse_verdict(F.col("t")), t=raw, schema="t string") == verdict


def test_missing_text_is_an_error_verdict(spark):
    assert value(spark, X.parse_verdict(F.col("t")), t=None, schema="t string") == "error"


@pytest.mark.parametrize(
    "raw,cut",
    [
        ("a [[B]] b [[A]]", "a [[B]]"),
        ("no\nstop", "no\nstop"),
        ("one\ntwo [[C]]\nthree [[C]]", "one\ntwo [[C]]"),
        ("[[A]", "[[A]"),
    ],
)
def test_cut_at_stop(spark, raw, cut):
    assert value(spark, X.cut_at_stop(F.col("t")), t=raw, schema="t string") == cut


def test_winner_codes(spark):
    df = spark.createDataFrame([("A",), ("B",), ("C",), ("error",)], "v string")
    assert [r[0] for r in df.select(X.verdict_winner(F.col("v"))).collect()] == [0, 1, None, None]


def test_strip_equals_python(spark):
    raw = " \x1c \t a b  \n\x85　"
    assert value(spark, X.strip(F.col("t")), t=raw, schema="t string") == raw.strip()


def test_judge_prompt_layout(spark):
    built = value(
        spark, X.judge_prompt(F.col("q"), F.col("a"), F.col("b"), "Judge."), q="Q?", a="one", b=None,
        schema="q string, a string, b string",
    )
    assert built == (
        "Judge.\n[User Question]\nQ?\n\n[The Start of Assistant A's Answer]\none\n"
        "[The End of Assistant A's Answer]\n\n[The Start of Assistant B's Answer]\n\n"
        "[The End of Assistant B's Answer]"
    )


def test_rendering(spark):
    schema = "m array<struct<role:string,content:string>>"
    m = [("user", "hi"), ("assistant", "yo")]
    assert value(spark, X.render_chat(F.col("m")), m=m, schema=schema) == (
        "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n"
    )
    assert value(spark, X.render_simple_chat(F.col("m")), m=m, schema=schema) == "User: hi\n\nAssistant: yo\n\n"
    assert value(spark, X.render_chat(F.col("m")), m=[], schema=schema) == ""


def test_names(spark):
    assert value(spark, X.model_slug(F.col("n")), n="a/b/c_d", schema="n string") == "a_b_c_d"
    got = value(
        spark,
        X.run_name(F.lit("logs/x_y"), F.col("n"), F.lit("hub/d_s"), F.to_timestamp(F.lit("2024-01-02 03:04:05"))),
        n="org/m_1", schema="n string",
    )
    assert got == "logs/x-y-m-1-d-s-20240102-030405"
    labels = spark.createDataFrame([(0,), (1,), (2,)], "l int").select(X.label_name(F.col("l")).alias("n"))
    assert [r.n for r in labels.collect()] == ["BAD", "GOOD", None]
    assert [r[0] for r in labels.select(X.label_id(F.col("n"))).collect()] == [0, 1, None]
# Verdict phrases and marks, and the layout of the judge prompt below.
