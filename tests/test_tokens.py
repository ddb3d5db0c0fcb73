import pytest
from pyspark.sql import functions as F

from helpers import value
from thumbwheel.functions import tokens as K

IDS = "ids array<int>"


@pytest.mark.parametrize(
    "ids,stop,out",
    [
        ([5, 1, 6, 7], 1, [5, 1, 0, 0]),
        ([1, 6, 7], 1, [1, 0, 0]),
        ([5, 6], 1, [5, 6]),
        ([5, 0, 6], 0, [5, 0, 9]),
        ([5, 1, 6], None, [5, 1, 6]),
        ([5, 1], 1, [5, 1]),
        ([], 1, []),
    ],
)
def test_truncate_at_stop(spark, ids, stop, out):
    pad = 9 if stop == 0 else 0
    assert value(spark, K.truncate_at_stop(F.col("ids"), stop, pad), ids=ids, schema=IDS) == out


@pytest.mark.parametrize("ids,last", [([5, 1, 0, 0], 1), ([5, 6], 1), ([0, 0], -1), ([7, 0], 0)])
def test_sequence_length_and_mask(spark, ids, last):
    assert value(spark, K.sequence_length(F.col("ids"), 0), ids=ids, schema=IDS) == last
    masked = K.mask_after(F.transform("ids", lambda x: x.cast("double") + 10), K.sequence_length(F.col("ids"), 0))
    expected = [x + 10.0 if i <= last else 1.0 for i, x in enumerate(ids)]
    assert value(spark, masked, ids=ids, schema=IDS) == expected


def test_eos_counts(spark):
    assert value(spark, K.count_token(F.col("ids"), 1), ids=[1, 2, 1], schema=IDS) == 2
    assert value(spark, K.contains_token(F.col("ids"), 3), ids=[1, 2, 1], schema=IDS) is False


@pytest.mark.parametrize("n_prompt,n_completion", [(3, 3), (10, 3), (3, 10), (10, 10), (0, 10), (6, 0)])
def test_truncate_pair(spark, n_prompt, n_completion):
    p, c = list(range(n_prompt)), list(range(100, 100 + n_completion))
    kept_p, kept_c = K.truncate_pair(F.col("p"), F.col("c"), max_prompt=4, max_total=8)
    df = spark.createDataFrame([(p, c)], "p array<int>, c array<int>").select(kept_p.alias("p"), kept_c.alias("c"))
    row = df.first()
    assert row.p == p[max(0, len(p) - 4):]
    assert row.c == c[: 8 - len(row.p)]


def test_a_long_prompt_may_stay_while_the_pair_fits(spark):
    df = spark.createDataFrame([(list(range(6)), [9]), (list(range(6)), [9] * 5)], "p array<int>, c array<int>")
    kept = K.truncate_pair(F.col("p"), F.col("c"), max_prompt=4, max_total=8, only_if_over=True)
    sizes = df.select(*(F.size(c) for c in kept)).collect()
    assert [tuple(r) for r in sizes] == [(6, 1), (4, 4)]


def test_padding_sides(spark):
    for side, out, mask in (("right", [3, 4, 0], [1, 1, 0]), ("left", [0, 3, 4], [0, 1, 1])):
        assert value(spark, K.pad_to(F.col("ids"), F.lit(3), 0, side), ids=[3, 4], schema=IDS) == out
        assert value(spark, K.attention_mask(F.col("ids"), F.lit(3), side), ids=[3, 4], schema=IDS) == mask


def test_argmax_takes_the_first_of_a_tie(spark):
    assert value(spark, K.argmax(F.col("x")), x=[1.0, 3.0, 3.0], schema="x array<double>") == 1


def test_token_ids_are_stable_and_never_reserved(spark):
    ids = value(spark, K.token_ids(F.col("t")), t=" a b\n\ta ", schema="t string")
    assert len(ids) == 3 and ids[0] == ids[2] != ids[1] and min(ids) >= K.RESERVED_IDS
    assert value(spark, K.token_count(F.col("t")), t="", schema="t string") == 0


def test_a_tokenizer_plugs_in_as_a_pandas_udf(spark):
    import pandas as pd

    from thumbwheel.plans.datasets import reward_training_rows

    @F.pandas_udf("array<int>")
    def by_character(text: pd.Series) -> pd.Series:
        return text.map(lambda t: [ord(c) for c in t])

    rows = spark.createDataFrame(
        [(1, "p", "abc", 1), (2, "p", "abcdef", 0)], "example_id long, prompt string, completion string, label int"
    )
    out = reward_training_rows(rows, F.col("completion"), by_character, max_length=3)
    assert [(r.example_id, r.label, r.input_ids) for r in out.collect()] == [(1, 1, [97, 98, 99])]
