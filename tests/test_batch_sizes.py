import pandas as pd
from pyspark.sql import functions as F

from thumbwheel.operators import inference

CHARS = 10_000


def size_teller():
    """Every row gets the rows and the characters of its batch."""

    def factory():
        return lambda prompts: pd.Series(f"{len(prompts)} {int(prompts.str.len().sum())}", index=prompts.index)

    return factory


def test_a_model_gets_no_more_text_at_a_time_than_it_is_given_room_for(spark):
    rows = spark.range(0, 2000, 1, 1).select(F.col("id").alias("ordinal"), F.repeat(F.lit("x"), CHARS).alias("prompt"))
    out = inference.batch_generate(rows, size_teller()).collect()
    assert sorted(r.ordinal for r in out) == list(range(2000))
    assert max(int(r.text.split()[1]) for r in out) <= inference.BATCH_BYTES < 2000 * CHARS


def test_nulls_and_large_keys_pass_through(spark):
    key = 2**62 + 1
    rows = spark.createDataFrame([(key, "a"), (None, "b"), (5, None)], "ordinal long, prompt string")
    out = inference.batch_generate(rows.coalesce(1), lambda: lambda prompts: prompts + "!").collect()
    assert {(r.ordinal, r.text) for r in out} == {(key, "a!"), (None, "b!"), (5, None)}


def test_a_text_longer_than_a_batch_is_a_batch(spark):
    long = inference.BATCH_BYTES + 1
    rows = spark.range(3).select(F.col("id").alias("ordinal"), F.repeat(F.lit("x"), long).alias("prompt"))
    assert {r.text for r in inference.batch_generate(rows, size_teller()).collect()} == {f"1 {long}"}
