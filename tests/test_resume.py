"""Model runs that go on where an earlier one stopped."""

import pytest
from pyspark.sql import functions as F

from thumbwheel.operators import inference
from workload import judges


def generator(spark, die_at=None):
    """Counts the prompts that reach the model; may die at one of them."""
    asked = spark.sparkContext.accumulator(0)

    def factory():
        def call(prompts):
            if die_at is not None and (prompts == die_at).any():
                raise RuntimeError("the machine is gone")
            asked.add(len(prompts))
            return prompts.str.upper() + "!"

        return call

    return asked, lambda df: inference.batch_generate(df, factory)


def prompts(spark, n, step=1):
    return spark.range(n).select((F.col("id") * step).alias("ordinal"), F.concat(F.lit("p"), F.col("id") * step).alias("prompt"))


def test_only_missing_ordinals_reach_the_model(spark, folder):
    df, path = prompts(spark, 100, 3), f"{folder}/out"
    first, dying = generator(spark, die_at="p180")
    with pytest.raises(Exception, match="the machine is gone"):
        inference.run_in_parts(df, dying, path, parts=10)
    done = spark.read.parquet(path).count()
    assert 0 < done < 100
    second, model = generator(spark)
    out = inference.run_in_parts(df, model, path, parts=7)
    assert second.value == 100 - done
    assert sorted((r.ordinal, r.text) for r in out.collect()) == [(3 * i, f"P{3 * i}!") for i in range(100)]
    third, model = generator(spark)
    more = prompts(spark, 110, 3).unionByName(spark.createDataFrame([(None, "x")], "ordinal long, prompt string"))
    assert inference.run_in_parts(more, model, path).count() == 110 and third.value == 10
    fourth, model = generator(spark)
    assert inference.run_in_parts(more, model, path).count() == 110 and fourth.value == 0


def test_judging_goes_on_too(spark, folder):
    df = spark.range(40).select(
        F.col("id").alias("ordinal"), F.lit("q").alias("prompt"), F.repeat(F.lit("a"), F.col("id").cast("int")).alias("answer_a"),
        F.lit("bbbbbb").alias("answer_b"),
    )
    judge = lambda d: inference.batch_judge(d, judges.length_judge)
    inference.run_in_parts(df.where("ordinal % 3 = 0"), judge, f"{folder}/j")
    got = inference.run_in_parts(df, judge, f"{folder}/j", parts=3)
    assert sorted(map(str, got.collect())) == sorted(map(str, judge(df).collect()))


def test_nothing_to_do(spark, folder):
    _, model = generator(spark)
    assert inference.run_in_parts(prompts(spark, 0), model, f"{folder}/out").count() == 0
