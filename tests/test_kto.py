"""Mismatched pairs of a batch and the reference point."""

import random

import pytest
from pyspark.sql import functions as F

from thumbwheel.operators import kto, ordering

SCHEMA = "batch long, key long, prompt string, completion string"


def rows(n=200):
    rng = random.Random(2)
    keys = rng.sample(range(10_000), n)
    # One batch holds half the rows.
    return [(None if i % 11 == 0 else 7 if i % 2 else i % 13, k, f"p{k}", f"c{k}") for i, k in enumerate(keys)]


@pytest.mark.parametrize("partitions", [1, 4, 23])
def test_completions_move_on_by_one_in_their_batch(spark, partitions):
    data = rows() + [(99, 123_456, "p123456", "c123456")]
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        df = spark.createDataFrame(data, SCHEMA).repartition(6)
        got = {(r.batch, r.key): (r.other, r.prompt, r.completion) for r in kto.mismatched_pairs(spark, df, "batch", "key", "prompt", "completion").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = {}
    for batch in {r[0] for r in data}:
        keys = sorted(r[1] for r in data if r[0] == batch)
        for i, k in enumerate(keys):
            want[batch, k] = (keys[i - 1], f"p{k}", f"c{keys[i - 1]}")
    assert got == want


def test_reference_point_is_a_mean_and_not_below_zero(spark):
    data = [(b, 10 * b + i, str(i), str(i * sign)) for b, sign in ((1, 1), (2, -1)) for i in range(4)]
    score = lambda df: df.withColumn("logp_sum", F.col("completion").cast("double")).withColumn("ref_logp_sum", F.lit(0.0))
    points = kto.kto_reference_point(spark, spark.createDataFrame(data, SCHEMA), "batch", "key", "prompt", "completion", score)
    assert sorted(map(tuple, points.collect())) == [(1, 4, 1.5), (2, 4, 0.0)]
    joined = kto.with_reference_point(spark.createDataFrame(data, SCHEMA), points, "batch", "key")
    assert sorted((r.key, r.z) for r in joined.collect()) == [(10 * b + i, z) for b, z in ((1, 1.5), (2, 0.0)) for i in range(4)]


def test_places_have_no_gaps_and_batches_are_full(spark):
    df = spark.range(10).select((F.col("id") * 100).alias("o"), F.sequence(F.lit(1), F.col("id") % 3 + 1).alias("ids"))
    assert sorted(map(tuple, ordering.dense_ordinals(spark, df, ["o"]).collect())) == [(100 * i, i) for i in range(10)]
    out = ordering.pad_batch(df, "ids", "o", 4).collect()
    assert sorted((r.o, r.batch_id) for r in out) == [(100 * i, i // 4) for i in range(10)]
    assert {r.width for r in out} == {3}
