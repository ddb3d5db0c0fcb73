import pytest
from pyspark.sql import functions as F

from helpers import plan
from thumbwheel.operators import skew
from thumbwheel.operators.rollouts import rloo_advantage_any_k


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture
def rows(spark):
    """Half of the rows share key 0, a sixth have no key."""
    key = F.when(F.col("id") % 2 == 0, 0).when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 50)
    return spark.range(3000).select(F.col("id"), key.alias("k"), (F.col("id") % 7).alias("v"))


@pytest.mark.parametrize("pieces", [1, 3, 32])
def test_group_stats_equal_group_by(rows, no_broadcast, pieces):
    out = skew.attach_group_sums(rows, ["k"], {"total": F.col("v"), "n": F.lit(1)}, "id", pieces)
    stats = [F.sum("v").alias("total"), F.count(F.lit(1)).alias("n")]
    groups = {r.k: (r.total, r.n) for r in rows.groupBy("k").agg(*stats).collect()}
    got = out.collect()
    assert len(got) == 3000 and len({r.id for r in got}) == 3000
    assert all((r.total, r.n) == groups[r.k] for r in got)


def test_the_log_is_read_once_for_sums_and_join(spark, sf_dir):
    from workload.queries import REGISTRY

    shown = plan(REGISTRY["rloo_advantage_any_k"](spark, sf_dir))
    assert "l_orderkey" not in shown and "zip_with" not in shown


def test_hot_rows_are_really_spread(rows, no_broadcast):
    dimension = rows.select("k").distinct().withColumn("d", F.lit("x"))
    out = skew.lookup_join(rows, dimension, ["k"], "id", pieces=15)
    shown = plan(out)
    assert "SortMergeJoin [k" in shown and "__piece" in shown.split("SortMergeJoin")[1][:80]
    assert "CartesianProduct" not in shown and "NestedLoop" not in shown
    assert out.count() == rows.where("k is not null").count()
    pieces = rows.where("k = 0").select(F.pmod(F.xxhash64("id"), F.lit(15)).alias("p")).groupBy("p").count()
    assert pieces.count() == 15


def test_left_lookup_keeps_unmatched(rows, spark):
    dimension = spark.createDataFrame([(0, "zero")], "k long, d string")
    out = skew.lookup_join(rows, dimension, ["k"], "id", how="left")
    assert out.count() == 3000
    assert out.where("d is not null").count() == 1500


def test_advantages_of_a_hot_prompt(spark, no_broadcast):
    df = spark.range(500).select(
        F.lit(1).alias("update_id"),
        F.when(F.col("id") < 400, 0).otherwise(F.col("id")).alias("prompt_id"),
        F.col("id").alias("rollout_id"),
        (F.col("id") % 4).cast("double").alias("rlhf_reward"),
    )
    out = rloo_advantage_any_k(df).collect()
    total = sum(i % 4 for i in range(400))
    for r in out:
        if r.prompt_id == 0:
            assert r.advantage == pytest.approx(r.rlhf_reward - (total - r.rlhf_reward) / 399)
        else:
            assert r.advantage is None
    assert len(out) == 500
