"""The steps of rollouts slice by slice, and a feed of them that comes in parts."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from thumbwheel.operators.rollouts import RolloutConfig
from thumbwheel.plans import training_log
from thumbwheel.session import work_root
from workload import queries

CFG = RolloutConfig(k=2)
ROLLOUT = (
    "update_id long, prompt_id long, sample_idx long, rollout_id long, response array<int>, logp array<double>, "
    "ref_logp array<double>, score array<double>, elapsed double, lr double"
)
POLICY = "rollout_id long, ppo_epoch long, minibatch long, microbatch long, new_logp array<double>, token_entropy array<double>"


def folders(spark):
    root = work_root(spark).removeprefix("file://").removeprefix("file:")
    return set(os.listdir(root))


def logs(spark):
    """Full slots, one with a lone sample, one whose samples have no key, a rollout without steps."""
    rollouts, policy = [], []
    for i in range(40):
        rollout = None if i == 7 else i
        rollouts.append(
            (i // 16, i // 4, i % 4, rollout, [3, 1, 4], [-0.5, -0.25, -i / 8], [-0.25, -0.5, -0.75],
             [i % 3 / 4, 0.25], 30.0 * (i // 16 + 1), 0.5)
        )
        if i % 10 != 9:
            policy += [(rollout, e, i % 2, e, [-0.5, -i / 16, -0.25], [0.5, 0.25, e / 2]) for e in (1, 0)]
    return spark.createDataFrame(rollouts[:-1], ROLLOUT), spark.createDataFrame(policy, POLICY)


@pytest.mark.parametrize("slices", [1, 3])
def test_slices_have_the_rows_of_the_whole_and_leave_nothing(spark, slices):
    before = folders(spark)
    rollouts, policy = logs(spark)
    got, sizes = [], []
    for steps in training_log.sliced_rollout_steps(rollouts, policy, CFG, slices):
        rows = steps.collect()
        sizes.append(len(rows))
        got += [r.asDict() for r in rows]
    whole = [r.asDict() for r in training_log.rollout_steps(rollouts, policy, CFG).collect()]
    by_key = lambda r: (r["rollout_id"], r["ppo_epoch"])
    assert sorted(got, key=by_key) == sorted(whole, key=by_key) and len(whole) == 70
    assert len(sizes) == slices and max(sizes) < (len(whole) + 1 if slices == 1 else len(whole))
    assert folders(spark) == before


def test_parts_are_later_than_those_before_and_have_every_row(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, None if i == 5 else t0 + dt.timedelta(seconds=i * 37 % 50)) for i in range(100)]
    table = spark.createDataFrame(rows, "id long, ts timestamp")
    parts = [p.collect() for p in queries._by_time(table, "ts", 4)]
    assert sorted(r.id for p in parts for r in p) == list(range(100)) and len(parts) == 4
    spans = [(min(x), max(x)) for x in ([r.ts for r in p if r.ts is not None] for p in parts)]
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert max(map(len, parts)) < 40
    same = table.withColumn("ts", F.lit(t0))
    assert sum(p.count() for p in queries._by_time(same, "ts", 4)) == 100


def test_update_metrics_of_a_feed_in_parts_are_those_of_one_part(spark, folder, monkeypatch):
    """What was worked off is deleted: neither the steps nor their feed are there afterwards."""
    lines = [(o, o * 7 + n, o * 3 + n, n) for o in range(64) for n in range(1, 5)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int").write.parquet(
        f"{folder}/lineitem.parquet"
    )
    found = []
    for most in (1, 3):
        monkeypatch.setattr(queries, "SLICE_LINES", 64)
        monkeypatch.setattr(queries, "MOST_SLICES", most)
        before = folders(spark)
        rows = queries.REGISTRY["stream_update_metrics"](spark, folder).collect()
        found.append(sorted(rows, key=lambda r: r.update_id))
        assert [n.rsplit("-", 1)[0] for n in folders(spark) - before] == ["update-metrics"]
    assert len(found[0]) == 16 and all(r.complete for r in found[0]) and found[0] == found[1]
