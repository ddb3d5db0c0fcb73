import math

import pytest
from pyspark.sql import functions as F

from helpers import plan
from thumbwheel.operators import rollouts as RO
from thumbwheel.plans import training_log
from thumbwheel.sources import readers, writers
from workload import inputs
from workload.inputs import CONFIG

SCHEMA = (
    "update_id long, prompt_id long, sample_idx long, rollout_id long, response array<int>, "
    "logp array<double>, ref_logp array<double>, score array<double>"
)
POLICY = (
    "rollout_id long, ppo_epoch long, minibatch long, microbatch long, "
    "new_logp array<double>, token_entropy array<double>"
)


def brute(row, cfg):
    """One rollout by hand: truncate, mask, KL, reward."""
    ids = list(row[4])
    if 1 in ids:
        cut = ids.index(1)
        ids = ids[: cut + 1] + [0] * (len(ids) - cut - 1)
    last = ids.index(0) - 1 if 0 in ids else len(ids) - 1
    mask = lambda xs: [x if i <= last else 1.0 for i, x in enumerate(xs)]
    logp, ref = mask(row[5]), mask(row[6])
    kl = sum(a - b for a, b in zip(logp, ref))
    score = [x - (0 if 1 in ids else cfg.missing_eos_penalty) for x in row[7]]
    return kl, float(score.index(max(score))), -cfg.kl_coef * kl + score.index(max(score))


ROWS = [
    (1, 10, 0, 100, [5, 1, 6], [-1.0, -2.0, -3.0], [-0.5, -1.0, -9.0], [0.25, 0.5]),
    (1, 10, 1, 101, [5, 6, 7], [-1.0, -1.0, -1.0], [-1.0, -1.0, -1.0], [0.5, 0.5]),
    (1, 11, 0, 110, [1, 6, 7], [-0.5, -1.0, -1.0], [-0.25, -1.0, -1.0], [1.0, 0.0]),
    (2, 10, 0, 120, [5, 6, 1], [-0.5, -1.0, -1.0], [-0.25, -2.0, -1.0], [0.0, 1.0]),
    (2, 10, 1, 121, [5, 6, 1], [-0.5, -1.0, -1.0], [-0.25, -2.0, -4.0], [0.0, 1.0]),
]
NEW = {100: [-1.5, -2.0, -4.0], 101: [-1.0] * 3, 110: [-0.5, -1.0, -1.0], 120: [-0.5, -1.0, -1.0], 121: [-0.5, -1.0, -1.0]}


@pytest.fixture
def log(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture
def policy(spark):
    """Two epochs: the second repeats the first's values a little lower."""
    rows = [(i, e, 0, 0, [x - e / 4 for x in new], ROWS[0][5]) for i, new in NEW.items() for e in (0, 1)]
    return spark.createDataFrame(rows, POLICY)


def test_rewards_by_hand(log):
    out = RO.rollout_rewards(RO.masked_rollouts(log, CONFIG), CONFIG)
    got = {r.rollout_id: (r.kl, r.reward_score, r.rlhf_reward) for r in out.collect()}
    assert got == {r[3]: pytest.approx(brute(r, CONFIG)) for r in ROWS}


def test_advantages_of_two_are_opposite_and_lone_samples_null(log):
    out = {r.rollout_id: r for r in training_log.scored_rollouts(log, CONFIG).collect()}
    assert out[110].advantage is None
    for a, b in ((100, 101), (120, 121)):
        expected = out[a].rlhf_reward - out[b].rlhf_reward
        assert out[a].advantage == expected == -out[b].advantage


def test_advantages_sum_to_zero_per_slot(spark, sf_dir):
    out = training_log.scored_rollouts(inputs.rollouts(spark, sf_dir), CONFIG)
    sums = out.groupBy("update_id", "prompt_id", "slot").agg(F.abs(F.sum("advantage")).alias("s"))
    assert sums.where("s > 0").count() == 0


def test_penalty_cannot_change_the_thumbs_score(spark, sf_dir):
    masked = RO.masked_rollouts(inputs.rollouts(spark, sf_dir), CONFIG)
    with_penalty = RO.rollout_rewards(masked, CONFIG).select("rollout_id", "reward_score")
    without = RO.rollout_rewards(masked, RO.RolloutConfig(missing_eos_penalty=None)).select("rollout_id", "reward_score")
    assert masked.where("NOT has_eos").count() > 0
    assert with_penalty.exceptAll(without).count() == 0


def test_penalty_lowers_scalar_and_intended_rewards(log):
    masked = RO.masked_rollouts(log, CONFIG)
    scalar = {r.rollout_id: r.reward_score for r in RO.rollout_rewards(masked, CONFIG, scalar_reward=True).collect()}
    assert scalar[101] == -0.5 and scalar[100] == 0.25
    intended = RO.rollout_rewards(masked, CONFIG, penalty_after_argmax=True)
    assert {r.rollout_id: r.reward_score for r in intended.collect()}[101] == -1.0


def test_kl_of_identical_policies_is_zero(log):
    same = log.withColumn("ref_logp", F.col("logp"))
    out = RO.rollout_rewards(RO.masked_rollouts(same, CONFIG), CONFIG)
    assert {r.kl for r in out.collect()} == {0.0}


def test_entropy_counts_masked_positions_unless_told_otherwise(log):
    masked = RO.masked_rollouts(log, CONFIG).where("rollout_id = 100")
    row = masked.select(
        RO.sequence_entropy(F.col("logp")).alias("a"),
        RO.sequence_entropy(F.col("logp"), F.col("sequence_length")).alias("b"),
    ).first()
    assert (row.a, row.b) == (2.0, 3.0)


def test_epochs_share_the_advantage_of_their_rollout(spark):
    rows = [(1, 10, i, 100 + i, [5, 1], [-1.0, -1.0], [-1.0, -1.0], [1.0 * i, 0.5]) for i in (0, 1)]
    log = spark.createDataFrame(rows, SCHEMA)
    steps = [(100 + i, e, e, 0, [-1.0, -1.0 - e], [0.5, 0.5]) for i in (0, 1) for e in (0, 1)]
    out = training_log.policy_rollouts(log, spark.createDataFrame(steps, POLICY), CONFIG).collect()
    assert sorted((r.rollout_id, r.ppo_epoch, r.advantage) for r in out) == [
        (100, 0, 1.0), (100, 1, 1.0), (101, 0, -1.0), (101, 1, -1.0),
    ]
    row = training_log.training_metrics(
        log.withColumns({"elapsed": F.lit(2.0), "lr": F.lit(0.5)}), spark.createDataFrame(steps, POLICY), CONFIG, 8, 4
    ).first()
    assert row["val/num_eos_tokens"] == 2 and row["objective/scores"] == 0.5 and row["lr"] == 0.5


def test_a_stored_log_gives_metrics(spark, sf_dir, folder):
    inputs.rollouts(spark, sf_dir).write.parquet(f"{folder}/rollouts")
    inputs.policy_log(spark, sf_dir).write.parquet(f"{folder}/policy")
    rollouts = readers.read_rollouts(spark, f"{folder}/rollouts")
    out = training_log.training_metrics(rollouts, readers.read_policy_log(spark, f"{folder}/policy"), CONFIG, 64, 1000)
    assert out.count() == rollouts.select("update_id").distinct().count()
    assert readers.duplicate_samples(rollouts).isEmpty()


def test_policy_terms_by_hand(log, policy):
    out = training_log.policy_rollouts(log, policy, CONFIG)
    row = out.where("rollout_id = 100 and ppo_epoch = 0").first()
    ratio = math.exp(-0.5)
    assert row.ratio == pytest.approx(ratio)
    assert row.loss == pytest.approx(max(-row.advantage * ratio, -row.advantage * 0.8))
    assert row.token_ratio_sum == pytest.approx(math.exp(-0.5) + 1 + 1)


def test_sums_equal_sums_over_masked_arrays(spark, sf_dir):
    masked = RO.masked_rollouts(inputs.rollouts(spark, sf_dir), CONFIG)
    log = inputs.policy_log(spark, sf_dir)
    sums = RO.policy_sums(log, RO.sized_rollouts(inputs.rollouts(spark, sf_dir), CONFIG))
    new = log.join(masked.select("rollout_id", "logp", "sequence_length"), "rollout_id").select(
        "rollout_id", "ppo_epoch", "logp", RO.K.mask_after(F.col("new_logp"), F.col("sequence_length")).alias("new_logp")
    )
    both = sums.join(new, ["rollout_id", "ppo_epoch"]).select(
        (F.col("logp_sum") == RO.K.array_sum(F.col("logp"))).alias("a"),
        (F.col("new_logp_sum") == RO.K.array_sum(F.col("new_logp"))).alias("b"),
        (F.abs(F.col("token_ratio_sum") - RO.R.token_ratio_sum(F.col("new_logp"), F.col("logp"))) < 1e-9).alias("c"),
    )
    assert both.where("NOT (a AND b AND c)").count() == 0


def test_token_arrays_do_not_travel_to_the_advantages(log, folder, spark):
    log.write.parquet(f"{folder}/r")
    out = training_log.scored_rollouts(spark.read.schema(SCHEMA).parquet(f"{folder}/r"), CONFIG)
    shuffled = out._jdf.queryExecution().executedPlan().toString().split("Window")[-1]
    project = shuffled.split("Exchange")[1].split("Project [")[1].split("\n")[0]
    columns = [c.split(" AS ")[-1].split("#")[0].strip() for c in project.split(", ")]
    assert "objective_entropy" in columns
    assert not set(columns) & {"logp", "ref_logp", "response", "truncated", "score"}


def test_rewards_need_no_shuffle_or_python(log, folder, spark):
    log.write.parquet(f"{folder}/r")
    stored = spark.read.schema(SCHEMA).parquet(f"{folder}/r")
    shown = plan(RO.rollout_rewards(RO.masked_rollouts(stored, CONFIG), CONFIG))
    assert "Exchange" not in shown and "Python" not in shown
    shown = plan(training_log.scored_rollouts(stored, CONFIG))
    assert shown.count("Exchange") == 1


@pytest.mark.parametrize("temperature", [None, 0.7])
def test_log_softmax_by_hand_with_extreme_logits(spark, temperature):
    groups = {0: [1.0, 2.0, 3.0], 1: [-5000.0, 1000.0, 999.5], 2: [700.0, -700.0, 0.0], 3: [255.9, 256.1, 0.0]}
    rows = [(g, 0, t, x, 2) for g, xs in groups.items() for t, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "rollout_id long, pos long, token long, logit double, chosen long")
    got = {r.rollout_id: r for r in RO.log_softmax_gather(df, temperature=temperature).collect()}
    for g, xs in groups.items():
        xs = xs if temperature is None else [x / (temperature + 1e-7) for x in xs]
        top = max(xs)
        log_z = top + math.log(sum(math.exp(x - top) for x in xs))
        probabilities = [math.exp(x - log_z) for x in xs]
        assert got[g].logp == pytest.approx(xs[2] - log_z)
        entropy = -sum(p * (x - log_z) for p, x in zip(probabilities, xs))
        assert got[g].entropy == pytest.approx(entropy, abs=1e-9)


def test_report_decodes_truncated_responses(log, spark):
    prompts = spark.createDataFrame([(10, "q10"), (12, "q12")], "prompt_id long, query string")
    out = RO.completions_report(prompts, log, CONFIG).orderBy("rollout_id").collect()
    # A completion whose prompt is not listed stays, with a NULL query.
    assert [r.query for r in out if r.rollout_id // 10 not in (10, 12)] == [None] * (len(ROWS) - 4)
    assert [(r.rollout_id, r.query, r["model response"]) for r in out if r.query] == [
        (100, "q10", "5 1 0"), (101, "q10", "5 6 7"), (120, "q10", "5 6 1"), (121, "q10", "5 6 1"),
    ]


@pytest.mark.parametrize("scored", [False, True])
def test_a_bucketed_log_is_read_once_and_shuffled_three_times(spark, sf_dir, folder, scored):
    """Advantages, slots and updates: no shuffle brings the logs together."""
    for name, log in (("rollouts", inputs.rollouts), ("policy", inputs.policy_log)):
        writers.write_bucketed(log(spark, sf_dir), f"log_{name}_{scored}", f"{folder}/{name}", buckets=4)
    rollouts, policy = (spark.table(f"log_{n}_{scored}") for n in ("rollouts", "policy"))
    if scored:
        out = training_log.training_metrics(rollouts, policy, CONFIG, 64, 1000)
    else:
        out = training_log.training_slot_stats(rollouts, policy, CONFIG)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shown = plan(out)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shown.count("Exchange ") == 3 and shown.count("FileScan") == 2
    plain = training_log.training_slot_stats(inputs.rollouts(spark, sf_dir), inputs.policy_log(spark, sf_dir), CONFIG)
    if not scored:
        rows = lambda df: sorted(tuple(round(x, 9) for x in r) for r in df.collect())
        assert rows(out) == rows(plain)


def test_a_rollout_without_policy_rows_counts_for_the_objectives_only(spark):
    rows = [(1, 10, i, 100 + i, [5, 1], [-1.0, -1.0], [-1.0, -1.0], [1.0 * i, 0.5]) for i in (0, 1)]
    log = spark.createDataFrame(rows, SCHEMA).withColumns({"elapsed": F.lit(2.0), "lr": F.lit(0.5)})
    steps = spark.createDataFrame([(100, e, 0, 0, [-1.0, -1.0], [0.5, 0.5]) for e in (0, 1)], POLICY)
    row = training_log.training_metrics(log, steps, CONFIG, 8, 4).first()
    assert row["val/num_eos_tokens"] == 2 and row["objective/scores"] == 0.5 and row["val/ratio"] == 1.0
    assert training_log.policy_rollouts(log, steps, CONFIG).count() == 2
    assert training_log.training_metrics(log, steps.limit(0), CONFIG, 8, 4).count() == 0


def test_logs_meet_without_lists_from_aggregation_and_without_entropies(spark, sf_dir):
    shown = plan(RO.steps_of_rollouts(inputs.policy_log(spark, sf_dir)))
    assert "ObjectHashAggregate" not in shown
    assert "entropy_sum" in shown and "token_entropy" not in shown.split("Exchange")[0]


def test_policy_rows_meet_as_lists_in_order_and_rows_without_a_rollout_take_no_part(spark):
    rows = [(1, 1, 0, 0, [-2.0], [0.5, 0.25]), (1, 0, 0, 1, [-1.0], [1.0]), (None, 0, 0, 0, [-1.0], [1.0]), (2, 0, 3, 0, None, None)]
    got = {r.rollout_id: [tuple(s) for s in r.steps] for r in RO.steps_of_rollouts(spark.createDataFrame(rows, POLICY)).collect()}
    assert got == {1: [(0, 0, 1, [-1.0], 1.0), (1, 0, 0, [-2.0], 0.75)], 2: [(0, 3, 0, None, None)]}
