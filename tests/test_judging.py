import pytest
from pyspark.sql import functions as F

from thumbwheel.operators import inference, judging, metrics, pairing
from thumbwheel.plans import evaluation
from workload import judges

JUDGED = "model string, model_a string, model_b string, winner int, verdict string"


@pytest.fixture
def judged(spark):
    rows = [("m", "x", "y", 1, "B"), ("m", "x", "y", 0, "A"), ("m", "x", "y", 1, "B"), ("m", "x", "y", None, "C"),
            ("n", "x", "z", None, "error")]
    return spark.createDataFrame(rows, JUDGED)


def test_win_rates(judged):
    rates = {r.model: r for r in judging.win_rate_vs_reference(judged).collect()}
    assert rates["m"].win_rate == pytest.approx(2 / 3) and rates["m"].win_rate_percent == pytest.approx(200 / 3)
    assert rates["n"].win_rate is None
    pairs = {r.model_b: r for r in judging.win_rate_1v1(judged).collect()}
    assert pairs["y"].rate_a + pairs["y"].rate_b == pytest.approx(100) and pairs["z"].rate_a is None


def test_verdict_distribution_accounts_for_every_row(judged):
    r = judging.verdict_distribution(judged).first()
    assert (r.n_a, r.n_b, r.n_tie, r.n_error, r.n) == (1, 2, 1, 1, 5)
    assert r.error_rate == pytest.approx(0.2)


@pytest.fixture
def completions(spark):
    rows = [(o, m, "w" * (o + i)) for i, m in enumerate(("a", "b", "c")) for o in range(10 - 2 * i)]
    return spark.createDataFrame(rows, "ordinal long, model string, text string")


@pytest.fixture
def prompts(spark):
    return spark.range(20).select(F.col("id").alias("ordinal"), F.lit("q").alias("prompt"))


def test_pairing_stops_at_the_shorter_list(completions):
    assert pairing.pair_two_models(completions, "a", "b").count() == 8
    a, b = (completions.where(F.col("model") == m) for m in "ab")
    assert tuple(pairing.unmatched_counts(a, b).first()) == (8, 2, 0)


def test_tournament_plays_listed_matches_only(completions):
    assert pairing.round_robin(["c", "a", "b", "a"]) == [("a", "b"), ("a", "c"), ("b", "c")]
    out = pairing.tournament(completions, [("c", "a")]).collect()
    assert len(out) == 6 and all((r.model_a, r.model_b) == ("c", "a") for r in out)
    assert all(len(r.answer_a) == r.ordinal + 2 for r in out)


def test_tournament_keeps_every_answer(spark):
    rows = [(0, "a", "x"), (0, "a", "y"), (0, "b", None), (1, "a", "z"), (2, "b", "w")]
    out = pairing.tournament(spark.createDataFrame(rows, "ordinal long, model string, text string"), [("a", "b")])
    assert sorted((r.ordinal, r.answer_a, r.answer_b) for r in out.collect()) == [(0, "x", None), (0, "y", None)]


def test_matches_of_a_prompt_have_coins_of_their_own(spark):
    rows = [(i, a, b, "x", "y") for i in range(40) for a, b in (("a", "b"), ("a", "c"))]
    df = spark.createDataFrame(rows, "ordinal long, model_a string, model_b string, answer_a string, answer_b string")
    flips = {(r.ordinal, r.model_b): r.flipped for r in judging.flip_order(df, ("ordinal", "model_a", "model_b"), 3).collect()}
    assert any(flips[i, "b"] != flips[i, "c"] for i in range(40))


def test_flip_is_undone(spark, completions, prompts):
    plain = evaluation.judge_matches(prompts, completions, [("a", "b")], judges.length_judge)
    flipped = evaluation.judge_matches(prompts, completions, [("a", "b")], judges.length_judge, flip_seed=5)
    assert plain.collect() == flipped.collect()
    flags = judging.flip_order(pairing.pair_two_models(completions, "a", "b"), "ordinal", 5).select("flipped").distinct()
    assert flags.count() == 2


def test_judging_keeps_keys_of_undecided_rows(completions, prompts):
    asked = pairing.attach_prompts(pairing.pair_two_models(completions, "a", "b"), prompts)
    out = inference.batch_judge(asked, judges.length_judge)
    assert sorted(r.ordinal for r in out.collect()) == list(range(8))
    assert out.where("winner is null").count() == out.where("verdict in ('C', 'error')").count()


def test_a_factory_runs_once_per_task(spark):
    def factory():
        calls = {"n": 0}

        def run(prompts):
            calls["n"] += 1
            return prompts.map(lambda p: f" {p}:{calls['n']}\n")

        return run

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        df = spark.range(6).coalesce(1).select(F.col("id").alias("ordinal"), F.lit("p").alias("prompt"))
        out = inference.batch_generate(df, factory).orderBy("ordinal").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r.text for r in out] == ["p:1", "p:1", "p:2", "p:2", "p:3", "p:3"]


def test_reward_evaluations(spark):
    pairs = spark.createDataFrame([(2.0, 1.0), (0.0, 0.0), (-800.0, 800.0)], "c double, r double")
    r = metrics.pairwise_reward_eval(pairs, F.col("c"), F.col("r")).first()
    assert r.accuracy == pytest.approx(1 / 3)
    assert r.loss == pytest.approx((0.31326168751822286 + 0.6931471805599453 + 1600) / 3)
    points = spark.createDataFrame([([0.0, 2.0], 1), ([3.0, 1.0], 1)], "x array<double>, y int")
    p = metrics.pointwise_reward_eval(points, F.col("x"), F.col("y")).first()
    assert (p.accuracy, p.true_good, p.false_bad) == (0.5, 1, 1)
    assert p.cross_entropy == pytest.approx(0.1269280110429726 / 2 + 2.1269280110429727 / 2)


def test_slot_means_weigh_slots_equally(spark):
    rows = [(1, 0, 0, 0, 1.0)] * 3 + [(1, 0, 1, 0, 5.0)]
    df = spark.createDataFrame(rows, "update_id long, ppo_epoch long, minibatch long, microbatch long, loss double")
    for c in ("is_clipped", "log_ratio_sq", "entropy_sum", "token_ratio_sum"):
        df = df.withColumn(c, F.col("loss"))
    df = df.withColumn("n_tokens", F.lit(2))
    r = metrics.slot_stats(df).first()
    assert r["loss/policy_avg"] == 3.0 and r["val/ratio"] == 1.5
    assert r["val/ratio_var"] == pytest.approx(2.0)
    one = metrics.slot_stats(df.where("minibatch = 0")).first()
    assert one["val/ratio_var"] is None
