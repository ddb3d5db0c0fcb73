import datetime as dt

import pytest
from pyspark.sql import functions as F

from thumbwheel.operators import metrics
from thumbwheel.operators.rollouts import rloo_advantage
from thumbwheel.session import STATE_STORE_KEY
from thumbwheel.streaming import feedback

T0 = dt.datetime(2024, 1, 1)
END = (dt.datetime(2100, 1, 1), None)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """A state store per partition and run: two are as good as many here."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def write_batch(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def drain(spark, stream, folder, name="out"):
    feedback.drain_to_table(stream, f"{folder}/{name}", f"{folder}/{name}-checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{folder}/{name}").collect()


def test_late_feedback_is_dropped_and_other_events_move_the_watermark(spark, folder):
    schema = "ts timestamp, up boolean"
    source = f"{folder}/in"
    hour = lambda h: T0 + dt.timedelta(hours=h)

    def rates():
        stream = feedback.read_table_stream(spark, source, spark.read.parquet(source).schema)
        return feedback.stream_thumbs_rate(stream, "ts", F.col("up"), "1 hour", "1 hour")

    write_batch(spark, [(hour(0.1), True), (hour(0.2), False), (hour(0.3), True), (hour(5), None)], schema, source)
    drain(spark, rates(), folder)
    write_batch(spark, [(hour(0.4), True), (hour(5.5), False)], schema, source)
    drain(spark, rates(), folder)
    write_batch(spark, [END], schema, source)
    got = sorted((r.window_start, r.n_up, r.n) for r in drain(spark, rates(), folder))
    assert got == [(hour(0), 2, 3), (hour(5), 0, 1)]


def test_a_feed_sent_twice_gives_the_rates_of_one(spark, folder):
    schema = "event_id long, ts timestamp, up boolean"
    rows = [(1, at(0), True), (2, at(60), False), (3, at(3700), True), (4, at(3800), None)]
    source = f"{folder}/in"

    def rates():
        stream = feedback.read_table_stream(spark, source, spark.read.parquet(source).schema)
        return feedback.stream_thumbs_rate(stream, "ts", F.col("up"), "1 hour", "1 hour", key=["event_id"])

    write_batch(spark, rows, schema, source)
    write_batch(spark, rows[:2], schema, source)
    drain(spark, rates(), folder)
    write_batch(spark, rows, schema, source)
    drain(spark, rates(), folder)
    write_batch(spark, [(None, *END)], schema, source)
    got = sorted((r.window_start, r.n_up, r.n) for r in drain(spark, rates(), folder))
    assert got == [(at(0), 1, 2), (at(3600), 1, 1)]


def state_rows(query):
    return [o["numRowsTotal"] for o in query.lastProgress["stateOperators"]]


def test_what_a_feed_remembers_is_let_go_with_the_watermark(spark, folder):
    schema = "event_id long, ts timestamp, up boolean"
    source = f"{folder}/in"
    write_batch(spark, [(i, at(i), True) for i in range(200)], schema, source)
    stream = feedback.once(feedback.read_table_stream(spark, source, spark.read.parquet(source).schema), ["event_id"], "ts", "1 minute")

    def run():
        query = (
            stream.writeStream.format("parquet").option("path", f"{folder}/out")
            .option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return state_rows(query)

    run()
    write_batch(spark, [(1000, at(100_000), True)], schema, source)
    assert run() == [1]
    assert spark.read.parquet(f"{folder}/out").count() == 201


def test_pairs_sent_twice_give_one_pair_of_rows(spark, folder):
    message = "array<struct<role: string, content: string>>"
    schema = f"example_id long, split string, prompt string, chosen {message}, rejected {message}, ts timestamp"
    row = (1, "train", "p", [("assistant", "good")], [("assistant", "bad")], at(0))
    write_batch(spark, [row, row], schema, f"{folder}/in")
    write_batch(spark, [row, (2, *row[1:])], schema, f"{folder}/in")
    stream = feedback.read_table_stream(spark, f"{folder}/in", spark.read.parquet(f"{folder}/in").schema)
    once = drain(spark, feedback.stream_unpaired(stream, key=["example_id"], ts="ts"), folder)
    assert sorted((r.example_id, r.branch) for r in once) == [(1, 0), (1, 1), (2, 0), (2, 1)]
    with pytest.raises(ValueError):
        feedback.stream_unpaired(stream, key=["example_id"])


REWARDS = "update_id long, prompt_id long, sample_idx long, rollout_id long, rlhf_reward double, ts timestamp"


def reward_stream(spark, source, **options):
    stream = feedback.read_table_stream(spark, source, spark.read.schema(REWARDS).parquet(source).schema)
    return feedback.stream_rloo_advantage(stream, 2, **options)


@pytest.mark.parametrize("apart", [1, 660, 3600])
def test_slots_close_with_their_last_sample_however_far_apart(spark, folder, apart):
    """Every sample comes in a run of its own; others move the clock between them."""
    source = f"{folder}/in"
    steps = [
        [(1, 1, 0, 10, 1.0, at(0)), (1, 3, 0, 30, 0.5, at(0))],
        [(1, 1, 0, 10, 1.0, at(0)), (9, 9, 0, 90, 0.0, at(apart))],
        [(1, 1, 1, 11, 0.25, at(apart)), (1, 1, 2, 12, 4.0, at(apart)), (1, 1, 3, 13, None, at(apart))],
        [(1, 1, 1, 11, 0.25, at(apart)), (1, 1, 0, 10, 1.0, at(apart))],
    ]
    seen = []
    for rows in steps:
        write_batch(spark, rows, REWARDS, source)
        drained = drain(spark, reward_stream(spark, source, watermark="2 hours"), folder)
        seen.append({r.rollout_id: r.advantage for r in drained})
        assert len(drained) == len(seen[-1])
    pair = {10: 0.75, 11: -0.75}
    assert seen[:2] == [{}, {}] and seen[2] == seen[3] == {**pair, 12: None, 13: None} | {12: 4.0 - (4.0 - 4.0) / 1}
    write_batch(spark, [(None, None, None, None, None, END[0])], REWARDS, source)
    last = drain(spark, reward_stream(spark, source, watermark="2 hours"), folder)
    rows = sum(steps[:3], [])
    distinct = spark.createDataFrame(sorted(set(rows), key=str), REWARDS)
    batch = {r.rollout_id: r.advantage for r in rloo_advantage(distinct, 2).collect()}
    assert {r.rollout_id: r.advantage for r in last} == batch and len(last) == len(batch) == 6
    assert batch[30] is None and batch[90] is None


def test_a_slot_with_too_many_samples_fails_the_stream(spark, folder):
    rows = [(1, 1, 0, i, 1.0, at(i)) for i in range(3)]
    write_batch(spark, rows, REWARDS, f"{folder}/in")
    with pytest.raises(Exception, match="a slot of 2 has samples"):
        drain(spark, reward_stream(spark, f"{folder}/in"), folder)


def test_incomplete_slots_come_once_at_their_timer_and_leave_no_state(spark, folder):
    source = f"{folder}/in"
    options = dict(patience=dt.timedelta(hours=1), watermark="1 minute")
    write_batch(spark, [(1, 1, 0, 10, 1.0, at(0)), (1, 2, 0, 20, 1.0, at(0)), (1, 2, 1, 21, 0.0, at(1))], REWARDS, source)
    assert {r.rollout_id for r in drain(spark, reward_stream(spark, source, **options), folder)} == {20, 21}
    write_batch(spark, [(9, 9, 0, 90, 0.0, at(7200))], REWARDS, source)
    assert {r.rollout_id for r in drain(spark, reward_stream(spark, source, **options), folder)} == {20, 21, 10}
    write_batch(spark, [(9, 9, 1, 91, 0.0, at(7201))], REWARDS, source)
    query = (
        reward_stream(spark, source, **options).writeStream.format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/out-checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = spark.read.parquet(f"{folder}/out").collect()
    assert sorted(r.rollout_id for r in got) == [10, 20, 21, 90, 91]


STEP = (
    "update_id long, rollout_id long, ppo_epoch long, minibatch long, microbatch long, step_number int, "
    "loss double, is_clipped double, log_ratio_sq double, entropy_sum double, n_tokens long, token_ratio_sum double, "
    "kl double, objective_entropy double, non_score_reward double, rlhf_reward double, reward_score double, "
    "num_eos long, elapsed double, lr double, slot_rows long, n_slots long, ts timestamp"
)


def step_rows(update, shift):
    out = []
    for epoch in (0, 1):
        for i in range(4):
            loss = None if i == 3 else 0.25 * i + epoch
            out.append(
                (update, update * 10 + i, epoch, i // 2, 0, epoch, loss, None if i == 3 else float(i % 2), 0.5 * i, 1.0 + i,
                 2 + i, 2.5 + i, 0.25 * i, 1.0, -0.125, 0.5 * i, float(i % 2), i, 30.0 * update, 0.5, 2, 4, at(shift * (i + 4 * epoch)))
            )
    return out


@pytest.mark.parametrize("apart", [1, 3600])
def test_updates_equal_batch_however_long_they_take(spark, folder, apart):
    rows = step_rows(1, apart) + step_rows(2, apart)
    source = f"{folder}/in"

    def metrics_stream():
        stream = feedback.read_table_stream(spark, source, spark.read.schema(STEP).parquet(source).schema)
        return feedback.stream_update_metrics(stream, 8, 2, 10, watermark="9 hours")

    got = []
    for part in (rows[:5], rows[:9] + rows[3:4], rows[9:], rows):
        write_batch(spark, part, STEP, source)
        got.append({r.update_id for r in drain(spark, metrics_stream(), folder)})
    assert got == [set(), {1}, {1, 2}, {1, 2}]
    stream = {r.update_id: r.asDict() for r in drain(spark, metrics_stream(), folder)}
    steps = spark.createDataFrame(rows, STEP)
    batch = metrics.update_metrics(steps, 8, 2, 10, F.col("elapsed"), F.col("lr")).collect()
    assert len(batch) == 2
    for row in batch:
        for name, value in row.asDict().items():
            assert stream[row.update_id][name] == pytest.approx(value), name
        assert (stream[row.update_id]["n_slots"], stream[row.update_id]["n_rollouts"]) == (4, 4)
        assert stream[row.update_id]["complete"]


def test_an_update_that_stays_incomplete_says_so(spark, folder):
    source = f"{folder}/in"
    write_batch(spark, step_rows(1, 1)[:5], STEP, source)
    write_batch(spark, [(*[None] * 22, END[0])], STEP, source)
    stream = feedback.read_table_stream(spark, source, spark.read.schema(STEP).parquet(source).schema)
    (row,) = drain(spark, feedback.stream_update_metrics(stream, 8, 2, 10), folder)
    assert (row.update_id, row.n_slots, row.n_rollouts, row.complete) == (1, 3, 4, False)
    assert row["objective/kl"] == 0.375


@pytest.fixture
def default_store(spark):
    """A session that names no state store for its streams has one without keyed state."""
    before = spark.conf.get(STATE_STORE_KEY)
    store = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(STATE_STORE_KEY, store)
    yield store
    assert spark.conf.get(STATE_STORE_KEY) == store
    spark.conf.set(STATE_STORE_KEY, before)


def test_keyed_streams_run_in_a_session_with_another_state_store(spark, folder, default_store):
    write_batch(spark, [(1, 1, 0, 10, 1.0, at(0)), (1, 1, 1, 11, 0.25, at(1))], REWARDS, f"{folder}/in")
    feedback.drain_to_table(reward_stream(spark, f"{folder}/in"), f"{folder}/out", f"{folder}/c", keyed_state=True)
    assert {r.rollout_id: r.advantage for r in spark.read.parquet(f"{folder}/out").collect()} == {10: 0.75, 11: -0.75}
    write_batch(spark, step_rows(1, 1), STEP, f"{folder}/steps")
    steps = feedback.read_table_stream(spark, f"{folder}/steps", spark.read.schema(STEP).parquet(f"{folder}/steps").schema)
    feedback.drain_to_table(
        feedback.stream_update_metrics(steps, 8, 2, 10), f"{folder}/updates", f"{folder}/c2", keyed_state=True
    )
    (row,) = spark.read.parquet(f"{folder}/updates").collect()
    assert (row.update_id, row.n_slots, row.n_rollouts, row.complete) == (1, 4, 4, True)


def test_slots_that_share_their_state_keep_their_own_timers(spark, folder):
    """One share for all slots: each comes at its own time, those without a key too."""
    source = f"{folder}/in"

    def run(*rows):
        write_batch(spark, list(rows), REWARDS, source)
        stream = reward_stream(spark, source, patience=dt.timedelta(hours=1), watermark="1 minute", pieces=1)
        return {r.rollout_id: r.advantage for r in drain(spark, stream, folder)}

    first = (1, 1, 0, 10, 1.0, at(0)), (1, 2, 0, 20, 1.0, at(1800)), (1, None, None, 30, 2.0, at(1900)), (1, None, None, 31, 1.0, at(1900))
    assert run(*first) == {30: 1.0, 31: -1.0}
    assert run((1, 9, 0, 90, 0.0, at(4000))) == {30: 1.0, 31: -1.0, 10: None}
    assert run((1, 2, 1, 21, 0.5, at(4100)), (1, None, None, 31, 1.0, at(4100))) == {30: 1.0, 31: -1.0, 10: None, 20: 0.5, 21: -0.5}
    assert run((2, 9, 9, 99, 0.0, at(90000))) == {30: 1.0, 31: -1.0, 10: None, 20: 0.5, 21: -0.5, 90: None}


def test_the_clock_of_a_feed_takes_no_rows_from_the_slots_beside_it(spark, folder):
    """The row without a key that ends a feed shares its task with slots that have begun before."""
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    source = f"{folder}/in"
    rows = step_rows(1, 1) + step_rows(2, 1)

    def run(part):
        write_batch(spark, part, STEP, source)
        stream = feedback.read_table_stream(spark, source, spark.read.schema(STEP).parquet(source).schema)
        return drain(spark, feedback.stream_update_metrics(stream, 8, 2, 10), folder)

    assert run(rows[::2]) == []
    got = run(rows[1::2] + [(*[None] * 22, END[0])])
    assert sorted((r.update_id, r.n_slots, r.n_rollouts, r.complete) for r in got) == [(1, 4, 4, True), (2, 4, 4, True)]


def test_a_slot_without_a_part_of_its_key_keeps_its_null(spark, folder):
    rows = [r[:3] + (None,) + r[4:20] + (4, 2) + r[22:] for r in step_rows(1, 1)]
    write_batch(spark, rows, STEP, f"{folder}/in")
    stream = feedback.read_table_stream(spark, f"{folder}/in", spark.read.schema(STEP).parquet(f"{folder}/in").schema)
    (row,) = drain(spark, feedback.stream_update_metrics(stream, 8, 2, 10), folder)
    assert (row.update_id, row.n_slots, row.n_rollouts, row.complete) == (1, 2, 4, True)


def test_bounded_state_gives_the_session_its_own_settings_back(spark):
    keys = feedback.BATCHES_KEPT_KEY, feedback.PARTITIONS_KEY
    before = [spark.conf.get(k) for k in keys]
    with feedback.bounded_state(spark, batches=3, partitions=1):
        assert [spark.conf.get(k) for k in keys] == ["3", "1"]
    assert [spark.conf.get(k) for k in keys] == before
