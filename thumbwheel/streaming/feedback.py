"""Streams of pairs, thumbs feedback and rollouts."""

from __future__ import annotations

import contextlib
import datetime as dt
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from thumbwheel.operators.metrics import OBJECTIVES, SLOT
from thumbwheel.operators.reshape import pairs_to_unpaired
from thumbwheel.session import ROCKSDB, STATE_STORE_KEY

BATCHES_KEPT_KEY = "spark.sql.streaming.minBatchesToRetain"
PARTITIONS_KEY = "spark.sql.shuffle.partitions"

#: How long a slot or an update waits for what is missing, counted from its last row.
PATIENCE = dt.timedelta(days=1)


def read_table_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    glob: str | None = None,
    files_per_trigger: int | None = 1000,
) -> DataFrame:
    """A file stream; a backlog is worked off ``files_per_trigger`` files at a time, all at once if None."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def once(events: DataFrame, key: Sequence[str], ts: str, watermark: str) -> DataFrame:
    """A feed that may deliver an event more than once, with every event once.

    ``key`` names the event. Deliveries of an event that lie no further apart than
    ``watermark`` in event time are recognised; what is remembered is let go when the
    watermark has passed it, so state is bounded by the events of that time.
    """
    return events.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(key))


def stream_unpaired(
    pairs: DataFrame,
    label_type: str = "int",
    key: Sequence[str] = (),
    ts: str | None = None,
    watermark: str = "1 hour",
) -> DataFrame:
    """Pairs to unpaired rows, the batch expression unchanged.

    With ``key`` and ``ts`` a pair that is delivered again gives no second rows;
    without them the stream is stateless and passes on what it gets.
    """
    if key:
        if ts is None:
            raise ValueError("a feed is freed of repetitions by a key and a time column")
        pairs = once(pairs, key, ts, watermark)
    return pairs_to_unpaired(pairs, label_type)


def stream_thumbs_rate(
    feedback: DataFrame,
    ts: str,
    up: Column,
    window: str = "1 day",
    watermark: str = "1 hour",
    key: Sequence[str] = (),
) -> DataFrame:
    """Thumbs-up rate per tumbling window; ``up`` is true, false, or NULL for other events.

    Other events are not counted but still move the watermark, so they are
    left out by the counts and not by a filter. With ``key`` an event that is
    delivered again counts once.
    """
    marked = feedback.withColumn("__up", up)
    timed = once(marked, key, ts, watermark) if key else marked.withWatermark(ts, watermark)
    return (
        timed.groupBy(F.window(ts, window).alias("w"))
        .agg(
            F.count(F.when(F.col("__up"), 1)).alias("n_up"),
            F.count("__up").alias("n"),
        )
        .where(F.col("n") > 0)
        .select(
            F.col("w.start").alias("window_start"),
            "n_up",
            "n",
            (F.col("n_up") / F.col("n")).alias("up_rate"),
        )
    )


class _Waiting(StatefulProcessor):
    """A key that is let go ``patience`` after the last row it got."""

    def __init__(self, patience: dt.timedelta):
        self.wait_ms = int(patience.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def wait_until(self, before: int | None, last_ms: int | None) -> int | None:
        """Moves the key's timer to its last row; the timer's time."""
        if last_ms is None:
            return before
        timer = last_ms + self.wait_ms
        if before is not None:
            if timer <= before:
                return before
            self.handle.deleteTimer(before)
        self.handle.registerTimer(timer)
        return timer

    def close(self) -> None:
        pass


class SlotSamples(_Waiting):
    """The samples of a share of an update's slots: rewards until a slot's ``k``-th is there, ids after that.

    The state of many slots is read and written at once, as a call to the state store costs more
    than a slot's work. One timer stands for all of them: that of the slot let go first.
    """

    def __init__(self, k: int, patience: dt.timedelta):
        super().__init__(patience)
        self.k = k

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        # A row per sample; ``until`` is the timer of its slot, the same for all samples of a slot.
        self.state = handle.getValueState(
            "samples",
            "prompts array<bigint>, slots array<bigint>, ids array<bigint>, rewards array<double>, "
            "until array<bigint>, timer bigint",
        )

    def load(self) -> tuple[dict, int | None]:
        """``(prompt, slot)`` to its ids, rewards and timer; the timer that is set."""
        known, waiting = self.state.get(), {}
        if known is None:
            return waiting, None
        for prompt, slot, i, reward, until in zip(*known[:5]):
            ids, rewards, _ = waiting.setdefault((prompt, slot), ([], [], until))
            ids.append(i)
            rewards.append(reward)
        return waiting, known[5]

    def store(self, waiting: dict, timer: int | None) -> None:
        if not waiting:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.state.clear()
            return
        first = min((until for _, _, until in waiting.values() if until is not None), default=None)
        if first != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if first is not None:
                self.handle.registerTimer(first)
        rows = [(*at, i, r, until) for at, (ids, rewards, until) in waiting.items() for i, r in zip(ids, rewards)]
        self.state.update((*map(list, zip(*rows)), first))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        arrived: dict = {}
        for r in rows:
            arrived.setdefault((r["prompt_id"], r["slot"]), []).append((r["rollout_id"], r["rlhf_reward"], r["ts_ms"]))
        waiting, timer = self.load()
        changed = False
        for at, samples in arrived.items():
            ids, rewards, until = waiting.get(at, ([], [], None))
            seen, last = len(ids), None
            for i, reward, ts_ms in samples:
                last = _larger(last, ts_ms)
                if i not in ids:
                    ids.append(i)
                    rewards.append(reward)
            if len(ids) == seen:
                continue
            if len(ids) > self.k:
                raise ValueError(f"a slot of {self.k} has samples: {sorted(map(str, ids))}")
            if len(ids) == self.k:
                yield from self.advantages(key[0], at[0], ids, rewards)
                rewards = [None] * self.k
            until = until if last is None else _larger(until, last + self.wait_ms)
            waiting[at], changed = (ids, rewards, until), True
        if changed:
            self.store(waiting, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        passed = max(now + 1, timerValues.getCurrentWatermarkInMs())
        waiting, _ = self.load()
        due = [at for at, (_, _, until) in waiting.items() if until is not None and until < passed]
        for at in due:
            ids, rewards, _ = waiting.pop(at)
            if len(ids) < self.k:
                yield from self.advantages(key[0], at[0], ids, rewards)
        self.store(waiting, None)

    def advantages(self, update, prompt, ids: list, rewards: list) -> Iterator[Row]:
        n, valued = len(ids), [r for r in rewards if r is not None]
        total = sum(valued)
        for i, r in zip(ids, rewards):
            alone = r is None or n < 2
            yield Row(
                update_id=update, prompt_id=prompt, rollout_id=i, rlhf_reward=r,
                advantage=None if alone else r - (total - r) / (n - 1),
            )


def stream_rloo_advantage(
    rewards: DataFrame,
    k: int,
    ts: str = "ts",
    patience: dt.timedelta = PATIENCE,
    watermark: str = "10 minutes",
    pieces: int = 256,
) -> DataFrame:
    """Advantages of every slot when its ``k``-th sample arrives: the rows of the batch operator.

    It does not matter how far apart the samples are. A slot that stays incomplete is
    given out ``patience`` after its last sample as batch does: over the samples it has,
    NULL for one without company. A sample that is delivered again changes nothing.
    State per slot is at most ``k`` samples, their ids alone once they are out, until the
    same timer; a slot with more than ``k`` samples fails the stream. The slots of an update
    are kept in ``pieces`` shares, each read and written as one: a share should fit a task's memory.
    Start it with ``drain_to_table(..., keyed_state=True)`` or over the RocksDB state store.
    """
    slot = F.floor(F.col("sample_idx") / F.lit(k)).cast("long").alias("slot")
    return (
        rewards.withWatermark(ts, watermark)
        .select("update_id", "prompt_id", slot, "rollout_id", "rlhf_reward", F.unix_millis(ts).alias("ts_ms"), ts)
        .withColumn("piece", F.pmod(F.xxhash64("prompt_id", "slot"), F.lit(pieces)))
        .groupBy("update_id", "piece")
        .transformWithState(
            SlotSamples(k, patience),
            "update_id bigint, prompt_id bigint, rollout_id bigint, rlhf_reward double, advantage double",
            "append",
            "EventTime",
        )
    )


#: What a slot adds up over its rows, and over those of the first epoch, where every rollout is once.
STEP_SUMS = ("loss", "is_clipped", "log_ratio_sq", "entropy_sum", "n_tokens", "token_ratio_sum")
ROLLOUT_SUMS = (*OBJECTIVES, "num_eos")
SUMMED = (*STEP_SUMS, *ROLLOUT_SUMS)

#: What a row of the steps has besides its time.
STEP_COLUMNS = (*SLOT, "rollout_id", "step_number", *SUMMED, "elapsed", "lr")

SLOT_STATE = (
    "n bigint, want bigint, slots bigint, rollouts bigint, elapsed double, lr double, "
    "sums array<double>, counts array<bigint>, last bigint, timer bigint"
)
SLOT_ROW = (
    ", ".join(f"{c} bigint" for c in SLOT) + ", n_slots bigint, n_rollouts bigint, elapsed double, lr double, "
    "complete boolean, sums array<double>, counts array<bigint>, last_seen timestamp"
)
UPDATE_STATE = (
    "rollouts bigint, complete boolean, elapsed double, lr double, want bigint, "
    "slots array<array<double>>, sums array<double>, counts array<bigint>, timer bigint"
)
UPDATE_ROW = (
    "update_id bigint, n_slots bigint, n_rollouts bigint, complete boolean, elapsed double, lr double, "
    "slots array<array<double>>, sums array<double>, counts array<bigint>"
)


def _larger(a, b):
    return b if a is None else a if b is None else max(a, b)


def _largest(column: pd.Series, kind: type = int):
    """A column of integers comes as floats with the rows of a batch in which one is NULL."""
    return None if column.isna().all() else kind(column.max())


def _share(total: float, n: float) -> float | None:
    return total / n if n else None


class SlotSums(_Waiting):
    """Sums and counts of the values in the rows of one optimisation slot, given out with its last row.

    The key is the slot, 0 for what is NULL, and a bit for each NULL: a NULL key turns the keys that come to Python
    with it into floats, and the state of a key of floats is not that of the slot.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.state = handle.getValueState("sums", SLOT_STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n, want, slots, rollouts, elapsed, lr, sums, counts, last, timer = (
            self.state.get() or (0, None, None, 0, None, None, None, None, None, None)
        )
        sums = np.array(sums if sums is not None else np.zeros(len(SUMMED)))
        counts = np.array(counts if counts is not None else np.zeros(len(SUMMED), np.int64))
        for frame in rows:
            first = frame["step_number"] == 0
            for i, c in enumerate(SUMMED):
                column = frame[c] if i < len(STEP_SUMS) else frame[c][first]
                sums[i] += column.sum()
                counts[i] += column.count()
            n, rollouts = n + len(frame), rollouts + int(first.sum())
            want, slots = _larger(want, _largest(frame["slot_rows"])), _larger(slots, _largest(frame["n_slots"]))
            elapsed, lr = _larger(elapsed, _largest(frame["elapsed"], float)), _larger(lr, _largest(frame["lr"], float))
            last = _larger(last, _largest(frame["ts_ms"]))
        if want is not None and n >= want:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.state.clear()
            yield self.row(key, slots, rollouts, elapsed, lr, True, sums, counts, last)
        else:
            timer = self.wait_until(timer, last)
            self.state.update((n, want, slots, rollouts, elapsed, lr, sums.tolist(), counts.tolist(), last, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = self.state.get()
        self.state.clear()
        if known is not None:
            _, _, slots, rollouts, elapsed, lr, sums, counts, last, _ = known
            # The clock of the next stage has come this far: a row behind it would count as late.
            last = max(last, int(expiredTimerInfo.getExpiryTimeInMs()))
            yield self.row(key, slots, rollouts, elapsed, lr, False, sums, counts, last)

    def row(self, key, slots, rollouts, elapsed, lr, complete, sums, counts, last) -> pd.DataFrame:
        seen = pd.Timestamp(last, unit="ms", tz="UTC")
        *slot, nulls = map(int, key)
        slot = (None if nulls >> i & 1 else part for i, part in enumerate(slot))
        values = (*slot, slots, rollouts, elapsed, lr, complete, list(sums), list(counts), seen)
        names = (*SLOT, "n_slots", "n_rollouts", "elapsed", "lr", "complete", "sums", "counts", "last_seen")
        return pd.DataFrame({n: [v] for n, v in zip(names, values)})


class UpdateSlots(_Waiting):
    """The statistics of the slots of one update, given out when the last slot is there."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.state = handle.getValueState("slots", UPDATE_STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        rollouts, complete, elapsed, lr, want, slots, sums, counts, timer = (
            self.state.get() or (0, True, None, None, None, None, None, None, None)
        )
        slots = [list(s) for s in slots] if slots is not None else []
        sums = list(sums) if sums is not None else [0.0] * len(ROLLOUT_SUMS)
        counts = list(counts) if counts is not None else [0] * len(ROLLOUT_SUMS)
        last = None
        for r in rows:
            rollouts, complete = rollouts + r["n_rollouts"], complete and r["complete"]
            elapsed, lr, want = _larger(elapsed, r["elapsed"]), _larger(lr, r["lr"]), _larger(want, r["n_slots"])
            loss, clipped, squared, entropy, tokens, ratio = r["sums"][: len(STEP_SUMS)]
            n_loss, n_clipped, n_squared = r["counts"][:3]
            half = _share(0.5 * squared, n_squared)
            slots.append(
                [_share(loss, n_loss), _share(clipped, n_clipped), half, _share(entropy, tokens), _share(ratio, tokens)]
            )
            for i in range(len(ROLLOUT_SUMS)):
                sums[i] += r["sums"][len(STEP_SUMS) + i]
                counts[i] += r["counts"][len(STEP_SUMS) + i]
            last = _larger(last, r["ts_ms"])
        if want is not None and len(slots) >= want:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.state.clear()
            yield self.row(key, rollouts, complete, elapsed, lr, slots, sums, counts)
        else:
            timer = self.wait_until(timer, last)
            self.state.update((rollouts, complete, elapsed, lr, want, slots, sums, counts, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known = self.state.get()
        self.state.clear()
        if known is not None:
            rollouts, _, elapsed, lr, _, slots, sums, counts, _ = known
            yield self.row(key, rollouts, False, elapsed, lr, [list(s) for s in slots], list(sums), list(counts))

    def row(self, key, rollouts, complete, elapsed, lr, slots, sums, counts) -> Row:
        return Row(
            update_id=key[0], n_slots=len(slots), n_rollouts=rollouts, complete=complete, elapsed=elapsed, lr=lr,
            slots=slots, sums=sums, counts=counts,
        )


# The metric names.
def stream_update_metrics(
    steps: DataFrame,
    batch_size: int,
    k: int,
    n_train: int,
    ts: str = "ts",
    patience: dt.timedelta = PATIENCE,
    watermark: str = "10 minutes",
) -> DataFrame:
    """One row of all metrics per update while training runs, when its last slot closes.

    ``steps`` are the rows of ``rollout_steps``, with ``slot_rows`` (how many rows its optimisation slot gets) and
    ``n_slots`` (how many slots its update has), which the trainer knows. A slot
    closes with its last row and an update with its last slot, however long either
    takes: two stateful aggregations, the second over the few slots of an update. An
    update that stays incomplete comes ``patience`` after its last row, with
    ``complete`` false. A row that is delivered again counts once.
    """
    named = once(steps, ["update_id", "rollout_id", "ppo_epoch"], ts, watermark)
    sums = [F.col(c).cast("double").alias(c) for c in SUMMED]
    known = [F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in SLOT]
    nulls = sum(F.col(c).isNull().cast("long") * (1 << i) for i, c in enumerate(SLOT)).alias("nulls")
    slots = (
        named.select(
            *known, nulls, *sums, *(F.col(c).cast("long").alias(c) for c in ("slot_rows", "n_slots", "step_number")),
            F.col("elapsed").cast("double").alias("elapsed"), F.col("lr").cast("double").alias("lr"),
            F.unix_millis(ts).alias("ts_ms"), ts,
        )
        .groupBy(*SLOT, "nulls")
        .transformWithStateInPandas(SlotSums(patience), SLOT_ROW, "append", "EventTime", eventTimeColumnName="last_seen")
    )
    updates = (
        slots.withColumn("ts_ms", F.unix_millis("last_seen"))
        .groupBy("update_id")
        .transformWithState(UpdateSlots(patience), UPDATE_ROW, "append", "EventTime")
    )
    mean = lambda i: F.try_divide(F.col("sums")[i], F.col("counts")[i])
    of = lambda i: F.filter(F.transform("slots", lambda s: s[i]), lambda x: x.isNotNull())
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x)
    average = lambda i: F.try_divide(total(of(i)), F.size(of(i)))
    spread = total(F.transform(of(4), lambda x: F.pow(x - average(4), F.lit(2))))
    episode = F.col("update_id") * F.lit(batch_size)
    return updates.select(
        "update_id",
        *(mean(i).alias(name) for i, name in enumerate(OBJECTIVES.values())),
        F.col("sums")[len(OBJECTIVES)].cast("long").alias("val/num_eos_tokens"),
        average(2).alias("policy/approxkl_avg"),
        average(1).alias("policy/clipfrac_avg"),
        average(0).alias("loss/policy_avg"),
        average(3).alias("policy/entropy_avg"),
        average(4).alias("val/ratio"),
        F.when(F.size(of(4)) > 1, spread / (F.size(of(4)) - 1)).alias("val/ratio_var"),
        F.lit(0.0).alias("val/clipfrac_avg"),
        "lr",
        episode.alias("episode"),
        F.floor(F.try_divide(episode, F.col("elapsed"))).cast("long").alias("eps"),
        (episode / F.lit(float(k * n_train))).alias("epoch"),
        "n_slots",
        "n_rollouts",
        "complete",
    )


@contextlib.contextmanager
def bounded_state(spark: SparkSession, batches: int = 2, partitions: int = 64) -> Iterator[None]:
    """Streams that start in here keep less on the disks.

    Their checkpoints go back ``batches`` batches instead of Spark's hundred, and they have at most ``partitions``
    partitions: a store sets some 4 MB aside before it holds anything, and there is one per partition and stateful step.
    """
    before = {key: spark.conf.get(key) for key in (BATCHES_KEPT_KEY, PARTITIONS_KEY)}
    spark.conf.set(BATCHES_KEPT_KEY, batches)
    spark.conf.set(PARTITIONS_KEY, min(partitions, int(before[PARTITIONS_KEY])))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@contextlib.contextmanager
def keyed_state_store(spark: SparkSession) -> Iterator[None]:
    """Streams that start in here keep state in RocksDB, which ``transformWithState`` needs; Spark's default cannot.

    A stream copies the settings when it starts, so the session has its own again afterwards.
    """
    before = spark.conf.get(STATE_STORE_KEY)
    if before.endswith("RocksDBStateStoreProvider"):
        yield
        return
    spark.conf.set(STATE_STORE_KEY, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE_KEY, before)


def drain_to_table(stream: DataFrame, path: str, checkpoint: str, keyed_state: bool = False) -> None:
    """Process everything available and append it to a parquet table, exactly once.

    ``keyed_state``: the stream keeps state per key and is started over the store that this needs.
    """
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    with keyed_state_store(stream.sparkSession) if keyed_state else contextlib.nullcontext():
        query = writer.start()
    query.awaitTermination()
