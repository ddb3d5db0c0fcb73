"""Evaluation metrics and per-update training metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thumbwheel.functions import rollout as R
from thumbwheel.functions.tokens import argmax

SLOT = ("update_id", "ppo_epoch", "minibatch", "microbatch")


def accuracy(df: DataFrame, logits: Column, label: Column, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose largest logit is the label."""
    hit = (argmax(logits) == label).cast("double")
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def eval_samples(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("eval_samples"))


def label_balance(df: DataFrame, by: Sequence[str], label: str = "label") -> DataFrame:
    """Thumbs-up and thumbs-down counts per group."""
    return df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))


def pairwise_reward_eval(
    df: DataFrame, chosen: Column, rejected: Column, by: Sequence[str] = ()
) -> DataFrame:
    """Bradley-Terry loss, accuracy and mean margin of scored pairs."""
    margin = chosen - rejected
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((chosen > rejected).cast("double")).alias("accuracy"),
        F.avg(margin).alias("mean_margin"),
        F.avg(R.softplus(-margin)).alias("loss"),
    )


def pointwise_reward_eval(
    df: DataFrame, logits: Column, label: Column, by: Sequence[str] = ()
) -> DataFrame:
    """Cross-entropy, accuracy and confusion counts of a two-logit model."""
    down, up = F.get(logits, F.lit(0)), F.get(logits, F.lit(1))
    wrong_lead = F.when(label == 1, down - up).otherwise(up - down)
    predicted = argmax(logits)
    count = lambda p, y: F.count(F.when((predicted == p) & (label == y), 1))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(R.softplus(wrong_lead)).alias("cross_entropy"),
        F.avg((predicted == label).cast("double")).alias("accuracy"),
        count(1, 1).alias("true_good"),
        count(1, 0).alias("false_good"),
        count(0, 0).alias("true_bad"),
        count(0, 1).alias("false_bad"),
    )


def kto_objective(
    df: DataFrame,
    batch: str,
    beta: float = 0.1,
    desirable_weight: float = 1.0,
    undesirable_weight: float = 1.0,
) -> DataFrame:
    """Mean KTO loss per batch, and the mean log ratio of either label.

    Input rows: ``logp_sum``, ``ref_logp_sum``, ``label`` (1 up, 0 down) and the
    batch's reference point ``z`` (its mean KL, not below zero).
    """
    log_ratio = F.col("logp_sum") - F.col("ref_logp_sum")
    up = F.lit(desirable_weight) * (1 - R.sigmoid(F.lit(beta) * (log_ratio - F.col("z"))))
    down = F.lit(undesirable_weight) * (1 - R.sigmoid(F.lit(beta) * (F.col("z") - log_ratio)))
    return df.groupBy(batch).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.when(F.col("label") == 1, up).otherwise(down)).alias("loss"),
        F.avg(F.when(F.col("label") == 1, log_ratio)).alias("log_ratio_up"),
        F.avg(F.when(F.col("label") == 0, log_ratio)).alias("log_ratio_down"),
    )


# The metric names below, here and in ``update_metrics``.
#: Per-rollout values and the names of their means over an update.
OBJECTIVES = {
    "kl": "objective/kl",
    "objective_entropy": "objective/entropy",
    "non_score_reward": "objective/non_score_reward",
    "rlhf_reward": "objective/rlhf_reward",
    "reward_score": "objective/scores",
}


def _slot_means() -> list[Column]:
    """The five policy statistics of an optimisation slot.

    Entropy and ratio are means over tokens, masked positions included.
    """
    return [
        F.avg("loss").alias("policy_loss"),
        F.avg("is_clipped").alias("clipfrac"),
        (F.avg("log_ratio_sq") * 0.5).alias("approxkl"),
        F.try_divide(F.sum("entropy_sum"), F.sum("n_tokens")).alias("entropy"),
        F.try_divide(F.sum("token_ratio_sum"), F.sum("n_tokens")).alias("ratio"),
    ]


def _over_slots() -> list[Column]:
    """Plain means of slot means: slots weigh the same whatever their size."""
    return [
        F.avg("approxkl").alias("policy/approxkl_avg"),
        F.avg("clipfrac").alias("policy/clipfrac_avg"),
        F.avg("policy_loss").alias("loss/policy_avg"),
        F.avg("entropy").alias("policy/entropy_avg"),
        F.avg("ratio").alias("val/ratio"),
        F.var_samp("ratio").alias("val/ratio_var"),
    ]


def slot_stats(df: DataFrame) -> DataFrame:
    """Per update: means over slots, and the sample variance of the slot ratios."""
    slots = df.groupBy(*SLOT).agg(*_slot_means())
    return slots.groupBy("update_id").agg(*_over_slots(), F.count(F.lit(1)).alias("n_slots"))


def update_metrics(
    steps: DataFrame,
    batch_size: int,
    k: int,
    n_train: int,
    elapsed: Column,
    lr: Column | None = None,
) -> DataFrame:
    """One wide metric row per update, from one pass.

    ``steps`` has a row per rollout and epoch with ``step_number``, 0 for the rollout's
    first: objectives are means over those, so that every rollout counts once, policy
    statistics means over all steps of a slot. A rollout without steps is one row
    whose slot and ``step_number`` are NULL; it counts for the objectives only. Sums
    leave the slots, and an update adds up its few slots. ``elapsed`` (seconds
    since the start) and ``lr`` are constant within an update.
    """
    once = F.coalesce("step_number", F.lit(0)) == 0
    names = [*OBJECTIVES, "num_eos"]
    per_rollout = [
        f(F.when(once, F.col(c))).alias(f"__{kind}_{c}") for c in names for kind, f in (("sum", F.sum), ("n", F.count))
    ]
    slots = steps.groupBy(*SLOT).agg(
        *_slot_means(),
        *per_rollout,
        F.max(elapsed).alias("__elapsed"),
        F.max(lr if lr is not None else F.lit(None).cast("double")).alias("__lr"),
    )
    mean = lambda c: F.try_divide(F.sum(f"__sum_{c}"), F.sum(f"__n_{c}"))
    episode = F.col("update_id") * F.lit(batch_size)
    return (
        slots.groupBy("update_id")
        .agg(
            *(mean(c).alias(name) for c, name in OBJECTIVES.items()),
            F.sum("__sum_num_eos").alias("val/num_eos_tokens"),
            F.max("__elapsed").alias("__elapsed"),
            F.max("__lr").alias("lr"),
            *_over_slots(),
            F.count("ppo_epoch").alias("__slots"),
        )
        .where("__slots > 0")
        .withColumn("val/clipfrac_avg", F.lit(0.0))
        .withColumn("episode", episode)
        .withColumn("eps", F.floor(F.try_divide(episode, F.col("__elapsed"))).cast("long"))
        .withColumn("epoch", episode / F.lit(float(k * n_train)))
        .drop("__elapsed", "__slots")
    )
