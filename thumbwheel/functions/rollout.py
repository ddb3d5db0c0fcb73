"""Reward and policy-loss arithmetic on one rollout row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from thumbwheel.functions.tokens import array_sum, argmax


def sequence_kl(logp: Column, ref_logp: Column) -> Column:
    """Sum of log-probability differences; equal fills on both sides cancel."""
    return array_sum(F.zip_with(logp, ref_logp, lambda p, r: p - r))


def penalise_missing_eos(score: Column, has_eos: Column, penalty: float | None) -> Column:
    """Lower every logit of a response that never ends.

    All logits move together, so a 0/1 score by argmax cannot change; a scalar
    reward does.
    """
    if penalty is None:
        return score
    return F.when(has_eos, score).otherwise(F.transform(score, lambda x: x - F.lit(penalty)))


def thumbs_score(score: Column) -> Column:
    return argmax(score).cast("double")


def leave_one_out(reward: Column, total: Column, n: Column) -> Column:
    """Reward minus the mean of the other samples; NULL for a lone sample."""
    return reward - F.try_divide(total - reward, n - 1)


def at_most(n: Column, k: int) -> Column:
    """``n``, or an error where a slot holds more than its ``k`` samples (a sample logged twice)."""
    message = F.concat(F.lit(f"a slot of {k} has samples: "), n.cast("string"))
    return F.when(n > k, F.raise_error(message).cast("int")).otherwise(n)


def sequence_ratio(new_sum: Column, old_sum: Column) -> Column:
    return F.exp(new_sum - old_sum)


def token_ratio_sum(new_logp: Column, old_logp: Column) -> Column:
    """Sum of per-token ratios, masked positions (ratio 1) included."""
    return array_sum(F.zip_with(new_logp, old_logp, lambda n, o: F.exp(n - o)))


def clipped_losses(advantage: Column, ratio: Column, cliprange: float) -> tuple[Column, Column]:
    """Unclipped and clipped policy loss of one rollout."""
    clipped = F.least(F.greatest(ratio, F.lit(1.0 - cliprange)), F.lit(1.0 + cliprange))
    return -advantage * ratio, -advantage * clipped


def softplus(x: Column) -> Column:
    """log(1 + exp(x)) without overflow."""
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))
