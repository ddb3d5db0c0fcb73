"""The reference point of the KTO objective: the KL of prompts with completions that are not theirs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thumbwheel.operators.ordering import previous_in_group
from thumbwheel.operators.skew import lookup_join


def mismatched_pairs(
    spark: SparkSession, df: DataFrame, batch: str, key: str, prompt: str, completion: str
) -> DataFrame:
    """``batch, key, other, prompt, completion``: each prompt with the completion before its own.

    The completions of a batch, in the order of the unique ``key``, move on by one and
    the last one comes to the front; a batch of one row keeps its own. Only keys are
    put in order; prompts and completions then meet by key, each sent once.
    """
    moved = previous_in_group(spark, df, batch, key).withColumnRenamed("previous", "other")
    prompts = df.select(key, prompt)
    completions = df.select(F.col(key).alias("other"), completion)
    return moved.join(prompts, key).join(completions, "other").select(batch, key, "other", prompt, completion)


def kto_reference_point(
    spark: SparkSession,
    df: DataFrame,
    batch: str,
    key: str,
    prompt: str,
    completion: str,
    score: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """``batch, n, z``: the mean log ratio of a batch's mismatched pairs, not below zero.

    ``score`` adds ``logp_sum`` and ``ref_logp_sum`` to rows with a prompt and a completion: the
    policy's and the reference's log-probability of that completion for that prompt.
    """
    scored = score(mismatched_pairs(spark, df, batch, key, prompt, completion))
    ratio = F.col("logp_sum") - F.col("ref_logp_sum")
    return scored.groupBy(batch).agg(
        F.count(F.lit(1)).alias("n"), F.greatest(F.avg(ratio), F.lit(0.0)).alias("z")
    )


def with_reference_point(df: DataFrame, points: DataFrame, batch: str, key: str) -> DataFrame:
    """The rows of ``df`` with their batch's ``z``; a batch of any size is spread over tasks."""
    return lookup_join(df, points.select(batch, "z"), [batch], key)
