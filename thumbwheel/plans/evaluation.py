"""Completions and judged evaluation: against reference texts and model against model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thumbwheel.operators.inference import TextFactory, batch_generate, batch_judge
from thumbwheel.operators.judging import (
    flip_order,
    unflip_winner,
    win_rate_1v1,
    win_rate_vs_reference,
)
from thumbwheel.operators.pairing import attach_prompts, pair_reference_candidate, tournament
from thumbwheel.operators.selection import head_examples


def generate_completions(
    examples: DataFrame, generate: TextFactory, model: str, n: int | None = None
) -> DataFrame:
    """One model's completions of the first ``n`` prompts, ready to be written."""
    prompts = head_examples(examples.select("ordinal", "prompt"), n)
    done = batch_generate(prompts, generate)
    return done.select("ordinal", F.lit(model).alias("model"), "text")


def judge_against_reference(
    examples: DataFrame, completions: DataFrame, judge: TextFactory
) -> DataFrame:
    """Win rate of every model in ``completions`` against the examples' references."""
    references = examples.select("ordinal", F.col("reference").alias("text"))
    pairs = pair_reference_candidate(references, completions)
    judged = batch_judge(attach_prompts(pairs, examples), judge)
    return win_rate_vs_reference(judged)


def judge_matches(
    prompts: DataFrame,
    completions: DataFrame,
    matches: Sequence[tuple[str, str]],
    judge: TextFactory,
    flip_seed: int | None = None,
) -> DataFrame:
    """Win rates of listed model pairs; ``flip_seed`` swaps answers to offset position bias."""
    asked = attach_prompts(tournament(completions, matches), prompts)
    if flip_seed is not None:
        asked = flip_order(asked, ("ordinal", "model_a", "model_b"), flip_seed)
    judged = batch_judge(asked, judge)
    if flip_seed is not None:
        judged = judged.withColumn("winner", unflip_winner(F.col("winner"), F.col("flipped")))
    return win_rate_1v1(judged)
