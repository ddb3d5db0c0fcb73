"""Bringing prompts and completions of several models together by ordinal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_reference_candidate(references: DataFrame, candidates: DataFrame) -> DataFrame:
    """Reference text as answer A, the candidate's as answer B; ordinals in both only.

    Other columns of the candidates (their model) are kept.
    """
    a = references.select("ordinal", F.col("text").alias("answer_a"))
    b = candidates.withColumnRenamed("text", "answer_b")
    return a.join(b, "ordinal")


def pair_two_models(completions: DataFrame, model_0: str, model_1: str) -> DataFrame:
    """Model 0 as answer A against model 1 as answer B."""
    side = lambda m: completions.where(F.col("model") == m).select("ordinal", "text")
    return pair_reference_candidate(side(model_0), side(model_1))


def attach_prompts(pairs: DataFrame, prompts: DataFrame) -> DataFrame:
    return prompts.select("ordinal", "prompt").join(pairs, "ordinal")


def unmatched_counts(left: DataFrame, right: DataFrame, key: str = "ordinal") -> DataFrame:
    """How many keys an inner join of both sides keeps and loses."""
    tagged = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    seen = tagged.groupBy(key).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return seen.agg(
        F.sum(F.col("l") * F.col("r")).alias("matched"),
        F.sum(F.col("l") * (1 - F.col("r"))).alias("left_only"),
        F.sum((1 - F.col("l")) * F.col("r")).alias("right_only"),
    )


def round_robin(models: Sequence[str]) -> list[tuple[str, str]]:
    """The usual list of matches: every model against every later one by name."""
    names = sorted(set(models))
    return [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]


def tournament(completions: DataFrame, matches: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per ordinal, listed match and pair of answers of both models.

    One aggregation puts an ordinal's answers side by side as lists; the
    matches are then read off that row. The completions are read and shuffled
    once for any number of matches, and nothing is joined to itself. A model
    with several answers plays with each, and a NULL answer is an answer.
    """
    models = sorted({m for match in matches for m in match})
    slot = {m: f"__m{i}" for i, m in enumerate(models)}
    answers = lambda m: F.collect_list(F.when(F.col("model") == m, F.struct("text"))).alias(slot[m])
    wide = (
        completions.where(F.col("model").isin(models))
        .groupBy("ordinal")
        .agg(*(answers(m) for m in models))
    )
    rows = [
        F.struct(
            F.lit(a).alias("model_a"),
            F.lit(b).alias("model_b"),
            F.col(slot[a]).alias("__a"),
            F.col(slot[b]).alias("__b"),
        )
        for a, b in matches
    ]
    played = wide.select("ordinal", F.inline(F.array(*rows)))
    return (
        played.select("ordinal", "model_a", "model_b", "__b", F.explode("__a").alias("__a"))
        .select("ordinal", "model_a", "model_b", "__a", F.explode("__b").alias("__b"))
        .select(
            "ordinal", "model_a", "model_b",
            F.col("__a.text").alias("answer_a"), F.col("__b.text").alias("answer_b"),
        )
    )
