"""Unpaired datasets from preference pairs: one narrow stage each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thumbwheel.functions.text import render_chat
from thumbwheel.functions.tokens import truncate_pair
from thumbwheel.operators.ordering import pack_sequences, pad_batch
from thumbwheel.operators.reshape import (
    drop_columns,
    keep_assistant,
    pairs_to_unpaired,
    prompt_to_chat,
    repeat_prompts,
)
from thumbwheel.operators.skew import lookup_join
from thumbwheel.operators.selection import max_length_filter


def build_unpaired(
    pairs: DataFrame,
    label_type: str = "int",
    chat_prompt: bool = False,
    assistant_only: bool = False,
) -> DataFrame:
    df = drop_columns(pairs)
    if chat_prompt:
        df = prompt_to_chat(df)
    df = pairs_to_unpaired(df, label_type)
    return keep_assistant(df) if assistant_only else df


def build_kto_dataset(pairs: DataFrame) -> DataFrame:
    """Chat prompt, assistant messages only, boolean label."""
    return build_unpaired(pairs, "bool", chat_prompt=True, assistant_only=True)


def build_unpaired_dataset(pairs: DataFrame) -> DataFrame:
    """Chat prompt, whole completion, integer label."""
    return build_unpaired(pairs, "int", chat_prompt=True)


def reward_training_rows(
    unpaired: DataFrame,
    render: Column,
    tokenize: Callable[[Column], Column],
    max_length: int = 2048,
) -> DataFrame:
    """Rendered completions as token ids of bounded length with their labels."""
    keys = [c for c in unpaired.columns if c not in ("prompt", "completion")]
    rendered = unpaired.select(*keys, render.alias("text"))
    return max_length_filter(rendered, tokenize(F.col("text")), max_length).drop("text")


def rloo_prompts(
    prompts: DataFrame, tokenize: Callable[[Column], Column], k: int, batch_size: int, pad: int = 0
) -> DataFrame:
    """Prompts ready for sampling: ids only, left-padded within their batch, each ``k`` times."""
    ids = prompts.select("ordinal", tokenize(F.col("prompt")).alias("input_ids"))
    return repeat_prompts(pad_batch(ids, "input_ids", "ordinal", batch_size, pad, side="left"), k)


def sft_spans(
    spark: SparkSession, turns: DataFrame, tokenize: Callable[[Column], Column], block: int = 2048
) -> DataFrame:
    """Whole conversations rendered, tokenized and packed: token ranges of turns in blocks.

    A conversation is its turn rows in order, however long; each turn is
    rendered on its own and an end token follows a conversation's last turn.
    """
    one = render_chat(F.array(F.struct("role", F.col("text").alias("content"))))
    sized = turns.select("conv_id", "turn", F.size(tokenize(one)).cast("long").alias("n"))
    last = sized.groupBy("conv_id").agg(F.max("turn").alias("last_turn"))
    ended = lookup_join(sized, last, ["conv_id"], "turn")
    n = F.col("n") + (F.col("turn") == F.col("last_turn")).cast("long")
    return pack_sequences(spark, ended, ["conv_id", "turn"], n, block, separator=0)


def kto_training_rows(
    pairs: DataFrame, tokenize: Callable[[Column], Column], max_prompt: int = 512, max_length: int = 2048
) -> DataFrame:
    """Tokenized KTO rows: prompt and completion rendered and cut to the length limits."""
    rows = build_kto_dataset(pairs)
    ids = rows.select(
        "example_id", "branch", "split", "label",
        tokenize(render_chat(F.col("prompt"))).alias("__p"),
        tokenize(render_chat(F.col("completion"))).alias("__c"),
    )
    prompt, completion = truncate_pair(F.col("__p"), F.col("__c"), max_prompt, max_length)
    return ids.select(
        "example_id", "branch", "split", "label", prompt.alias("prompt_ids"), completion.alias("completion_ids")
    )
