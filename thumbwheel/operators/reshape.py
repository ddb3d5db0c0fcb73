"""Reshaping of preference pairs and conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thumbwheel.functions.text import strip
from thumbwheel.schemas import require_columns

# The columns an unpaired dataset leaves out.
UNUSED_COLUMNS = ("prompt_id", "messages", "score_chosen", "score_rejected")


def drop_columns(df: DataFrame, names: tuple[str, ...] = UNUSED_COLUMNS) -> DataFrame:
    """Drop columns that must exist; plain ``drop`` would ignore a misspelt one."""
    require_columns(df, *names)
    return df.drop(*names)


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def prompt_to_chat(df: DataFrame, column: str = "prompt") -> DataFrame:
    """A prompt string as a one-message conversation."""
    return df.withColumn(column, F.array(message("user", F.col(column))))


def pairs_to_unpaired(
    df: DataFrame,
    label_type: str = "int",
    chosen: str = "chosen",
    rejected: str = "rejected",
) -> DataFrame:
    """Two labelled rows per pair, chosen first: one scan, no shuffle.

    ``branch`` (0 chosen, 1 rejected) with the pair's key gives the source order.
    """
    if label_type not in ("int", "bool"):
        raise ValueError("label_type must be 'int' or 'bool'")
    require_columns(df, chosen, rejected)
    spark_type = {"int": "int", "bool": "boolean"}[label_type]

    def branch(i: int, column: str) -> Column:
        return F.struct(
            F.lit(i).alias("branch"),
            F.col(column).alias("completion"),
            F.lit(1 - i).cast(spark_type).alias("label"),
        )

    kept = [c for c in df.columns if c not in (chosen, rejected)]
    return df.select(*kept, F.inline(F.array(branch(0, chosen), branch(1, rejected))))


def keep_assistant(df: DataFrame, column: str = "completion") -> DataFrame:
    """Only assistant messages, in order; the list may become empty."""
    return df.withColumn(column, F.filter(column, lambda m: m["role"] == "assistant"))


def assistant_turns(df: DataFrame, role: str = "role") -> DataFrame:
    """The assistant's turns of whole conversations, one row each: a filter, no shuffle."""
    return df.where(F.col(role) == "assistant")


def reference_text(messages: Column) -> Column:
    """The stripped text of the second message; NULL when there is none."""
    return strip(F.get(messages, F.lit(1))["content"])


def repeat_prompts(df: DataFrame, k: int) -> DataFrame:
    """Each prompt ``k`` times, told apart by ``sample_idx``."""
    if k < 1:
        raise ValueError("k must be at least 1")
    return df.withColumn("sample_idx", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))


def assemble_messages(
    df: DataFrame,
    conversation: str,
    turn: str,
    role: str,
    text: str,
    turns_per_row: int,
) -> DataFrame:
    """Windows of every conversation as ordered message arrays.

    Each row holds the turns of one ``segment``: turns 0 to ``turns_per_row`` - 1,
    the next as many, and so on, for short and long conversations alike. The
    segments of a conversation joined in order are the conversation. Whole
    conversations of any length are the turn rows themselves (``assistant_turns``).
    """
    ordered = F.array_sort(F.collect_list(F.struct(turn, role, text)))
    return (
        df.withColumn("segment", F.floor(F.col(turn) / F.lit(turns_per_row)).cast("long"))
        .groupBy(conversation, "segment")
        .agg(ordered.alias("messages"))
        .withColumn(
            "messages",
            F.transform(
                "messages", lambda m: F.struct(m[role].alias("role"), m[text].alias("content"))
            ),
        )
    )


def messages_text(messages: Column, between: str = "|") -> Column:
    """Messages as ``role=content`` parts, for reports and comparisons."""
    return F.array_join(
        F.transform(messages, lambda m: F.concat(m["role"], F.lit("="), m["content"])), between
    )


def neighbouring_replies(
    df: DataFrame, conversation: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text",
) -> DataFrame:
    """Preference pairs from logged conversations.

    A user turn answered by the assistant, whose next exchange is also
    user-then-assistant: the first reply is ``chosen``, the later one
    ``rejected``. Each turn is sent to the exchanges it belongs to and the
    parts meet by (conversation, turn), so a long conversation is spread over
    tasks; a window over the conversation would keep it in one.
    """
    user, assistant = F.col(role) == "user", F.col(role) == "assistant"

    def part(back: int, slot: str) -> Column:
        return F.struct((F.col(turn) - back).alias("at"), F.lit(slot).alias("slot"))

    parts = F.when(user, F.array(part(0, "prompt"), part(2, "next_user"))).when(
        assistant, F.array(part(1, "chosen"), part(3, "rejected"))
    )
    sent = df.select(conversation, text, F.inline(parts)).where(F.col("at") >= 0)

    def pick(slot: str) -> Column:
        return F.max(F.when(F.col("slot") == slot, F.col(text)))

    return (
        sent.withColumn(text, F.when(F.col("slot") == "next_user", "").otherwise(F.col(text)))
        .groupBy(conversation, F.col("at").alias(turn))
        .agg(*(pick(s).alias(s) for s in ("prompt", "chosen", "next_user", "rejected")))
        .where(
            F.col("prompt").isNotNull()
            & F.col("chosen").isNotNull()
            & F.col("next_user").isNotNull()
            & F.col("rejected").isNotNull()
        )
        .drop("next_user")
    )
