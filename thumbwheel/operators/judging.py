"""From judge texts to win rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thumbwheel.functions.text import cut_at_stop, parse_verdict, seeded_bit, verdict_winner


def read_verdicts(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Add ``verdict`` and ``winner``; undecided rows stay, with a NULL winner."""
    return df.withColumn("verdict", parse_verdict(cut_at_stop(F.col(raw)))).withColumn(
        "winner", verdict_winner(F.col("verdict"))
    )


def flip_order(df: DataFrame, keys: str | Sequence[str], seed: int) -> DataFrame:
    """Swap the answers of about half the rows, by a seeded coin on the keys.

    Keys that tell matches apart give every match of a prompt its own coin.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    flip = seeded_bit(F.concat_ws(":", *names), seed)
    return (
        df.withColumn("flipped", flip)
        .withColumn("__a", F.when(F.col("flipped"), F.col("answer_b")).otherwise(F.col("answer_a")))
        .withColumn(
            "answer_b", F.when(F.col("flipped"), F.col("answer_a")).otherwise(F.col("answer_b"))
        )
        .withColumn("answer_a", F.col("__a"))
        .drop("__a")
    )


def unflip_winner(winner: Column, flipped: Column) -> Column:
    """The winner in the original order."""
    return F.when(flipped, 1 - winner).otherwise(winner)


def win_rate_vs_reference(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Share of decided comparisons won by the candidate (answer B); NULL if none is decided."""
    return (
        df.groupBy(*by)
        .agg(
            F.count("winner").alias("decided"),
            F.count(F.when(F.col("winner") == 1, 1)).alias("wins"),
        )
        .withColumn("win_rate", F.try_divide(F.col("wins").cast("double"), F.col("decided")))
        .withColumn("win_rate_percent", F.col("win_rate") * 100)
    )


def win_rate_1v1(df: DataFrame, by: Sequence[str] = ("model_a", "model_b")) -> DataFrame:
    """Both models' percentages of the decided comparisons; they add up to 100."""
    return (
        df.groupBy(*by)
        .agg(
            F.count("winner").alias("decided"),
            F.count(F.when(F.col("winner") == 1, 1)).alias("b_wins"),
        )
        .withColumn("rate_b", F.try_divide(F.col("b_wins") * 100.0, F.col("decided")))
        .withColumn("rate_a", 100.0 - F.col("rate_b"))
        .drop("b_wins")
    )


def verdict_distribution(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts of A, B, C and unparsed verdicts, and the share of unparsed ones."""
    of = lambda v: F.count(F.when(F.col("verdict") == v, 1))
    return (
        df.groupBy(*by)
        .agg(
            of("A").alias("n_a"),
            of("B").alias("n_b"),
            of("C").alias("n_tie"),
            of("error").alias("n_error"),
            F.count(F.lit(1)).alias("n"),
        )
        .withColumn("error_rate", F.try_divide(F.col("n_error").cast("double"), F.col("n")))
    )
