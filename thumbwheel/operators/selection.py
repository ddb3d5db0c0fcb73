"""Row filters and limits, all by explicit key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def head_examples(
    df: DataFrame,
    n: int | None,
    ordinal: str = "ordinal",
    strict: bool = False,
    dense: bool = False,
) -> DataFrame:
    """The first ``n`` examples in source order; ``None`` keeps all.

    Every task keeps its first ``n`` rows and only those meet. A caller who
    knows that the keys are 0, 1, 2, ... may say ``dense``: then a range predicate
    on the key reaches the file scan. ``strict`` raises when fewer than ``n`` exist.
    """
    if n is None:
        return df
    head = df.where(F.col(ordinal) < n) if dense else df.orderBy(ordinal).limit(n)
    if strict and head.select(ordinal).count() < n:
        raise ValueError(f"fewer than {n} examples")
    return head


def eval_sample(df: DataFrame, ordinal: str = "ordinal", n: int = 100) -> DataFrame:
    """The evaluation rows used during training."""
    return head_examples(df, n, ordinal)


def max_length_filter(
    df: DataFrame, tokens: Column, max_length: int = 2048, name: str = "input_ids"
) -> DataFrame:
    """Rows of at most ``max_length`` tokens, with their tokens as ``name``.

    A generator emits the row's tokens or nothing. A plain filter would be
    pushed below the projection that builds them and tokenize every text twice.
    """
    fitting = F.filter(F.array(tokens), lambda t: F.size(t) <= max_length)
    return df.withColumn(name, F.explode(fitting))


def drop_error_verdicts(df: DataFrame, winner: str = "winner") -> DataFrame:
    """Only decided comparisons; their keys stay."""
    return df.where(F.col(winner).isNotNull())


def report_top(
    df: DataFrame, ordinal: str = "ordinal", n: int = 5, first_batch_of: int | None = None
) -> DataFrame:
    """The first ``n`` report rows; ``first_batch_of`` limits the report to its first batch."""
    if first_batch_of is not None:
        df = df.where(F.col(ordinal) < first_batch_of)
    return df.orderBy(ordinal).limit(n)
