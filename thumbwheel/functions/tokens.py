"""Token-array functions. Arrays stay on their row: none of these needs a shuffle.

``slice``/``concat``/``array_repeat`` are preferred over lambdas where both work,
because they keep the projection inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INVALID_LOGPROB = 1.0  # fixed value: what masked positions hold

SEPARATORS = "[ \\t\\n\\r\\f\\x0B]+"
RESERVED_IDS = 2  # pad = 0 and end-of-sequence = 1 are never produced from words


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SEPARATORS), "")


def token_ids(text: Column) -> Column:
    """Whitespace words as stable ids: the word's checksum, no vocabulary to share."""
    span = 2**31 - 1 - RESERVED_IDS
    return F.transform(
        words(text), lambda w: (F.pmod(F.crc32(w), F.lit(span)) + RESERVED_IDS).cast("int")
    )


def token_count(text: Column) -> Column:
    """Length of ``token_ids`` without building the ids."""
    return F.size(words(text)).cast("long")


def keep_start(ids: Column, n: Column) -> Column:
    return F.slice(ids, F.lit(1), F.greatest(n, F.lit(0)))


def keep_end(ids: Column, n: Column) -> Column:
    size = F.size(ids)
    kept = F.least(size, F.greatest(n, F.lit(0)))
    return F.slice(ids, size - kept + 1, kept)


def truncate_pair(
    prompt: Column,
    completion: Column,
    max_prompt: int = 512,
    max_total: int = 2048,
    only_if_over: bool = False,
) -> tuple[Column, Column]:
    """Prompt end up to ``max_prompt``; completion start up to what is then left of ``max_total``.

    ``only_if_over`` leaves a long prompt alone while both together fit.
    """
    limit = F.lit(min(max_prompt, max_total))
    if only_if_over:
        fits = F.size(prompt) + F.size(completion) <= max_total
        limit = F.when(fits, F.size(prompt)).otherwise(limit)
    room = F.lit(max_total) - F.least(F.size(prompt), limit)
    return keep_end(prompt, limit), keep_start(completion, room)


def pad_to(ids: Column, width: Column, pad: int = 0, side: str = "right") -> Column:
    fill = F.array_repeat(F.lit(pad), F.greatest(width - F.size(ids), F.lit(0)).cast("int"))
    return F.concat(ids, fill) if side == "right" else F.concat(fill, ids)


def attention_mask(ids: Column, width: Column, side: str = "right") -> Column:
    ones = F.array_repeat(F.lit(1), F.size(ids))
    return pad_to(ones, width, 0, side)


def truncate_at_stop(ids: Column, stop: int | None, pad: int) -> Column:
    """Everything after the first stop token becomes pad; the stop token stays."""
    if stop is None:
        return ids
    at = F.array_position(ids, stop).cast("int")
    cut = F.concat(F.slice(ids, F.lit(1), at), F.array_repeat(F.lit(pad), F.size(ids) - at))
    return F.when(at > 0, cut).otherwise(ids)


def sequence_length(ids: Column, pad: int) -> Column:
    """Index of the last token before the first pad (-1 if the row starts with pad)."""
    at = F.array_position(ids, pad)
    return F.when(at > 0, at - 2).otherwise(F.size(ids) - 1).cast("int")


def mask_after(values: Column, last: Column, fill: float = INVALID_LOGPROB) -> Column:
    """Positions beyond ``last`` hold ``fill``."""
    n = F.least(last + 1, F.size(values))
    return F.concat(
        F.slice(values, F.lit(1), n), F.array_repeat(F.lit(fill), F.size(values) - n)
    )


def contains_token(ids: Column, token: int) -> Column:
    return F.array_contains(ids, token)


def count_token(ids: Column, token: int) -> Column:
    return (F.size(ids) - F.size(F.array_remove(ids, token))).cast("long")


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def argmax(values: Column) -> Column:
    """0-based index of the largest value; the first one wins a tie."""
    return F.array_position(values, F.array_max(values)) - 1
