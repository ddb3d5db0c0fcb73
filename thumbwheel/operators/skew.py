"""Equi-joins and group statistics that survive a key holding a large share of the rows.

Every key is cut into pieces by a hash of the row's own key, whatever its size:
a key meets the dimension once per piece that has rows, so a small key costs at
most as many pieces as it has rows and a large one is spread over all of them.
Nothing is counted first and no threshold changes the plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thumbwheel.session import scratch_path

_PIECE = "__piece"


def key_pieces(df: DataFrame) -> int:
    """As many pieces as shuffle partitions: a key with any share of the rows can keep all tasks busy."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _join_on(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, null_safe: bool
) -> DataFrame:
    """Equi-join keeping the left keys; ``null_safe`` lets a NULL key match a NULL key."""
    if not null_safe:
        return left.join(right, list(keys), how)
    renamed = {k: f"__r_{k}" for k in keys}
    right = right.withColumnsRenamed(renamed)
    matches = [left[k].eqNullSafe(right[r]) for k, r in renamed.items()]
    return left.join(right, matches, how).drop(*renamed.values())


def lookup_join(
    rows: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    row_key: str,
    how: str = "inner",
    pieces: int | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Join many ``rows`` to one ``dimension`` row per key (``how``: inner or left)."""
    n = pieces or key_pieces(rows)
    spread = rows.withColumn(_PIECE, F.pmod(F.xxhash64(row_key), F.lit(n)).cast("int"))
    occupied = spread.select(*keys, _PIECE).distinct()
    placed = _join_on(occupied, dimension, keys, "inner", null_safe)
    return _join_on(spread, placed, [*keys, _PIECE], how, null_safe).drop(_PIECE)


def attach_group_sums(
    df: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, Column],
    row_key: str,
    pieces: int | None = None,
) -> DataFrame:
    """Each row with sums over its whole group; NULL keys form a group, as in ``groupBy``.

    The rows (scalars, as a rule) are written to the work folder once, so that what
    made them runs once. Sums of the pieces leave the tasks that read them, the
    few sums of a group are added up and sent back to its pieces, and the rows
    meet them there.
    """
    path = scratch_path(df.sparkSession, "group-rows")
    n = pieces or key_pieces(df)
    df.withColumn(_PIECE, F.pmod(F.xxhash64(row_key), F.lit(n)).cast("int")).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    parts = rows.groupBy(*keys, _PIECE).agg(*(F.sum(c).alias(name) for name, c in sums.items()))
    groups = parts.groupBy(*keys).agg(*(F.sum(name).alias(name) for name in sums))
    placed = _join_on(parts.select(*keys, _PIECE), groups, keys, "inner", True)
    return _join_on(rows, placed, [*keys, _PIECE], "inner", True).drop(_PIECE)
