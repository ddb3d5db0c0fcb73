"""Connected components by repeated star operations, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thumbwheel.llm.store import Scratch
from thumbwheel.operators.skew import lookup_join


def _is_stars(edges: DataFrame) -> bool:
    """Whether every edge joins a leaf that has no other edge to a centre that is no leaf."""
    roles = edges.select(F.col("a").alias("x"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).unionByName(
        edges.select(F.col("b").alias("x"), F.lit(0).alias("leaf"), F.lit(1).alias("centre"))
    )
    mixed = roles.groupBy("x").agg(F.sum("leaf").alias("leaf"), F.sum("centre").alias("centre")).where(
        (F.col("leaf") > 1) | ((F.col("leaf") > 0) & (F.col("centre") > 0))
    )
    return mixed.isEmpty()


def _smallest_neighbour(edges: DataFrame, key: str, value: str) -> DataFrame:
    """Every edge with the smallest end that its ``key`` meets; hubs are cut into pieces."""
    least = edges.groupBy(key).agg(F.min(value).alias("least"))
    return lookup_join(edges, least, [key], value).withColumn("least", F.least("least", key))


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``node, component`` (the smallest node reached) of every node with an edge ``a, b``.

    Large-star and small-star steps alternate until the edges are stars around
    the smallest nodes. Each round is written, so lineage stays short. Edges
    with a null end and loops are ignored.
    """
    ordered = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current, last, turn = scratch.keep(ordered, f"{name}-0"), f"{name}-0", 0
    while not _is_stars(current):
        turn += 1
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (
            _smallest_neighbour(both, "a", "b").where("b > a")
            .select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        )
        near = _smallest_neighbour(large, "a", "b")
        small = near.select(F.inline(F.array(F.struct("a", F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b")))))
        current = scratch.keep(small.where("a != b").distinct(), f"{name}-{turn}")
        scratch.drop(last)
        last = f"{name}-{turn}"
    return current.select(F.inline(F.array(
        F.struct(F.col("a").alias("node"), F.col("b").alias("component")),
        F.struct(F.col("b").alias("node"), F.col("b").alias("component")),
    ))).distinct()
