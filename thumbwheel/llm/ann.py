"""Nearest neighbours by cosine through a hierarchical k-means tree.

The tree is fitted on a bounded sample; every vector is put into the leaf it
descends to. A query visits leaves best bin first: a priority queue holds tree
nodes by the distance of their centre, the nearest node is opened next, and the
search ends after a number of leaves, or later if these hold too few candidates.
That number is calibrated: it grows until a set of calibration queries finds the
wanted share of the neighbours that a comparison with all vectors finds.

Vectors that occur many times are searched once: of equal candidates only the
``k + 1`` smallest ids can be among anyone's ``k`` nearest, and equal queries
share one search. Leaves and the queries that visit them are cut into blocks, so no
task holds a number of either that follows the data.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from thumbwheel.llm.store import Scratch
from thumbwheel.llm.words import map_batches


@dataclass(frozen=True)
class AnnConfig:
    k: int = 5
    sample: int = 20_000  # vectors the tree is fitted on, at most
    branching: int = 8
    leaf_sample: int = 48  # a node with at most so many sample vectors is a leaf
    rounds: int = 12  # of k-means
    block: int = 4096  # index rows in a block of a leaf, and queries that meet it at a time
    calibration: int = 256  # queries, at most
    recall: float = 0.96  # wanted of the calibration queries
    seed: int = 5


@dataclass
class Tree:
    """Nodes in creation order; node 0 is the root. A leaf has no children."""

    centres: list[np.ndarray] = field(default_factory=list)  # of a node's children
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)  # number of the leaf, -1 for inner nodes
    n_leaves: int = 0


def build_tree(points: np.ndarray, cfg: AnnConfig) -> Tree:
    """Split by spherical k-means until the sample vectors of a node fit into a leaf."""
    tree, rng = Tree(), np.random.default_rng(cfg.seed)

    def grow(own: np.ndarray) -> int:
        node = len(tree.children)
        tree.children.append([])
        tree.centres.append(np.zeros((0, points.shape[1])))
        tree.leaf.append(-1)
        parts, centres = _split(own, cfg, rng) if len(own) > cfg.leaf_sample else ([], None)
        if len(parts) < 2:
            tree.leaf[node] = tree.n_leaves
            tree.n_leaves += 1
            return node
        tree.centres[node] = centres
        tree.children[node] = [grow(p) for p in parts]
        return node

    grow(points)
    return tree


def _split(own: np.ndarray, cfg: AnnConfig, rng: np.random.Generator):
    distinct = np.unique(own, axis=0)
    if len(distinct) < 2:
        return [], None
    centres = distinct[rng.permutation(len(distinct))[: cfg.branching]]
    for _ in range(cfg.rounds):
        near = (own @ centres.T).argmax(axis=1)
        sums = np.stack([own[near == i].sum(axis=0) for i in range(len(centres))])
        norms = np.linalg.norm(sums, axis=1)
        centres = np.where(norms[:, None] > 0, sums / np.maximum(norms, 1e-12)[:, None], centres)
    near = (own @ centres.T).argmax(axis=1)
    used = [i for i in range(len(centres)) if (near == i).any()]
    return [own[near == i] for i in used], centres[used]


def leaf_of(tree: Tree, units: np.ndarray) -> np.ndarray:
    """The leaf every unit vector descends to."""
    out = np.zeros(len(units), np.int64)

    def descend(node: int, rows: np.ndarray) -> None:
        if not len(rows):
            return
        if tree.leaf[node] >= 0:
            out[rows] = tree.leaf[node]
            return
        near = (units[rows] @ tree.centres[node].T).argmax(axis=1)
        for i, child in enumerate(tree.children[node]):
            descend(child, rows[near == i])

    descend(0, np.arange(len(units)))
    return out


def leaves_in_order(
    tree: Tree, unit: np.ndarray, most: int | None = None, held: dict[int, int] | None = None, least: int = 0
) -> list[int]:
    """Leaves in best-bin-first order of one query: the first ``most``, and more until they hold ``least`` rows."""
    queue, found, rows = [(0.0, 0)], [], 0
    while queue and (most is None or len(found) < most or rows < least):
        _, node = heapq.heappop(queue)
        if tree.leaf[node] >= 0:
            found.append(tree.leaf[node])
            rows += held.get(tree.leaf[node], 0) if held else 0
            continue
        for away, child in zip(-(tree.centres[node] @ unit), tree.children[node]):
            heapq.heappush(queue, (float(away), child))
    return found


def usable(embedding: Column, dimension: int) -> Column:
    good = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (F.size(embedding) == dimension) & good & F.exists(embedding, lambda x: x != 0)


def _matrix(column: pa.Array | Iterable[bytes], dimension: int) -> np.ndarray:
    values = column.to_pylist() if isinstance(column, pa.Array) else list(column)
    return np.frombuffer(b"".join(values), np.float64).reshape(-1, dimension)


def _units(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)  # norms of huge components stay finite
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row; the order of the additions depends on the dimension only."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _nearest(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int):
    """Query number, id and score of the ``k`` nearest rows of every query, ties to smaller ids."""
    unit_rows, out = _units(rows), []
    for at in range(0, len(queries), 256):
        part = queries[at : at + 256]
        rough = _units(part) @ unit_rows.T
        for i in range(len(part)):
            near = np.arange(len(ids))
            if len(ids) > k:
                limit = np.partition(rough[i], len(ids) - k)[len(ids) - k]
                near = np.flatnonzero(rough[i] >= limit - 1e-12)
            score = _cosines(np.broadcast_to(part[i], (len(near), len(part[i]))), rows[near])
            best = np.lexsort((ids[near], -score))[:k]
            out.append((np.full(len(best), at + i), ids[near][best], score[best]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(c) for c in zip(*out))


def _prepared(rows: DataFrame, cfg: AnnConfig) -> tuple[DataFrame, int]:
    """``vec_id, vector`` (doubles as bytes, equal vectors equal) of the rows that take part."""
    known = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    sizes = known.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"))
    usual = sizes.orderBy(F.desc("n"), "d").limit(1).collect()
    dimension = usual[0]["d"] if usual else 1
    good = known.where(usable(F.col("embedding"), dimension)).select(F.col("vec_id").cast("long"), "embedding")

    def pack(batch: pa.RecordBatch):
        flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
        packed = [v.tobytes() for v in flat.reshape(-1, dimension)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["vec_id", "vector"])

    return map_batches(good, pack, "vec_id long, vector binary"), dimension


def search(
    spark: SparkSession, rows: DataFrame, is_query: Column, cfg: AnnConfig = AnnConfig()
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of every row for which ``is_query`` holds.

    Candidates are all rows but those with the query's own vec_id. Rows whose
    vec_id or vector is null, and vectors that are zero, hold null or non-finite
    components or have another length than most, take no part; nor do repeated
    rows count twice. Other columns are not read. Fewer than k candidates
    give as many results; an empty table gives none.
    """
    scratch = Scratch(spark, "ann")
    prepared, dimension = _prepared(rows.select("vec_id", "embedding"), cfg)
    all_rows = scratch.keep(prepared.distinct(), "rows")
    same = Window.partitionBy("vector").orderBy("vec_id")
    # Spark keeps the first k + 1 of a vector before the shuffle already.
    index = scratch.keep(
        all_rows.withColumn("n", F.row_number().over(same)).where(F.col("n") <= cfg.k + 1).drop("n"), "candidates"
    )
    queries = all_rows.where(is_query)
    classes = scratch.keep(queries.groupBy("vector").agg(F.min("vec_id").alias("class_id")), "classes")

    order = [F.xxhash64("vec_id"), F.col("vec_id")]
    sample = index.orderBy(*order).limit(cfg.sample).collect()  # bounded by cfg.sample
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample.sort(key=lambda r: r["vec_id"])
    tree = build_tree(_units(_matrix((bytes(r["vector"]) for r in sample), dimension)), cfg)

    def place(batch: pa.RecordBatch):
        leaves = leaf_of(tree, _units(_matrix(batch.column(1), dimension)))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves)], ["vec_id", "vector", "leaf"])

    placed = scratch.keep(map_batches(index, place, "vec_id long, vector binary, leaf long"), "index")
    visits = _calibrated(placed, classes, tree, dimension, cfg)
    # One row per leaf of the tree: its number is bounded by the sample.
    sizes = placed.groupBy("leaf").agg(F.count("*").alias("n"))
    held = {r["leaf"]: r["n"] for r in sizes.collect()}
    query_blocks = -(-max(classes.count(), 1) // cfg.block)

    def visit(batch: pa.RecordBatch):
        units = _units(_matrix(batch.column(1), dimension))
        # Among k + 1 rows at most one is the query itself.
        leaves = [leaves_in_order(tree, u, visits, held, cfg.k + 1) for u in units]
        rows_of = np.repeat(np.arange(len(units)), [len(x) for x in leaves])
        take = pa.array(rows_of)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(take), batch.column(1).take(take), pa.array(np.concatenate(leaves).astype(np.int64))],
            ["class_id", "vector", "leaf"],
        )

    blocks = F.broadcast(sizes.select("leaf", F.ceil(F.col("n") / F.lit(cfg.block)).cast("int").alias("n_blocks")))
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = (
        placed.join(blocks, "leaf")
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("n_blocks")).cast("int"))
        .withColumn("part", each(F.lit(query_blocks)))
    )
    right = (
        map_batches(classes.select("class_id", "vector").repartition("class_id"), visit, "class_id long, vector binary, leaf long")
        .join(blocks, "leaf")
        .withColumn("part", F.pmod(F.xxhash64("class_id", F.lit(cfg.seed)), F.lit(query_blocks)).cast("int"))
        .withColumn("block", each(F.col("n_blocks")))
    )

    def compare(candidates: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if candidates.empty or asking.empty:
            return pd.DataFrame({"class_id": [], "vec_id": [], "score": []})
        ids = candidates["vec_id"].to_numpy()
        who, near, score = _nearest(
            _matrix(asking["vector"], dimension), _matrix(candidates["vector"], dimension), ids, cfg.k + 1
        )
        return pd.DataFrame({"class_id": asking["class_id"].to_numpy()[who], "vec_id": near, "score": score})

    found = (
        left.select("leaf", "block", "part", "vec_id", "vector").groupBy("leaf", "block", "part")
        .cogroup(right.select("leaf", "block", "part", "class_id", "vector").groupBy("leaf", "block", "part"))
        .applyInPandas(compare, "class_id long, vec_id long, score double")
    )
    nearest = Window.partitionBy("class_id").orderBy(F.desc("score"), "vec_id")
    best = scratch.keep(
        found.withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= cfg.k + 1), "found"
    )
    asked = queries.join(classes, "vector").select(F.col("vec_id").alias("query_id"), "class_id")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asked.join(best, "class_id").where("query_id != vec_id")
        .withColumn("rank", F.row_number().over(own))
        .where(F.col("rank") <= cfg.k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _calibrated(placed: DataFrame, classes: DataFrame, tree: Tree, dimension: int, cfg: AnnConfig) -> int:
    """How many leaves to visit: the least number that reaches ``cfg.recall``.

    The calibration queries are compared with every vector, a batch at a time;
    each task sends its k nearest of each, so what meets is bounded by them.
    """
    if tree.n_leaves < 2:
        return 1
    chosen = classes.orderBy(F.xxhash64("class_id"), "class_id").limit(cfg.calibration).collect()
    if not chosen:
        return 1
    queries = _matrix((bytes(r["vector"]) for r in chosen), dimension)
    own = np.array([r["class_id"] for r in chosen])

    def nearest(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, leaves = (batch.column(i).to_numpy() for i in (0, 2))
            who, near, score = _nearest(queries, _matrix(batch.column(1), dimension), ids, cfg.k + 1)
            leaf = dict(zip(ids.tolist(), leaves.tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(who), pa.array(near), pa.array(score), pa.array([leaf[i] for i in near.tolist()], pa.int64())],
                ["query", "vec_id", "score", "leaf"],
            )

    first = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    truth = (
        placed.select("vec_id", "vector", "leaf")
        .mapInArrow(nearest, "query long, vec_id long, score double, leaf long")
        .withColumn("n", F.row_number().over(first)).where(F.col("n") <= cfg.k + 1)
        .collect()
    )
    needed = []
    order = [{leaf: i + 1 for i, leaf in enumerate(leaves_in_order(tree, u))} for u in _units(queries)]
    for q in range(len(queries)):
        mine = sorted((r["n"], r["leaf"]) for r in truth if r["query"] == q and r["vec_id"] != own[q])
        needed += [order[q][leaf] for _, leaf in mine[: cfg.k]]
    if not needed:
        return 1
    needed.sort()
    return int(needed[min(len(needed) - 1, int(np.ceil(cfg.recall * len(needed))) - 1)])
