"""Whitening of embeddings by the covariance of their distinct vectors, weighted by multiplicity.

Vectors are put on an integer grid and equal ones are grouped, so a vector that
holds a third of the table is one row from then on. Tasks add up exact sums and
then a centred, weighted Gram matrix of their distinct vectors; only those
matrices (dimensions squared, whatever the number of rows) are shuffled and meet
on the driver for the eigenvectors. Every distinct vector is whitened once and
goes back to its rows by a 128-bit key of the vector.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thumbwheel.llm.store import Scratch

KEY = ["key_a", "key_b"]
#: Cells of one block of vectors that a task works on at a time.
CELLS = 1 << 22
SAFE = 1 << 62


@dataclass(frozen=True)
class WhitenConfig:
    components: int = 32
    scale: int = 64  # grid cells per unit
    offset: int = 1_000_000
    weights: str = "count"  # a distinct vector's weight in the fit: its "count", or "one"

    def __post_init__(self) -> None:
        if self.weights not in ("count", "one"):
            raise ValueError(f"weights are 'count' or 'one', not {self.weights!r}")


def on_grid(vector: Column, cfg: WhitenConfig) -> Column:
    """The vector as whole numbers; NULL if it, or an entry, is null or not finite.

    Entries beyond 2 ** 62 in absolute value, which no long could hold, stay there.
    """
    edge = float(SAFE)
    scaled = lambda c: F.least(F.greatest(c.cast("double") * cfg.scale, F.lit(-edge)), F.lit(edge))
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == F.lit(float("inf")))
    grid = F.transform(vector, lambda c: F.floor(scaled(c)).cast("long") + F.lit(cfg.offset).cast("long"))
    return F.when(vector.isNotNull() & ~F.exists(vector, odd), grid)


def vector_keys(x: Column) -> list[Column]:
    """128 bits of a vector."""
    return [F.xxhash64(x).alias(KEY[0]), F.xxhash64(F.lit(7), x).alias(KEY[1])]


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch]]:
    """Vectors (a row each), weights and the batch they come from; ``x`` and ``weight`` are its first columns."""
    for batch in batches:
        if not batch.num_rows:
            continue
        d = len(batch.column(0)[0])
        for at in range(0, batch.num_rows, max(1, CELLS // max(d, 1))):
            part = batch.slice(at, max(1, CELLS // max(d, 1)))
            yield part.column(0).flatten().to_numpy().reshape(part.num_rows, d), part.column(1).to_numpy(), part


def exact(x: np.ndarray, bound: int) -> np.ndarray:
    """``x`` in a type that holds whole numbers up to ``bound``."""
    return x.astype(np.int64) if bound < SAFE else x.astype(object)


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0


def weighted_sums(df: DataFrame) -> tuple[int, list]:
    """Total weight and, per dimension, the weighted sum of the column ``x``; exact for whole numbers."""
    whole = df.schema["x"].dataType.elementType.typeName() == "long"
    kind = "decimal(38,0)" if whole else "double"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for x, w, _ in _blocks(batches):
            bound = _largest(x) * int(w.sum()) if whole else 0
            sums = exact(w, bound) @ exact(x, bound) if whole else w @ x
            n, total = n + int(w.sum()), (0 if total is None else total) + sums.astype(object if whole else float)
        if total is not None:
            sums = pa.array([int(s) for s in total], pa.decimal128(38, 0)) if whole else pa.array(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()), sums], ["i", "n", "s"]
            )

    parts = df.select("x", "weight").mapInArrow(add, f"i int, n long, s {kind}")
    # One row per dimension.
    rows = sorted(parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())
    return (int(rows[0]["n"]) if rows else 0), [int(r["s"]) if whole else float(r["s"]) for r in rows]


def centred(x: np.ndarray, n: int, sums: list) -> np.ndarray:
    """``x - sums / n``; whole numbers are first moved by the whole part of the mean."""
    if x.dtype != np.int64:
        return x - np.array(sums) / n
    whole = [s // n for s in sums]
    rest = np.array([(s - q * n) / n for s, q in zip(sums, whole)])
    bound = _largest(x) + max(map(abs, whole), default=0)
    return (exact(x, bound) - np.array(whole, object if bound >= SAFE else np.int64)).astype(float) - rest


def covariance(df: DataFrame, n: int, sums: list) -> np.ndarray:
    """Covariance of ``x`` by ``weight``, centred before multiplying, divided by the total weight."""
    d = len(sums)

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x, w, _ in _blocks(batches):
            z = centred(x, n, sums)
            total = (0 if total is None else total) + (z * w[:, None].astype(float)).T @ z
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(d), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"]
            )

    parts = df.select("x", "weight").mapInArrow(gram, "i int, row array<double>")
    cells = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    # Dimensions squared, the size of the model itself.
    found = cells.toPandas()
    out = np.zeros((d, d))
    out[found.i.to_numpy(), found.j.to_numpy()] = found.v.to_numpy() / n
    return (out + out.T) / 2


def principal_components(cov: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    Every eigenvector's largest entry is positive. Eigenvalues that are zero to
    double precision are given as exactly zero.
    """
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    top = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.sign(vectors[top, np.arange(vectors.shape[1])])
    noise = len(cov) * np.finfo(float).eps * max(float(values[0]), 0.0)
    return np.where(values > noise, values, 0.0), vectors


def _deviations(x: np.ndarray, n: int, sums: list) -> pa.Array:
    """Sum over dimensions of (n * x - sums) ** 2; NULL beyond 38 digits."""
    reach = n * _largest(x) + max(map(abs, sums), default=0)
    shifted = exact(x, reach) * n - np.array(sums, object if reach >= SAFE else np.int64)
    bound = _largest(shifted) ** 2 * x.shape[1]
    squares = (exact(shifted, bound) ** 2).sum(axis=1)
    if bound < SAFE:
        return pa.array(squares, pa.int64()).cast(pa.decimal128(38, 0))
    return pa.array([int(s) if s < 10**38 else None for s in squares], pa.decimal128(38, 0))


def whiten_distinct(
    fit: DataFrame, by: list[str], n: int, sums: list, values: np.ndarray, vectors: np.ndarray
) -> DataFrame:
    """Every distinct vector once: the columns ``by``, ``weight``, ``deviation`` and ``x``, the whitened vector."""
    scales = np.divide(1.0, np.sqrt(values), out=np.zeros_like(values), where=values > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, _, part in _blocks(batches):
            y = (centred(x, n, sums) @ vectors) * scales
            offsets = pa.array(np.arange(0, y.size + 1, y.shape[1]), pa.int32())
            white = pa.ListArray.from_arrays(offsets, pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[2:], part.column(1), _deviations(x, n, sums), white], [*by, "weight", "deviation", "x"]
            )

    kinds = "".join(f"{c} {fit.schema[c].dataType.simpleString()}, " for c in by)
    return fit.select("x", "weight", *by).mapInArrow(
        run, f"{kinds}weight long, deviation decimal(38,0), x array<double>"
    )


def whiten(
    spark: SparkSession,
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    cfg: WhitenConfig = WhitenConfig(),
    keys: Callable[[Column], list[Column]] = vector_keys,
) -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error``: a row per row and component.

    Rows whose vector is null, or holds a null or an entry that is not finite,
    take no part. The vectors' length is the most frequent one of the rest (of
    equally frequent ones the largest); rows of another length take no part
    either, and of length zero neither. Repeated rows and rows with a null or repeated key are rows like any
    other. A component without variance has ``whitened`` NULL and an
    ``explained`` of 0 (NULL if no component has any); ``identity_error`` is over
    the others and NULL if there are none. An empty table gives no rows. Other
    columns are not read. Time grows with rows times dimensions squared, memory
    of a task with dimensions squared and a block of 4 million entries.
    """
    scratch = Scratch(spark, "whitening")
    placed = rows.select(F.col(key).alias("__id"), on_grid(F.col(vector), cfg).alias("x")).where("x is not null")
    every = scratch.keep(
        placed.groupBy("x").agg(F.count("*").alias("weight")).select("x", "weight", *keys(F.col("x"))), "distinct"
    )
    lengths = every.where(F.size("x") > 0).groupBy(F.size("x").alias("d")).agg(F.sum("weight").alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    names = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    if usual is None:
        none = placed.where("false").select(F.col("__id").alias(key))
        kinds = ["int", "long", "decimal(38,0)", "double", "double", "double"]
        return none.select(key, *(F.lit(None).cast(k).alias(c) for c, k in zip(names, kinds)))

    distinct = every.where(F.size("x") == usual["d"])
    fit = distinct if cfg.weights == "count" else distinct.withColumn("weight", F.lit(1).cast("long"))
    n, sums = weighted_sums(fit)
    cov = covariance(fit, n, sums)
    values, vectors = principal_components(cov, cfg.components)
    # Two vectors with one key would be told apart by the vectors themselves.
    unique = every.groupBy(*KEY).agg(F.count("*").alias("c")).where("c > 1").isEmpty()
    by = KEY if unique else ["v"]
    white = scratch.keep(whiten_distinct(fit.withColumn("v", F.col("x")), by, n, sums, values, vectors), "whitened")
    scratch.drop("distinct")
    live = int((values > 0).sum())
    error = None
    if live:
        part = white.withColumn("x", F.slice("x", 1, live))
        error = float(np.abs(covariance(part, *weighted_sums(part)) - np.eye(live)).max())

    trace = float(np.trace(cov))
    explained = [float(v / trace) if trace > 0 else None for v in values]
    own = placed.where(F.size("x") == usual["d"]).select("__id", F.col("x").alias("v"), *keys(F.col("x")))
    joined = own.select("__id", *by).join(white.drop("weight").withColumnRenamed("x", "y"), by)
    shares = F.array(*(F.lit(e).cast("double") for e in explained))
    return joined.select("__id", "deviation", F.posexplode("y").alias("p", "w")).select(
        F.col("__id").alias(key),
        (F.col("p") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        F.when(F.col("p") < live, F.col("w")).alias("whitened"),
        F.get(shares, F.col("p")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
