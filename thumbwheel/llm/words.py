"""Words, hashes and Arrow batches shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64
GOLDEN = U64(0x9E3779B97F4A7C15)
BASE_A = U64(0xD6E8FEB86659FD93)
BASE_B = U64(0xA0761D6478BD642F)


def split_words(text: str | None) -> list[bytes]:
    """Words of a whole text as UTF-8; ``bytes.split`` breaks at space and characters 9 to 13."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def window_hashes(hashes: np.ndarray, width: int, base: np.uint64 = BASE_A) -> np.ndarray:
    """A 64-bit hash of every ``width`` consecutive words (none if there are fewer)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    total = hashes[:n].copy()
    for i in range(1, width):
        total = total * base + hashes[i : i + n]
    return mix(total)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=U64)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with one input batch at a time; ``fn`` yields any number of batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(run, schema)


def carried_schema(df: DataFrame, names: Sequence[str]) -> str:
    """The columns ``names`` of ``df`` as the end of a schema text."""
    return "".join(f", `{n}` {df.schema[n].dataType.simpleString()}" for n in names)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
