"""Near-duplicate documents by SetSketch registers, confirmed on whole shingle sets.

A document is the set of its five-word shingles. A register holds the smallest
of the set's hashes as an exponential variate on a logarithmic scale, truncated
to 16 bits: registers of a union are the larger of both, and two sets agree in a
register about as often as they share elements. Documents with equal sets are
one class from then on. Bands of registers bring classes together; a joint
likelihood of the registers and set sizes rules out most pairs, and the others
are compared shingle by shingle.

Classes that share a band, directly or over others, form a candidate group.
Groups are compared block by block inside tasks, which return the connections
they found as stars, never pairs: rows out are at most rows in. The texts of a
group's classes are sent once for every block of their group.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thumbwheel.llm.graph import components
from thumbwheel.llm.store import Scratch
from thumbwheel.llm.words import BASE_B, U64, map_batches, mix, signed, window_hashes, word_hashes
from thumbwheel.operators.skew import lookup_join


@dataclass(frozen=True)
class SketchConfig:
    shingle: int = 5
    percent: int = 85  # of the union that linked sets share
    bands: int = 28
    rows: int = 6  # registers in a band
    base: float = 1.001  # of the logarithmic scale
    seed: int = 3
    slack: float = 5.0  # standard errors below the threshold that a pair is still compared
    block: int = 512  # classes compared with as many others in one task
    largest_group: int = 16_384  # larger candidate groups are compared bucket by bucket
    prefilter_bits: int = 20

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def shingle_set(text: str | None, cfg: SketchConfig) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a whole text, A-Z in lower case."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, U64)
    hashes = word_hashes(words)
    if len(words) < cfg.shingle:
        return window_hashes(hashes, len(words), BASE_B)
    return np.unique(window_hashes(hashes, cfg.shingle))


@cache
def _multipliers(cfg: SketchConfig) -> np.ndarray:
    rng = np.random.default_rng(cfg.seed)
    return rng.integers(1, 1 << 63, cfg.registers, dtype=np.uint64) * U64(2) + U64(1)


def sketches(sets: list[np.ndarray], cfg: SketchConfig) -> np.ndarray:
    """Registers of every set, a row each; empty sets have zeros."""
    out = np.zeros((len(sets), cfg.registers), np.uint16)
    filled = [i for i, s in enumerate(sets) if len(s)]
    if not filled:
        return out
    flat = np.concatenate([sets[i] for i in filled])
    starts = np.cumsum([0, *(len(sets[i]) for i in filled[:-1])])
    least = np.empty((len(filled), cfg.registers), U64)
    for r, factor in enumerate(_multipliers(cfg)):
        least[:, r] = np.minimum.reduceat((flat * factor) >> U64(32), starts)
    waiting = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**32)
    out[filled] = np.clip(np.floor(1 - np.log(waiting) / np.log(cfg.base)) + 4096, 1, 65535)
    return out


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, whatever its order."""
    total = lambda x: int(signed(np.array([mix(x).sum(dtype=np.uint64)]))[0])
    return total(s), total(s ^ BASE_B)


def similarity(ka: np.ndarray, kb: np.ndarray, na: np.ndarray, nb: np.ndarray, cfg: SketchConfig) -> np.ndarray:
    """Jaccard similarity of pairs by maximum joint likelihood of registers and known sizes."""
    above, below = (ka > kb).sum(axis=1), (ka < kb).sum(axis=1)
    equal = ka.shape[1] - above - below
    u, v = na / (na + nb), nb / (na + nb)
    chance = lambda x: -np.log1p(-x * (cfg.base - 1) / cfg.base) / np.log(cfg.base)

    def likelihood(j):
        pa_, pb_ = chance(np.maximum(u - v * j, 0)), chance(np.maximum(v - u * j, 0))
        log = lambda p: np.log(np.maximum(p, 1e-12))
        return above * log(pa_) + below * log(pb_) + equal * log(1 - pa_ - pb_)

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(24):
        one, two = low + (high - low) / 3, high - (high - low) / 3
        better = likelihood(one) < likelihood(two)
        low, high = np.where(better, one, low), np.where(better, high, two)
    return (low + high) / 2


def _intersections(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
    return np.add.reduceat((own[at] == flat).astype(np.int64), np.cumsum([0, *map(len, others[:-1])]))


def connect(
    nodes: np.ndarray, sizes: np.ndarray, registers: np.ndarray, sets: list[np.ndarray], side: np.ndarray,
    cfg: SketchConfig,
) -> list[tuple[int, int]]:
    """Links within a block, or between two (``side`` 0 and 1), as stars around smallest nodes.

    Pairs that are connected already need no comparison: only connections are asked for.
    """
    n = len(nodes)
    labels = np.arange(n)
    spread = np.sqrt(cfg.percent / 100 * (1 - cfg.percent / 100) / cfg.registers)
    limit = cfg.percent / 100 - cfg.slack * spread
    within = bool((side == side[0]).all())
    for i in range(n):
        after = np.arange(i + 1, n) if within else (np.flatnonzero(side == 1) if side[i] == 0 else np.zeros(0, int))
        after = after[labels[after] != labels[i]]
        after = after[np.minimum(sizes[after], sizes[i]) * 100 >= np.maximum(sizes[after], sizes[i]) * cfg.percent]
        if not len(after):
            continue
        mine = np.broadcast_to(registers[i], (len(after), registers.shape[1]))
        shared = (registers[after] == mine).mean(axis=1)
        # Agreement overstates similarity at this base, so it can rule out before the estimate.
        after = after[shared >= limit]
        if not len(after):
            continue
        mine = np.broadcast_to(registers[i], (len(after), registers.shape[1]))
        estimate = similarity(mine, registers[after], np.full(len(after), sizes[i], float), sizes[after].astype(float), cfg)
        after = after[estimate >= limit]
        if not len(after):
            continue
        common = _intersections(sets[i], [sets[j] for j in after])
        union = sizes[i] + sizes[after] - common
        for j in after[common * 100 >= union * cfg.percent]:
            labels[labels == labels[j]] = labels[i]
    out = []
    for label in np.unique(labels):
        members = nodes[labels == label]
        least = members.min()
        out += [(int(m), int(least)) for m in members if m != least]
    return out


def _signatures(docs: DataFrame, cfg: SketchConfig) -> DataFrame:
    def sign(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            sets = [shingle_set(t, cfg) for t in part.column(1).to_pylist()]
            prints = [fingerprint(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([p[0] for p in prints], pa.int64()), pa.array([p[1] for p in prints], pa.int64()),
                    pa.array([r.tobytes() for r in sketches(sets, cfg)], pa.binary()),
                ],
                ["doc_id", "n_shingles", "print_a", "print_b", "registers"],
            )

    return map_batches(
        docs.select(F.col("doc_id").cast("long"), "text"), sign,
        "doc_id long, n_shingles long, print_a long, print_b long, registers binary",
    )


PRINT = ["print_a", "print_b", "n_shingles"]


def _candidate_groups(classes: DataFrame, cfg: SketchConfig, scratch: Scratch) -> DataFrame:
    """``node, group_id, block, n_blocks`` of every class that shares a band with another."""
    width = 2 * cfg.rows
    band = lambda i: F.xxhash64(F.lit(i), F.substring("registers", 1 + width * i, width))
    bands = classes.select("node", F.explode(F.array(*map(band, range(cfg.bands)))).alias("bucket"))
    heads = bands.groupBy("bucket").agg(F.min("node").alias("head"), F.max("node").alias("tail")).where("head != tail")
    shared = scratch.keep(bands.join(heads.select("bucket", "head"), "bucket"), "buckets")
    groups = components(shared.select(F.col("node").alias("a"), F.col("head").alias("b")), scratch, "candidates")
    groups = scratch.keep(groups, "groups")
    sizes = groups.groupBy("component").agg(F.count("*").alias("n"))
    sized = lookup_join(groups, sizes, ["component"], "node")
    whole = sized.where(F.col("n") <= cfg.largest_group).select("node", F.col("component").alias("group_id"))
    large = sized.where(F.col("n") > cfg.largest_group).select("node").join(shared.select("node", "bucket"), "node")
    rows = whole.unionByName(large.select("node", F.col("bucket").alias("group_id")).distinct())
    blocks = rows.groupBy("group_id").agg(F.ceil(F.count("*") / F.lit(cfg.block)).cast("int").alias("n_blocks"))
    placed = lookup_join(rows, blocks, ["group_id"], "node")
    return placed.withColumn("block", F.pmod(F.xxhash64("node", F.lit(7)), "n_blocks").cast("int"))


def _texts_of(docs: DataFrame, members: DataFrame, cfg: SketchConfig) -> DataFrame:
    """Texts of the documents in ``members``.

    A set of hash buckets of the wanted ids goes ahead: at most 2 ** prefilter_bits
    numbers, whatever the number of ids; it spares most other texts the shuffle.
    """
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << cfg.prefilter_bits))
    wanted = members.select(slot("node").alias("slot")).distinct()
    near = docs.select(F.col("doc_id").cast("long").alias("node"), "text").withColumn("slot", slot("node"))
    return near.join(F.broadcast(wanted), "slot", "left_semi").drop("slot")


def near_duplicates(spark: SparkSession, docs: DataFrame, cfg: SketchConfig = SketchConfig()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``.

    Texts that are null or have no word have no shingle and are linked with
    nothing. Rows with a null doc_id are linked with nothing and kept, with a null
    component. Repeated rows are one document; if one doc_id has several
    texts, all of them count as that document. Other columns are not read.
    """
    scratch = Scratch(spark, "near-duplicates")
    signed_docs = scratch.keep(_signatures(docs, cfg), "signatures")
    classes = scratch.keep(
        signed_docs.where("n_shingles > 0 and doc_id is not null").groupBy(*PRINT)
        .agg(F.min("doc_id").alias("node"), F.first("registers").alias("registers")),
        "classes",
    )
    placed = scratch.keep(_candidate_groups(classes, cfg, scratch), "placed")
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    pairs = (
        placed.join(classes.select("node", *PRINT, "registers"), "node")
        .join(_texts_of(docs, placed, cfg), "node")
        .withColumn("other", other)
        .select(
            "group_id", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
            (F.col("block") > F.col("other")).cast("int").alias("side"), "node", *PRINT, "registers", "text",
        )
    )
    keys = ["group_id", "i", "j"]
    links = scratch.keep(
        pairs.repartition(*keys).sortWithinPartitions(*keys, "side", "node").mapInArrow(_compare(cfg), "a long, b long"),
        "links",
    )
    linked = scratch.keep(components(links, scratch, "linked"), "components")
    # One row per class: rows of one doc_id with several texts may meet in a component of their own.
    named = classes.select(*PRINT, "node").join(linked, "node", "left")
    known = named.select(*PRINT, F.coalesce("component", "node").alias("component_id"))
    found = lookup_join(signed_docs.drop("registers"), known, PRINT, "doc_id", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(component, "doc_id"))
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )


def _compare(cfg: SketchConfig):
    """Reads rows sorted by block pair and yields the stars of each; holds one pair of blocks."""

    def compare(rows: list[tuple]) -> list[tuple[int, int]]:
        kept, seen = [], set()
        for side, node, print_a, print_b, n, registers, text in rows:
            s = shingle_set(text, cfg)
            if (node, print_a, print_b) not in seen and len(s) == n and fingerprint(s) == (print_a, print_b):
                seen.add((node, print_a, print_b))
                kept.append((side, node, n, np.frombuffer(registers, np.uint16), s))
        if len(kept) < 2:
            return []
        side, nodes, sizes = (np.array([k[c] for k in kept]) for c in range(3))
        return connect(nodes, sizes, np.stack([k[3] for k in kept]), [k[4] for k in kept], side, cfg)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key, out = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:3] != key:
                    out += compare(held) if held else []
                    key, held = row[:3], []
                held.append(row[3:])
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])
                out = []
        out += compare(held) if held else []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])

    return run
