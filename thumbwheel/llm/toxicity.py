"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes ratios.

A document is the set of its hashed n-grams. Each n-gram's value is the log
ratio of its frequency among toxic and among clean training documents; a
logistic regression over those values gives the score. Only the ``features``
n-grams whose frequencies differ most take part.

The training rows are a bounded sample: of each class the ``per_class`` rows
with the smallest hash of doc_id. Scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thumbwheel.llm.store import Scratch
from thumbwheel.llm.words import GOLDEN, U64, map_batches


@dataclass(frozen=True)
class ToxicityConfig:
    order: int = 4
    bucket_bits: int = 16
    features: int = 2048
    per_class: int = 10_000  # training rows of each class, at most
    steps: int = 150
    rate: float = 0.2
    ridge: float = 1e-3
    threshold: float = 0.7

    @property
    def buckets(self) -> int:
        return 1 << self.bucket_bits


@dataclass(frozen=True)
class ToxicityModel:
    slot: np.ndarray  # feature number of each bucket, -1 for none
    weights: np.ndarray  # of each feature, ratio included
    bias: float


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def hashed_grams(text: str | None, cfg: ToxicityConfig) -> np.ndarray:
    """Buckets of the n-grams of the lower-cased text, a space at either end."""
    raw = np.frombuffer(f" {(text or '').lower()} ".encode("utf-8", "surrogatepass"), np.uint8)
    n = len(raw) - cfg.order + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    code = raw[:n].astype(U64)
    for i in range(1, cfg.order):
        code = (code << U64(8)) | raw[i : i + n]
    return ((code * GOLDEN) >> U64(64 - cfg.bucket_bits)).astype(np.int64)


def training_labels(labels: DataFrame, cfg: ToxicityConfig) -> DataFrame:
    """``doc_id, toxic`` of the sample; the worst label counts when a document has several."""
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    pick = lambda c: known.where(F.col("toxic") == c).orderBy(*order).limit(cfg.per_class)
    return pick(1).unionByName(pick(0))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, cfg: ToxicityConfig) -> ToxicityModel:
    """The model from the labelled sample; with one class or none, every score is the base rate."""
    scratch = Scratch(spark, "toxicity")
    # At most two classes of per_class keys, whatever the size of the tables.
    chosen = scratch.keep(training_labels(labels, cfg), "chosen")
    sample = scratch.keep(
        docs.select(F.col("doc_id"), "text").join(F.broadcast(chosen), "doc_id").select("toxic", "text"),
        "sample",
    )
    totals = {
        r["toxic"]: r["n"]
        for r in labels.where(~held_out(F.col("doc_id"))).groupBy("toxic").agg(F.count("*").alias("n")).collect()
    }
    counts = _class_counts(sample, cfg)
    rows = np.zeros(2)
    for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect():
        rows[int(r["toxic"])] = r["n"]
    clean, toxic = rows
    prior = np.log((totals.get(1, 0) + 1) / (totals.get(0, 0) + 1))
    if not clean or not toxic:
        scratch.drop("")
        return ToxicityModel(np.full(cfg.buckets, -1), np.zeros(0), float(prior))
    p, q = counts[1] / toxic, counts[0] / clean
    pooled = (counts[0] + counts[1]) / (clean + toxic)
    spread = np.sqrt(pooled * (1 - pooled) * (1 / clean + 1 / toxic)) + 1e-9
    chosen_buckets = np.sort(np.argsort(-np.abs(p - q) / spread, kind="stable")[: cfg.features])
    slot = np.full(cfg.buckets, -1)
    slot[chosen_buckets] = np.arange(len(chosen_buckets))
    ratio = np.log((counts[1] + 1) / (toxic + 2)) - np.log((counts[0] + 1) / (clean + 2))
    weights, bias = _regress(_sample_features(sample, slot, cfg), ratio[chosen_buckets], cfg)
    scratch.drop("")
    return ToxicityModel(slot, weights, float(bias + prior - np.log(toxic / clean)))


def _class_counts(sample: DataFrame, cfg: ToxicityConfig) -> np.ndarray:
    """Documents of each class that hold a bucket's n-gram; a row per bucket and task at most."""

    def count(batches: Iterable[pa.RecordBatch]):
        seen = np.zeros((2, cfg.buckets), np.int64)
        for batch in batches:
            for toxic, text in zip(*(c.to_pylist() for c in batch.columns)):
                seen[int(toxic), np.unique(hashed_grams(text, cfg))] += 1
        used = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(seen[0, used]), pa.array(seen[1, used])], ["bucket", "n0", "n1"]
        )

    parts = sample.select(F.col("toxic").cast("int"), "text").mapInArrow(
        count, "bucket long, n0 long, n1 long"
    )
    out = np.zeros((2, cfg.buckets))
    for r in parts.groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect():
        out[:, r["bucket"]] = r["n0"], r["n1"]
    return out


def _sample_features(sample: DataFrame, slot: np.ndarray, cfg: ToxicityConfig):
    """Label and feature numbers of the sample's rows: at most 2 * per_class * features numbers."""

    def features(batch: pa.RecordBatch):
        found = [_features(t, slot, cfg).astype(np.uint16).tobytes() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["toxic", "found"])

    rows = map_batches(
        sample.select(F.col("toxic").cast("int"), "text"), features, "toxic int, found binary"
    ).collect()
    # Summation order must not depend on how the tasks were scheduled.
    rows.sort(key=lambda r: (r["toxic"], bytes(r["found"])))
    return (
        np.array([r["toxic"] for r in rows], float),
        [np.frombuffer(bytes(r["found"]), np.uint16).astype(np.int64) for r in rows],
    )


def _features(text: str | None, slot: np.ndarray, cfg: ToxicityConfig) -> np.ndarray:
    found = slot[hashed_grams(text, cfg)]
    return np.unique(found[found >= 0])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _regress(rows, ratio: np.ndarray, cfg: ToxicityConfig) -> tuple[np.ndarray, float]:
    """Logistic regression by full-batch descent with a rate of its own for each weight."""
    labels, found = rows
    flat = np.concatenate(found)
    row = np.repeat(np.arange(len(found)), [len(f) for f in found])
    values = ratio[flat]
    weights, bias = np.zeros(len(ratio)), np.log(labels.sum() / (len(labels) - labels.sum()))
    square, square_bias = np.zeros(len(ratio)), 0.0
    for _ in range(cfg.steps):
        scores = np.bincount(row, values * weights[flat], minlength=len(found)) + bias
        error = _sigmoid(scores) - labels
        grad = np.bincount(flat, values * error[row], minlength=len(ratio)) / len(labels)
        grad += cfg.ridge * weights
        square += grad * grad
        weights -= cfg.rate * grad / np.sqrt(square + 1e-12)
        square_bias += error.mean() ** 2
        bias -= cfg.rate * error.mean() / np.sqrt(square_bias + 1e-12)
    return weights * ratio, float(bias)


def toxicity_scores(docs: DataFrame, model: ToxicityModel, cfg: ToxicityConfig) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; null and empty texts score by the bias."""

    def score(batch: pa.RecordBatch):
        sums = [float(model.weights[_features(t, model.slot, cfg)].sum()) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(_sigmoid(np.array(sums) + model.bias), pa.float64())],
            ["doc_id", "score"],
        )

    scored = map_batches(docs.select(F.col("doc_id").cast("long"), "text"), score, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= cfg.threshold).cast("int").alias("predicted"),
    )


def classify_toxicity(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, cfg: ToxicityConfig = ToxicityConfig()
) -> DataFrame:
    """Train on the labelled sample, score every document: one row per row of ``docs``.

    Only ``text`` enters a score. Null doc_ids are never learned from and are
    not held out. Repeated rows are scored alike; other columns are not read.
    An empty ``labels`` table gives every document the same base rate.
    """
    return toxicity_scores(docs, fit(spark, docs, labels, cfg), cfg)
