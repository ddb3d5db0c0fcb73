"""Quality rules: a hashed n-gram log-likelihood ratio behind a few base rules.

Two multinomials over hashed byte n-grams are counted: one over documents
labelled trustworthy, one over the whole corpus. A document's score is the mean
over its n-grams of log p_target - log p_corpus, so it does not depend on
length, and the document is kept when the score reaches ``threshold``. The
corpus counts cover every document; the trusted ones are a bounded sample of the
labelled rows, the ``max_trusted`` with the smallest hash of doc_id, so their
ids can be broadcast and no text is shuffled. The model is a table of
``buckets`` numbers whatever the input size.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thumbwheel.llm.words import GOLDEN, U64, carried_schema, map_batches, window_hashes, word_hashes

SYMBOLS = b"#*$%&|<>"
_BREAKS = b" \t\n\x0b\x0c\r"
_BREAK_TEXT = _BREAKS.decode()


@dataclass(frozen=True)
class QualityRules:
    order: int = 4  # bytes in an n-gram
    bucket_bits: int = 16
    smoothing: float = 50.0  # corpus n-grams added to every bucket; the target gets its share of them
    threshold: float = -0.3  # nats per n-gram
    max_trusted: int = 20_000  # labelled rows that make the target multinomial, at most
    min_words: int = 10
    max_repeat_percent: int = 20
    repeat_window: int = 5

    @property
    def buckets(self) -> int:
        return 1 << self.bucket_bits


def hashed_ngrams(text: bytes, rules: QualityRules) -> np.ndarray:
    """Bucket of every n-gram of bytes, repetitions included."""
    raw = np.frombuffer(text, np.uint8)
    n = len(raw) - rules.order + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    code = raw[:n].astype(U64)
    for i in range(1, rules.order):
        code = (code << U64(8)) | raw[i : i + n]
    return ((code * GOLDEN) >> U64(64 - rules.bucket_bits)).astype(np.int64)


def repeated_words(words: list[bytes], width: int) -> int:
    """How many words lie in a window of ``width`` words that occurs at least twice."""
    windows = window_hashes(word_hashes(words), width)
    if len(windows) < 2:
        return 0
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    equal = ranked[1:] == ranked[:-1]
    if not equal.any():
        return 0
    twice = np.zeros(len(windows), bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def base_figures(text: str | None, rules: QualityRules) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, repeated words. Null: all zero."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    seen: set[str] = set()
    repeated = 0
    for line in text.split("\n"):
        if line.strip(_BREAK_TEXT):
            repeated += line in seen
            seen.add(line)
    n_chars = len(text) - (len(raw) - len(raw.translate(None, _BREAKS)))
    n_symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    return len(words), n_chars, n_symbols, repeated, repeated_words(words, rules.repeat_window)


def with_target_flag(docs: DataFrame, labels: DataFrame, rules: QualityRules) -> DataFrame:
    """``text, is_target``: whether the document is in the trusted sample."""
    good = (
        labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull())
        .select("doc_id").distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rules.max_trusted)
        .withColumn("is_target", F.lit(True))
    )
    # At most max_trusted keys, whatever the size of the tables.
    return docs.select("doc_id", "text").join(F.broadcast(good), "doc_id", "left").select(
        "text", F.coalesce("is_target", F.lit(False)).alias("is_target")
    )


def ngram_counts(flagged: DataFrame, rules: QualityRules) -> DataFrame:
    """``bucket, n_target, n_corpus`` over all documents.

    Each task adds up its own documents first and sends at most one row per
    bucket, so the shuffle does not see single n-grams.
    """
    buckets = rules.buckets

    def count(batches: Iterable[pa.RecordBatch]):
        target, corpus = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            for text, is_target in zip(*(c.to_pylist() for c in batch.columns)):
                if text:
                    found = hashed_ngrams(text.encode("utf-8", "surrogatepass"), rules)
                    if len(found) > buckets >> 3:
                        here = np.bincount(found, minlength=buckets)
                        corpus += here
                        target += here * is_target
                    else:
                        np.add.at(corpus, found, 1)
                        if is_target:
                            np.add.at(target, found, 1)
        used = np.flatnonzero(corpus)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(target[used]), pa.array(corpus[used])],
            ["bucket", "n_target", "n_corpus"],
        )

    parts = flagged.select("text", "is_target").mapInArrow(
        count, "bucket long, n_target long, n_corpus long"
    )
    return parts.groupBy("bucket").agg(
        F.sum("n_target").alias("n_target"), F.sum("n_corpus").alias("n_corpus")
    )


def log_ratios(counts: DataFrame, rules: QualityRules) -> np.ndarray:
    """The model: one log ratio per bucket, at most ``rules.buckets`` rows on the driver."""
    target, corpus = np.zeros(rules.buckets), np.zeros(rules.buckets)
    for row in counts.collect():
        target[row["bucket"]], corpus[row["bucket"]] = row["n_target"], row["n_corpus"]
    share = target.sum() / max(corpus.sum(), 1)
    if not share:
        return np.zeros(rules.buckets)
    # Totals of both multinomials stand in the same ratio as their smoothing, so they cancel.
    return np.log((target / share + rules.smoothing) / (corpus + rules.smoothing))


def quality_verdicts(
    docs: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules(), carry: Sequence[str] = ()
) -> DataFrame:
    """Figures and verdict of every document, one row per row of ``docs``.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, score, kept, and the columns of ``docs`` named in
    ``carry``. Null and empty texts have zero
    figures, score 0 and fail the base rules. Repeated rows each get their own
    row; other columns of ``docs`` and ``labels`` are not read. Without trusted
    labels every score is 0 and the base rules alone decide.
    """
    counts = ngram_counts(with_target_flag(docs, labels, rules), rules)
    return score_documents(docs, log_ratios(counts, rules), rules, carry)


def score_documents(
    docs: DataFrame, ratios: np.ndarray, rules: QualityRules, carry: Sequence[str] = ()
) -> DataFrame:
    weights = ratios.astype(np.float64)

    def score(batch: pa.RecordBatch):
        figures, scores = [], []
        for text in batch.column(1).to_pylist():
            figures.append(base_figures(text, rules))
            found = hashed_ngrams((text or "").encode("utf-8", "surrogatepass"), rules)
            scores.append(float(weights[found].mean()) if len(found) else 0.0)
        columns = [pa.array(c, pa.int64()) for c in zip(*figures)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *columns, pa.array(scores, pa.float64()), *batch.columns[2:]],
            ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", *carry],
        )

    # Carried columns under names of their own: one may be called like a column here.
    own = (F.col(c).alias(f"__carry_{i}") for i, c in enumerate(carry))
    scored = map_batches(
        docs.select(F.col("doc_id").cast("long"), "text", *own), score,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, score double" + carried_schema(docs, carry),
    )
    failed = (F.col("n_words") < rules.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_percent
    )
    return scored.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= rules.threshold)
    )
