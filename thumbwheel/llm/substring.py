"""Repeated passages by a compacted de Bruijn graph of words.

Edges of the graph are the windows of ``window`` consecutive words. Windows of
a document that share their minimizer (the smallest hash among the ``k``-word
sequences inside) lie next to each other and form one piece of a path. Equal
windows have equal minimizers, so every occurrence of a window lies in a piece
with the same one:

* all pieces of a minimizer are equal: the path does not branch there, and one
  row stands for all its windows;
* pieces differ: the path branches, and the windows of each distinct piece are
  compared one by one.

Occurrences meet by minimizer and piece, and their coordinates (doc_id, start)
tell which comes first. What is removed is checked once more against the words
at those coordinates before it is cut out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thumbwheel.llm.store import Scratch
from thumbwheel.llm.words import BASE_A, BASE_B, U64, carried_schema, map_batches, mix, powers, signed, split_words, word_hashes


@dataclass(frozen=True)
class PassageConfig:
    window: int = 20  # words that must repeat
    k: int = 8  # words in a minimizer
    chunk: int = 400_000  # words handled at a time
    prefilter_bits: int = 20


BASE_INVERSE = U64(pow(int(BASE_B), -1, 1 << 64))
PIECE = "anchor long, piece long, doc_id long, start long, n long"
PIECE_NAMES = [f.split()[0] for f in PIECE.split(", ")]


class WordHashes:
    """Hashes of any run of words of a text (or several laid end to end) in constant time."""

    def __init__(self, hashes: np.ndarray):
        self.size = len(hashes)
        self.sums = np.zeros(self.size + 1, U64)
        np.cumsum(hashes * powers(BASE_B, self.size), dtype=U64, out=self.sums[1:])
        self.shift = powers(BASE_INVERSE, self.size + 1)

    def runs(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        end = start + length
        raw = (self.sums[end] - self.sums[start]) * self.shift[start]
        return mix(raw ^ mix(np.broadcast_to(np.asarray(length, U64), raw.shape).astype(U64) * BASE_A))


def pieces_of(hashes: np.ndarray, owner: np.ndarray, cfg: PassageConfig):
    """Minimizer, hash, first window and number of windows of every piece of laid-out texts.

    ``owner`` tells which text a word belongs to; windows never cross texts.
    """
    n_windows = len(hashes) - cfg.window + 1
    empty = np.zeros(0, np.int64)
    if n_windows <= 0:
        return empty.view(U64), empty.view(U64), empty, empty
    runs = WordHashes(hashes)
    grams = runs.runs(np.arange(len(hashes) - cfg.k + 1), cfg.k)
    least, where = grams[:n_windows].copy(), np.zeros(n_windows, np.int64)
    for o in range(1, cfg.window - cfg.k + 1):
        there = grams[o : o + n_windows]
        better = there < least
        least[better] = there[better]
        where[better] = o
    where += np.arange(n_windows)
    inside = np.flatnonzero(owner[:n_windows] == owner[cfg.window - 1 :])
    if not len(inside):
        return empty.view(U64), empty.view(U64), empty, empty
    new = np.ones(len(inside), bool)
    new[1:] = (where[inside][1:] != where[inside][:-1]) | (owner[inside][1:] != owner[inside][:-1])
    first = np.flatnonzero(new)
    start = inside[first]
    count = np.diff(np.append(first, len(inside)))
    piece = mix(runs.runs(start, count + cfg.window - 1) + (where[start] - start).astype(U64))
    return least[start], piece, start, count


def _first_and_later(rows: list[np.ndarray]):
    """Sort rows by (anchor, piece, doc_id, start); which come first, and which are later copies."""
    order = np.lexsort(rows[3::-1])
    rows = [r[order] for r in rows]
    same = (rows[0][1:] == rows[0][:-1]) & (rows[1][1:] == rows[1][:-1])
    first = np.ones(len(order), bool)
    first[1:] = ~same
    head = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    later = (rows[2] != rows[2][head]) | (rows[3] != rows[3][head])
    return rows, first, later


def _batch(rows: list[np.ndarray], kind: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(pa.array(r) for r in rows), pa.array(kind)], [*PIECE_NAMES, "later"])


def document_pieces(docs: DataFrame, cfg: PassageConfig) -> DataFrame:
    """Pieces of all documents. Of equal pieces in a batch of documents only the first
    goes on to be compared; the others are known to come later (``later``)."""

    def find(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out: list[list[np.ndarray]] = []
        words: list[bytes] = []
        owner: list[int] = []
        sizes: list[int] = []

        def flush() -> None:
            lengths = np.array(sizes)
            offsets = np.cumsum(lengths) - lengths
            hashes = word_hashes(words)
            anchor, piece, start, n = pieces_of(hashes, np.repeat(np.arange(len(sizes)), lengths), cfg)
            text = np.searchsorted(offsets, start, side="right") - 1
            ids = np.array(owner, np.int64)
            out.append([signed(anchor), signed(piece), ids[text], start - offsets[text], n])

        for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            found = split_words(text)
            if doc_id is None or len(found) < cfg.window:
                continue
            if words and len(words) + len(found) > cfg.chunk:
                flush()
                words, owner, sizes = [], [], []
            words += found
            owner.append(doc_id)
            sizes.append(len(found))
        if words:
            flush()
        if out:
            rows, first, later = _first_and_later([np.concatenate(c) for c in zip(*out)])
            keep = first | later
            yield _batch([r[keep] for r in rows], later[keep])

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), find, f"{PIECE}, later boolean")


def _resolve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads pieces sorted by (anchor, piece, doc_id, start).

    Yields later copies (``later``), and the first of every distinct piece whose
    anchor has several. Between batches only the current group's first row is held.
    """
    anchor = piece = None
    first: tuple | None = None  # of the current piece
    waiting: tuple | None = None  # the anchor's only piece so far

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [c.to_numpy() for c in batch.columns]
        n = len(rows[0])
        new_anchor, new_piece = np.ones(n, bool), np.ones(n, bool)
        new_anchor[1:] = rows[0][1:] != rows[0][:-1]
        new_piece[1:] = new_anchor[1:] | (rows[1][1:] != rows[1][:-1])
        new_anchor[0] = anchor != rows[0][0]
        new_piece[0] = new_anchor[0] or piece != rows[1][0]
        head = np.maximum.accumulate(np.where(new_piece, np.arange(n), -1))
        head_doc = np.where(head >= 0, rows[2][np.maximum(head, 0)], first[2] if first else 0)
        head_start = np.where(head >= 0, rows[3][np.maximum(head, 0)], first[3] if first else 0)
        later = (rows[2] != head_doc) | (rows[3] != head_start)
        heads = np.flatnonzero(new_piece)
        group = np.cumsum(new_anchor[heads]) if len(heads) else np.zeros(0, int)
        # Pieces of each anchor in this batch; the first group may go on from the batch before.
        per = np.bincount(group, minlength=group.max() + 1 if len(group) else 1)
        goes_on = group == 0
        branching = per[group] > 1
        branching[goes_on] = True
        extra = []
        if goes_on.any() and waiting is not None:
            extra.append(waiting)
        last_open = None
        if len(heads) and group[-1] > 0 and per[group[-1]] == 1:
            last_open = tuple(int(r[heads[-1]]) for r in rows)
        if len(heads) and group[-1] > 0:
            waiting = last_open
        elif goes_on.any():
            waiting = None
        chosen = np.concatenate([np.flatnonzero(later), heads[branching]])
        kind = np.concatenate([np.ones(int(later.sum()), bool), np.zeros(int(branching.sum()), bool)])
        picked = [r[chosen] for r in rows]
        if extra:
            picked = [np.append(p, e) for p, e in zip(picked, extra[0])]
            kind = np.append(kind, False)
        if len(kind):
            yield _batch(picked, kind)
        anchor, piece = rows[0][-1], rows[1][-1]
        if head[-1] >= 0:
            first = tuple(int(r[head[-1]]) for r in rows)


def _with_texts(docs: DataFrame, spans: DataFrame, cfg: PassageConfig) -> DataFrame:
    """Texts of the documents that have ``spans``, with the spans as one list per document.

    At most 2 ** prefilter_bits hash slots of their ids go ahead, whatever the
    number of documents, and spare most other texts the shuffle.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << cfg.prefilter_bits)).alias("slot")
    near = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select("*", slot)
    near = near.join(F.broadcast(spans.select(slot).distinct()), "slot", "left_semi").drop("slot")
    # A document has at most as many pieces as words.
    lists = spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n", "piece")).alias("spans"))
    return near.join(lists, "doc_id")


def branching_windows(docs: DataFrame, pieces: DataFrame, cfg: PassageConfig) -> DataFrame:
    """``window_a, window_b, doc_id, start`` of every window of the given pieces."""

    def windows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = []
        for doc_id, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
            hashes = word_hashes(split_words(text))
            runs = WordHashes(hashes)
            start = np.array([s["start"] for s in spans])
            n = np.array([s["n"] for s in spans])
            at = np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())
            at = np.unique(at[at + cfg.window <= len(hashes)])
            a = runs.runs(at, cfg.window)
            # A second hash over words scrambled anew: 128 bits tell windows apart.
            b = WordHashes(mix(hashes ^ BASE_A)).runs(at, cfg.window)
            out.append((signed(a), signed(b), np.full(len(at), doc_id), at))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)], ["window_a", "window_b", "doc_id", "start"]
        )

    return map_batches(
        _with_texts(docs, pieces, cfg).select("doc_id", "text", "spans"), windows,
        "window_a long, window_b long, doc_id long, start long",
    )


def repeated_spans(spark: SparkSession, docs: DataFrame, cfg: PassageConfig, scratch: Scratch) -> DataFrame:
    """``doc_id, start, n, piece``: runs of n windows from ``start`` that occur earlier elsewhere.

    ``piece`` is the hash of the piece, or of the words of a single window.
    """
    pieces = scratch.keep(document_pieces(docs, cfg), "pieces")
    resolved = scratch.keep(
        pieces.where("not later").drop("later").repartition("anchor")
        .sortWithinPartitions("anchor", "piece", "doc_id", "start")
        .mapInArrow(_resolve, f"{PIECE}, later boolean"),
        "resolved",
    )
    windows = scratch.keep(branching_windows(docs, resolved.where("not later"), cfg), "windows")
    firsts = windows.groupBy("window_a", "window_b").agg(
        F.min(F.struct("doc_id", "start")).alias("first"), F.count("*").alias("n")
    ).where("n > 1").select("window_a", "window_b", "first")
    again = windows.join(firsts, ["window_a", "window_b"]).where(
        (F.col("doc_id") != F.col("first.doc_id")) | (F.col("start") != F.col("first.start"))
    )
    single = again.select("doc_id", "start", F.lit(1).cast("long").alias("n"), F.col("window_a").alias("piece"))
    whole = lambda df: df.where("later").select("doc_id", "start", "n", "piece")
    return whole(pieces).unionByName(whole(resolved)).unionByName(single)


def _kept_words(text: str | None, spans: list[dict] | None, cfg: PassageConfig) -> tuple[int, int, str]:
    """Cut the spans whose words are still found at their coordinates."""
    words = split_words(text)
    if not spans:
        return len(words), 0, b" ".join(words).decode("utf-8", "surrogatepass")
    start, n, piece = (np.array([s[c] for s in spans], np.int64) for c in ("start", "n", "piece"))
    length = n + cfg.window - 1
    fits = start + length <= len(words)
    start, length, piece = start[fits], length[fits], piece[fits].view(U64)
    found = WordHashes(word_hashes(words)).runs(start, length)
    # A piece's hash also tells where its minimizer lies; a single window's does not.
    offsets = np.arange(cfg.window - cfg.k + 1, dtype=U64)
    right = (found == piece) | (mix(found[:, None] + offsets) == piece[:, None]).any(axis=1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, start[right], 1)
    np.add.at(edges, (start + length)[right], -1)
    gone = np.cumsum(edges)[:-1] > 0
    kept = [w for w, g in zip(words, gone.tolist()) if not g]
    return len(words), int(gone.sum()), b" ".join(kept).decode("utf-8", "surrogatepass")


def remove_repeats(
    spark: SparkSession, docs: DataFrame, cfg: PassageConfig = PassageConfig(), carry: Sequence[str] = ()
) -> DataFrame:
    """``doc_id, n_words, n_removed, text`` of every row: the words no earlier window covers.

    ``text`` has the kept words joined by one space. Columns of ``docs`` named in
    ``carry`` follow.

    Null and empty texts have no word and an empty text. Rows with a null doc_id
    take no part: nothing is removed from them and nothing counts as repeating
    them. Repeated rows are one document and come out alike. Other columns are not read.
    """
    scratch = Scratch(spark, "passages")
    spans = scratch.keep(repeated_spans(spark, docs, cfg, scratch), "spans")
    scratch.drop("pieces", "resolved", "windows")
    lists = spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n", "piece")).alias("spans"))

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            done = [_kept_words(t, s, cfg) for t, s in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
            n_words, n_removed, texts = zip(*done)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, pa.string()),
                 *part.columns[3:]],
                ["doc_id", "n_words", "n_removed", "text", *carry],
            )

    # Carried columns under names of their own: one may be called like a column here.
    own = [f"__carry_{i}" for i in range(len(carry))]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", *(F.col(c).alias(o) for c, o in zip(carry, own))
    )
    schema = "doc_id long, n_words long, n_removed long, text string" + carried_schema(docs, carry)
    return map_batches(rows.join(lists, "doc_id", "left").select("doc_id", "text", "spans", *own), cut, schema)
