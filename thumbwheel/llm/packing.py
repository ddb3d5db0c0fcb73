"""Packing along a space-filling curve.

Every document becomes token ids; the hashed vector of its tokens is projected
to a few dimensions and placed on a Hilbert curve. Documents are laid end to end
in the order of their Hilbert keys and the stream is cut every ``length``
tokens, so documents that share words share sequences and no sequence but the
last is padded.

Positions come from running sums over (key, size) rows only; token ids are made
once, written, and cut when the positions are known.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thumbwheel.llm.store import Scratch
from thumbwheel.llm.words import map_batches, split_words
from thumbwheel.operators.ordering import running_offsets


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@dataclass(frozen=True)
class PackingConfig:
    length: int = 2048
    end_id: int = 1  # closes every document
    dimensions: int = 4
    bits: int = 10  # of each dimension of the curve
    seed: int = 11
    cached_words: int = 500_000  # in either generation of a task's cache
    cache_below: int = 48  # bytes of a word worth keeping


# Fixed value: how the vocabulary's rules cut a lower-cased word of Latin letters, digits and signs.
WORD_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
LATIN_WORD = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
PROBES = "Hello, it's Ünïcode's x1234,, don't!! ÉÀÇ naïve... 's a'b'll $$$ Straße <|x| (1,5%) l'été '' ÿ".split()


class WordTokenizer:
    """Ids of whole texts, word by word.

    White space never lies inside a token of this vocabulary, so a text's ids
    are those of its words one after the other; words met again are not encoded
    again. Words are kept in two generations of at most ``cached_words``: when
    the younger is full it becomes the older, and what is not asked for until
    the next change is forgotten.

    A new word of Latin letters goes to the model piece by piece; any other, and
    every word of a vocabulary that cuts the probes differently, takes the
    tokenizer's whole way.
    """

    def __init__(self, path: str, cfg: PackingConfig):
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.model = self.encoder.model
        self.limit, self.longest = cfg.cached_words, cfg.cache_below
        self.old: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.young = _Words(self)
        letters = [chr(c) for c in range(0xC0, 0x100)]
        stage = self.encoder.pre_tokenizer
        self.letters = {ord(c): "".join(part for part, _ in stage.pre_tokenize_str(c)) for c in letters} if stage else {}
        self.latin = bool(stage) and all(self._by_pieces(w) == self._whole(w) for w in PROBES)

    def _whole(self, word: str) -> bytes:
        return np.asarray(self.encoder.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def _by_pieces(self, word: str) -> bytes:
        out = []
        for piece in WORD_PIECES.findall(word.lower()):
            found = self.pieces.get(piece)
            if found is None:
                shown = piece if piece.isascii() else piece.translate(self.letters)
                found = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(shown)])
                if len(self.pieces) >= self.limit:
                    self.pieces.clear()
                self.pieces[piece] = found
            out.append(found)
        return b"".join(out)

    def encode(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "surrogatepass")
        if self.latin and LATIN_WORD.fullmatch(text) and "<|" not in text:
            return self._by_pieces(text)
        return self._whole(text)

    def ids(self, text: str | None) -> bytes:
        """The ids as unsigned little-endian 32-bit numbers, without the end."""
        packed = b"".join(map(self.young.__getitem__, split_words(text)))
        if len(self.young) > self.limit:
            self.old, self.young = self.young, _Words(self)
        return packed


class _Words(dict):
    """The younger generation of a tokenizer's words; asks the older one, then the model."""

    def __init__(self, owner: WordTokenizer):
        super().__init__()
        self.owner = owner

    def __missing__(self, word: bytes) -> bytes:
        found = dict.get(self.owner.old, word)
        if found is None:
            found = self.owner.encode(word)
        if len(word) <= self.owner.longest:
            self[word] = found
        return found


@cache
def _tokenizer(path: str, cfg: PackingConfig) -> WordTokenizer:
    return WordTokenizer(path, cfg)


def token_signs(ids: np.ndarray, cfg: PackingConfig) -> np.ndarray:
    """A pseudo-random sign of every token in every dimension."""
    x = (ids.astype(np.uint64) + np.uint64(cfg.seed)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    shifts = np.uint64(32) + np.arange(cfg.dimensions, dtype=np.uint64)
    return ((x[:, None] >> shifts) & np.uint64(1)).astype(np.float64) * 2 - 1


def curve_cells(ids: np.ndarray, cfg: PackingConfig) -> np.ndarray:
    """The cell of a document: its projection in units of chance, squeezed into the grid."""
    used, times = np.unique(ids, return_counts=True)
    weight = np.log1p(times)
    projected = weight @ token_signs(used, cfg) / max(np.sqrt((weight**2).sum()), 1e-9)
    share = 1 / (1 + np.exp(-1.7 * projected))
    return np.minimum((share * (1 << cfg.bits)).astype(np.int64), (1 << cfg.bits) - 1)


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions along the Hilbert curve of rows of cells.

    Undoes the curve's rotations from the highest bit down, Gray-codes the axes
    and interleaves their bits.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for axis in range(n):
            turned = (x[axis] & bit) != 0
            swap = np.where(turned, 0, (x[0] ^ x[axis]) & below)
            x[0] = np.where(turned, x[0] ^ below, x[0] ^ swap)
            x[axis] ^= swap
    for axis in range(1, n):
        x[axis] ^= x[axis - 1]
    flip = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        flip = np.where((x[n - 1] >> level) & 1, flip ^ ((1 << level) - 1), flip)
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in range(n):
            key = (key << 1) | ((x[axis] >> level) & 1)
    return key


def tokenized(docs: DataFrame, vocabulary: str, cfg: PackingConfig) -> DataFrame:
    """``doc_id, curve, n_tokens, ids``: ids as packed 32-bit numbers, the end included."""
    end = np.asarray([cfg.end_id], "<u4").tobytes()

    def encode(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = _tokenizer(vocabulary, cfg)
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            packed = [words.ids(t) + end for t in part.column(1).to_pylist()]
            cells = np.stack([curve_cells(np.frombuffer(p, "<u4"), cfg) for p in packed])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), pa.array(hilbert_keys(cells, cfg.bits)),
                    pa.array([len(p) >> 2 for p in packed], pa.int64()), pa.array(packed, pa.binary()),
                ],
                ["doc_id", "curve", "n_tokens", "ids"],
            )

    return map_batches(
        docs.select(F.col("doc_id").cast("long"), "text"), encode,
        "doc_id long, curve long, n_tokens long, ids binary",
    )


def pack_documents(
    spark: SparkSession, docs: DataFrame, vocabulary: str | None = None, cfg: PackingConfig = PackingConfig()
) -> DataFrame:
    """Pieces of all documents: which tokens lie where in which sequence.

    Columns: doc_id, start, length, ids_crc32 (of the piece's ids as unsigned
    little-endian 32-bit numbers), doc_tokens, sequence_id, offset. Null and
    empty texts are one token, the end. Repeated rows are packed as documents of
    their own, null ids too; other columns are not read. Sequence numbers follow the
    curve; the last sequence alone may be short.
    """
    scratch = Scratch(spark, "packing")
    tokens = scratch.keep(
        tokenized(docs, vocabulary or default_vocabulary(), cfg).withColumn("row", F.monotonically_increasing_id()),
        "tokens",
    )
    placed = running_offsets(spark, tokens.select("curve", "doc_id", "row", "n_tokens"), ["curve", "doc_id", "row"], "n_tokens")
    starts = placed.select("row", F.col("start").alias("at"))
    joined = tokens.select("row", "doc_id", "n_tokens", "ids").join(starts, "row").select("doc_id", "n_tokens", "ids", "at")

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for doc_id, n, ids, at in zip(*(c.to_pylist() for c in batch.columns)):
            start = 0
            while start < n:
                offset = (at + start) % cfg.length
                size = min(n - start, cfg.length - offset)
                piece = ids[start * 4 : (start + size) * 4]
                rows.append((doc_id, start, size, zlib.crc32(piece), n, (at + start) // cfg.length, offset))
                start += size
        columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
        yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in schema.split(", ")])

    schema = (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
    return map_batches(joined, cut, schema)
