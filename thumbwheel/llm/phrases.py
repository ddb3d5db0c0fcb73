"""Phrase collocations by Rabin-Karp fingerprints.

Prefix polynomials over the word hashes of a batch of texts give the fingerprint
of every n-gram by one subtraction and one multiplication. A task counts equal
fingerprints, comparing their words with those of the first occurrence, and the shuffle
adds the counts up and keeps a pointer to one occurrence. Fingerprints can only merge
phrases, so what stays below the least count is not frequent; the others are marked in a
bitmap of fixed size, and longer n-grams are looked at only where all the shorter ones
they are made of are marked. Frequent phrases alone become text: their pointers' documents
are read and the words found there hashed again. Phrases that share a fingerprint are told
apart by their words inside a task and by a second, independent hash between tasks, so
that a collision changes no count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from thumbwheel.llm.store import Scratch
from thumbwheel.llm.words import U64, mix, powers, signed
from thumbwheel.operators.skew import lookup_join

BASE = U64(0x9FB21C651E98DF25)
#: BASE times this is 1 in 64-bit arithmetic.
BASE_INVERSE = U64(pow(int(BASE), -1, 1 << 64))
LENGTH_SALT = U64(0xC2B2AE3D27D4EB4F)

#: Bytes that end a piece become 0xFF, which UTF-8 does not use; A-Z become lower case.
END = b"\xff"
TABLE = bytes(
    0xFF if b in b".,;:!?" or 0x0A <= b <= 0x0D else b + 32 if 0x41 <= b <= 0x5A else 0x20 if b == 0x09 else b
    for b in range(256)
)


@dataclass(frozen=True)
class PhraseConfig:
    longest: int = 5
    print_bits: int = 64  # of a fingerprint
    least: int = 100  # occurrences of a phrase
    absorbed: int = 100  # percent of a phrase's count that a longer one needs to replace it
    top: int = 2000
    bitmap_bits: int = 26  # slots of the bitmap of frequent fingerprints
    chunk: int = 1_000_000  # words that a task lays out at a time
    slot_bits: int = 20  # hash slots of the documents that pointers lead to
    pieces: int = 32  # of a language, for ranking
    unknown: str = "und"


class Words:
    """The words of some texts laid out one behind the other."""

    def __init__(
        self, texts: list[bytes | None], langs: list[str], docs: list[int | None], refs: np.ndarray, cfg: PhraseConfig
    ):
        rows = [(t.translate(TABLE).replace(END, b" \xff ") if t else b"").split() for t in texts]
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        flat = pa.array([w for r in rows for w in r], pa.binary()).dictionary_encode()
        del rows
        ids = flat.indices.to_numpy()
        self.vocabulary: list[bytes] = flat.dictionary.to_pylist()
        known = {lang: i for i, lang in enumerate(dict.fromkeys(langs))}
        self.langs = list(known)
        row = np.repeat(np.arange(len(sizes)), sizes)
        if END in self.vocabulary:
            ends = ids == self.vocabulary.index(END)
        else:
            ends = np.zeros(len(ids), bool)
        # A piece is a run of words without an end, of one text.
        piece = (np.cumsum(ends) + row)[~ends]
        self.ids, self.row, self.piece = ids[~ends], row[~ends], piece
        self.lang = np.array([known[x] for x in langs], np.int32)[self.row]
        self.docs, self.refs, self.mask = docs, refs, U64((1 << cfg.print_bits) - 1)
        starts = np.searchsorted(self.row, np.arange(len(sizes)))
        self.place = np.arange(len(self.ids)) - starts[self.row]
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in self.vocabulary], U64)
        seeds = np.array([xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass"), seed=1) for x in self.langs], U64)
        self.other = np.array([xxhash.xxh3_64_intdigest(w, seed=2) for w in self.vocabulary], U64)
        self.word = hashes[self.ids] if len(self.ids) else np.zeros(0, U64)
        self.seed = seeds[self.lang] if len(self.ids) else np.zeros(0, U64)
        n = len(self.ids)
        # prefix[i]: sum of word[j] * BASE ** j over j < i.
        self.prefix = np.zeros(n + 1, U64)
        np.cumsum(self.word * powers(BASE, n), out=self.prefix[1:])
        self.shift = powers(BASE_INVERSE, n)

    def __len__(self) -> int:
        return len(self.ids)

    def starts(self, n: int) -> np.ndarray:
        """Where ``n`` words of one piece begin."""
        m = len(self) - n + 1
        if m <= 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.piece[:m] == self.piece[n - 1 :])

    def prints(self, at: np.ndarray, n: int) -> np.ndarray:
        """Fingerprints of the ``n`` words and the language from each place in ``at``."""
        window = (self.prefix[at + n] - self.prefix[at]) * self.shift[at]
        return mix((window + self.seed[at]) ^ U64(int(LENGTH_SALT) * n % (1 << 64))) & self.mask

    def seconds(self, at: np.ndarray, n: int) -> np.ndarray:
        """An independent hash of the same words and language."""
        total = mix(self.seed[at] + U64(n))
        for i in range(n):
            total = mix(total ^ self.other[self.ids[at + i]])
        return total

    def groups(self, at: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Fingerprint, first occurrence and count of every distinct phrase among those at ``at``.

        Occurrences whose words differ from those of the first one with their
        fingerprint go to the next round.
        """
        while len(at):
            found, first, back, count = np.unique(
                self.prints(at, n), return_index=True, return_inverse=True, return_counts=True
            )
            head = at[first][back]
            same = self.lang[at] == self.lang[head]
            for i in range(n):
                same &= self.ids[at + i] == self.ids[head + i]
            yield found, at[first], count if same.all() else np.bincount(back[same], minlength=len(found))
            at = at[~same]


def _chunks(batches: Iterator[pa.RecordBatch], cfg: PhraseConfig) -> Iterator[Words]:
    """Texts laid out, about ``chunk`` words (at six bytes) at a time; a text is never divided."""
    for batch in batches:
        docs, langs, refs = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_numpy()
        texts = batch.column(2)
        sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1])
        part = np.cumsum(sizes.astype(np.int64)) // (6 * cfg.chunk)
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield Words(texts[a:b].to_pylist(), langs[a:b], docs[a:b], refs[a:b], cfg)


def _texts(docs: DataFrame, cfg: PhraseConfig) -> DataFrame:
    """``ref`` is where a pointer leads: the document, or the text of a row that names none."""
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))
    return docs.select(
        doc_id.alias("doc_id"),
        F.coalesce("lang", F.lit(cfg.unknown)).alias("lang"),
        text.cast("binary").alias("text"),
        F.coalesce(doc_id, F.xxhash64(text)).alias("ref"),
    )


class Bitmap:
    """A set of fingerprints as 2 ** bits marks, whatever their number; it may hold others too."""

    def __init__(self, bits: int):
        self.bits = bits
        self.marks = np.zeros(max(1, (1 << bits) >> 6), U64)

    @classmethod
    def of(cls, prints: DataFrame, bits: int) -> Bitmap:
        """Marks the column ``print``; tasks send at most one number for every 64 marks."""
        at = F.expr(f"cast(shiftright(print & {(1 << bits) - 1}L, 6) as int)").alias("at")
        marks = F.expr("bit_or(shiftleft(1L, cast(print & 63 as int)))").alias("marks")
        words = prints.groupBy(at).agg(marks).toArrow()
        out = cls(bits)
        out.marks[words.column("at").to_numpy()] = words.column("marks").to_numpy().view(U64)
        return out

    def has(self, prints: np.ndarray) -> np.ndarray:
        slot = prints & U64((1 << self.bits) - 1)
        return (self.marks[(slot >> U64(6)).astype(np.int64)] >> (slot & U64(63))) & U64(1) == 1


#: What tells phrases apart: the fingerprint and a second, independent hash of the same words.
KEY = ["print", "second"]


def _summed(counted: DataFrame, *keys: str) -> DataFrame:
    """The count of every phrase and a pointer to one occurrence."""
    return counted.groupBy(*keys, *KEY).agg(F.sum("n").alias("n"), F.min("ref").alias("ref"))


def _counted(words: Words, prints: np.ndarray, first: np.ndarray, n: np.ndarray, length: int) -> list[pa.Array]:
    """Fingerprint, count, second hash and pointer of distinct phrases."""
    refs = words.refs[words.row[first]]
    return [pa.array(x) for x in (signed(prints), n.astype(np.int64), signed(words.seconds(first, length)), refs)]


def word_counts(texts: DataFrame, cfg: PhraseConfig) -> DataFrame:
    """``lang, print`` and the counts of single words, counted in the tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _chunks(batches, cfg):
            for prints, first, n in words.groups(np.arange(len(words)), 1):
                langs = pa.DictionaryArray.from_arrays(pa.array(words.lang[first]), pa.array(words.langs, pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [langs.cast(pa.string()), *_counted(words, prints, first, n, 1)], ["lang", "print", "n", "second", "ref"]
                )

    counted = texts.mapInArrow(count, "lang string, print long, n long, second long, ref long")
    return _summed(counted, "lang")


def _possible(words: Words, n: int, shorter: Bitmap, width: int) -> np.ndarray:
    """Where ``n`` words begin whose runs of ``width`` words are all marked."""
    at = words.starts(n)
    marked = np.zeros(len(words) + 1, bool)
    runs = words.starts(width)
    marked[runs] = shorter.has(words.prints(runs, width))
    for i in range(n - width + 1):
        at = at[marked[at + i]]
    return at


def phrase_counts(texts: DataFrame, lengths: range, shorter: Bitmap, width: int, cfg: PhraseConfig) -> DataFrame:
    """``print`` and the counts of n-grams of the given ``lengths`` all of whose runs of ``width`` words are marked."""
    shared = texts.sparkSession.sparkContext.broadcast(shorter)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _chunks(batches, cfg):
            for length in lengths:
                for prints, first, n in words.groups(_possible(words, length, shared.value, width), length):
                    yield pa.RecordBatch.from_arrays(
                        _counted(words, prints, first, n, length), ["print", "n", "second", "ref"]
                    )

    return _summed(texts.mapInArrow(count, "print long, n long, second long, ref long"))


PHRASE = "lang string, phrase string, words int, doc_id long, place long, print long, second long"


def _as_text(words: Words, first: np.ndarray, length: int) -> pa.RecordBatch:
    """The phrases of ``length`` words at ``first`` in the columns of ``PHRASE``."""
    ids = words.ids[first[:, None] + np.arange(length)].tolist()
    text = [b" ".join([words.vocabulary[i] for i in row]) for row in ids]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([words.langs[i] for i in words.lang[first]], pa.string()),
            pa.array(text, pa.binary()).cast(pa.string()),
            pa.array([length] * len(first), pa.int32()),
            pa.array([words.docs[i] for i in words.row[first]], pa.int64()), pa.array(words.place[first]),
            pa.array(signed(words.prints(first, length))), pa.array(signed(words.seconds(first, length))),
        ],
        [c.split()[0] for c in PHRASE.split(", ")],
    )


def phrases_at_pointers(texts: DataFrame, found: DataFrame, cfg: PhraseConfig) -> DataFrame:
    """``lang, phrase, words, a, first``: the text of every fingerprint in ``found``, read where its pointer leads.

    Hash slots of the pointers, at most 2 ** slot_bits whatever their number, go ahead and
    spare the other texts the shuffle. A document's list is no longer than its n-grams.
    """
    slot = F.pmod(F.xxhash64("ref"), F.lit(1 << cfg.slot_bits)).alias("slot")
    near = texts.select("*", slot).join(F.broadcast(found.select(slot).distinct()), "slot", "left_semi")
    lists = found.groupBy("ref").agg(F.collect_list("print").alias("prints"))
    wanted = near.join(lists, "ref").select("doc_id", "lang", "text", "ref", "prints")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc, lang, text, ref = (batch.column(c)[i].as_py() for c in range(4))
                words = Words([text], [lang], [doc], np.array([ref]), cfg)
                prints = batch.column(4)[i].values.to_numpy().view(U64)
                for length in range(1, cfg.longest + 1):
                    at = words.starts(length)
                    at = at[np.isin(words.prints(at, length), prints)]
                    for _, first, _ in words.groups(at, length):
                        yield _as_text(words, first, length)

    # Rows that share a document's id may each have the phrase.
    once = wanted.mapInArrow(read, PHRASE).groupBy("lang", "phrase", "words", *KEY).agg(
        F.min(F.struct("doc_id", "place")).alias("first")
    )
    # What is read there has to give both hashes again.
    return once.join(found.select(*KEY, F.col("n").alias("a")), KEY).select("lang", "phrase", "words", "a", "first")


def frequent_phrases(texts: DataFrame, cfg: PhraseConfig, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases of all lengths, single words included, and ``lang, n``: the words of each language."""
    enough = F.col("n") >= cfg.least
    words = scratch.keep(word_counts(texts, cfg), "words")
    totals = scratch.keep(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    found = scratch.keep(words.where(enough).drop("lang"), "found-1")
    scratch.drop("words")
    for length, lengths in ((2, range(2, 3)), (3, range(3, cfg.longest + 1))):
        if length <= cfg.longest:
            shorter = Bitmap.of(found if length == 2 else longer, cfg.bitmap_bits)
            counts = phrase_counts(texts, lengths, shorter, length - 1, cfg)
            longer = scratch.keep(counts.where(enough), f"found-{length}")
            found = found.unionByName(longer)
    return scratch.keep(phrases_at_pointers(texts, found, cfg), "phrases"), totals


def scored_phrases(phrases: DataFrame, totals: DataFrame, cfg: PhraseConfig) -> DataFrame:
    """The lowest-scoring cut of every phrase of two words and more."""
    words = F.split("phrase", " ")
    text = lambda start, n: F.array_join(F.slice(words, start, n), " ")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cuts = phrases.where("words > 1").select("*", cut).select(
        "lang", "phrase", "words", "a", "first", "k",
        text(F.lit(1), F.col("k")).alias("left"), text(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"),
    )
    # Parts of a frequent phrase are frequent, so they are all in the table.
    part = lambda key, count: phrases.select("lang", F.col("phrase").alias(key), F.col("a").alias(count))
    sides = lookup_join(cuts, part("left", "l"), ["lang", "left"], "phrase")
    sides = lookup_join(sides, part("right", "r"), ["lang", "right"], "phrase")
    # One row per language.
    sides = sides.join(F.broadcast(totals), "lang")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    scaled = (wide("a") * 1000).cast("decimal(22,0)") * F.col("n").cast("decimal(16,0)")
    sides = sides.withColumn("top", scaled).withColumn("bottom", wide("l") * wide("r"))
    scores = sides.withColumn("score", F.expr("top div bottom"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    return (
        scores.groupBy("lang", "phrase", "words", "a", "first", "n").agg(best)
        .select("lang", "phrase", "words", "a", "best.l", "best.r", "n", "best.score", "first")
    )


def absorbed_phrases(phrases: DataFrame, cfg: PhraseConfig) -> DataFrame:
    """``lang, phrase`` of the phrases that a longer one all but replaces."""
    words = F.split("phrase", " ")
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda n: F.transform(
                F.sequence(F.lit(1), F.col("words") - n + 1), lambda i: F.array_join(F.slice(words, i, n), " ")
            ),
        )
    )
    inside = phrases.where("words > 2").select("lang", "a", F.explode(F.array_distinct(spans)).alias("phrase"))
    longer = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    own = phrases.where("words > 1").select("lang", "phrase", "a").join(longer, ["lang", "phrase"])
    return own.where(F.col("longer") * 100 >= F.col("a") * cfg.absorbed).select("lang", "phrase")


def mine_phrases(spark: SparkSession, docs: DataFrame, cfg: PhraseConfig = PhraseConfig()) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score, words, first_doc, first_word``: the best phrases of each language.

    Null texts and empty ones have no word; a null ``lang`` is ``und``. Repeated
    rows count as often as they stand there, a null ``doc_id`` counts like any
    other; ``first_doc`` and ``first_word`` are then NULL if all occurrences
    are in such rows. Ties are settled as the contract says, so ranks are
    unique. An empty table gives no rows. Other columns are not read. A task lays out
    about ``chunk`` words at a time, and never less than a whole text, at some 100 bytes a word.
    """
    scratch = Scratch(spark, "phrases")
    phrases, totals = frequent_phrases(_texts(docs, cfg), cfg, scratch)
    scored = scored_phrases(phrases, totals, cfg)
    left = scored.join(absorbed_phrases(phrases, cfg), ["lang", "phrase"], "left_anti")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranked = lambda df, by: df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*best))).where(
        F.col("rank") <= cfg.top
    )
    # A language is ranked in pieces first; what is left for its one task is at most pieces * top rows.
    pieces = ranked(left.withColumn("piece", F.pmod(F.xxhash64("phrase"), F.lit(cfg.pieces))), ["lang", "piece"])
    return ranked(pieces, ["lang"]).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score",
        F.col("words").cast("long").alias("words"),
        F.col("first.doc_id").alias("first_doc"), F.col("first.place").alias("first_word"),
    )
