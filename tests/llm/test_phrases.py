"""Phrase mining against counting everything in Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from thumbwheel.llm import phrases
from thumbwheel.llm.phrases import PhraseConfig, mine_phrases

SCHEMA = "doc_id long, text string, lang string, phrase int, n string"


def pieces(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split("[.,;:!?\n\x0b\x0c\r]", low)]


def plain(rows, cfg):
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            totals[lang] += len(words)
            for k in range(1, cfg.longest + 1):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    frequent = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= cfg.least}
    out = {}
    for (lang, p), a in frequent.items():
        if any(
            b * 100 >= cfg.absorbed * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            for (other, q), b in frequent.items() if other == lang and len(q) > len(p)
        ):
            continue
        sides = [(k, counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p))]
        score, _, l, r = min((1000 * a * totals[lang] // (l * r), k, l, r) for k, l, r in sides)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, totals[lang], -s)
        for lang, xs in out.items() for rank, (s, a, p, l, r) in enumerate(sorted(xs)[: cfg.top], 1)
    )


def mined(spark, rows, cfg):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(5)
    found = mine_phrases(spark, df, cfg).collect()
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found)


def corpus(n=120):
    rng = random.Random(3)
    words = ["the", "The", "of", "new", "york", "city", "état", "ß", "a\x00b", "x\u00a0y", "don't", "#", "\x85", "z"]
    ends = [" ", " ", "  ", "\t", ", ", ".", "!?", "\n", "\r\n", " ; ", ":", "\x0b"]
    rows = [(i, "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randrange(60))), rng.choice(["en", "de", None])) for i in range(n)]
    rows += [(1000 + i, "One two three four five six", "en") for i in range(9)]
    return rows + [(5, None, "en"), (6, "", None), (None, "new york city new york city", "en"), (None, " ,.\n", None), rows[3], (7, "solo", "")]


@pytest.mark.parametrize("cfg", [
    PhraseConfig(least=4, top=50, bitmap_bits=20, pieces=3),
    PhraseConfig(least=4, top=7, bitmap_bits=6, chunk=20),
    PhraseConfig(least=2, top=10_000, longest=3, absorbed=60, chunk=1),
])
def test_like_counting_everything(spark, cfg):
    rows = corpus()
    assert mined(spark, rows, cfg) == plain(rows, cfg)


def test_occurrences_that_share_a_fingerprint_part_in_their_batch():
    rows, cfg = corpus(30), PhraseConfig(print_bits=2)
    words = phrases.Words([r[1].encode() if r[1] else None for r in rows], ["en"] * len(rows), [r[0] for r in rows], np.arange(len(rows)), cfg)
    at = words.starts(2)
    counted = Counter()
    for _, first, n in words.groups(at, 2):
        counted.update({tuple(words.ids[f : f + 2]): int(c) for f, c in zip(first, n)})
    assert counted == Counter(tuple(words.ids[i : i + 2]) for i in at)


@pytest.mark.parametrize("bits", [2, 5, 9])
def test_phrases_that_share_a_fingerprint_are_told_apart(spark, bits):
    rows, cfg = corpus(), PhraseConfig(least=4, bitmap_bits=8, print_bits=bits)
    assert mined(spark, rows, cfg) == plain(rows, cfg)


def test_prefix_polynomials_hash_words_wherever_they_stand():
    words = phrases.Words([b"a b c d a b c", None, b"b c"], ["en", "en", "de"], [1, 2, 3], np.arange(3), PhraseConfig())
    three = words.prints(np.array([0, 4]), 3)
    assert three[0] == three[1] and words.prints(np.array([1]), 2) != words.prints(np.array([7]), 2)
    assert words.starts(3).tolist() == [0, 1, 2, 3, 4] and words.place.tolist() == [0, 1, 2, 3, 4, 5, 6, 0, 1]


def test_first_occurrences_and_empty_table(spark):
    rows = [(9, "x. big cat", "en"), (3, "a big cat", "en"), (None, "big cat", "en")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    (row,) = mine_phrases(spark, df, PhraseConfig(least=2)).collect()
    assert (row.phrase, row.a, row.first_word in (0, 1)) == ("big cat", 3, True)
    assert mine_phrases(spark, df.limit(0)).count() == 0


def test_counts_beyond_64_bits(spark):
    """Products of counts are whole numbers of up to 38 digits."""
    big = 3_000_000_000
    table = [("en", "a b", 2, big, (1, 1)), ("en", "a", 1, big + 7, (1, 1)), ("en", "b", 1, big + 1, (1, 1))]
    df = spark.createDataFrame(table, "lang string, phrase string, words int, a long, first struct<doc_id: long, place: long>")
    totals = spark.createDataFrame([("en", 10**13)], "lang string, n long")
    (row,) = phrases.scored_phrases(df, totals, PhraseConfig()).collect()
    assert row.score == 1000 * big * 10**13 // ((big + 7) * (big + 1))
