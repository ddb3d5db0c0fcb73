"""Deterministic stand-ins for models, used by registered queries and tests."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd

from thumbwheel.functions.text import A_END, A_START, B_END, B_START


def echo_generator():
    """Answers every prompt by repeating it."""
    return lambda prompts: "\n Echo: " + prompts + " \t"


def _between(texts: pd.Series, start: str, end: str) -> pd.Series:
    after = texts.str.partition(f"{start}\n")[2]
    return after.str.rpartition(f"\n{end}")[0]


def length_judge():
    """Prefers the longer answer; refuses when both lengths add up to a multiple of 11."""

    def verdicts(prompts: pd.Series) -> pd.Series:
        shown = prompts.astype(object)
        a = _between(shown.str.partition(f"\n\n{B_START}\n")[0], A_START, A_END).str.len()
        b = _between(shown, B_START, B_END).str.len()
        mark = np.select([a > b, b > a], ["A", "B"], "C")
        said = "Compared lengths. The answer is [[" + pd.Series(mark, index=prompts.index) + "]] indeed"
        return said.where((a + b) % 11 != 0, "cannot say")

    return verdicts


def length_scorer():
    """Two logits from the text lengths."""

    def call(query: pd.Series, response: pd.Series) -> pd.Series:
        logits = np.stack([query.str.len() % 9 / 4, response.str.len() % 7 / 4], axis=1)
        return pd.Series(list(logits), index=query.index)

    return call


def crc_tokenizer(texts: pd.Series) -> pd.Series:
    """Word ids by checksum, as a stand-in for a subword tokenizer that works on batches."""
    return texts.str.encode("utf-8").map(lambda t: [zlib.crc32(w) % 2147483645 + 2 for w in t.split()])
