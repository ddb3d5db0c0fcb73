"""Text functions for chat formatting, judge prompts and verdicts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything Python's ``str.strip()`` removes; Spark's ``trim`` removes only spaces.
STRIP_CHARS = "".join(c for c in map(chr, range(0x10000)) if c.isspace())

# The verdict format and the section markers of a judge prompt.
STOP_STRINGS = ("[[A]]", "[[B]]", "[[C]]")
ANSWER_PHRASE = "The answer is"
QUESTION_MARK = "[User Question]"
A_START = "[The Start of Assistant A's Answer]"
A_END = "[The End of Assistant A's Answer]"
B_START = "[The Start of Assistant B's Answer]"
B_END = "[The End of Assistant B's Answer]"

# Our own wording; a different instruction is passed as a parameter.
JUDGE_INSTRUCTION = (
    "Compare two assistant answers to the question below and decide which one serves the user "
    "better. Weigh correctness, relevance and depth; ignore length, order and names. Explain "
    'briefly, then finish with "The answer is [[A]]", "The answer is [[B]]", or '
    '"The answer is [[C]]" when they are equally good.'
)

# Class names of a thumbs label.
LABEL_NAMES = {0: "BAD", 1: "GOOD"}


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace of every kind."""
    return F.btrim(text, F.lit(STRIP_CHARS))


def model_slug(name: Column) -> Column:
    """``org/model`` as a file-safe name."""
    return F.replace(name, F.lit("/"), F.lit("_"))


def run_name(base: Column, model: Column, dataset: Column, at: Column) -> Column:
    """``base-model-dataset-stamp`` with every underscore turned into a dash."""
    joined = F.concat_ws(
        "-",
        base,
        F.substring_index(model, "/", -1),
        F.substring_index(dataset, "/", -1),
        F.date_format(at, "yyyyMMdd_HHmmss"),
    )
    return F.replace(joined, F.lit("_"), F.lit("-"))


def label_name(label: Column) -> Column:
    out = F.when(label == 0, LABEL_NAMES[0])
    return out.when(label == 1, LABEL_NAMES[1])


def label_id(name: Column) -> Column:
    return F.when(name == LABEL_NAMES[0], 0).when(name == LABEL_NAMES[1], 1)


def render_chat(
    messages: Column,
    before_role: str = "<|im_start|>",
    after_role: str = "\n",
    after_content: str = "<|im_end|>\n",
) -> Column:
    """Messages as one training string; the ChatML markers are the default template."""
    return F.array_join(
        F.transform(
            messages,
            lambda m: F.concat(
                F.lit(before_role), m["role"], F.lit(after_role), m["content"], F.lit(after_content)
            ),
        ),
        "",
    )


def render_simple_chat(messages: Column) -> Column:
    """``Role: content`` and a blank line per message."""
    return F.array_join(
        F.transform(
            messages,
            lambda m: F.concat(
                F.upper(F.substring(m["role"], 1, 1)),
                F.lower(m["role"].substr(F.lit(2), F.length(m["role"]))),
                F.lit(": "),
                m["content"],
                F.lit("\n\n"),
            ),
        ),
        "",
    )


def judge_prompt(
    question: Column, answer_a: Column, answer_b: Column, instruction: str = JUDGE_INSTRUCTION
) -> Column:
    """The judge's input. A missing part is shown as empty rather than losing the prompt."""
    part = lambda c: F.coalesce(c, F.lit(""))
    return F.concat(
        F.lit(f"{instruction}\n{QUESTION_MARK}\n"),
        part(question),
        F.lit(f"\n\n{A_START}\n"),
        part(answer_a),
        F.lit(f"\n{A_END}\n\n{B_START}\n"),
        part(answer_b),
        F.lit(f"\n{B_END}"),
    )


def cut_at_stop(text: Column, stops: Sequence[str] = STOP_STRINGS) -> Column:
    """Text up to and including the first stop string (of several at one place the first listed); unchanged without one."""
    ends = []
    for i, stop in enumerate(stops):
        at = F.locate(stop, text)
        ends.append(F.when(at > 0, F.struct(at.alias("at"), F.lit(i).alias("i"), F.lit(len(stop)).alias("n"))))
    first = F.least(*ends) if len(ends) > 1 else ends[0]
    return F.coalesce(F.substring(text, F.lit(1), first["at"] + first["n"] - 1), text)


# The marks of a verdict.
VERDICT_MARKS = {"[[A]]": "A", "[[B]]": "B", "[[C]]": "C"}


def parse_verdict(text: Column, phrase: str = ANSWER_PHRASE) -> Column:
    """A, B or C if the stripped text after the last phrase starts with its mark, else ``error``."""
    tail = F.substring_index(text, phrase, -1)
    mark = F.substring(F.ltrim(tail, F.lit(STRIP_CHARS)), 1, 5)
    return F.coalesce(F.try_element_at(_constant_map(VERDICT_MARKS), mark), F.lit("error"))


def verdict_winner(verdict: Column) -> Column:
    """0 when A won, 1 when B won; ties and unparsed verdicts are NULL."""
    return F.try_element_at(_constant_map({"A": 0, "B": 1}), verdict)


def _constant_map(entries: Mapping[str, str | int]) -> Column:
    """A literal map.

    A lookup names its argument once; a CASE repeats it per branch, and in a
    filter each repetition is evaluated again.
    """
    return F.create_map(*(F.lit(x) for item in entries.items() for x in item))


def seeded_bit(key: Column, seed: int) -> Column:
    """A reproducible coin per key, independent of partitioning."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.substring(digest, 1, 1) < F.lit("8")
