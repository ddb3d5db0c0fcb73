"""Licence scans: normalised text against templates by the Dice coefficient of word bigrams.

Units are every line of a document, its whole text and passages of several
lines. A unit is only compared with templates whose size lets the coefficient
reach the threshold: with a and b distinct bigrams it is at most
2 * min(a, b) / (a + b). A unit that reaches it shares a part of the template
that cannot do without certain words, so texts with none of them are not read
further. The templates, notices and whole licences, are a fixed list inside
the plan; only the passages found meet again by document.
"""

from __future__ import annotations

from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Notices and short texts of widely used licences.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", "
        "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
        "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
        "OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, "
        "or (at your option) any later version.",
    ),
    "LGPL-2.1": ("This library is licensed under the GNU Lesser General Public License, version 2.1.",),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
        "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.",),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License.",),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0-1.0": ("Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "All-rights-reserved": ("All rights reserved.",),
}

MIN_DICE_PERCENT = 80
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised_words(text: str) -> list[str]:
    """ASCII letters in lower case and digits; anything else separates words."""
    kept = "".join(c if c.isascii() and c.isalnum() else " " for c in text).lower()
    return kept.split()


def template_bigrams() -> list[tuple[str, int, list[str]]]:
    """Licence, number of the template within it, and its distinct word bigrams."""
    out = []
    for licence, texts in TEMPLATES.items():
        for i, text in enumerate(texts):
            words = normalised_words(text)
            out.append((licence, i, sorted({f"{a} {b}" for a, b in zip(words, words[1:])})))
    return out


def body_bigrams() -> list[tuple[str, int, list[str]]]:
    """The same of whole licences, numbered after the notices of theirs."""
    out = []
    for path in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")):
        words = normalised_words(path.read_text())
        grams = sorted({f"{a} {b}" for a, b in zip(words, words[1:])})
        out.append((path.stem, len(TEMPLATES.get(path.stem, ())), grams))
    return out


def key_words(templates: list[tuple[str, int, list[str]]], min_percent: int) -> list[str]:
    """Words of which every unit that reaches ``min_percent`` of a template has one.

    Such a unit shares at least min / (200 - min) of the template's bigrams; bigrams
    without a key word are fewer than that.
    """
    chosen: set[str] = set()
    while True:
        gains: Counter[str] = Counter()
        for _, _, grams in templates:
            left = [set(g.split()) for g in grams]
            left = [g for g in left if not chosen & g]
            if left and len(left) * (200 - min_percent) >= len(grams) * min_percent:
                for word, n in Counter(w for g in left for w in g).items():
                    gains[word] += n / len(grams)
        if not gains:
            return sorted(chosen)
        # Long words are rarer in other texts.
        chosen.add(max(gains, key=lambda w: (len(w) > 5, gains[w], w)))


def _pattern(words: list[str]) -> str:
    """Matches where one of ``words`` starts, A-Z as a-z; tried at starts of words only, by their first letter."""
    heads = sorted({w[0] for w in words})
    return "(?i)(?<![a-z0-9])(?:" + "|".join(
        h + "(?:" + "|".join(w[1:] for w in words if w[0] == h) + ")" for h in heads
    ) + ")"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, _UPPER, _LOWER), "[^a-z0-9]+"), lambda w: w != "")


def _pairs(words: Column) -> Column:
    following = F.slice(words, 2, F.greatest(F.size(words), F.lit(1)))
    pairs = F.zip_with(words, following, lambda a, b: F.concat(a, F.lit(" "), b))  # the last is null
    return F.filter(pairs, lambda p: p.isNotNull())


def bigrams(text: Column) -> Column:
    return F.array_distinct(_pairs(_words(text)))


def _once(value: Column) -> Column:
    """A generator of one row: what follows reads the value instead of building it again."""
    return F.explode(F.array(value))


def _passages(docs: DataFrame, known: Column, min_percent: int) -> DataFrame:
    """``row, doc_id, unit, last_line, unit_text`` of runs of lines that reach a template.

    A line is strong for a template if its bigrams alone, with the one that leads
    into it, lift the coefficient. A passage starts where strong lines start and
    ends where some end: more or fewer lines only lower it. Lines that reach the
    template by themselves are in no passage; blank lines do not count.
    """
    numbered = F.transform(
        F.split("text", "\n"), lambda x, i: F.struct((i + 1).alias("no"), x.alias("line"), _words(x).alias("w"))
    )
    lines = docs.select("row", "doc_id", _once(F.filter(numbered, lambda x: F.size(x["w"]) > 0)).alias("lines"))
    before = lambda i: F.get("lines", i - 1)["w"]
    lead = lambda i: F.when(i > 0, F.slice(before(i), -1, 1)).otherwise(F.array().cast("array<string>"))
    grams = F.transform(
        "lines", lambda x, i: F.struct(_pairs(F.concat(lead(i), x["w"])).alias("led"), _pairs(x["w"]).alias("own"))
    )
    paired = lines.where(F.size("lines") > 1).select("row", "doc_id", "lines", _once(grams).alias("grams"))
    all_grams = F.array_distinct(F.flatten(F.transform("grams", lambda x: x["led"])))
    held = paired.select("*", _once(all_grams).alias("all_grams"))
    possible = F.filter(
        known,
        lambda t: F.size(F.array_intersect(t["grams"], F.col("all_grams"))) * (200 - min_percent) >= t["n"] * min_percent,
    )
    tried = held.select("row", "doc_id", "lines", "grams", F.explode(possible).alias("t"))
    t = F.col("t")
    shared = lambda g: F.size(F.array_intersect(g, t["grams"]))
    whole = lambda g: shared(g) * 200 >= (F.size(F.array_distinct(g)) + t["n"]) * min_percent
    marks = F.transform(
        "grams",
        lambda x: F.struct(
            whole(x["own"]).alias("whole"), (shared(x["led"]) * 200 > F.size(x["led"]) * min_percent).alias("lifts")
        ),
    )
    marked = tried.select("*", _once(marks).alias("marks"))
    strong = lambda i: F.coalesce(F.get("marks", i)["lifts"] & ~F.get("marks", i)["whole"], F.lit(False))
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    bounds = marked.select(
        "*", _once(F.filter(places, lambda i: strong(i) & ~strong(i - 1))).alias("starts"),
    ).select("*", _once(F.filter(places, lambda i: strong(i) & ~strong(i + 1))).alias("ends"))
    free = lambda a, b: (
        (b > a) & (b - a + 1 < F.size("lines")) & ~F.exists(F.slice("marks", a + 1, b - a + 1), lambda m: m["whole"])
    )
    windows = F.flatten(F.transform("starts", lambda a: F.transform(
        F.filter("ends", lambda b: free(a, b)), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    part = lambda w: F.concat(
        F.get("grams", w["a"])["own"],
        F.flatten(F.transform(F.slice("grams", w["a"] + 2, w["b"] - w["a"]), lambda x: x["led"])),
    )
    found = bounds.select("row", "doc_id", "lines", F.explode(F.filter(windows, lambda w: whole(part(w)))).alias("w"))
    inside = F.slice("lines", F.col("w.a") + 1, F.col("w.b") - F.col("w.a") + 1)
    return found.select(
        "row", "doc_id", (-F.get("lines", F.col("w.a"))["no"]).cast("long").alias("unit"),
        F.get("lines", F.col("w.b"))["no"].cast("long").alias("last_line"),
        F.array_join(F.transform(inside, lambda x: x["line"]), "\n").alias("unit_text"),
    )


def _best_passages(matched: DataFrame) -> DataFrame:
    """Of overlapping passages of a document, those that no better one makes needless."""
    fields = [c for c in matched.columns if c not in ("row", "doc_id")]
    order = F.struct((-F.col("dice")).alias("order"), *fields)
    grouped = matched.groupBy("row", "doc_id").agg(F.collect_set(order).alias("all"))
    meets = lambda v, w: (-v["unit"] <= w["last_line"]) & (-w["unit"] <= v["last_line"])
    first = F.filter("all", lambda w: ~F.exists("all", lambda v: (v < w) & meets(v, w)))
    ranked = grouped.select("doc_id", "all", _once(first).alias("first"))
    # Only what meets a best passage goes, so that nothing is lost to a passage that goes itself.
    kept = F.filter("all", lambda w: ~F.exists("first", lambda v: (v < w) & meets(v, w)))
    return ranked.select("doc_id", F.explode(kept).alias("w")).select("doc_id", *(F.col("w")[c].alias(c) for c in fields))


def scan_licences(docs: DataFrame, min_percent: int = MIN_DICE_PERCENT) -> DataFrame:
    """The best template of every unit that reaches ``min_percent``; one row per such unit.

    Columns: doc_id, unit (0 the whole text, a line by its number, a passage by
    its first line's number below zero), licence, template (whole licences are
    numbered after the notices), n_shared, n_bigrams, n_template, dice, last_line
    (of the unit; null for the whole text). Equal coefficients go to the first licence by name,
    then template. Null and empty texts and units of one word give no row;
    repeated rows give repeated results; other columns are not read. A document
    of one line is judged as its whole text and as line 1.
    """
    templates = template_bigrams() + body_bigrams()
    known = F.array(
        *(
            F.struct(
                F.lit(licence).alias("licence"), F.lit(number).alias("template"),
                F.lit(len(grams)).alias("n"), F.split(F.lit("|".join(grams)), r"\|").alias("grams"),
            )
            for licence, number, grams in templates
        )
    )
    texts = docs.where(F.col("text").rlike(_pattern(key_words(templates, min_percent)))).select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    units = texts.select(
        "row", "doc_id", F.posexplode(F.concat(F.array("text"), F.split("text", "\n"))).alias("unit", "unit_text")
    ).select(
        "row", "doc_id", F.col("unit").cast("long").alias("unit"),
        F.when(F.col("unit") > 0, F.col("unit")).cast("long").alias("last_line"), "unit_text",
    )
    columns = ["doc_id", "unit", "licence", "template", "n_shared", "n_bigrams", "n_template", "dice", "last_line"]
    passages = _best_passages(_matches(_passages(texts, known, min_percent), known, templates, min_percent))
    return _matches(units, known, templates, min_percent).select(*columns).unionByName(passages.select(*columns))


def _matches(units: DataFrame, known: Column, templates: list, min_percent: int) -> DataFrame:
    sizes = [len(grams) for _, _, grams in templates]
    # Generators, not filters: a filter would be pushed below the projection
    # that builds the bigrams and build them twice.
    possible = lambda g: (
        (F.size(g) * (200 - min_percent) >= min(sizes) * min_percent)
        & (F.size(g) * min_percent <= max(sizes) * (200 - min_percent))
    )
    sized = units.select(
        "row", "doc_id", "unit", "last_line",
        F.explode(F.filter(F.array(bigrams(F.col("unit_text"))), possible)).alias("grams"),
    ).withColumn("n_bigrams", F.size("grams").cast("long"))
    n = F.col("n_bigrams")
    fits = lambda t: F.least(n, t["n"]) * 200 >= (n + t["n"]) * min_percent
    shared = F.transform(
        F.filter(known, fits),
        lambda t: F.struct(
            t["licence"].alias("licence"), t["template"].cast("long").alias("template"),
            t["n"].cast("long").alias("n_template"),
            F.size(F.array_intersect(F.col("grams"), t["grams"])).cast("long").alias("n_shared"),
        ),
    )
    reaching = F.filter(shared, lambda t: t["n_shared"] * 200 >= (n + t["n_template"]) * min_percent)
    ranked = F.transform(
        reaching,
        lambda t: F.struct(
            (F.lit(-2.0) * t["n_shared"] / (n + t["n_template"])).alias("order"),
            t["licence"].alias("licence"), t["template"].alias("template"),
            t["n_shared"].alias("n_shared"), t["n_template"].alias("n_template"),
        ),
    )
    best = F.explode(F.filter(F.array(F.array_min(ranked)), lambda b: b.isNotNull()))
    return sized.select("row", "doc_id", "unit", "last_line", "n_bigrams", best.alias("best")).select(
        "row", "doc_id", "unit", "last_line", "best.licence", "best.template", "best.n_shared", "n_bigrams", "best.n_template",
        (-F.col("best.order")).alias("dice"),
    )


def oracle(min_percent: int = MIN_DICE_PERCENT) -> str:
    """The same rows in DuckDB SQL, bigram by bigram."""
    grams = ", ".join(
        f"('{licence}', {number}, {len(g)}, '{x}')" for licence, number, g in template_bigrams() for x in g
    )
    return f"""
    with templates(licence, template, n_template, gram) as (values {grams}),
    units as (
      select doc_id, 0 unit, text u from documents where text is not null
      union all
      select doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) unit,
             unnest(string_split(text, chr(10))) u from documents where text is not null),
    worded as (select doc_id, unit, list_filter(string_split_regex(translate(u, '{_UPPER}', '{_LOWER}'),
               '[^a-z0-9]+'), lambda w: w <> '') w from units),
    grams as (select distinct doc_id, unit, unnest(list_transform(range(1, len(w)),
              lambda i: w[i] || ' ' || w[i + 1])) gram from worded),
    sizes as (select doc_id, unit, count(*) n_bigrams from grams group by all),
    shared as (select doc_id, unit, licence, template, n_template, count(*) n_shared
               from grams join templates using (gram) group by all),
    scored as (select *, 2.0::double * n_shared / (n_bigrams + n_template) dice
               from shared join sizes using (doc_id, unit)
               where n_shared * 200 >= (n_bigrams + n_template) * {min_percent})
    select doc_id, unit, licence, template::bigint template, n_shared, n_bigrams, n_template::bigint n_template, dice
    from scored
    qualify row_number() over (partition by doc_id, unit order by dice desc, licence, template) = 1
    """
