"""Quality rules, toxicity, HTML extraction and licence scans on small hand-made tables."""

import re
import zlib

import pytest

from thumbwheel.llm import licenses, quality, toxicity
from thumbwheel.llm.html_text import extract_pages, main_text

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
RULES = quality.QualityRules()


def brute_figures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, repeated_lines = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated_lines += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in range(i, i + 5)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, repeated_lines, len(covered)


@pytest.mark.parametrize(
    "text",
    [
        None, "", " \n\t", "one", "a b c d e a b c d e", "x\nx\n x\nx", "é#$ ü\x85ö   z\x0bq",
        "a a a a a a a", "to be or not to be or not to be", "line\n\nline\n \n \nline" * 3,
    ],
)
def test_base_figures(text):
    assert quality.base_figures(text, RULES) == brute_figures(text)


def test_quality_over_edge_rows(spark):
    good = "the quick brown fox jumps over the lazy dog and runs far away today"
    junk = "#### $$$$ %%%% **** #### &&&& $$$$ |||| %%%% **** #### $$$$ %%%% ****"
    rows = [(i, f"{good} number {i}", "en", "s", 1) for i in range(60)]
    rows += [(100 + i, f"{junk} {i}", "en", "s", 1) for i in range(60)]
    rows += [(None, good, None, None, None), (200, None, None, None, None), (201, "", "en", "s", 0), (0, rows[0][1], "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(0, 1, 0), (None, 1, 0), (5, None, None)], LABELS)
    out = quality.quality_verdicts(docs, labels).collect()
    assert len(out) == len(rows)
    kept = {r.doc_id: r.kept for r in out}
    assert all(kept[i] for i in range(60)) and not any(kept[100 + i] for i in range(60))
    assert not kept[200] and not kept[201] and kept[None]
    none = quality.quality_verdicts(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.0}
    assert quality.quality_verdicts(docs.limit(0), labels).count() == 0


def test_quality_carries_columns_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a " * 12, "kept", 0.5)], "doc_id long, text string, kept string, score double")
    labels = spark.createDataFrame([], LABELS)
    assert quality.quality_verdicts(docs, labels).columns[:2] == ["doc_id", "n_words"]
    assert quality.quality_verdicts(docs.drop("score", "kept"), labels, carry=["text"]).first()["text"] == "a " * 12


def test_toxicity_learns_and_holds_out(spark):
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        rows.append((i, f"plain words about topic {i % 37} " + ("you horrible nitwit " if bad else "") + "and more words"))
        labels.append((i, 1, int(bad)))
    rows += [(1000, None), (1001, ""), (None, "you horrible nitwit"), (0, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = toxicity.classify_toxicity(spark, docs, spark.createDataFrame(labels, LABELS)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if r.doc_id is not None and r.doc_id < 600:
            assert r.predicted == int(r.doc_id % 4 == 0)
    assert [r.predicted for r in out if r.doc_id is None] == [1]


def test_toxicity_never_learns_from_held_out_rows(spark):
    ids = [i for i in range(300) if zlib.crc32(str(i).encode()) % 3 == 1]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in ids], LABELS)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(300)], "doc_id long, text string")
    assert len({r.score for r in toxicity.classify_toxicity(spark, docs, labels).collect()}) == 1
    assert toxicity.classify_toxicity(spark, docs.limit(0), labels.limit(0)).count() == 0


PAGES = {
    "<html><body><nav><a href=1>Home</a></nav><article><h1>T &amp; U</h1><p>One <i>bo</i>dy\n text.<p>Two</article>"
    "<footer>f</footer></body></html>": "T & U One body text. Two",
    "<article><p>a<script>var x='<p>no</p>'</script>b</p><aside>s</aside><form>f</form><p>c</article>": "ab c",
    "<body><div class='cookie-notice'>We use cookies</div><div id=main><p>Long enough paragraph of text here.</p>"
    "<p>And one more.</p></div><div class=sidebar>links</div>": "Long enough paragraph of text here. And one more.",
    "<article><p>x</p><section class='comments'><p>Great post, thank you so much</p></section></article>": "x",
    "<p>cut off &am": "cut off &am", "just text": "just text", "a < b and c > d": "a < b and c > d",
    "": "", None: "", "<!-- only -->": "", "<article><p>a<br>b</p><ul><li>c<li>d</ul></article>": "a b c d",
    "<article><!-- <p>no</p> --><p title='a>b'>yes</p></article": "yes",
    "<article>" + "<div>" * 300 + "deep" + "</div>" * 300 + "</article>": "deep",
}


@pytest.mark.parametrize("source", list(PAGES), ids=range(len(PAGES)))
def test_main_text(source):
    assert main_text(source) == PAGES[source]


def test_extraction_equals_the_article_of_every_given_page(spark, sf_dir):
    import html

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in extract_pages(pages.withColumn("text", pages.url)).collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", source[r.page_id], re.S)[1]
        plain = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", " ", inner))
        assert r.text == " ".join(html.unescape(plain).split()) and r.n_chars == len(r.text)
    assert extract_pages(pages.limit(0)).count() == 0


def brute_licences(text):
    found = []
    for unit, part in enumerate([text, *text.split("\n")]):
        words = re.findall("[a-z0-9]+", re.sub("[^A-Za-z0-9]", " ", part).lower())
        grams = {" ".join(p) for p in zip(words, words[1:])}
        scored = [
            (-200 * len(grams & set(g)) / (len(grams) + len(g)), name, number)
            for name, number, g in licenses.template_bigrams()
            if 200 * len(grams & set(g)) >= 80 * (len(grams) + len(g))
        ]
        if scored:
            best = min(scored)
            found.append((unit, best[1], best[2]))
    return found


def test_licences_against_brute_force(spark):
    mit = licenses.TEMPLATES["MIT"][3]
    texts = [
        "Some text\nReleased under the MIT License.\nAll rights reserved.", mit, mit.replace("Software", "Work"),
        "", None, "MIT", "licensed under cc by nc 4 0", "All rights reserved" * 3, "x\n" * 50, "All Rights\nReserved.",
        "Licensed under the Apache License, Version 2.0 (the \"License\")",
    ]
    docs = spark.createDataFrame([(i, t, "unit") for i, t in enumerate([*texts, texts[0]])], "doc_id long, text string, unit string")
    got = sorted((r.doc_id, r.unit, r.licence, r.template) for r in licenses.scan_licences(docs).collect())
    want = sorted((i, *f) for i, t in enumerate([*texts, texts[0]]) if t for f in brute_licences(t))
    assert got == want and len(want) > 6
    assert licenses.scan_licences(docs.limit(0)).count() == 0
