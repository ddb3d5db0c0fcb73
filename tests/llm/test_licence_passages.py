"""Licences wrapped over lines inside longer documents, and whole licences."""

import textwrap
from pathlib import Path

from thumbwheel.llm import licenses

BODIES = Path(licenses.__file__).parent / "licence_texts"


def test_wrapped_notices_and_whole_licences(spark):
    code = "\n".join(f"value{i} = compute the thing number {i} with care" for i in range(120))
    apache, mit = licenses.TEMPLATES["Apache-2.0"][1], licenses.TEMPLATES["MIT"][3]
    wrap = lambda t: "\n".join("# " + x for x in textwrap.wrap(t, 60))
    bsd, gpl = (BODIES / "BSD-2-Clause.txt").read_text(), (BODIES / "GPL-3.0.txt").read_text()
    texts = [f"{code}\n{wrap(apache)}\n\n{code}", f"{wrap(mit)}\n{code}\n{wrap(mit)}\n{code}", f"{code}\n{bsd}\n{code}", gpl, code]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted((r.doc_id, r.unit, r.last_line, r.licence, r.dice) for r in licenses.scan_licences(docs).collect())
    n_mit = len(wrap(mit).split("\n"))
    want = [
        (0, -121, 120 + len(wrap(apache).split("\n")), "Apache-2.0"), (1, -(n_mit + 121), 2 * n_mit + 120, "MIT"),
        (1, -1, n_mit, "MIT"), (2, -122 if bsd.startswith("\n") else -121, 120 + len(bsd.rstrip().split("\n")), "BSD-2-Clause"),
    ]
    passages = [r[:4] for r in rows if r[1] < 0 and r[0] < 3]
    assert passages == want and all(r[4] > 0.95 for r in rows if r[1] < 0 and r[0] < 3)
    assert (3, 0, "GPL-3.0", 1.0) in [(r[0], r[1], r[3], r[4]) for r in rows] and not [r for r in rows if r[0] == 4]


def test_key_words_after_letters_beyond_ascii(spark):
    docs = spark.createDataFrame([(1, "\u212aRELEASED under the MIT License.")], "doc_id long, text string")
    assert {r.licence for r in licenses.scan_licences(docs).collect()} == {"MIT"}
