"""Text density against a plain recursion, and what article elements change."""

import math
import random
import time

import pytest

from thumbwheel.llm import html_text
from thumbwheel.llm.html_text import main_text

P = "<p>" + "several words of an ordinary paragraph. " * 4 + "{}</p>"


@pytest.mark.parametrize("page,inside,outside", [
    # Sibling articles are one text, wherever the densest node lies.
    (f"<body><article>{P}{P}one</article><article>{P}two</article><nav>menu</nav></body>", ["one", "two"], ["menu"]),
    (f"<body><article>{P}one</article><div>{P}{P}{P}{P}{P}two</div></body>", ["one", "two"], []),
    (f"<main><div><article>{P}one</article></div><div><article>{P}two</article></div></main>", ["one", "two"], []),
    # Comments are none of it, even as articles of their own.
    (f"<body><article>{P}one</article><section class=comments><article class=comment>{P}hey</article></section></body>", ["one"], ["hey"]),
    (f"<body><article>{P}one<div id=comments><article class=comment>{P}hey</article></div></article></body>", ["one"], ["hey"]),
    # A page's only article is kept whatever it is called.
    (f"<body><article class='post with-sidebar'>{P}one</article></body>", ["one"], []),
    # Without any such element the threshold decides.
    (f"<body><div><div>{P}{P}one</div><div>{P}two</div></div><ul>{'<li><a href=x>link</a>' * 20}</ul></body>", ["one", "two"], ["link"]),
])
def test_what_is_chosen(page, inside, outside):
    text = main_text(page.replace("{}", ""))
    assert all(x in text.split() for x in inside) and not any(x in text for x in outside)


def plain_density(page, out, v, share, sums):
    inside = [w for w in range(v, page.last[v] + 1) if not out[w]]
    texts = [(len("".join(p.split())), linked) for n, p, linked in page.pieces if p and n in set(inside)]
    c, lc = sum(s for s, _ in texts), sum(s for s, linked in texts if linked)
    if out[v] or not c:
        return 0.0
    links = sum(n in set(inside) for n in page.links)
    tags = max(len(inside) - 1 + links, 1)
    base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
    ratio = max(c / max(lc, 1) * tags / max(links, 1), 1.0)
    return c / tags * (math.log(ratio) / math.log(base) if base > 1 else math.log(ratio))


@pytest.mark.parametrize("seed", range(6))
def test_densities_are_those_of_a_plain_recursion(seed):
    rng = random.Random(seed)

    def tree(depth):
        if depth == 0 or rng.random() < 0.2:
            word = "w" * rng.randrange(1, 9)
            return rng.choice([word + " ", f"<a href=x>{word}</a> ", f"<i>{word}</i>"])
        tag = rng.choice(["div", "section", "nav", "ul", "article"])
        return f"<{tag}>" + "".join(tree(depth - 1) for _ in range(rng.randrange(1, 5))) + f"</{tag}>"

    page = html_text.parse("<body>" + "".join(tree(4) for _ in range(3)) + "</body>")
    out = html_text._boilerplate(page)
    density, total = html_text.densities(page, out)
    kept = [(len("".join(p.split())), linked) for n, p, linked in page.pieces if p and not out[n]]
    share = sum(s for s, linked in kept if linked) / max(sum(s for s, _ in kept), 1)
    want = [plain_density(page, out, v, share, total) for v in range(len(page.tag))]
    assert density == pytest.approx(want)
    for v in range(len(page.tag)):
        assert total[v] == pytest.approx(sum(want[w] for w in range(1, len(want)) if page.parent[w] == v))


@pytest.mark.parametrize("page", [
    "<div>" * 60_000 + "x", "<b>" * 30_000 + "<p>x" * 30_000, "<div>" * 20_000 + "</span>" * 20_000 + "x",
    "<article>" + P * 20_000 + "</article>",
], ids=["blocks", "inline", "stray ends", "long text"])
def test_deep_and_long_pages_take_time_in_proportion(page):
    start = time.perf_counter()
    assert "x" in main_text(page) + "x"
    assert time.perf_counter() - start < 20
