"""Extraction as a whole: against a plain version on generated trees, on comments of other themes, and on
pages that are nested very deep."""

import itertools
import random
import time

import numpy as np
import pytest

from kerbsight.llm import html_extract as H

SF = "/root/testdata/sf0.001"
PROSE = ["The river had been low all summer, and the stones showed their backs like sleeping animals.", "Nobody in the village remembered such a year, although the old men, as ever, claimed to."]


@pytest.fixture(scope="module")
def extractor(spark):
    return H.Extractor(H.train(spark.read.parquet(f"{SF}/pages.parquet")))


def generate(r, depth=0):
    """A tree of (element, class, children); leaves are texts."""
    if depth > 4 or (depth > 1 and r.random() < 0.4):
        n = r.choice([1, 2, 3, 9, 25])
        words = " ".join(r.choice(["stone", "river", "Home", "low", "year,", "all"]) for _ in range(n))
        return words + r.choice(["", ".", "."])
    name = r.choice(["div", "section", "p" if depth > 2 else "div", "article", "nav", "aside", "header", "main", "blockquote"])
    kind = r.choice(["", "", "", "sidebar", "post has-sidebar", "story", "cookie-notice", "related-work"])
    if name == "p":
        return (name, kind, [generate(r, 9)])
    return (name, kind, [generate(r, depth + 1) for _ in range(r.choice([1, 2, 3]))])


def spell(node):
    if isinstance(node, str):
        return f" {node} "
    return f"<{node[0]}{f' class={node[1]!r}' if node[1] else ''}>{''.join(map(spell, node[2]))}</{node[0]}>"


def plain_blocks(tree):
    """(text, path): path is a list of (element, class, number) from the outside in."""
    out, number, open_text = [], itertools.count(1), []

    def flush(path):
        if open_text:
            out.append((" ".join(" ".join(open_text).split()), list(path)))
            open_text.clear()

    def walk(node, path):
        if isinstance(node, str):
            open_text.append(node)
            return
        flush(path)
        inner = [*path, (node[0], node[1], next(number))]
        for child in node[2]:
            walk(child, inner)
        flush(inner)

    walk(tree, [])
    return out


def plain_evidence(blocks):
    words = lambda e, c: [w for t in c.split() if t.split("-")[0] != "has" for w in (t.split("-")[-1:] if e == "p" else t.split("-")) if w in H.NAMED]
    size, total = {}, sum(len(t) for t, _ in blocks)
    for t, path in blocks:
        for e in path:
            size[e] = size.get(e, 0) + len(t)
    mains = [e for e in size if e[0] in H.CONTENT]
    main = max(mains, key=lambda e: (size[e], e[2])) if mains else None
    if main:
        around = next(path[: path.index(main) + 1] for _, path in blocks if main in path)
        outside = -H.OUTSIDE if 3 * size[main] >= total else 0.0
    else:
        around, outside = [e for e in size if 10 * size[e] >= 9 * total], 0.0
    out = []
    for _, path in blocks:
        value = outside
        for i, e in enumerate(path):
            if e[0] in H.NEVER or (e[0] == "header" and main not in path[:i]):
                value = -H.NEVER_WEIGHT
                break
            if e == main:
                value = H.MAIN
            elif words(e[0], e[1]) and e not in around:
                value = -H.NAME
        out.append(value)
    return out


def plain_edges(blocks):
    out = []
    for i, (_, p) in enumerate(blocks):
        before = [j for j in range(i) if blocks[j][1][:-1] == p[:-1]]
        for j in {*([i - 1] if i else []), *before[-1:]}:
            q = blocks[j][1]
            k = next((k for k in range(min(len(p), len(q))) if p[k] != q[k]), min(len(p), len(q)))
            out.append((j, i, H.EDGE * (k + 1) / (max(len(p), len(q)) + 1)))
    return out


def test_extraction_by_brute_force(extractor):
    """Blocks, evidence, capacities, edges and the cheapest of all labellings, each in its plain form."""
    r, cuts = random.Random(11), 0
    for _ in range(400):
        tree = generate(r)
        page = spell(tree)
        want = plain_blocks(tree)
        got = H.blocks_of(page)
        assert [b.text for b in got] == [t for t, _ in want], page
        if not 0 < len(want) <= 11 or H.comment_lists(got, H.main_element(got)):
            continue  # lists of comments have tests of their own
        score = [float(np.clip(extractor.odds[H.key_of(b)], -H.MOST_TEXT, H.MOST_TEXT)) + e for b, e in zip(got, plain_evidence(want))]
        assert extractor.scores(got) == pytest.approx(score), page
        edges = plain_edges(want)
        assert np.allclose(sorted(H.edges_of(got)), sorted(edges))
        cost = lambda x: sum(max(0, -s if on else s) for s, on in zip(score, x)) + sum(c for a, b, c in edges if x[a] != x[b])
        labels = extractor.labels(got)
        assert cost(labels) == pytest.approx(min(map(cost, itertools.product((False, True), repeat=len(want))))), page
        assert extractor.text(page) == "\n\n".join(t for (t, _), on in zip(want, labels) if on)
        cuts += labels != [s > 0 for s in score]
    assert cuts > 10


ARTICLE = f"<h1>A head</h1><p>{PROSE[0]}</p><p>{PROSE[1]}</p>"
SAID = ["I liked this very much, thank you for writing it down for all of us to read.", "Not so sure about the stones, but the old men are well observed indeed."]


@pytest.mark.parametrize(
    "page",
    [
        # beside the article, as prose without a date or a name
        "<body><article>{a}</article><section class=replies><h2>Replies</h2><p>{0}</p><p>{1}</p></section></body>",
        "<body><article>{a}</article><div class=box><p>{0}</p><p>{1}</p></div></body>",
        # in the article, signed
        "<body><article>{a}<section id=discussion><div class=entry><div>Ann Miller</div><p>{0}</p></div><div class=entry><div>Bo</div><p>{1}</p></div></section></article></body>",
        "<body><main>{a}<ol class=responses><li>{0}<li>{1}</ol></main></body>",
        "<body><main>{a}<ul><li><div>Ann, 3 hours ago</div><p>{0}</p><li><div>Bo, 12:45</div><p>{1}</p></ul></main></body>",
        "<body><main>{a}<div><article><p>Ann Miller on 4 May 2021</p><p>{0}</p></article><article><p>Bo on 5 May 2021</p><p>{1}</p></article></div></main></body>",
        "<body><div>{a}<div id=thread><div><p>Ann</p><p>{0} {1}</p></div></div></div></body>",
    ],
)
def test_reader_comments_go(extractor, page):
    assert extractor.text(page.format(*SAID, a=ARTICLE)) == "A head\n\n" + "\n\n".join(PROSE)


@pytest.mark.parametrize(
    "page, extra",
    [
        # names of what a paragraph is about, and sections of an article that are named like a thread
        ("<article>{a}<p class=related-work>{0}</p></article>", [SAID[0]]),
        ("<article>{a}<section id=discussion><h2>Discussion</h2><p>{0}</p><p>{1}</p></section></article>", ["Discussion", *SAID]),
        # entries with a date that are the article
        ("<article><h1>A head</h1><div><p>10:05</p><p>{p0}</p></div><div><p>10:45</p><p>{p1}</p></div></article>", None),
        # a teaser's article is not the page's main element
        ("<body><article><p>Short.</p></article><div>{a}</div></body>", ...),
        # lists and definitions without authors
        ("<article>{a}<ul><li>{0}<li>{1}</ul></article>", SAID),
        ("<article>{a}<section><h2>One Part</h2><p>{0}</p></section><section><h2>Other Part</h2><p>{1}</p></section></article>", ["One Part", SAID[0], "Other Part", SAID[1]]),
    ],
)
def test_what_looks_like_comments_stays(extractor, page, extra):
    got = extractor.text(page.format(*SAID, a=ARTICLE, p0=PROSE[0], p1=PROSE[1]))
    if extra is None:
        assert got == f"A head\n\n10:05\n\n{PROSE[0]}\n\n10:45\n\n{PROSE[1]}"
    elif extra is ...:
        assert "\n\n".join(["A head", *PROSE]) in got
    else:
        assert got == "\n\n".join(["A head", *PROSE, *extra])


def test_notices_in_paragraphs_go(extractor):
    assert extractor.text(f"<article>{ARTICLE}<p class=cookie-notice>Ok, fine</p></article>") == "A head\n\n" + "\n\n".join(PROSE)


@pytest.mark.parametrize("page", ["<div>x text. " * 40_000, "<div>" * 40_000 + "deep" + "</i>" * 20_000 + "</div>" * 40_000, "<b class=ad>x " * 40_000, "<p>a<li>b" * 20_000, "<ul><li>" * 20_000 + "x" + "</b>" * 20_000, "<table><tr><td>" * 13_000 + "x"])
def test_deep_pages_take_time_in_proportion(extractor, page):
    began = time.process_time()
    extractor.text(page)
    assert time.process_time() - began < 4
