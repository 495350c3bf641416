"""HTML extraction by minimum-cut labelling.

A page is read into text blocks with their element path.  What a block costs as
content or as boilerplate, its terminal capacity, is the sum of

* a classifier's log odds from its text alone (length, share of linked text, sentence
  end, commas), at most ``MOST_TEXT`` either way, and
* what the markup says (``evidence``): an element that never holds main text, a
  boilerplate name on the innermost element that has one, a list of reader comments (siblings that
  each begin with a line of an author or a date), or the page's main element, in it or beside it.

Elements are a tree of parent pointers, and what markup says is handed down in it, so a page
costs time and memory in proportion to its length, however deep its elements are nested.

Elements are a tree of parent pointers, and what markup says is handed down in it, so a page
costs time and memory in proportion to its length, however deep its elements are nested.

Edges between neighbouring blocks, and to the last block below the same
parent, cost something if their ends are labelled differently, more so the closer
they are in the tree.  The minimum cut is the cheapest labelling; max-flow finds it.  So a
heading or an odd line follows the paragraphs around it, whatever its own text looks like.

Blocks whose terminal capacity outweighs all their edges keep that label
in every minimum cut, so they are settled first and the flow runs over the rest.

The classifier learns from every page: blocks in the main element, without boilerplate
markup, are examples of content, blocks in boilerplate markup of the other
kind.  Spark counts them by the bins of the text's features; only those counts (at most
two for each of ``N_KEYS`` bins, however many pages there are) reach the driver, and the
logistic fit weighs both kinds equally.  Markup is no input of the classifier.

Edge cases: null or empty html gives an empty text; a page cut off anywhere is
read as far as it goes (an unfinished tag is dropped, an unfinished character
reference stays as written); pages are never cut by this module; a tie between
labellings goes to boilerplate; repeated rows give equal results; without pages
to learn from, the classifier's prior decides; an input column named like the
result is replaced.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter, defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from . import base

#: Bins of a block's text: length, linked share, sentence end, commas.
BINS = (11, 5, 2, 4)
N_KEYS = 11 * 5 * 2 * 4
#: Limits of the log odds from the text, and the weights of markup and edges beside it.
MOST_TEXT, MAIN, NAME, NEVER_WEIGHT, EDGE = 3.0, 2.5, 4.5, 9.0, 2.0
#: Evidence of a block beside the main element, if that holds such a share of the text that is not linked.
OUTSIDE, MAIN_SHARE = 3.5, 1 / 3
#: Evidence of a block beside the main element, if that holds such a share of the text that is not linked.
OUTSIDE, MAIN_SHARE = 3.5, 1 / 3

_TOKEN = re.compile(
    r"<!--(?:.*?(?:-->|--!>)|.*\Z)"
    r"|<(?P<raw>script|style|textarea|noscript|template|iframe|svg|title|xmp|noembed|noframes)(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>(?:.*?</(?P=raw)(?=[\s/>])[^>]*>|.*\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>"
    r"|</?[a-zA-Z][^>]*\Z"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"""(?<![\w-])(?:class|id|role|aria-label|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WHEN = re.compile(r"\b(?:19|20)\d\d\b|\b\d{1,2}[:.]\d\d\b|\b\d+ ?(?:s|m|min|h|d|w|second|minute|hour|day|week|month|year)s? ago\b|\b(?:just now|yesterday)\b", re.I)
_WHEN = re.compile(r"\b(?:19|20)\d\d\b|\b\d{1,2}[:.]\d\d\b|\b\d+ ?(?:s|m|min|h|d|w|second|minute|hour|day|week|month|year)s? ago\b|\b(?:just now|yesterday)\b", re.I)
_HIDDEN = re.compile(r"""(?<![\w-])(?:hidden(?![\w-])|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
#: Elements that never hold main text.
NEVER = frozenset("head nav footer aside form button select option menu dialog fieldset datalist".split())
CONTENT = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words in class, id or role that name boilerplate.
NAMED = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent copyright "
    "disqus footer header masthead menu nav navbar navigation newsletter notice notices pager pagination popup promo "
    "promoted related share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: Names of reader comments, where a list of theirs bears them out.
THREADS = frozenset("discussion reactions replies reply response responses thread".split())
#: A line of an author or a date is no longer than this.
SIGNED_CHARS = 80
#: Names of reader comments, where a list of theirs bears them out.
THREADS = frozenset("discussion reactions replies reply response responses thread".split())
#: A line of an author or a date is no longer than this.
SIGNED_CHARS = 80
#: First parts of class names that tell a state or topic, not what the element is.
STATES = frozenset("has no not with without is category tag type post page single template".split())
#: Start tags that end an open p, and the lists of siblings that end each other.
CLOSES_P = frozenset("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SIBLING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}


class Block:
    """A text block: its text, the innermost element around it (a node of its page's tree),
    and the share of its text inside links."""

    __slots__ = ("text", "node", "linked")

    def __init__(self, text: str, node: int, linked: float):
        self.text, self.node, self.linked = text, node, linked


class Page(list):
    """The blocks of a page, and its tree: each node's element, name words, parent and depth.  Node 0 is the page;
    parents come before their children.  Inline elements are nodes only if they have a name word."""

    def __init__(self):
        super().__init__()
        self.element, self.words, self.up, self.depth = [""], [()], [0], [0]

    def add(self, element: str, words: tuple[str, ...], up: int) -> int:
        self.element.append(element)
        self.words.append(words)
        self.up.append(up)
        self.depth.append(self.depth[up] + 1)
        return len(self.up) - 1

    def sums(self, values: list[float]) -> list[float]:
        """Of each node, the sum over the blocks in it."""
        out = [0.0] * len(self.up)
        for b, v in zip(self, values):
            out[b.node] += v
        for k in range(len(out) - 1, 0, -1):
            out[self.up[k]] += out[k]
        return out

    def shared(self, a: int, b: int) -> int:
        """Depth of the innermost node around both; the climb is paid for by the tags between them."""
        while a != b:
            if self.depth[a] < self.depth[b]:
                a, b = b, a
            a = self.up[a]
        return self.depth[a]


def name_words(attrs: str, element: str = "") -> tuple[str, ...]:
    """The boilerplate names among an element's class, id and role words."""
    out = []
    for groups in _NAMES.findall(attrs):
        for token in " ".join(groups).split():
            words = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower())
            if words and words[0] not in STATES:
                # What a paragraph is about comes first (related-work), what it is comes last (cookie-notice)
                out += [w for w in (words[-1:] if element == "p" else words) if w in NAMED or w in THREADS]
    if _HIDDEN.search(attrs):
        out.append("hidden!")
    return tuple(out)


def blocks_of(page: str) -> Page:
    """The visible text blocks of a page, in order."""
    out = Page()
    stack: list[tuple[str, int]] = []  # element, its node or that around it
    places: dict[str, list[int]] = defaultdict(list)  # where each element is open in the stack
    blocks: list[int] = []  # where elements that are not inline are
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(_html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, stack[-1][1] if stack else 0, min(1.0, linked / max(1, len(text)))))
            parts.clear()
        linked = 0

    def text(piece: str) -> None:
        nonlocal linked
        if piece:
            parts.append(piece)
            if places["a"]:
                linked += len(piece.strip())

    def pop_to(k: int) -> None:
        while len(stack) > k:
            name, _ = stack.pop()
            places[name].pop()
            if name not in INLINE:
                blocks.pop()

    def innermost(names) -> int:
        return max((places[n][-1] for n in names if places[n]), default=-1)

    at = 0
    for m in _TOKEN.finditer(page):
        text(page[at : m.start()])
        at = m.end()
        name = m["tag"] or m["tag2"]
        if name is None:
            continue
        name = name.lower()
        if m["close"] or m["close2"]:
            if name not in INLINE:
                flush()
            k = innermost((name,))
            if k >= 0 and (name not in INLINE or not blocks or blocks[-1] < k):
                pop_to(k)
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name not in INLINE:
            flush()
            if name in CLOSES_P and places["p"]:
                pop_to(places["p"][-1])
            if name in SIBLING:
                k = innermost(SIBLING[name])
                if k > innermost(STOPS[name] - SIBLING[name]):
                    pop_to(k)
        attrs = m["attrs"] if m["tag"] else m["attrs2"]
        if name in VOID or attrs.rstrip().endswith("/") and name not in INLINE | CONTENT | NEVER | CLOSES_P:
            continue
        words = name_words(attrs, name) if attrs and not attrs.isspace() else ()
        up = stack[-1][1] if stack else 0
        places[name].append(len(stack))
        if name not in INLINE:
            blocks.append(len(stack))
        stack.append((name, out.add(name, words, up) if words or name not in INLINE else up))
    text(page[at:])
    flush()
    return out


def main_element(page: Page) -> int | None:
    """The article or main element with the most text that is not linked
    (the innermost of equal ones); a page may have none."""
    size = page.sums([(1 - b.linked) * len(b.text) for b in page])
    return max((k for k, e in enumerate(page.element) if e in CONTENT and size[k] > 0), key=lambda k: (round(size[k], 6), k), default=None)


def _signed(b: Block) -> bool:
    """Whether a block looks like the line of an author or a date: short, no sentence, and with
    a date or of a few words that begin with capitals."""
    if len(b.text) > SIGNED_CHARS or b.text[-1] in ".!?…。;":
        return False
    words = b.text.split()
    return bool(_WHEN.search(b.text)) or (len(words) <= 4 and all(w[:1].isupper() or not w[:1].isalpha() for w in words) and any(w[:1].isalpha() for w in words))


def comment_lists(page: Page, main: int | None) -> set[int]:
    """Nodes that hold reader comments: most of their text is in two children or more of one kind, each with a line
    of an author or a date before a text; or they are named like a discussion and have one such child, or are a list.
    Not what holds nine tenths of the main element, nor children that begin with a heading."""
    first: dict[int, int] = {}  # of each node, its first and its last block
    last: dict[int, int] = {}
    size = page.sums([len(b.text) for b in page])
    for i, b in enumerate(page):
        k = b.node
        while k not in first:
            first[k] = i
            if not k:
                break
            k = page.up[k]
        last[b.node] = i
    for k in range(len(page.up) - 1, 0, -1):
        if k in last:
            last[page.up[k]] = max(last[k], last.get(page.up[k], -1))
    signed = [_signed(b) for b in page]
    heading = [page.element[b.node] in HEADINGS for b in page]
    each: dict[tuple[int, str], list[int]] = defaultdict(list)  # comments and their text, by parent and element
    for k in range(1, len(page.up)):
        if k in first and first[k] < last[k] and signed[first[k]] and not heading[first[k]] and len(page[last[k]].text) > 10:
            each[page.up[k], page.element[k]].append(k)
    out = set()
    whole = size[main] if main is not None else size[0]
    for (up, _), found in each.items():
        named = THREADS & set(page.words[up])
        if (len(found) > 1 or named) and 10 * sum(size[k] for k in found) >= 6 * size[up] and 10 * size[up] < 9 * whole:
            out.add(up)
    for k, e in enumerate(page.element):
        if e in ("ol", "ul", "dl") and THREADS & set(page.words[k]) and 10 * size[k] < 9 * whole:
            out.add(k)
    return out


def evidence(page: Page) -> list[float]:
    """What the markup says of each block: positive for content.  An element that never
    holds main text decides; else the innermost of a boilerplate name, a list of comments and the main element.
    Names on the main element, on those around it, or around nine tenths of the text
    name the page, not boilerplate, and don't count.  What is beside a main element that holds a good part of
    the text is no main text unless its neighbours are."""
    main = main_element(page)
    size = page.sums([len(b.text) for b in page])
    around: set[int] = set()
    outside = 0.0
    if main is None:
        around = {k for k, n in enumerate(size) if 10 * n >= 9 * size[0]}
    else:
        k = main
        while k not in around:
            around.add(k)
            k = page.up[k]
        plain = page.sums([(1 - b.linked) * len(b.text) for b in page])
        outside = -OUTSIDE if plain[main] >= MAIN_SHARE * plain[0] else 0.0
    comments = comment_lists(page, main)
    value, inside = [outside] * len(page.up), [False] * len(page.up)
    for k in range(1, len(page.up)):
        up, e, words = page.up[k], page.element[k], page.words[k]
        inside[k] = inside[up] or k == main
        value[k] = value[up]
        if value[up] == -NEVER_WEIGHT or "hidden!" in words or e in NEVER or e == "header" and not inside[up]:
            value[k] = -NEVER_WEIGHT
        elif k == main:
            value[k] = MAIN
        elif k in comments or (NAMED.intersection(words) and k not in around):
            value[k] = -NAME
    return [value[b.node] for b in page]


def key_of(b: Block) -> int:
    """The bin of a block's text."""
    n = len(b.text)
    parts = (min(10, n.bit_length()), round(4 * b.linked), b.text[-1] in ".!?…。:;", min(3, b.text.count(",")))
    out = 0
    for size, part in zip(BINS, parts):
        out = out * size + int(part)
    return out


def _bins() -> np.ndarray:
    """The bins of every key, one column a feature; the last column joins length and end."""
    rest, out = np.arange(N_KEYS), []
    for size in reversed(BINS):
        out.append(rest % size)
        rest = rest // size
    length, linked, stop, commas = reversed(out)
    return np.stack([length, linked, stop, commas, 2 * length + stop], 1)


def block_counts(pages: list[str | None]) -> Counter:
    """(bin, content or not) of the blocks whose markup tells, and how many."""
    out: Counter = Counter()
    for page in pages:
        blocks = blocks_of(page or "")
        for b, e in zip(blocks, evidence(blocks)):
            if e and e != -OUTSIDE:  # what is merely beside the main element is no example
                out[key_of(b), e > 0] += 1
    return out


def fit(counts: Counter, *, steps: int = 300, rate: float = 0.5, decay: float = 2e-3) -> np.ndarray:
    """The log odds of each bin, both kinds weighing the same, by logistic regression
    with a prior: long sentences look like content, links and fragments do not."""
    x, y = _bins(), np.array([0.0, 1.0])
    n = np.zeros((N_KEYS, 2))
    for (k, good), c in counts.items():
        n[k, int(good)] += c
    n /= np.maximum(n.sum(0), 1)
    width = [*BINS, 2 * BINS[0]]
    w = [np.zeros(k) for k in width]
    w[0][:] = np.clip(np.arange(BINS[0]) - 6, -2, 2) / 2
    w[1][:] = np.array([0.5, 0.0, -1.0, -1.5, -2.0])
    w[2][:] = np.array([-0.5, 0.5])
    prior = [v.copy() for v in w]
    odds = lambda: sum(v[x[:, i]] for i, v in enumerate(w))
    for _ in range(steps):
        g = (n * (y - 1 / (1 + np.exp(-odds()))[:, None])).sum(1)
        for i, v in enumerate(w):
            v += rate * (np.bincount(x[:, i], g, width[i]) - decay * (v - prior[i]))
    return odds()


def _max_flow(n: int, source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay on the source's side of a minimum cut (Dinic)."""
    s, t = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    cap: list[float] = []

    def add(a: int, b: int, c: float, back: float) -> None:
        head[a].append(len(to))
        to.append(b)
        cap.append(c)
        head[b].append(len(to))
        to.append(a)
        cap.append(back)

    for i in range(n):
        add(s, i, source[i], 0.0)
        add(i, t, sink[i], 0.0)
    for a, b, c in edges:
        add(a, b, c, c)
    eps = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for e in head[a]:
                if cap[e] > eps and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        nxt = [0] * (n + 2)
        while True:
            path: list[int] = []
            a = s
            while a != t:
                while nxt[a] < len(head[a]):
                    e = head[a][nxt[a]]
                    if cap[e] > eps and level[to[e]] == level[a] + 1:
                        break
                    nxt[a] += 1
                else:
                    if a == s:
                        break
                    e = path.pop()
                    a = to[e ^ 1]
                    nxt[a] += 1
                    continue
                path.append(e)
                a = to[e]
            if a != t:
                break
            f = min(cap[e] for e in path)
            for e in path:
                cap[e] -= f
                cap[e ^ 1] += f


def min_cut(score: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The labelling (True: content) that minimises the sum of what it costs to
    call block i content (-score[i]) or boilerplate (score[i]) where positive,
    and of the edges between different labels."""
    n = len(score)
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for a, b, c in edges:
        near[a].append((b, c))
        near[b].append((a, c))
    value, label = list(score), [None] * n
    free = [sum(c for _, c in near[i]) for i in range(n)]  # edges to unsettled neighbours
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if label[i] is None and abs(value[i]) > free[i]:
            label[i] = value[i] > 0
            for j, c in near[i]:
                if label[j] is None:
                    value[j] += c if label[i] else -c
                    free[j] -= c
                    todo.append(j)
    left = [i for i in range(n) if label[i] is None]
    if left:
        new = {i: k for k, i in enumerate(left)}
        side = _max_flow(len(left), [max(0.0, value[i]) for i in left], [max(0.0, -value[i]) for i in left], [(new[a], new[b], c) for a, b, c in edges if a in new and b in new])
        for i, k in new.items():
            label[i] = side[k]
    return [bool(x) for x in label]


def edges_of(page: Page, *, weight: float = EDGE) -> list[tuple[int, int, float]]:
    """Smoothness: to the next block and to the last block below the same parent,
    by the share of the element path that both have."""
    out, last = [], {}
    for i, b in enumerate(page):
        up = page.up[b.node]
        near = {i - 1: page.shared(page[i - 1].node, b.node)} if i else {}
        if up in last:
            near[last[up]] = page.depth[b.node] if page[last[up]].node == b.node else page.depth[up]
        last[up] = i
        for j, k in near.items():
            out.append((j, i, weight * (k + 1) / (max(page.depth[page[j].node], page.depth[b.node]) + 1)))
    return out


class Extractor:
    def __init__(self, odds: np.ndarray):
        self.odds = np.clip(odds, -MOST_TEXT, MOST_TEXT).tolist()

    def scores(self, blocks: Page) -> list[float]:
        """What a block gains as content: the signed terminal capacities."""
        return [self.odds[key_of(b)] + e for b, e in zip(blocks, evidence(blocks))]

    def labels(self, blocks: Page) -> list[bool]:
        return min_cut(self.scores(blocks), edges_of(blocks))

    def text(self, page: str | None) -> str:
        blocks = blocks_of(page or "")
        return "\n\n".join(b.text for b, on in zip(blocks, self.labels(blocks)) if on)


def train(pages: DataFrame, *, html: str = "html") -> np.ndarray:
    """Log odds of each bin, from all pages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for part in base.slices(batch):
                total += block_counts(base.column(part, "html").to_pylist())
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in total], pa.int32()), pa.array([g for _, g in total]), pa.array(list(total.values()), pa.int64())], names=["k", "good", "n"])

    found = pages.select(F.col(html).cast("string").alias("html")).mapInArrow(count, "k int, good boolean, n bigint")
    return fit(Counter({(r["k"], r["good"]): r["n"] for r in found.groupBy("k", "good").agg(F.sum("n").alias("n")).collect()}))


def extract(pages: DataFrame, odds: np.ndarray, *, html: str = "html", out: str = "text") -> DataFrame:
    """pages with the main text of each in ``out``."""

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        x = Extractor(odds)
        return {out: pa.array([x.text(v.as_py()) for v in base.column(batch, html)], pa.string())}

    return base.map_arrow(pages, run, StructType([StructField(out, StringType())]))


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = base.table(spark, sf_dir, "pages")
    out = extract(pages.select("page_id", "url", "html"), train(pages))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
