"""Operators against brute force and SQL on small fixtures."""

import collections
import itertools
import math
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from kerbsight.llm import components, decontaminate, elias_fano, html_extract, hyperminhash, language_model, near_dedup, pieces, quality, registry, repeats, textbatch, toxicity

SF = "/root/testdata/sf0.001"
W = re.compile(r"[^\x20\x09-\x0D]+")


def table(rows):
    return sorted(repr(tuple(r)) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    want = con.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = registry.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert table(got.select(*columns).collect()) == table(want.fetchall())


def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_quality_base(spark):
    t = texts(spark)
    got = {r.doc_id: r for r in entry.queries()["op1_quality_rules"](spark, SF).collect()}
    for i, text in t.items():
        ws = W.findall(text)
        seen, dup = set(), 0
        for line in text.split("\n"):
            if W.search(line):
                dup += line in seen
                seen.add(line)
        c = collections.Counter(zip(ws, ws[1:], ws[2:]))
        rep = {k + j for k, g in enumerate(zip(ws, ws[1:], ws[2:])) if c[g] > 1 for j in range(3)}
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(ws), sum(map(len, ws)), sum(x in "#*$%&|<>" for x in text), dup, len(rep))
        assert r.base_failed == (len(ws) < 50 or 100 * len(rep) > 50 * len(ws)) and not (r.base_failed and r.kept)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    f = quality.Field(rng.normal(size=(quality.N_FEATURES, 2)), rng.normal(size=(2, 2)))
    first = np.array([0, 5, 5, 6, 12])
    s = rng.normal(size=(12, 2))
    state = f.viterbi(s, first)
    for a, b in zip(first[:-1], first[1:]):
        cost = lambda p: sum(s[a + k, x] for k, x in enumerate(p)) + sum(f.move[x, y] for x, y in zip(p, p[1:]))  # noqa: B023, E731
        assert cost(tuple(state[a:b])) == pytest.approx(max(map(cost, itertools.product((0, 1), repeat=b - a))))


def test_crf_gradient():
    rng = np.random.default_rng(2)
    feats = np.stack([rng.integers(a, b, 9) for a, b in zip(quality.OFFSET[:-1], quality.OFFSET[1:])], 1)
    first, gold = np.array([0, 4, 9]), rng.integers(0, 2, 9)
    f = quality.Field(rng.normal(size=(quality.N_FEATURES, 2)), rng.normal(size=(2, 2)))

    def value():
        total = 0.0
        for a, b in zip(first[:-1], first[1:]):
            s = f.scores(feats)[a:b]
            cost = lambda p: sum(s[k, x] for k, x in enumerate(p)) + sum(f.move[x, y] for x, y in zip(p, p[1:]))  # noqa: B023, E731
            total += cost(gold[a:b]) - np.logaddexp.reduce([cost(p) for p in itertools.product((0, 1), repeat=b - a)])
        return total

    emit, move, p = f.gradient(feats, first, gold)
    assert p.sum(1) == pytest.approx(np.ones(9))
    for w, g in ((f.emit, emit), (f.move, move)):
        for at in ((0, 0), (1, 1)):
            old = w[at]
            w[at] = old + 1e-5
            up = value()
            w[at] = old - 1e-5
            assert (up - value()) / 2e-5 == pytest.approx(g[at], abs=1e-5)
            w[at] = old


def line_bins(line, earlier):
    """The features of a line, by their definitions."""
    ws, raw = W.findall(line), line.encode()
    n, share = max(1, len(ws)), lambda x, y: x / max(1, y)
    up, low = sum(65 <= c <= 90 for c in raw), sum(97 <= c <= 122 for c in raw)
    stop = bool(ws) and raw[: len(raw.rstrip(b"\t\n\v\f\r "))][-1:] in (b".", b"!", b"?")
    value = {
        "words": len(ws), "upper": share(up, up + low), "symbol": sum(c in b"#*$%&|<>" for c in raw) / n, "bang": sum(c in b"!?" for c in raw) / n,
        "bar": raw.count(b"|") / n, "digit": share(sum(48 <= c <= 57 for c in raw), len(raw)), "stutter": sum(a == b for a, b in zip(ws, ws[1:])) / n,
        "length": sum(len(x.encode()) for x in ws) / n, "repeat": bool(ws) and line in earlier, "stop": stop,
        "item": (1 if stop else 2) if 0 < len(ws) <= quality.ITEM else 0,
    }
    return [int(quality.OFFSET[i]) + sum(value[k] >= e for e in edges) for i, (k, edges) in enumerate(quality.EDGES.items())]


def test_quality_verdict(spark):
    """The whole verdict of each text, line by line and path by path."""
    t = texts(spark)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = sorted(i for i in labels if i in t)
    f = quality.fit_texts([t[i] for i in ids], np.array([labels[i] > 0 for i in ids]))
    menu = "\n".join([PROSE[0], "Home", "About us", "News | Sport | Weather", "Contact", "Log in", PROSE[1]])
    docs = [*t.values(), menu]
    got = quality.verdicts(pa.array(docs), f).to_pylist()
    assert got[-1]["content"] == [True, False, False, False, False, False, True]
    for text, v in zip(docs, got):
        lines, best, back = text.split("\n"), None, []
        for k, line in enumerate(lines):
            s = f.emit[line_bins(line, lines[:k])].sum(0)
            if best is None:
                best = s
            else:
                via = best[:, None] + f.move
                back.append([int(via[1, j] >= via[0, j]) for j in (0, 1)])
                best = via.max(0) + s
        state = [int(best[1] >= best[0])]
        for b in back[::-1]:
            state.append(b[state[-1]])
        state = state[::-1]
        words = [len(W.findall(x)) for x in lines]
        share = sum(n for n, s in zip(words, state) if s) / max(1, sum(words))
        assert v["content"] == [x > 0 for x in state] and v["content_share"] == pytest.approx(share)
        assert v["kept"] == (not v["base_failed"] and share >= quality.MIN_SHARE)
    multi = [v["content"] for v in got[:-1] if len(v["content"]) > 1]
    assert sum(0 < sum(x) < len(x) for x in multi) > 0.02 * len(multi)


def test_line_labels_of_instances():
    p, words, first = np.array([0.9, 0.2, 0.1, 0.4, 0.6, 0.7]), np.array([10, 1, 1, 5, 5, 2]), np.array([0, 3, 6, 6])
    good = np.array([True, False, True])
    # A good text keeps its unlikely lines as boilerplate; a bad one must be boilerplate in 0.7 of its words
    assert quality.line_labels(p, words, first, good).tolist() == [1, 0, 0, 0, 0, 1]


def test_decontamination_in_parts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    a, b = (decontaminate.find(docs.select("doc_id", "text"), bench, part_bytes=p).select("doc_id", "decontam") for p in (1 << 22, 1500))
    assert table(a.collect()) == table(b.collect())
    for r in decontaminate.find(docs, bench).where("decontam.n_hit > 0").limit(20).collect():
        spans = [r.text.encode()[x:y] for x, y in zip(r.decontam.span_start, r.decontam.span_end)]
        assert sum(len(decontaminate.words_of(s)) for s in spans) == r.decontam.n_hit


def plain_hits(text, items, window=13):
    """(words, hit words, items) by looking for each window at each word."""
    words = decontaminate.words_of((text or "").encode())
    on, found = set(), set()
    for name, item in items:
        ws = decontaminate.words_of((item or "").encode())
        if name is None or not ws:
            continue
        size = min(window, len(ws))
        windows = {tuple(ws[k : k + size]) for k in range(len(ws) - size + 1)}
        for k in range(len(words) - size + 1):
            if tuple(words[k : k + size]) in windows:
                found.add(name)
                on.update(range(k, k + size))
    return len(words), len(on), sorted(found)


@pytest.mark.parametrize("window, part_bytes", [(13, 1 << 24), (13, 3000), (5, 1 << 24), (2, 1 << 24), (1, 1 << 24)])
def test_decontamination_by_brute_force(spark, window, part_bytes):
    """Few words, so windows begin and end anywhere; items repeat, share windows and ids, and hold a document."""
    r = random.Random(window)
    some = lambda n: " ".join(r.choice("abcd") for _ in range(n))
    items = [(f"i{k % 25}", some(r.choice([1, 2, 6, 7, 12, 13, 14, 20, 21, 40]))) for k in range(40)]
    items += items[:5] * 3 + [("x", None), (None, some(20)), ("y", "  "), ("z", items[7][1].upper())]
    rows = []
    for k in range(60):
        item = r.choice(items[:40])[1].replace(" ", r.choice([" ", ", ", "\n"]))
        plain = r.choice([None, "", some(3), some(13), some(300)])
        rows.append((k, plain if k % 2 else f"{some(5)} zz {item}! {some(9)}"))
    rows.append((0, rows[0][1]))
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(3).withColumn("text_digest", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = decontaminate.find(docs, bench, window=window, part_bytes=part_bytes).collect()
    want = {k: plain_hits(t, items, window) for k, t in rows}
    assert len(got) == len(rows) and all((x.decontam.n_words, x.decontam.n_hit, x.decontam["items"]) == want[x.doc_id] for x in got)


def test_decontamination_of_a_long_item_and_many_copies(spark):
    """One item of 5 MB is in one automaton; a row that is repeated counts once when the benchmark is gathered."""
    r = random.Random(8)
    vocabulary = [f"v{k}" for k in range(20000)]
    words = [r.choice(vocabulary) for _ in range(800_000)]
    long = " ".join(words)
    assert len(long) > 4_500_000
    bench = spark.createDataFrame([("long", long)], "item_id string, text string").unionByName(spark.range(20_000).selectExpr("'copy' as item_id", "'one two three four five six seven eight nine ten eleven twelve thirteen' as text"))
    docs = spark.createDataFrame([(1, " ".join(words[500_003:500_016])), (2, " ".join(words[500_003:500_015])), (3, "x one two three four five six seven eight nine ten eleven twelve Thirteen"), (4, " ".join(words[-40:] + words[:12]))], "doc_id int, text string")
    got = {x.doc_id: x.decontam for x in decontaminate.find(docs, bench).collect()}
    assert [(got[k].n_hit, got[k]["items"]) for k in (1, 2, 3, 4)] == [(13, ["long"]), (0, []), (13, ["copy"]), (40, ["long"])]


def jaccard(a, b):
    return 100 * len(a & b) >= 80 * len(a | b)


def near_rows(seed=0):
    r = random.Random(seed)
    rows = []
    for g in range(12):
        base = [f"g{g}x{r.randrange(4000)}" for _ in range(r.choice([6, 12, 30, 80, 200, 400]))]
        for _ in range(r.choice([1, 4, 12])):
            t = list(base)
            for _ in range(r.randrange(0, max(1, len(t) // 7))):
                t[r.randrange(len(t))] = f"n{r.randrange(10**6)}"
            rows.append(" ".join(t))
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("shingle", [2, 5])
def test_near_dedup_components(spark, shingle):
    rows = near_rows()
    sets = {}
    for i, t in rows:
        ws = t.split()
        sets[i] = {tuple(ws[k : k + shingle]) for k in range(len(ws) - shingle + 1)} or {tuple(ws)}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if jaccard(sets[a], sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = near_dedup.group(spark.createDataFrame(rows, "doc_id bigint, text string"), shingle=shingle, block=3).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(s), find(i)) for i, s in sets.items()}


def test_small_sets_meet_and_pass_the_gate():
    """Pairs of 5 to 60 shingles at the threshold: how many share a band and pass the gate."""
    rng = np.random.default_rng(6)
    missed = total = 0
    for n in (5, 8, 12, 20, 40, 60):
        shared = math.ceil(2 * n * 0.8 / 1.8 - 1e-9)
        x = rng.integers(0, 2**64, (400, n), dtype=np.uint64)
        y = np.concatenate([x[:, :shared], rng.integers(0, 2**64, (400, n - shared), dtype=np.uint64)], 1)
        cuts, size = np.arange(401) * n, np.full(400, n)
        a, b = (hyperminhash.registers(np.sort(v, 1).ravel(), cuts) for v in (x, y))
        met = (hyperminhash.bands(a) == hyperminhash.bands(b)).any(1)
        missed += int((~(met & near_dedup._possible(a, b, size, size, 80))).sum())
        total += 400
    assert missed == 0 and total == 2400


def test_registers_estimate():
    rng = np.random.default_rng(3)
    for n in (40, 400, 5000):
        for share in (0.0, 0.5, 0.9):
            x = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2)
            y = np.concatenate([x[: int(n * share)], rng.integers(0, 2**63, n - int(n * share), dtype=np.uint64) * np.uint64(2) + np.uint64(1)])
            a, b = (hyperminhash.registers(np.unique(textbatch.mix(s)), np.array([0, n])) for s in (x, y))
            want = share / (2 - share)
            assert abs(hyperminhash.jaccard(hyperminhash.matches(a, b), np.array([n]), np.array([n]))[0] - want) < 0.2


def test_components(spark):
    r = random.Random(1)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1040)]
    root = {x: x for p in links for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def test_repeats_with_dealt_groups(spark):
    r = random.Random(5)
    passage = [f"p{k}" for k in range(60)]
    rows = []
    for i in range(40):
        ws = [f"w{r.randrange(300)}" for _ in range(r.randrange(0, 90))]
        cut = r.randrange(0, len(ws) + 1)
        a = r.randrange(0, 30)
        ws[cut:cut] = passage[a : a + r.randrange(20, 60)]
        rows.append((i, "  ".join(ws) if i % 2 else "\n".join(ws)))
    rows.append((40, " ".join(["same"] * 50)))
    window, prefix = 9, 4
    where = collections.defaultdict(list)
    for i, t in rows:
        ws = t.split()
        for k in range(len(ws) - window + 1):
            where[tuple(ws[k : k + window])].append((i, k))
    gone = {(i, k + j) for v in where.values() if len(v) > 1 for i, k in v for j in range(window)}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for group in (4096, 2):
        for x in repeats.remove(docs, window=window, prefix=prefix, group=group).collect():
            ws = x.text.split()
            kept = [w for k, w in enumerate(ws) if (x.doc_id, k) not in gone]
            assert (x.deduped.n_words, x.deduped.n_removed) == (len(ws), len(ws) - len(kept))
            assert x.deduped.text.split() == kept


def test_deal_of_repeats_does_not_depend_on_the_batch():
    """A text's places go to the same subgroups whatever rows come before it."""
    r = random.Random(2)
    rows = []
    for k in range(4):
        text = " ".join(r.choice(["a", "b", "c"]) for _ in range(200))
        w = textbatch.words_of(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
        places = np.unique(repeats.anchors(w, 35, 8)[1]).tolist()
        rows.append((k * 7 + 1, k, text, places, [1000] * len(places)))
    got = set()
    for order in itertools.permutations(rows):
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*order), [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())])], names=["k1", "k2", "text", "places", "deals"])
        out = pa.Table.from_batches(list(repeats._leaf_rows(35, 8)(iter([batch])))).to_pylist()
        got.add(repr(sorted((x["k1"], x["start"], x["g"], x["deal"]) for x in out)))
    assert len(got) == 1 and len({x["deal"] for x in out}) > 20


def test_pieces_round_trip_and_distribution(spark):
    v = pieces.Vocabulary(open(pieces.MODEL, "rb").read())
    e = pieces.Encoder(v)
    odd = ["", " ", "  a", "a  b ", "a▁b ▁", "x\n\ty é 😀 \x00 日本語", "x" * 700, "\n\n", "\r\n;\r"]
    got = pieces.encode_all(e, odd, np.arange(len(odd)).astype(np.uint64))
    assert [v.decode(x.tolist()) for x in got] == odd
    n = 6000
    drawn = collections.Counter(tuple(x.tolist()) for x in pieces.encode_all(e, ["thing"] * n, np.arange(n).astype(np.uint64)))
    weight = {bytes(v.bytes[i]).decode(): (int(i), w) for i, w in zip(v.id.tolist(), v.weight)}
    total = {}
    for k in range(6):
        for cut in itertools.combinations(range(1, 6), k):
            ps = [" thing"[a:b] for a, b in zip((0, *cut), (*cut, 6))]
            if all(p in weight for p in ps):
                total[tuple(weight[p][0] for p in ps)] = math.exp(sum(weight[p][1] for p in ps))
    z = sum(total.values())
    assert set(drawn) <= set(total)
    for k, w in total.items():
        assert abs(drawn[k] / n - w / z) < 0.03
    long = " ".join(f"word{k}" for k in range(3000))
    whole = pieces.encode_all(e, [long], np.array([5], np.uint64))[0]
    old = pieces.slices.__defaults__
    try:
        pieces.slices.__defaults__ = (500,)
        assert (pieces.encode_all(e, [long], np.array([5], np.uint64))[0] == whole).all()
    finally:
        pieces.slices.__defaults__ = old
    assert all(r.lossless for r in entry.queries()["op6_sentencepiece"](spark, SF).collect())
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    assert pieces.decode(pieces.encode(docs)).where("not (decoded <=> text)").isEmpty()


def test_min_cut_is_minimal():
    r = random.Random(2)
    for _ in range(150):
        n = r.randrange(1, 9)
        score = [r.uniform(-2, 2) for _ in range(n)]
        edges = [(a, b, r.uniform(0, 2)) for a in range(n) for b in range(a) if r.random() < 0.4]
        cost = lambda x: sum(max(0, -s) if on else max(0, s) for s, on in zip(score, x)) + sum(c for a, b, c in edges if x[a] != x[b])  # noqa: B023, E731
        assert cost(html_extract.min_cut(score, edges)) == pytest.approx(min(map(cost, itertools.product((False, True), repeat=n))))


PROSE = ("This is a sentence of the article, which is long enough to be read as prose by anyone.", "Another sentence of it, again with a comma, and long enough to count as content, surely.")


def test_html_article(spark):
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    odds = html_extract.fit(html_extract.block_counts(pages))
    assert (html_extract.train(spark.read.parquet(f"{SF}/pages.parquet").repartition(3)) == odds).all()
    x = html_extract.Extractor(odds)
    page = (
        "<html><head><title>t</title></head><body><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav><div class='cookie-notice'>We use cookies</div>"
        "<main><h1>Head &amp; shoulders</h1><p>Para one, long enough.<p>Para <b>two</b><br>more<div class=ad>Buy now</div><p>Three.</p><section id=comments><p>nice!</section></main>"
        "<aside>side</aside><form><p>sign up</form><footer>(c)</footer></body></html>"
    )
    assert x.text(page) == "Head & shoulders\n\nPara one, long enough.\n\nPara two more\n\nThree."
    for p in pages:
        body = re.search(r"<article>(.*?)(?:</article>|$)", p, re.S)
        blocks = [" ".join(html_extract._html.unescape(re.sub(r"<[^>]*>?", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body[1])] if body else []
        assert x.text(p).replace(" ", "") == "\n\n".join(b for b in blocks if b).replace(" ", "")


@pytest.mark.parametrize(
    "page",
    [
        "<body class='post has-sidebar'><nav><a href=/>Home</a></nav><article><h1>A head</h1><p>{}<p>{}</article><div class=sidebar><p>Sidebar text that is prose, long enough to look like part of the article.</div><footer>c</footer></body>",
        "<article class='category-social'><h1>A head</h1><p>{}</p><p>{}</p></article><section id=comments><article class=comment><p>I liked this one very much, thank you for writing it down for us all.</article></section>",
        "<div><a href=1>Home</a></div><div><a href=2>News</a></div><div><div>A head</div><div>{}</div><div>{}</div></div><div><a href=x>Terms</a> <a href=y>Privacy</a></div>",
        "A head<p>{}<p>{}",
    ],
)
def test_html_keeps_the_article_of_other_themes(spark, page):
    x = html_extract.Extractor(html_extract.fit(html_extract.block_counts([r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()])))
    assert x.text(page.format(*PROSE)) == "A head\n\n" + "\n\n".join(PROSE)


def test_html_cut_decides(spark, monkeypatch):
    """Links of an article's reading list look like a menu; their neighbours keep them."""
    flows = []
    flow = html_extract._max_flow
    monkeypatch.setattr(html_extract, "_max_flow", lambda *a: flows.append(a[0]) or flow(*a))
    x = html_extract.Extractor(html_extract.fit(html_extract.block_counts([r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()])))
    page = f"<body><nav><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></nav><article><h1>A head</h1><p>{PROSE[0]}</p><p><a href=1>First</a></p><p><a href=2>Second</a></p><p>{PROSE[1]}</p></article></body>"
    blocks = html_extract.blocks_of(page)
    own, labels = [s > 0 for s in x.scores(blocks)], x.labels(blocks)
    assert labels == [False, False, True, True, True, True, True] and own[4:6] == [False, False] and flows


def test_min_cut_of_a_long_page():
    """Against dynamic programming over the labels of two blocks, which edges to the last two allow."""
    r = random.Random(3)
    n = 3000
    score = [r.uniform(-1, 1) for _ in range(n)]
    edges = [(i - k, i, r.choice([0.0, 0.5, 0.9])) for i in range(n) for k in (1, 2) if i >= k]
    of = collections.defaultdict(dict)
    for a, b, c in edges:
        of[b][b - a] = c
    own = lambda i, x: max(0, -score[i]) if x else max(0, score[i])
    best = {(x, y): own(0, x) + own(1, y) + of[1][1] * (x != y) for x in (0, 1) for y in (0, 1)}
    for i in range(2, n):
        best = {(y, z): own(i, z) + min(best[x, y] + of[i][1] * (y != z) + of[i][2] * (x != z) for x in (0, 1)) for y in (0, 1) for z in (0, 1)}
    x = html_extract.min_cut(score, edges)
    cost = sum(own(i, on) for i, on in enumerate(x)) + sum(c for a, b, c in edges if x[a] != x[b])
    assert cost == pytest.approx(min(best.values()))


@pytest.mark.parametrize(("n", "top"), [(1, 10), (5, 5), (900, 3000), (900, 2**61), (3, 0), (257, 300)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, top + 1, n).astype(np.uint64))
    e, _ = elias_fano.EliasFano.read(np.frombuffer(b"".join(p.tobytes() for p in elias_fano.EliasFano.build(v).parts()), np.uint8), 0)
    assert (e.get(np.arange(n)) == v).all()
    q = np.concatenate([v, v + np.uint64(1), rng.integers(0, 2 * top + 2, 500).astype(np.uint64), np.array([0, 2**64 - 1], np.uint64)])
    at, hit = e.successor(q)
    assert (at == np.searchsorted(v, q)).all() and (hit == np.isin(q, v)).all()


def test_language_model(spark, tmp_path):
    t = texts(spark)
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    token = {i: [*W.findall(x.translate(low)), "</s>"] for i, x in t.items()}
    c, b = collections.Counter(), collections.Counter()
    for i, w in token.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            c.update(w)
            b.update(zip(["</s>", *w], w))
    n, v = sum(c.values()), len(c)
    held = [0.0, 0.0]
    for r in entry.queries()["op9_lm_score"](spark, SF).collect():
        w = token[r.doc_id]
        one = [(c[x] + 1) / (n + v + 1) for x in w]
        m = language_model.PRIOR
        p = [(b[a, x] + m * q) / (c[a] + m) for a, x, q in zip(["</s>", *w], w, one)]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(map(math.log10, one)))
        assert r.score == pytest.approx(sum(map(math.log10, p)), abs=0.06 * len(w))
        if r.held_out:
            held = [held[0] + r.score, held[1] + r.base_score]
    assert held[0] > held[1]
    words = np.array([3, 9, 40], np.uint64)
    trie = elias_fano.Trie.build(words, np.array([2, 1, 5]), np.array([(0 << 40) | 9, (2 << 40) | 3], np.uint64), np.array([2, 4]), 0.75)
    assert trie.pointers.get(np.arange(4)).tolist() == [0, 1, 1, 2]
    trie.save(str(tmp_path / "t"))
    trie = elias_fano.Trie.open(str(tmp_path / "t"))
    rank, hit = trie.context(np.array([3, 4, 40], np.uint64))
    assert hit.tolist() == [True, False, True]
    code = trie.successors(rank[hit], np.array([2, 1]), np.array([9, 3, 9], np.uint64))
    assert code.tolist()[1:] == [0, 0] and 10 ** trie.books[1][code[0]] == pytest.approx(2)
    assert 10.0 ** trie.books[0][trie.share] == pytest.approx(1 / (np.array([2, 1, 5]) + 0.75))


def test_language_model_shards(spark):
    """The same scores however many shards there are, hot contexts among them."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("train", F.col("doc_id") % 3 != 0)
    got = [{r[0]: r[1:] for r in language_model.score(docs, shards=n, block=1 << 16).collect()} for n in (1, 5, 40)]
    for i, want in got[0].items():
        for other in got[1:]:
            assert other[i][:3] == want[:3] and other[i][3] == pytest.approx(want[3])
            assert other[i][4] == pytest.approx(want[4], abs=0.06 * want[0])


def auc(s, y):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(len(s))
    n = y.sum()
    return (rank[y == 1].sum() - n * (n - 1) / 2) / n / (len(y) - n)


@pytest.mark.parametrize(("name", "label", "least"), [("op4_quality_classifier", "quality", 0.95), ("op10_toxicity", "toxic", 0.7)])
def test_held_out_accuracy(spark, name, label, least):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in entry.queries()[name](spark, sf).collect()}
    rows = [(got[r.doc_id].score, r[label]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r.doc_id].held_out]
    assert auc(np.array([s for s, _ in rows]), np.array([y for _, y in rows])) > least
    assert all(0 <= r.score <= 1 for r in got.values())


def test_toxicity_gradient():
    rng = np.random.default_rng(0)
    net = toxicity.Network.new(rng, np.sort(textbatch.words_of(np.frombuffer(b"some bad here a text", np.uint8), np.array([0, 20])).code))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    for _, _, d, o in textbatch.groups(pa.array(["some bad words here and there", "a b c", "another text that is longer " * 5])):
        w = textbatch.words_of(d, o)
        code, rows, cuts, which = toxicity.forms_of(w)
        word = net.rows(code)
        doc, begin, size = toxicity.windows_of(w.first)
        index = toxicity._index(which, begin, size, len(word))
        y = rng.integers(0, 2, len(doc)).astype(float)
    loss = lambda: float(np.mean(np.log1p(np.exp(z := net.logits(net.inputs(word, rows, cuts), index))) - y * z))
    g = net.gradient(word, rows, cuts, index, y)
    for k in net.p:
        if isinstance(g[k], tuple):
            full = np.zeros_like(net.p[k])
            np.add.at(full, g[k][0], g[k][1])
            at = (g[k][0][0], 3)
        else:
            full = np.asarray(g[k]).reshape(net.p[k].shape)
            at = tuple(n // 2 for n in full.shape)
        old = net.p[k][at]
        net.p[k][at] = old + 1e-3
        up = loss()
        net.p[k][at] = old - 1e-3
        assert (up - loss()) / 2e-3 == pytest.approx(full[at], abs=2e-5)
        net.p[k][at] = old


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    docs, columns = spark.read.parquet(f"{SF}/documents.parquet"), None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.count()
        columns = docs.columns
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert 0 < docs.count() <= before
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert docs.where("not lossless").isEmpty() and F is not None


def test_word_vectors_cover_all_documents(spark):
    from kerbsight.llm import quality_classifier as qc

    r = random.Random(3)
    rows = [(i, " ".join(f"w{r.randrange(60)}" for _ in range(r.randrange(0, 40)))) for i in range(30)] + [(30, "alone"), (31, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    code = lambda x: textbatch.words_of(np.frombuffer(x.encode(), np.uint8), np.array([0, len(x.encode())])).code
    want = collections.defaultdict(lambda: np.zeros(qc.DIM))
    for _, t in rows:
        for _, _, d, o in textbatch.groups(pa.array([t or ""])):
            w = textbatch.words_of(d, o)
            index = qc.index_vectors(w.code, qc.DIM, 1)
            for i, j in itertools.permutations(range(len(w.code)), 2):
                if abs(i - j) <= qc.REACH:
                    want[w.code[i]] += index[j]
    # Forms of one text have the contexts of all texts; one that occurs nowhere has none
    forms = np.unique(np.concatenate([code(rows[5][1]), code("nowhere alone")]))
    vectors = qc.WordVectors.count(docs, forms)
    assert (vectors.vectors == qc.quantised(np.stack([want[c] for c in forms]))).all()
    assert not vectors.vectors[vectors.row(code("nowhere alone"))].any() and vectors.row(code("other")).tolist() == [-1]
    # Texts are pooled with the forms of all texts, held by the model or not
    full = qc.WordVectors(np.array(sorted(want), np.uint64), qc.quantised(np.stack([want[c] for c in sorted(want)])))
    x = full.pool(pa.array([t or "" for _, t in rows]))
    net = qc.Network.fit(x, np.arange(len(rows)) % 2.0, epochs=3)
    for kwargs in ({}, {"shards": 3, "block": 500}):
        got = {d.doc_id: d.score for d in qc.score(docs, (vectors, net), **kwargs).collect()}
        assert [got[i] for i, _ in rows] == pytest.approx(net.score(x).tolist(), abs=1e-5)


def test_pooling_network_and_temperature():
    from kerbsight.llm import quality_classifier as qc

    r, rng = random.Random(8), np.random.default_rng(8)
    texts = [" ".join(r.choice(["Ab", "ab!", "x#9", "café", "...", "LONGER"]) for _ in range(n)) for n in (0, 1, 39, 40, 41, 130)] + ["## %%"]
    low = lambda t: t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    code = lambda x: textbatch.words_of(np.frombuffer(x.encode(), np.uint8), np.array([0, len(x.encode())])).code[0]
    forms = np.unique([code(x) for x in ("ab", "x", "9", "café", "longer")])
    vectors = qc.WordVectors(forms, rng.integers(-7, 8, (len(forms), qc.DIM)).astype(np.int8))
    got = vectors.pool(pa.array(texts))
    for t, x in zip(texts, got):
        ws = [(m.start(), m.group()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))]
        rows = []
        for k, (a, word) in enumerate(ws):
            span = t[a : ws[k + 1][0] if k + 1 < len(ws) else len(t)]
            shape = 0
            for kind in ("A-Z", "a-z", "0-9", r"#*$%&|<>{}\[\]_=+~^\\/@", "!?"):
                shape = shape * 4 + min(3, len(re.findall(f"[{kind}]", span)))
            shape = (shape * 4 + min(3, len(word.encode()) // 4)) * 2 + (k > 0 and ws[k - 1][1] == word)
            at = np.flatnonzero(forms == code(word))
            v = vectors.vectors[at[0]].astype(float) if len(at) else np.zeros(qc.DIM)
            rows.append(np.concatenate([v / max(1e-6, np.linalg.norm(v)), qc.index_vectors(np.array([shape], np.uint64), qc.SHAPE_DIM, 3)[0]]))
        segs = [np.mean(rows[k : k + qc.SEGMENT], 0) for k in range(0, len(rows), qc.SEGMENT)]
        want = np.concatenate([np.mean(rows, 0), np.max(segs, 0), np.min(segs, 0), [np.log1p(len(rows)) / 10]]) if rows else np.zeros(len(x))
        assert x == pytest.approx(want, abs=1e-5)
    # Sums of packed lanes against plain ones, one form being frequent
    docs = [[r.randrange(30) for _ in range(r.randrange(50))] for _ in range(30)] + [[7] * 5000]
    which, first = np.array([x for d in docs for x in d]), np.cumsum([0] + [len(d) for d in docs])
    codes, row = np.arange(30).astype(np.uint64) + np.uint64(9), np.arange(30)
    row[3] = -1
    iv, want = qc.index_vectors(codes, qc.DIM, 1).astype(int), np.zeros((30, qc.DIM), int)
    for d in docs:
        for i, j in ((i, j) for i in range(len(d)) for j in range(max(0, i - qc.REACH), min(len(d), i + qc.REACH + 1)) if i != j):
            want[d[i]] += (row[d[i]] >= 0) * iv[d[j]]
    total = qc.contexts(which, first, qc.index_lanes(codes), row, 30)
    assert (total == want).all()
    for x in (total, total[:3] * 0, total.astype(np.int64) << 33, total[:0]):
        assert (qc._unpacked(qc._packed(x), len(x)) == x).all()
    # The network learns a rule, and its temperature is where the log loss is least
    x = rng.normal(size=(400, 6)).astype(np.float32)
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    net = qc.Network.fit(x, y, epochs=200)
    assert ((net.score(x) > 0.5) == y).mean() > 0.95
    logit, noisy = rng.normal(size=600) * 4, None
    noisy = (rng.random(600) < 1 / (1 + np.exp(-logit / 2))).astype(float)
    loss = lambda t, o: np.mean(np.log1p(np.exp(-(2 * noisy - 1) * (logit / t + o))))
    t, o = qc.calibrate(logit, noisy)
    assert all(loss(t, o) <= loss(t * a, o + b) + 1e-3 for a in (0.9, 1, 1.1) for b in (-0.1, 0, 0.1))


def test_toxicity_windows_by_hand():
    """Every window through a network written out for one window at a time."""
    rng = np.random.default_rng(4)
    texts = ["", "Some bad words here", " ".join(f"w{k % 37}" for k in range(90)), "a bb ccc " * 11]
    net = toxicity.Network.new(rng, np.sort(textbatch.words_of(np.frombuffer(b"some bad w1 w2 bb", np.uint8), np.array([0, 17])).code))
    net.p["word"][:-1] += rng.normal(size=net.p["word"][:-1].shape).astype(np.float32)
    p, h = net.p, toxicity.HIDDEN
    sig = lambda v: 1 / (1 + np.exp(-v))

    def vector(word):
        code = textbatch.words_of(np.frombuffer(word.encode(), np.uint8), np.array([0, len(word)])).code
        rows, _ = toxicity.char_rows([word.encode()])
        return p["word"][net.rows(code)[0]] + (p["char"][rows].sum(0) / np.sqrt(len(rows)) if len(rows) else 0)

    def logit(ws):
        xs = [vector(x) for x in ws]
        states = []
        for d in "fb":
            n, out = np.zeros(h), []
            for x in xs if d == "f" else xs[::-1]:
                a, b = x @ p["w" + d] + p["b" + d], n @ p["u" + d]
                z, r = sig(a[:h] + b[:h]), sig(a[h : 2 * h] + b[h : 2 * h])
                n = z * n + (1 - z) * np.tanh(a[2 * h :] + r * b[2 * h :])
                out.append(n)
            states.append(out if d == "f" else out[::-1])
        s = np.array([np.concatenate(v) for v in zip(*states)]).reshape(len(xs), 2 * h)
        e = np.exp(np.tanh(s @ p["wa"]) @ p["va"])
        return float((e / max(1e-9, e.sum())) @ s @ p["wo"] + p["bo"][0]) if len(xs) else float(p["bo"][0])

    for t, got in zip(texts, toxicity.score_texts(net, pa.array(texts), raw=True)):
        ws = t.lower().split()
        starts = [0]
        while starts[-1] + toxicity.WINDOW < len(ws):
            starts.append(starts[-1] + toxicity.STRIDE)
        assert got == pytest.approx(max(logit(ws[a : a + toxicity.WINDOW]) for a in starts), abs=1e-4)


def test_repeats_of_equal_rows_stay_linear(spark, monkeypatch):
    copies, n = 200, 120
    same = " ".join(f"s{k}" for k in range(n))
    docs = spark.createDataFrame([(1, same)] * copies + [(None, same + " x")] * copies + [(2, "short")], "doc_id bigint, text string").repartition(4)
    for group in (4096, 16):
        wide = docs.select("text", F.xxhash64("doc_id", "text").alias("k1"), F.hash("text").alias("k2"))
        ranges = repeats.find(wide, group=group).collect()
        # Once each, not once for each pair of rows
        assert len(ranges) == 2 and all(len({tuple(x) for x in r.ranges}) == len(r.ranges) <= n for r in ranges)
        done = repeats.remove(docs, group=group).collect()
        assert len(done) == 2 * copies + 1
        assert all(r.deduped.n_removed == (0 if r.doc_id == 2 else r.deduped.n_words) for r in done)
    sizes = spark.sparkContext.accumulator(0)
    leaf_rows = repeats._leaf_rows

    def counted(*args):
        run = leaf_rows(*args)

        def count(batches):
            for batch in run(batches):
                sizes.add(batch.num_rows)
                yield batch

        return count

    monkeypatch.setattr(repeats, "_leaf_rows", counted)
    repeats.find(wide).count()
    assert copies < sizes.value <= 2 * copies * n
