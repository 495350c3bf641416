"""Fill-in-middle rows and Merkle manifests against plain versions of themselves."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbsight.llm import fill_middle, merkle

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = [None, "", " ", "a", " a", "a ", "é", "aé b　c \n", "日本 語\t🙂🙂x y z", "<P>", "x <S y> <M", "a <M> b", "one two  three\n\nfour ", "x" * 5000 + " é" * 3000]


def plain_row(key, text, units, rate, spm, seed=42):
    text = text or ""
    n = len(units(text))
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    u = units(text)
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit, rate, spm", [("word", 50, 80), ("word", 100, 30), ("char", 100, 50), ("char", 0, 0)])
def test_fill_middle(spark, unit, rate, spm):
    rows = [(None if k == 50 else k, TEXTS[k % len(TEXTS)]) for k in range(140)]
    rows += [(7, "a b c")] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).withColumn("n", F.lit("old")).withColumn("h1", F.lit("old")).withColumn("FORM", F.lit("old"))
    got = fill_middle.transform(docs, unit=unit, rate=rate, spm=spm).withColumn("back", fill_middle.restore(F.col("fim"), F.col("form")))
    assert got.columns == ["doc_id", "text", "h1", "n", "prefix_chars", "middle_chars", "form", "fim", "back"]
    units = TOKEN.findall if unit == "word" else list
    want = sorted(repr((k, *plain_row(k, t, units, rate, spm))) for k, t in rows)
    found = got.collect()
    assert sorted(repr((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.fim)) for r in found) == want
    assert all(r.back == (r.text or "") for r in found)
    assert fill_middle.transform(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        fill_middle.transform(docs, unit="line")


def test_runs_are_maximal():
    raw = "aé日b  x".encode()
    runs = fill_middle.encode(np.frombuffer(raw, np.uint8), np.array([0, 0, len(raw), len(raw)]))
    assert runs.start.tolist() == [0, 1, 3, 6, 7, 9] and runs.units.tolist() == [0, 0, 0, 1, 0, 1] and runs.n.tolist() == [0, 2, 0]


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    """Root, and for each leaf its siblings by level."""
    paths, at, row = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(row) > 1:
        runs = [row[i : i + 3] for i in range(0, len(row), 3)]
        for k, path in enumerate(paths):
            run = runs[at[k] // 3]
            path.append((at[k] % 3, [x for j, x in enumerate(run) if j != at[k] % 3]))
        at, row = [x // 3 for x in at], [digest(*r) for r in runs]
    return (row or [None])[0], paths


def plain_fold(leaf, path):
    for own, siblings in path:
        leaf = digest(*siblings[:own], leaf, *siblings[own:])
    return leaf


@pytest.mark.parametrize("n", [1, 2, 3, 4, 8, 9, 10, 26, 27, 28, 80, 81])
@pytest.mark.parametrize("subtree", [1, 2, 3])
def test_traversal(n, subtree):
    leaves = [hashlib.sha256(bytes([k])).digest() for k in range(n)]
    root, paths = plain_tree([x.hex() for x in leaves])
    height = next(k for k in range(9) if 3**k >= n)
    got = list(merkle.traverse(leaves, height, subtree))
    assert [[(own, [x.hex() for x in s]) for own, s in merkle.steps(p)] for p in got] == paths
    assert merkle.block_root(leaves, height).hex() == root and {merkle.fold(x, p).hex() for x, p in zip(leaves, got)} == {root}


def test_subtrees_stay_small():
    """Nodes held by the stacked subtrees do not grow with the block."""
    held = []

    class Seen(merkle._Treehash):
        def close(self):
            held.append(sum(map(len, self.rows)) + sum(map(len, self.tail)))
            return super().close()

    whole, merkle._Treehash = merkle._Treehash, Seen
    try:
        list(merkle.traverse([bytes(32)] * 729, 6, 2))
    finally:
        merkle._Treehash = whole
    assert max(held) <= 9 + 3 + 2 * 6


ROWS = [(k, "hot", "en", k, f"line {k}\nend") for k in range(95)] + [(k, f"s{k % 7}", None, None, None if k % 3 else "x\n") for k in range(100, 130)]
ROWS += [(200, None, "en", 1, ""), (201, "", "en", 1, ""), (None, "hot", None, None, None), (5, "hot", "en", 5, "line 5\nend"), (5, "hot", "de", 5, "é")]


def plain_manifest(rows):
    f = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: digest(*map(f, (r[0], r[1], r[2], r[3])), f(text))
    groups = {}
    for r in rows:
        even = zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 2 == 0
        again = leaf(r, r[4].replace("\n", "") if r[4] is not None and even else r[4])
        groups.setdefault((r[1] is not None, (r[1] or "").encode()), []).append(((r[0] is not None, r[0] or 0), leaf(r, r[4]), again, r[0]))
    trees = {g: (sorted(x), *plain_tree([y[1] for y in sorted(x)])) for g, x in groups.items()}
    root, upper = plain_tree([trees[g][1] for g in sorted(trees)])
    out = []
    for g, above in zip(sorted(trees), upper):
        found, sub, paths = trees[g]
        for (_, own, again, key), path in zip(found, paths):
            whole = path + above
            folded = plain_fold(again, whole)
            out.append((key, own, sub, root, digest(*[x for _, s in whole for x in s]), folded, folded == root))
    return out


@pytest.mark.parametrize("height, subtree", [(1, 1), (2, 2), (3, 2), (6, 2)])
def test_manifest(spark, height, subtree):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(5)
    docs = docs.select("*", *[F.lit("x").alias(c) for c in ("g", "digest", "pos", "path", "seq", "again", "leaf")])
    got = merkle.audit(merkle.manifest(docs, height=height, subtree=subtree))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == sorted(map(repr, plain_manifest(ROWS)))


def test_manifest_of_one_and_none(spark):
    docs = spark.createDataFrame(ROWS[:1], "doc_id bigint, source string, lang string, n_chars bigint, text string")
    (r,) = merkle.audit(merkle.manifest(docs)).collect()
    assert r.leaf == r.subroot == r.root and r.proof_sha256 == digest("")
    assert merkle.audit(merkle.manifest(docs.limit(0))).count() == 0
