"""The parity-sketch join against all pairs."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbsight.llm import blocks, parity_join


def rows_of(seed, percent):
    """Families of texts whose members differ by about the threshold."""
    r = random.Random(seed)
    rows = []
    for g in range(10):
        whole = [f"g{g}x{r.randrange(4000)}" for _ in range(r.choice([3, 9, 11, 12, 30, 90, 250, 500]))]
        for _ in range(r.choice([1, 3, 14])):
            t = list(whole)
            for _ in range(r.randrange(0, max(2, len(t) * (100 - percent) // 300))):
                t[r.randrange(len(t))] = f"n{r.randrange(10**6)}"
            rows.append(" ".join(t))
    return [*enumerate(rows), (900, None), (901, ""), (902, " \n"), (903, "One"), (904, "one"), (904, "one"), (None, rows[0]), (905, rows[0].upper())]


@pytest.mark.parametrize("shingle, percent, block, seed", [(3, 90, 512, 1), (3, 90, 3, 2), (2, 80, 4, 3), (1, 95, 512, 4)])
def test_components(spark, shingle, percent, block, seed):
    rows = rows_of(seed, percent)
    sets = []
    for _, t in rows:
        ws = (t or "").lower().split()
        sets.append({tuple(ws[k : k + shingle]) for k in range(len(ws) - shingle + 1)} or ({tuple(ws)} if ws else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).select("*", *[F.lit("x").alias(c) for c in ("s", "n", "sk", "k", "hub")])
    got = parity_join.group(docs, shingle=shingle, percent=percent, block=block)
    want = sorted(repr((key, len(sets[i]), least.get(find(i)) if sets[i] else key)) for i, (key, _) in enumerate(rows))
    assert sorted(repr((r.doc_id, r.n_shingles, r.component_id)) for r in got.collect()) == want
    assert parity_join.group(docs.limit(0)).count() == 0


@pytest.mark.parametrize("percent", [80, 90, 97])
def test_linked_sets_share_a_word_and_pass_the_distance(percent):
    rng = np.random.default_rng(percent)
    for n in [*range(1, 40), 60, 100, 333, 1000, 5000]:
        for m in {n, n + 1, 100 * n // percent}:
            # The fewest shared elements with which sets of n and m are linked
            shared = -(-percent * (n + m) // (100 + percent))
            if shared > min(n, m):
                continue
            for _ in range(5):
                pool = rng.integers(0, 2**64, n + m - shared, dtype=np.uint64)
                sets = [np.unique(pool[:n]), np.unique(pool[n - shared :])]
                size = np.array([n, m])
                words, start = parity_join.sketch(np.concatenate(sets), np.concatenate(([0], np.cumsum(size))), percent)
                if np.array_equal(*sets):
                    continue
                key, doc = parity_join.keys_of(size, words, percent)
                assert set(key[doc == 0].tolist()) & set(key[doc == 1].tolist())
                table = int(parity_join.tables(np.array([max(n, m)]), percent)[0][0])
                x, y = (parity_join._in_table(words[start[d] : start[d + 1]].tobytes(), int(size[d]), table, percent) for d in (0, 1))
                apart = n + m - 2 * shared
                assert np.bitwise_count(x ^ y).sum() <= apart <= parity_join.most_apart(n, m, percent)


def test_keys_name_their_table():
    assert len(parity_join.EDGES) <= 1 << parity_join.TABLE_BITS
    n = np.array([5, 9, 17, 1000])
    words = np.arange(int(sum(x.sum() for x in parity_join.tables(n, 90)[1:])), dtype=np.uint64) | np.uint64(7 << 40)
    key, doc = parity_join.keys_of(n, words, 90)
    own = parity_join.tables(n, 90)[0]
    assert set(((key & np.uint64((1 << parity_join.TABLE_BITS) - 1)).astype(np.int64) - own[doc]).tolist()) <= {0, 1} and len(set(key.tolist())) == len(key) == len(words)


def test_blocks_link_alike_in_any_order(spark):
    """Links of a block come from its rows in one order, however they arrive."""
    rows = [(1, 0, k, k, 0, np.array(sorted(range(100)) + [1000 + k], np.uint64).tobytes()) for k in range(12)]
    schema = "g bigint, part bigint, s bigint, root bigint, side int, codes binary"
    found = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        links = blocks.met_in_blocks(spark.createDataFrame(rows, schema).repartition(3, F.lit(seed)), blocks.exact(90))
        found.add(tuple(sorted(tuple(r) for r in links.collect())))
    assert len(found) == 1 and len(found.pop()) == 11
