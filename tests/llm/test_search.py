"""Ranked search against scores of every document; bounds against what they bound."""

import math
import random
import re
from collections import Counter
from itertools import combinations

import pytest

from hitlist.llm import search

ITEM = "item_id long, text string, rank string, score string"


def plain_terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain(docs, items, k):
    counted = [(d, Counter(plain_terms(t))) for d, t in docs]
    n_docs, total = sum(1 for _, c in counted if c), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(plain_terms(text))
    out = []
    for item, words in wanted.items():
        scored = []
        for d, c in counted:
            if c:
                m = 100 - 90 + 90 * sum(c.values()) * n_docs // total
                score = sum(
                    math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in words & c.keys()
                )
                if score > 0:
                    scored.append((-score, d is None, d or 0))
        out += [(item, n, None if none else d, -s) for n, (s, none, d) in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


def made(spark, docs, items, k=10, **shape):
    indexed = search.index(spark.createDataFrame(docs, "doc_id long, text string"), **shape)
    asked = spark.createDataFrame([(*i, "own", "own") for i in items], ITEM)
    return Counter(tuple(r) for r in search.search(indexed, asked, k).collect())


def corpus(n, seed=1):
    """Zipf-like words, copies among them."""
    rng = random.Random(seed)
    words = [f"t{int(400 ** rng.random())}" for _ in range(4000)]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([0, 3, 30, 200])))) for i in range(n)]
    return docs + [(n + i, docs[1][1]) for i in range(20)]


@pytest.mark.parametrize("shape", [{}, {"shard_docs": 7}, {"shard_postings": 100}])
@pytest.mark.parametrize("k", [1, 10])
def test_all_scores(spark, k, shape):
    docs = corpus(400)
    rng = random.Random(7)
    items = [(i, " ".join(rng.choices(docs[rng.randrange(400)][1].split() or ["none"], k=12))) for i in range(25)]
    items += [(30, "T1 t1 T2"), (31, "nowhere"), (32, None), (33, "")]
    assert made(spark, docs, items, k, **shape) == plain(docs, items, k)


def test_blocks_of_queries(spark):
    docs = corpus(150)
    items = [(i, f"t{i} t{i + 1} t{2 * i} t{3 * i + 1}") for i in range(40)]
    indexed = search.index(spark.createDataFrame(docs, "doc_id long, text string"))
    asked = spark.createDataFrame(items, "item_id long, text string")
    found = Counter(tuple(r) for r in search.search(indexed, asked, 10, query_terms=20).collect())
    assert found == plain(docs, items, 10)


def test_ties_and_odd_rows(spark, odd, empty):
    docs = [(r.doc_id, r.text) for r in odd.collect()] + [(20 + i, "Tie éa TIE") for i in range(15)]
    items = [(1, "tie"), (1, "tie S7N3"), (None, "another s1n1 éA"), (2, None), (3, "w5x5 w6x6 w7x7")]
    found = made(spark, docs, items)
    assert found == plain(docs, items, 10)
    nothing = spark.createDataFrame([], "item_id string, text string")
    assert search.search(search.index(odd), nothing).count() == 0
    assert search.search(search.index(empty), spark.createDataFrame([("a", "b c")], "item_id string, text string")).count() == 0
    assert search.search(search.index(odd), spark.createDataFrame([("a", "tie")], nothing.schema)).first().item_id == "a"


def test_index_has_every_document_and_term(spark):
    docs = corpus(100)
    indexed = search.index(spark.createDataFrame(docs, "doc_id long, text string"), shard_docs=30)
    ids = [i for r in indexed.filter("term IS NULL").collect() for i in r.docs]
    assert sorted(ids) == [d for d, _ in docs]
    df = Counter(t for _, text in docs for t in set(plain_terms(text)))
    got = Counter()
    for r in indexed.filter("term IS NOT NULL").collect():
        got[r.term] += len(r.docs)
    assert got == df


def test_bounds_hold_and_pairs_tighten_them():
    rng = random.Random(2)
    tighter = 0
    for _ in range(300):
        n = rng.randrange(1, 7)
        docs = [[rng.randrange(1, 50) if rng.random() < 0.4 else 0 for _ in range(n)] for _ in range(12)]
        tops = [max(d[t] for d in docs) for t in range(n)]
        joint = {
            (a, b): max([d[a] + d[b] for d in docs if d[a] and d[b]], default=0)
            for a, b in combinations(range(n), 2)
            if rng.random() < 0.7
        }
        bounds = search.prefix_bounds(tops, joint)
        assert bounds == sorted(bounds) and len(bounds) == n + 1
        for m in range(n + 1):
            assert max(sum(d[:m]) for d in docs) <= bounds[m] <= sum(tops[:m])
        tighter += bounds[-1] < sum(tops)
    assert tighter > 100


def test_pairs_let_lists_be_skipped():
    import numpy as np

    # two rare terms that no document has together: with the pair known, neither list is essential
    lists = [(np.array([0, 1]), np.array([40, 40])), (np.array([2, 3]), np.array([45, 45])), (np.array([4]), np.array([60]))]
    ids = np.arange(5)
    assert search.prefix_bounds([40, 45, 60], {(0, 1): 0})[2] == 45
    assert search.best(lists, {(0, 1): 0}, ids, 5, 1, 50) == [(60, 4)] == search.best(lists, {}, ids, 5, 1, 50)
