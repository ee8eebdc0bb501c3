"""Golay keys, spanning links and components against plain versions."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from hitlist.llm import queries, simhash
from tests.llm.test_brute_force import SF, read


def plain_print(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not ws:
        return 0
    grams = [" ".join(ws[i : i + 4]) for i in range(max(len(ws) - 3, 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, errors=4):
    """{doc_id: (fingerprint, component)} of distinct ids."""
    prints = {d: plain_print(t) for d, t in rows}
    least = {d: d for d in prints}
    changed = True
    while changed:
        changed = False
        for a, b in combinations(prints, 2):
            if least[a] != least[b] and (prints[a] ^ prints[b]).bit_count() <= errors:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    return {d: (f"{prints[d]:016x}", least[d]) for d in prints}


def got(df):
    return {r.doc_id: (r.fingerprint, r.component_id) for r in df.collect()}


def test_golay_code():
    rest, errors, counts = simhash.golay()
    codewords = np.arange(4096) << 11 | rest
    distances = np.bitwise_count(codewords[:400, None] ^ codewords[None, :])
    assert distances[distances > 0].min() == 7
    words = np.random.default_rng(1).integers(0, 1 << 23, 300)
    index, valid = simhash.near_codewords(words)
    for w, i, v in zip(words, index, valid):
        assert set(i[v]) == set(np.flatnonzero(np.bitwise_count(codewords ^ w) <= 4))


@pytest.mark.parametrize("errors", range(5))
def test_keys_meet_within_errors(errors):
    rng = random.Random(errors)
    for _ in range(1500):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), errors):
            b ^= 1 << bit
        (x, _), (y, _) = simhash.keys_of(np.array([a], np.uint64)), simhash.keys_of(np.array([b], np.uint64))
        assert set(x) & set(y), (a, b)


def test_every_spread_of_errors_over_the_segments():
    a = 0x0123456789ABCDEF
    (x, _) = simhash.keys_of(np.array([a], np.uint64))
    places = [[42, 47, 53, 63], [21, 26, 32, 41], [0, 5, 11, 20]]
    for n in range(5):
        for flips in combinations([p for segment in places for p in segment], n):
            b = a
            for bit in flips:
                b ^= 1 << bit
            (y, _) = simhash.keys_of(np.array([b], np.uint64))
            assert set(x) & set(y), flips


def test_spanning_connects_what_pairs_connect():
    rng = random.Random(5)
    for size in (9, 40, 150):
        centres = [rng.getrandbits(64) for _ in range(3)]
        prints = set()
        while len(prints) < size:
            p = rng.choice(centres)
            for _ in range(rng.randrange(7)):
                p ^= 1 << rng.randrange(64)
            prints.add(p)
        prints = np.array(sorted(prints), np.uint64)

        def roots(pairs):
            label = list(range(size))
            for a, b in pairs:
                old, new = label[b], label[a]
                label = [new if x == old else x for x in label]
            return {frozenset(i for i in range(size) if label[i] == x) for x in label}

        links = simhash.spanning(prints)
        assert all(int(prints[a] ^ prints[b]).bit_count() <= 4 for a, b in links)
        every = [(a, b) for a, b in combinations(range(size), 2) if int(prints[a] ^ prints[b]).bit_count() <= 4]
        assert roots(links) == roots(every)


def test_documents(spark):
    want = plain_components(read("documents", "doc_id, text"))
    assert got(queries.QUERIES["op13_simhash_dedup"](spark, SF)) == want
    assert any(d != c for d, (_, c) in want.items())


def near_texts(n):
    """Texts about one base, a word or two apart, and others."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        own = list(base)
        for _ in range(rng.randrange(1, 4)):
            own[rng.randrange(400)] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(own)))
    return rows + [(n + i, " ".join(f"y{i}z{k}" for k in range(30))) for i in range(40)]


def test_hot_keys_in_blocks(spark):
    rows = near_texts(150)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_components(rows)
    assert got(simhash.near_duplicates(docs)) == want
    prints = simhash.fingerprints(docs)
    pairs = simhash.links(prints, block=8).collect()
    label = {int(p, 16): int(p, 16) for p, _ in want.values()}
    for a, b in ((a & (1 << 64) - 1, b & (1 << 64) - 1) for a, b in pairs):
        assert (a ^ b).bit_count() <= 4
        old, new = label[b], label[a]
        label = {k: new if v == old else v for k, v in label.items()}
    groups = {}
    for p, c in want.values():
        groups.setdefault(c, set()).add(label[int(p, 16)])
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def test_long_text_in_chunks(monkeypatch):
    text = " ".join(f"a{i * i % 613}" for i in range(3000))
    monkeypatch.setattr(simhash, "CHUNK", 100)
    assert simhash.fingerprint(text) == plain_print(text)
    for short in (None, "", " \t\n\x0b\x0c\r ", "One", "One tWo ÄÖ", "a b c d", "a b c d e"):
        assert simhash.fingerprint(short) == plain_print(short)


def test_odd_rows(odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    found = {(r.doc_id, r.fingerprint, r.component_id) for r in rows}
    zero = "0" * 16
    # empty texts are one component; a row without an id joins it where its fingerprint does
    assert {(2, zero, 2), (3, zero, 2), (8, zero, 2), (None, zero, 2)} <= found
    assert {c for d, _, c in found if d in (1, 9)} == {1}
    assert simhash.near_duplicates(empty).count() == 0
    assert set(simhash.fingerprints(odd).columns) == {*odd.columns, "fingerprint"} - {"text"}
