"""The prefix's length, and pairs' common shingles, against plain versions."""

import random

import numpy as np
import pytest

from hitlist.llm import neardup
from tests.llm import brute


def test_prefix_is_shortened_for_what_is_found():
    deep, least = neardup.DEPTH, neardup.depth_for()
    given = dict(recall=neardup.RECALL, percent=80, trees=neardup.TREES)
    # exact and close copies: the whole label finds them
    assert neardup.next_depth({100: 90_000, 97: 20_000}, deep, **given) == deep
    # many pairs right at the threshold, or nothing known: as short as the threshold needs
    assert neardup.next_depth({80: 5_000}, deep, **given) == least == neardup.next_depth({}, deep, **given)
    between = neardup.next_depth({84: 5_000, 100: 500}, deep, **given)
    assert least < between < deep
    assert neardup.next_depth({80: 5_000}, least, **given) == least


def test_expected_recall_is_that_of_real_labels():
    rng = random.Random(4)
    for percent, depth in ((80, 5), (85, 8), (90, 8)):
        hits = 0
        for k in range(300):
            # two sets of 400 with this share of the union in common
            common = round(400 * 2 * percent / (100 + percent))
            a = np.array([rng.getrandbits(64) for _ in range(800 - common)], np.uint64)
            x, y = (neardup.labels(np.sort(s)).view(np.uint64) for s in (a[:400], a[400 - common :]))
            hits += bool((x >> np.uint64(8 * (8 - depth)) == y >> np.uint64(8 * (8 - depth))).any())
        assert abs(hits / 300 - neardup.matched(percent, depth)) < 0.04


@pytest.mark.parametrize("few", [2, 16, 1000])
def test_common_values(monkeypatch, few):
    monkeypatch.setattr(neardup, "FEW", few)
    rng = random.Random(few)
    sets = [np.array(sorted(rng.sample(range(400), rng.choice([0, 1, 30, 200]))), np.uint64) for _ in range(40)]
    got = neardup._common(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert got[i, j] == len(set(a.tolist()) & set(b.tolist()))


def _texts(n, seed):
    """n texts about one base at about the threshold, so that many pairs are links and many not."""
    rng, base = random.Random(seed), [f"w{i}" for i in range(120)]
    rows = []
    for i in range(n):
        own = list(base)
        for _ in range(rng.randrange(3)):
            own[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((seed * 10_000 + i, " ".join(own)))
    return rows


def test_groups_of_any_size_by_one_rule(spark):
    rows = _texts(10, 1) + [(i, t.replace("w", "v")) for i, t in _texts(300, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.class_id, r.n_links) for r in neardup.links(df).collect()} == brute.links(rows)
