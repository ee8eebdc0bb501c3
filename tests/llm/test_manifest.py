"""The manifest against a tree that is built node by node."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from hitlist.llm import manifest

KIND = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def path(levels, at):
    """(left, right) of a node at each level."""
    out = []
    for level in levels[:-1]:
        start = at // 8 * 8
        run = level[start : start + 8]
        out.append(("".join(run[: at - start]), "".join(run[at - start + 1 :])))
        at //= 8
    return out


def plain(rows):
    """A Counter-like list of the audit's rows."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[g] = levels_of([plain_leaf(r) for r in groups[g]])
    high = levels_of([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            proof = path(trees[g], i) + path(high, k)
            node = plain_leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                node = plain_leaf((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            for left, right in proof:
                node = H(left, node, right)
            root = high[-1][0]
            out.append((r[0], plain_leaf(r), trees[g][-1][0], root, H(*(a + b for a, b in proof)), node, node == root))
    return sorted(out, key=str)


def made(rows, spark, **options):
    found = manifest.audit(spark.createDataFrame(rows, KIND), **options).collect()
    return sorted((tuple(r) for r in found), key=str)


@pytest.mark.parametrize("sizes", [[1], [2], [8], [9], [64, 1, 65], [513, 7, 8, 9, 1, 1, 1, 1, 1, 2]])
def test_sizes(spark, sizes):
    rng = random.Random(sum(sizes))
    rows = []
    for k, n in enumerate(sizes):
        rows += [(d, f"s{d % 3}", f"l{k}", d * 10, f"Text {d} ä") for d in rng.sample(range(-5, 5000), n)]
    rng.shuffle(rows)
    assert made(rows, spark) == plain(rows)


def test_steps_give_the_same_proofs(spark):
    rows = [(d, "s", "l", d, "Some Text") for d in range(130)]
    assert made(rows, spark, step=1) == made(rows, spark, step=3) == plain(rows)


def test_odd_rows(spark, odd, empty):
    rows = [tuple(r) for r in odd.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    rows += [(7, "", "", 0, ""), (7, None, "", None, None), (7, "", "", 0, ""), (8, "x", "é", 1, "É"), (8, "x", "z", 1, "-")]
    assert made(rows, spark) == plain(rows)
    assert manifest.audit(odd).count() == odd.count() and manifest.audit(empty).count() == 0


def test_proofs_are_real_and_fail_for_changed_rows(spark):
    rows = [(d, "s", f"l{d % 2}", d, f"Text {d}") for d in range(100)]
    docs = spark.createDataFrame(rows, KIND).withColumn("proof", F.lit("own"))
    found = manifest.manifest(docs).collect()
    for r in found[::9]:
        node = r.leaf
        for left, right in r.proof:
            node = H(left, node, right)
        assert node == r.root
    changed = spark.createDataFrame([(*r[:4], "other") if r[0] == 5 else r for r in rows], KIND)
    assert manifest.manifest(changed).first().root != found[0].root


def test_groups_by_another_column_and_no_python_in_the_plan(spark, capsys):
    docs = spark.createDataFrame([(str(d), d % 5) for d in range(40)], "name string, part int")
    found = manifest.manifest(docs, ["name", "part"], group="part", key="name")
    assert found.count() == 40 and found.select("subroot").distinct().count() == 5
    found.explain()
    assert "Python" not in capsys.readouterr().out
