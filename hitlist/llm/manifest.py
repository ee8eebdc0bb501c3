"""A Merkle manifest of a dataset, with checkpointed levels and recomputed proofs.

Every row is a leaf, the digest of its columns. The leaves of a group (a language), in order of
their id, are a tree in which every 8 consecutive nodes (of the last run, what is left) make
the digest above, until one node is left: the group's subroot. The subroots, in order of their
group, make a tree likewise, whose last node is the root.

``build`` goes up ``STEP`` levels at a time and stores only the nodes it then arrives at: an
aligned subtree of 8**STEP stored nodes becomes one. ``proofs`` comes back down: each stored
level is grouped into its aligned subtrees once more, the missing nodes inside are recomputed
from the stored ones below, every stored node gets its siblings in the subtree and above it, and
the recomputed nodes are dropped. No group is larger than a subtree, so nothing depends on how
the rows are spread over the groups; leaves are placed by ranges of (group, id).

Digests are lowercase hex texts of SHA-256, of the UTF-8 bytes. All is in DataFrame functions.

Null values are digested as ``-``, so they differ from empty texts; null groups come first, and
null ids first in their group. Rows that repeat an id are leaves of their own, by digest. An
empty table has no leaves and no root. Other columns are not part of the manifest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlist.llm.shared import broadcast_if_small, fresh, stage
from hitlist.operators.keys import with_dense_id

ARITY, STEP = 8, 2
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(*values: Column) -> Column:
    """The digest of a row: of each value, ``-`` or its length in bytes, a colon and itself."""

    def encoded(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(*map(encoded, values))


def _runs(nodes: Column) -> Column:
    """An array of digests as an array of runs of ``ARITY``."""
    starts = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / ARITY).cast("int"))
    return F.transform(starts, lambda k: F.slice(nodes, k * ARITY + 1, ARITY))


def _above(nodes: Column) -> Column:
    """The level above an array of digests."""
    return F.transform(_runs(nodes), lambda run: F.sha2(F.array_join(run, "").cast("binary"), 256))


def _subtrees(level: DataFrame, step: int, kept: list[str] = ()) -> DataFrame:
    """The aligned subtrees of a stored level, (tree, place, size, node) and the ``kept``
    columns: (tree, place, size, own, height, level0 and up), where own has the nodes' kept
    columns, levels the digests from the stored ones up to the subtree's top, and height says
    how many levels there are above level0. size: how many nodes the tree has at this level."""
    gathered = level.groupBy("tree", F.floor(F.col("place") / ARITY**step).alias("place")).agg(
        F.max("size").alias("size"), F.array_sort(F.collect_list(F.struct("place", "node", *kept))).alias("own")
    )
    # the tree ends at a single node: fewer levels for what is left of it
    height = F.lit(0)
    for k in range(step):
        height = F.when(F.col("size") > ARITY**k, k + 1).otherwise(height)
    out = gathered.withColumn("height", height).withColumn("level0", F.col("own.node"))
    for k in range(step):
        below = F.col(f"level{k}")
        out = out.withColumn(f"level{k + 1}", F.when(F.col("height") > k, _above(below)).otherwise(below))
    return out


def build(leaves: DataFrame, step: int = STEP) -> list[DataFrame]:
    """The stored levels, lowest first: (tree, place, size, node), the lowest with its other
    columns too. The last has a node a tree. ``leaves`` are given likewise."""
    levels = [stage(leaves, "merkle-level")]
    while not levels[-1].filter("size > 1").isEmpty():
        up = _subtrees(levels[-1].select("tree", "place", "size", "node"), step).select(
            "tree",
            "place",
            F.ceil(F.col("size") / ARITY**step).cast("long").alias("size"),
            F.element_at(f"level{step}", 1).alias("node"),
        )
        levels.append(stage(up, "merkle-level"))
    return levels


def _siblings(level: Column, at: Column) -> Column:
    """What a node's run has left and right of it, as texts; ``at``: its place in the subtree."""
    run = F.slice(level, F.floor(at / ARITY).cast("int") * ARITY + 1, ARITY)
    own = F.pmod(at, F.lit(ARITY)).cast("int")
    left, right = F.slice(run, F.lit(1), own), F.slice(run, own + 2, ARITY)
    return F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))


def proofs(levels: list[DataFrame], above: DataFrame | None = None, step: int = STEP) -> DataFrame:
    """(top, proof) of every node of the lowest level, with its columns but size: proof is an
    array of (left, right), the texts beside the node's path at each level from its own up.
    ``above``: (tree, top, proof) of the trees' last nodes, by default themselves and nothing."""
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    known = levels[-1].select("tree", "place", F.col("node").alias("top"), nothing.alias("proof"))
    if above is not None:
        known = levels[-1].select("tree", "place").join(above, "tree")
    if len(levels) == 1:
        return levels[0].drop("size").join(known, ["tree", "place"])
    for at in reversed(range(len(levels) - 1)):
        kept = [c for c in levels[at].columns if c not in ("tree", "place", "size", "node")]
        beside = []
        for k in range(step):
            siblings = _siblings(F.col(f"level{k}"), F.floor(F.col("i") / ARITY**k).cast("int"))
            beside.append(F.when(F.col("height") > k, F.array(siblings)).otherwise(nothing))
        known = (
            _subtrees(levels[at], step, kept)
            .join(known, ["tree", "place"])
            .select("tree", "height", *(f"level{k}" for k in range(step)), "top", "proof", F.posexplode("own").alias("i", "one"))
            .select(
                "tree", "one.place", "one.node", *(f"one.{c}" for c in kept), "top", F.concat(*beside, "proof").alias("proof")
            )
        )
        if at:  # few beside the leaves: a node of each subtree
            known = stage(known.select("tree", "place", "top", "proof"), "merkle-proofs")
    return known


def fold(node: Column, proof: Column) -> Column:
    """The root that a node and its proof give."""
    return F.aggregate(proof, node, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]).cast("binary"), 256))


def proof_digest(proof: Column) -> Column:
    """The digest of a proof's texts, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def manifest(
    docs: DataFrame,
    columns: list[str] = COLUMNS,
    group: str = "lang",
    key: str = "doc_id",
    more: dict[str, Column] | None = None,
    step: int = STEP,
) -> DataFrame:
    """Per row: ``key``, leaf, subroot, root, proof (an array of the texts left and right of the
    path, from the leaf up), and the columns of ``more``, computed from ``docs``."""
    more = more or {}
    names = fresh(docs, "group", "key", "node", "number", "tree", "place", "size", "named")
    grouped, id_, node, number, tree, place, size, named = names
    rows = docs.select(
        F.col(f"`{group}`").alias(grouped),
        F.col(f"`{key}`").alias(id_),
        leaf(*(F.col(f"`{c}`") for c in columns)).alias(node),
        *(c.alias(n) for n, c in more.items()),
    )
    order = [F.col(grouped).asc_nulls_first(), F.col(id_).asc_nulls_first(), F.col(node)]
    rows = with_dense_id(rows, order, number, start=0)
    # a tree's name is the number of its first leaf: in the order of the groups, and not null
    trees = rows.groupBy(F.col(grouped).alias(named)).agg(F.min(number).alias(tree), F.count(F.lit(1)).alias(size))
    trees = broadcast_if_small(stage(trees, "merkle-trees"), 100 + F.coalesce(F.octet_length(F.col(named).cast("string")), F.lit(0)))
    placed = rows.join(trees, F.col(grouped).eqNullSafe(F.col(named))).select(
        F.col(tree).alias("tree"),
        (F.col(number) - F.col(tree)).alias("place"),
        F.col(size).alias("size"),
        F.col(node).alias("node"),
        F.struct(F.col(id_).alias("key"), *more).alias("row"),
    )
    levels = build(placed, step)
    subroots = with_dense_id(levels[-1].select(F.col("tree").alias("sub"), "node"), ["sub"], "place", start=0)
    subroots = stage(subroots, "merkle-subroots")
    count = F.lit(subroots.count()).cast("long")
    high = build(subroots.select(F.lit(0).alias("tree"), "place", count.alias("size"), "node", "sub"), step)
    above = proofs(high, step=step).select(
        F.col("sub").alias("tree"), F.struct(F.col("node").alias("subroot"), F.col("top").alias("root")).alias("top"), "proof"
    )
    return proofs(levels, stage(above, "merkle-roots"), step).select(
        F.col("row.key").alias(key), F.col("node").alias("leaf"), "top.subroot", "top.root", "proof", *(f"row.{n}" for n in more)
    )


def tampered(text: Column) -> Column:
    """The contract's tampering: A-Z in lower case."""
    return F.translate(text, UPPER, LOWER)


def audit(
    docs: DataFrame, chosen: Callable[[Column], Column] = lambda key: F.crc32(key.cast("string")) % 3 == 0, step: int = STEP
) -> DataFrame:
    """What a manifest of ``docs`` says of a copy in which the texts of chosen ids are tampered
    with: doc_id, leaf, subroot, root and proof_sha256 of ``docs``, and folded_root, from the
    copy's leaf and the proof, and verified, whether that is the root."""
    (copy,) = fresh(docs, "copy")
    again = F.when(
        F.coalesce(chosen(F.col("doc_id")), F.lit(False)),
        leaf(*(tampered(F.col(c)) if c == "text" else F.col(c) for c in COLUMNS)),
    )
    made = manifest(docs.select(*COLUMNS), more={copy: again}, step=step)
    made = made.withColumn("folded_root", fold(F.coalesce(copy, "leaf"), F.col("proof")))
    return made.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
