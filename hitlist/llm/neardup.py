"""Similarity join of documents on their 5-word shingles, by an LSH forest and exact checks.

1. Documents with the same set of shingles form a class; its smallest id stands for it.
2. Every representative gets a label of ``DEPTH`` MinHash values (a byte each) in each of
   ``TREES`` trees. The labels of a tree, sorted, are the leaves of its prefix trie: labels
   with a common prefix are neighbours, which join into groups (connected components).
3. Within a group all pairs are compared on their whole shingle sets, block against block,
   whatever the size of the group; they leave counts of links, a spanning forest and how many
   links there are of each similarity, never the pairs.
4. The prefix to match is at first the whole label. From the links' similarities follows how
   many a prefix of a given length finds: while the share found is expected to be below
   ``RECALL``, the prefix is shortened to the longest one that reaches it, and groups that
   grow by this are compared anew. It never gets shorter than what pairs right at the
   threshold need for that recall.
5. The forests' components are the groups of near duplicates.

The labels are dealt by range of (tree, label, id), so a prefix that a third of all documents
share is still split over many tasks; the ends of the ranges are matched in a second step.

Ids are integers, or texts of such. Words are runs of characters other than ASCII white space, lower-cased in A-Z. A text of one
to four words is one shingle. Null and empty texts link to nothing, and rows without an id
neither; they are their own class. Rows that repeat an id are one document. Empty tables
give empty results. Other columns are ignored by ``links`` and kept by ``keep_one``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlist.llm.graph import components
from hitlist.llm.hashing import run_hashes, word_hashes
from hitlist.llm.shared import bound_batches, broadcast_if_small, fresh, stage

SHINGLE, PERCENT = 5, 80
TREES, DEPTH, RECALL = 24, 8, 0.9998
#: Members of a group, and shingles of them, that are compared at a time with as many others.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20
#: Owners of a shingle up to which its pairs are counted one by one.
FEW = 16


def matched(percent: float, depth: int, trees: int = TREES) -> float:
    """The share of pairs of a similarity with a common prefix of ``depth`` values in some tree."""
    return 1 - (1 - (percent / 100) ** depth) ** trees


def depth_for(recall: float = RECALL, percent: int = PERCENT, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix at which pairs of the threshold's similarity match in some tree with
    at least this probability."""
    while depth > 1 and matched(percent, depth, trees) < recall:
        depth -= 1
    return depth


def next_depth(links_at: dict[int, int], depth: int, recall: float, percent: int, trees: int) -> int:
    """The longest prefix, ``depth`` at most, whose expected recall reaches the target, by the links
    found at ``depth`` (similarity in whole percent: number). Those not found are estimated
    from those found; a pair right at the threshold is taken for granted."""
    found = dict(links_at)
    found[percent] = found.get(percent, 0) + 1
    every = {s: n / matched(s, depth, trees) for s, n in found.items()}
    shortest = depth_for(recall, percent, trees, depth)
    while depth > shortest and sum(n * matched(s, depth, trees) for s, n in every.items()) < recall * sum(every.values()):
        depth -= 1
    return depth


def shingles(text: str | None, n: int = SHINGLE):
    """The sorted distinct hashes of n-word shingles."""
    import numpy as np

    words = (text or "").encode().lower().split()  # bytes: only A-Z change
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    return np.unique(run_hashes(h, min(n, len(words))))


def _multipliers(count: int):
    import numpy as np

    return np.random.default_rng(20240229).integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def labels(s, trees: int = TREES, depth: int = DEPTH):
    """A label a tree: the bytes of ``depth`` MinHash values, the first one uppermost."""
    import numpy as np

    by = _multipliers(trees * depth)
    least = np.full(len(by), np.iinfo(np.uint64).max)
    with np.errstate(over="ignore"):
        for at in range(0, len(s), 1024):
            least = np.minimum(least, np.multiply.outer(by, s[at : at + 1024]).min(axis=1))
        value = (least * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)
    shifts = np.uint64(8) * np.arange(depth - 1, -1, -1, dtype=np.uint64)
    return np.bitwise_or.reduce(value.reshape(trees, depth) << shifts, axis=1).view(np.int64)


def _signatures(trees: int, depth: int):
    def rows(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        for batch in batches:
            prints, sizes, made = [], [], []
            for text in batch.column("text"):
                s = shingles(text.as_py())
                sizes.append(len(s))
                prints.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                made.append(labels(s, trees, depth) if len(s) else np.empty(0, np.int64))
            ends = np.concatenate([[0], np.cumsum([len(m) for m in made])])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(prints, pa.binary()), pa.array(sizes, pa.int64())]
                + [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(made), pa.int64()))],
                names=["doc_id", "print", "n_shingles", "labels"],
            )

    return rows


def _prefix_edges(match: int, depth: int):
    """Streams through sorted labels: an edge from each label to the first of its prefix, and
    the first and last label of the partition (to be matched with the neighbours')."""

    def rows(batches):
        import numpy as np
        import pyarrow as pa

        drop = np.uint64(8 * (depth - match))
        head = None  # (tree, prefix, node) of the current prefix
        last = None
        for batch in batches:
            if not len(batch):
                continue
            tree = batch.column("tree").to_numpy()
            label = batch.column("label").to_numpy()
            node = batch.column("node").to_numpy()
            prefix = (label.view(np.uint64) >> drop).view(np.int64)
            new = np.concatenate([[True], (tree[1:] != tree[:-1]) | (prefix[1:] != prefix[:-1])])
            firsts = node[np.flatnonzero(new)][np.cumsum(new) - 1]
            if head is not None and head[:2] == (int(tree[0]), int(prefix[0])):
                run = np.cumsum(new) == 1
                firsts[run] = head[2]
            ends = []
            if head is None:
                ends.append((int(tree[0]), int(label[0]), int(node[0])))
            head = (int(tree[-1]), int(prefix[-1]), int(firsts[-1]))
            last = (int(tree[-1]), int(label[-1]), int(node[-1]))
            linked = node != firsts
            yield _edge_batch(node[linked], firsts[linked], ends)
        if last is not None:
            yield _edge_batch(np.empty(0, np.int64), np.empty(0, np.int64), [last])

    return rows


def _edge_batch(a, b, ends):
    import pyarrow as pa

    n, m = len(a), len(ends)
    column = lambda made, k: pa.array([*made.tolist(), *(e[k] for e in ends)], pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            column(a, 2),
            pa.array([*b.tolist(), *[None] * m], pa.int64()),
            pa.array([*[None] * n, *(e[0] for e in ends)], pa.int64()),
            pa.array([*[None] * n, *(e[1] for e in ends)], pa.int64()),
        ],
        names=["a", "b", "tree", "label"],
    )


def candidate_edges(leaves: DataFrame, match: int, depth: int = DEPTH) -> DataFrame:
    """(a, b): edges that connect all nodes of a tree whose labels share a prefix of ``match``
    values. ``leaves``: (tree, label, node)."""
    order = ["tree", "label", "node"]
    found = stage(
        leaves.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_prefix_edges(match, depth), "a long, b long, tree long, label long"),
        "prefix-edges",
    )
    # two rows a partition: the last of one and the first of the next with the same prefix
    ends = found.filter("b IS NULL").select(
        "tree", F.call_function("shiftrightunsigned", "label", F.lit(8 * (depth - match))).alias("prefix"), "a"
    )
    least = ends.groupBy("tree", "prefix").agg(F.min("a").alias("b"))
    return (
        found.filter("b IS NOT NULL").select("a", "b").union(ends.join(least, ["tree", "prefix"]).select("a", "b"))
    ).filter("a != b").distinct()


def _common(sets: list):
    """How many values each two of the sets have in common."""
    import numpy as np

    n = len(sets)
    values, owner = np.concatenate(sets), np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.concatenate([[True], values[1:] != values[:-1]]) if len(values) else np.empty(0, bool)
    number = np.cumsum(new) - 1
    owners = np.bincount(number, minlength=1)  # of each value
    common = np.zeros(n * n, np.int64)
    few = owners[number] <= FEW if len(number) else np.empty(0, bool)
    for step in range(1, FEW):  # values of few owners: pairs of places, step by step
        at = np.flatnonzero((number[step:] == number[:-step]) & few[step:])
        if not len(at):
            break
        common += np.bincount(owner[at] * n + owner[at + step], minlength=n * n)
    common = common.reshape(n, n)
    common = common + common.T
    often = owners > FEW  # the others by products of matrices
    keep = ~few
    column, owner = (np.cumsum(often) - 1)[number[keep]], owner[keep]
    width = 2048
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [at, at + width])
        member = np.zeros((n, width), np.float32)
        member[owner[lo:hi], column[lo:hi] - at] = 1
        common += (member @ member.T).astype(np.int64)
    return common


def _linked(sets: list, percent: int):
    """(linked, similarity): for all pairs of the sets, whether their similarity is at least
    percent / 100, and it in whole percent."""
    import numpy as np

    sizes = np.array([len(s) for s in sets])
    common = _common(sets)
    union = sizes[:, None] + sizes[None, :] - common
    return (100 * common >= percent * union) & (common > 0), 100 * common // np.maximum(union, 1)


def _sets(batches):
    """The members' texts as their sorted shingles."""
    import pyarrow as pa

    for batch in batches:
        made = pa.array([shingles(t.as_py()).tobytes() for t in batch.column("text")], pa.binary())
        kept = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), made], names=[*kept, "grams"])


def _verify(percent: int):
    """Streams through members sorted by (unit, i, j); per block pair: links of each member, with
    the nearest member of a spanning forest, and, without a node, how many links (texts) there
    are of a similarity (near)."""

    def block(members):
        import numpy as np

        own, other = members["i"], members["j"]
        seen = {}
        for at, node in enumerate(members["node"]):
            seen.setdefault((node, members["grams"][at]), at)
        at = list(seen.values())
        nodes = np.array([members["node"][k] for k in at])
        weight = np.array([members["size"][k] for k in at])
        side = np.array([members["block"][k] for k in at])
        linked, similarity = _linked([np.frombuffer(members["grams"][k], np.uint64) for k in at], percent)
        linked &= nodes[:, None] != nodes[None, :]
        if own[0] != other[0]:  # pairs within a block are another pair's task
            linked &= side[:, None] != side[None, :]
        texts, docs = linked.sum(axis=1), linked @ weight
        root = np.arange(len(nodes))
        while True:  # the smallest place that can be reached
            best = np.where(linked, root[None, :], len(nodes)).min(axis=1)
            best = np.minimum(root, best)
            best = best[best]
            if (best == root).all():
                break
            root = best
        unit = members["unit"][0]
        for k in np.flatnonzero(texts):
            yield unit, int(nodes[k]), int(nodes[root[k]]), int(texts[k]), int(docs[k])
        for s, n in enumerate(np.bincount(similarity[linked], minlength=1).tolist()):
            if n:
                yield unit, None, s, n // 2, 0

    def rows(batches):
        import pyarrow as pa

        names = ["unit", "node", "near", "texts", "docs"]
        held: dict[str, list] = {}
        current, out = None, []
        for batch in batches:
            columns = batch.to_pydict()
            for at, key in enumerate(zip(columns["unit"], columns["i"], columns["j"])):
                if key != current:
                    if held:
                        out += block(held)
                    held, current = {c: [] for c in columns}, key
                for c, values in columns.items():
                    held[c].append(values[at])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=names)
                out = []
        if held and (out := list(block(held))):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=names)

    return rows


def compared(docs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The stored links within units of ``members`` (unit, node, size, n_shingles), all pairs of
    each: rows of ``_verify``. A member's shingles are made once and sent once for each block that its
    own is compared with, one for most units."""
    total = members.groupBy("unit").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("sum")).filter("n > 1")
    by_number, by_size = F.ceil(F.col("n") / BLOCK), F.ceil(F.col("sum") / BLOCK_SHINGLES)
    total = stage(total.select("unit", F.least("n", F.greatest(by_number, by_size)).cast("int").alias("blocks")), "blocks")
    placed = members.join(total, "unit").select(
        "unit", "node", "size", "blocks", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block")
    )
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least("block", k).alias("i"), F.greatest("block", k).alias("j"))
    )
    key = ["unit", "i", "j"]
    texts = broadcast_if_small(stage(placed, "members"), 64).join(docs.filter("text IS NOT NULL"), F.col("node") == F.col("doc_id"))
    sets = texts.select("unit", "node", "size", "block", "blocks", "text").mapInArrow(
        _sets, "unit long, node long, size long, block int, blocks int, grams binary"
    )
    return stage(
        sets.select("unit", "node", "size", "block", "grams", F.explode(pairs).alias("p"))
        .select("unit", "node", "size", "block", "grams", "p.i", "p.j")
        .repartition(*key)
        .sortWithinPartitions(*key)
        .mapInArrow(_verify(percent), "unit long, node long, near long, texts long, docs long"),
        "links",
    )


def links(docs: DataFrame, percent: int = PERCENT, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> DataFrame:
    """Per row: doc_id, class_id (the smallest id of its group of near duplicates), text_id (the
    smallest id with the same shingles), n_copies (documents with the same shingles), n_links
    (other documents at the threshold or above) and n_linked_texts (other shingle sets so)."""
    bound_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stage(
        docs.mapInArrow(
            _signatures(trees, depth), "doc_id long, print binary, n_shingles long, labels array<long>"
        ),
        "signatures",
    )
    classes = (
        signed.filter("print IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("print")
        .agg(F.min("doc_id").alias("text_id"), F.count(F.lit(1)).alias("n_copies"), F.max("n_shingles").alias("n_shingles"))
    )
    classes = stage(classes, "classes")
    first = signed.join(
        classes.select(F.col("print").alias("_print"), "text_id"),
        (F.col("doc_id") == F.col("text_id")) & (F.col("print") == F.col("_print")),
        "left_semi",
    )
    leaves = first.select(F.col("doc_id").alias("node"), F.posexplode("labels").alias("tree", "label")).select(
        "tree", "label", "node"
    )
    leaves = stage(leaves, "leaves")
    sizes = classes.groupBy(F.col("text_id").alias("node")).agg(
        F.sum("n_copies").alias("size"), F.sum("n_shingles").alias("n_shingles")
    )

    match, verified, before = depth, None, None
    while True:
        group = components(candidate_edges(leaves, match, depth))
        units = stage(group.groupBy(F.col("root").alias("unit")).agg(F.count(F.lit(1)).alias("n")), "units")
        # groups only grow: one of the same size is the same and was compared already
        anew = units if before is None else units.join(before, ["unit", "n"], "left_anti")
        members = group.withColumnRenamed("root", "unit").join(anew.select("unit"), "unit", "left_semi").join(sizes, "node")
        found = compared(docs, members, percent)
        if verified is not None:
            kept = verified.join(units.join(before, ["unit", "n"], "left_semi").select("unit"), "unit", "left_semi")
            found = found.unionByName(kept)
        verified, before = found, units
        by_similarity = verified.filter("node IS NULL").groupBy("near").agg(F.sum("texts").alias("n"))
        shorter = next_depth({r["near"]: r["n"] for r in by_similarity.collect()}, match, recall, percent, trees)
        if shorter == match:
            break
        match = shorter
    verified = verified.filter("node IS NOT NULL")
    near = components(verified.select(F.col("node").alias("a"), F.col("near").alias("b")))
    counts = verified.groupBy("node").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("linked"))
    # one row a class, so that the only join on a hot key is that of documents with their class
    known = (
        classes.join(near, F.col("text_id") == F.col("node"), "left")
        .drop("node")
        .join(counts, F.col("text_id") == F.col("node"), "left")
        .select(
            F.col("print").alias("_print"),
            "text_id",
            F.coalesce("root", "text_id").alias("class_id"),
            "n_copies",
            (F.col("n_copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
            F.coalesce("texts", F.lit(0).cast("long")).alias("n_linked_texts"),
        )
    )
    has_id = F.col("doc_id").isNotNull()
    return signed.join(known, has_id & (F.col("print") == F.col("_print")), "left").select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("text_id", "doc_id").alias("text_id"),
        F.coalesce("n_copies", F.lit(1).cast("long")).alias("n_copies"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("n_linked_texts", F.lit(0).cast("long")).alias("n_linked_texts"),
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, that of the smallest id.
    Rows without an id stay."""
    (name,) = fresh(docs, "gone")
    gone = links(docs, **options).filter("doc_id != class_id").select(F.col("doc_id").alias(name)).distinct()
    gone = broadcast_if_small(stage(gone, "near-duplicates"), 32)
    return docs.join(gone, F.col("doc_id").cast("long") == F.col(name), "left_anti")
