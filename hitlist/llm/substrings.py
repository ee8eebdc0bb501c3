"""Repeated passages across documents: seed on winnowed anchors, extend, remove.

A passage repeats if a window of ``WINDOW`` consecutive words also starts in a document with
a smaller id. Every word such a window covers is removed; windows are judged on the input.

1. Seeds. Of the hashes of all ``SEED``-word runs within a window the smallest is the
   window's anchor, so equal windows have the same anchor at the same place in them. One row
   per anchor place; anchors of a single document go.
2. Documents join their shared anchors. Around each, the windows that have it as their anchor
   (the extension to both sides) are hashed word by word.
3. Windows of an anchor are compared with each other only: the places of an anchor meet in
   one task, which streams through anchors in sorted order. For anchors with more than
   ``HEAVY`` places, each task first reduces its windows to the distinct ones with their
   smallest and largest id, these are merged, and the places are dealt to tasks with what
   they need to know of them, in chunks of about ``CHUNK`` windows and salts of ``SALTED``
   places; so no task holds a hot anchor.
4. Covered places become intervals by document; the words outside are kept.

Decisions need a 64-bit hash of the anchor and one of the window to agree at the same place.

Words are runs of characters other than ASCII white space. Null text has no words. A null id
is smaller than none: such rows are kept whole and remove nothing. Rows that repeat an id
don't remove each other, and each gets its result row. Empty tables give empty results.
Other columns are ignored by ``report`` and kept by ``remove``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlist.llm.hashing import run_hashes, word_hashes
from hitlist.llm.shared import SPACES, bound_batches, fresh, stage, text_key

WINDOW, SEED = 50, 12
#: Places of an anchor that one task may hold.
HEAVY = 512
#: Windows that a task reduces at a time, and those that a row of merged ones holds about.
HOLD, CHUNK = 200_000, 1024
#: Places of a hot anchor that go to one task.
SALTED = 4_000
#: Words of a text handled at a time.
BLOCK = 1 << 20

_POSITION_BITS = 21  # more than BLOCK and a window


def window_anchors(h, window: int = WINDOW, seed: int = SEED):
    """For each window place, the place of its anchor: the leftmost smallest seed hash in it;
    and the seed hashes."""
    import numpy as np

    g = run_hashes(h, seed)
    if len(h) < window:
        return np.empty(0, np.int64), g
    low = np.uint64((1 << _POSITION_BITS) - 1)
    m = (g & ~low) | np.arange(len(g), dtype=np.uint64)
    width, span = 1, window - seed + 1
    while 2 * width <= span:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    if width < span:
        m = np.minimum(m[: len(m) - (span - width)], m[span - width :])
    return (m & low).astype(np.int64), g


def _blocks(words: list[bytes], window: int):
    """(first word, hashes) of overlapping stretches, so that each window lies in one."""
    for at in range(0, max(len(words) - window + 1, 1), BLOCK):
        yield at, word_hashes(words[at : at + BLOCK + window - 1])


def _anchors(window: int, seed: int):
    def rows(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            row, place, value = [], [], []
            for i, text in enumerate(batch.column("text")):
                words = (text.as_py() or "").encode().split()
                if len(words) < window:
                    continue
                for at, h in _blocks(words, window):
                    a, g = window_anchors(h, window, seed)
                    a = a[np.concatenate([[True], a[1:] != a[:-1]])]
                    row.append(np.full(len(a), i))
                    place.append(a + at)
                    value.append(g[a].view(np.int64))
            if row:
                take = pa.array(np.concatenate(row))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(take), batch.column("key").take(take)]
                    + [pa.array(np.concatenate(place), pa.int64()), pa.array(np.concatenate(value), pa.int64())],
                    names=["doc_id", "key", "place", "anchor"],
                )

    return rows


def _windows(window: int, seed: int, heavy: bool):
    """Per marked anchor place: the windows that have it as their anchor, as hashes."""

    def rows(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            row, anchor, start, hashes, ends = [], [], [], [], [0]
            marks = batch.column("marks").to_pylist()
            for i, text in enumerate(batch.column("text")):
                mine = np.array(sorted({m["place"] for m in marks[i] if m["heavy"] == heavy}), np.int64)
                if not len(mine):
                    continue
                for at, h in _blocks(text.as_py().encode().split(), window):
                    a, g = window_anchors(h, window, seed)
                    if not len(a):
                        continue
                    w = run_hashes(h, window).view(np.int64)
                    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
                    last = np.append(first[1:], len(a))
                    here = np.isin(a[first] + at, mine)
                    for f, e in zip(first[here].tolist(), last[here].tolist()):
                        row.append(i)
                        anchor.append(int(g[a[f]].view(np.int64)))
                        start.append(f + at)
                        hashes.append(w[f:e])
                        ends.append(ends[-1] + e - f)
            if row:
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(take), batch.column("key").take(take), pa.array(anchor, pa.int64()), pa.array(start, pa.int64())]
                    + [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(hashes), pa.int64()))],
                    names=["doc_id", "key", "anchor", "start", "hashes"],
                )

    return rows


_WINDOW_ROWS = "doc_id long, key long, anchor long, start long, hashes array<long>"


def _repeats(table, window: int):
    """Intervals of words covered by windows that a smaller id of the table has too."""
    import numpy as np
    import pyarrow as pa

    lists = table.column("hashes").combine_chunks()
    values = lists.flatten().to_numpy()
    sizes = np.diff(lists.offsets.to_numpy())
    row = np.repeat(np.arange(len(sizes)), sizes)
    anchor = table.column("anchor").to_numpy()[row]
    doc = table.column("doc_id").to_numpy()[row]
    place = table.column("start").to_numpy()[row] + np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    order = np.lexsort((doc, values, anchor))
    v, a, d = values[order], anchor[order], doc[order]
    new = np.concatenate([[True], (v[1:] != v[:-1]) | (a[1:] != a[:-1])])
    least = np.empty(len(d), d.dtype)
    least[order] = d[np.flatnonzero(new)][np.cumsum(new) - 1]
    hit = np.flatnonzero(doc > least)
    if not len(hit):
        return None
    begin = np.concatenate([[True], (np.diff(hit) != 1) | (row[hit][1:] != row[hit][:-1])])
    first, last = hit[begin], hit[np.append(np.flatnonzero(begin)[1:] - 1, len(hit) - 1)]
    take = pa.array(row[first])
    return pa.RecordBatch.from_arrays(
        [table.column(c).combine_chunks().take(take) for c in ("doc_id", "key")]
        + [pa.array(place[first], pa.int64()), pa.array(place[last] + window, pa.int64())],
        names=["doc_id", "key", "start", "end"],
    )


def _compare(window: int):
    """Streams through rows sorted by anchor; holds the rows of whole anchors only."""

    def rows(batches):
        import numpy as np
        import pyarrow as pa

        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n < 4000:
                continue
            table = pa.Table.from_batches(held)
            anchors = table.column("anchor").to_numpy()
            whole = int(np.searchsorted(anchors, anchors[-1]))  # the last anchor may go on
            if whole:
                if (out := _repeats(table.slice(0, whole), window)) is not None:
                    yield out
                table = table.slice(whole)
            held, n = table.combine_chunks().to_batches(), len(table)
        if held and (out := _repeats(pa.Table.from_batches(held), window)) is not None:
            yield out

    return rows


def _distinct(batches):
    """(anchor, hash, lo, hi): the distinct windows of what a task holds at a time."""
    import numpy as np
    import pyarrow as pa

    def reduced():
        table = pa.Table.from_batches(held)
        lists = table.column("hashes").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        value = lists.flatten().to_numpy()
        anchor = np.repeat(table.column("anchor").to_numpy(), sizes)
        doc = np.repeat(table.column("doc_id").to_numpy(), sizes)
        order = np.lexsort((doc, value, anchor))
        v, a, d = value[order], anchor[order], doc[order]
        first = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (a[1:] != a[:-1])]))
        last = np.append(first[1:], len(v)) - 1
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (a[first], v[first], d[first], d[last])], names=["anchor", "hash", "lo", "hi"]
        )

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch.column("hashes").flatten())
        if n >= HOLD:
            yield reduced()
            held, n = [], 0
    if n:
        yield reduced()


def _covered(window: int):
    """Streams through rows sorted so that a chunk of windows, with their smallest ids, comes
    before the places that are looked up in it: intervals of the places."""

    def rows(batches):
        import numpy as np
        import pyarrow as pa

        current, known, least = None, None, None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("anchor", "chunk", "salt"))))
            docs, starts = batch.column("doc_id").to_pylist(), batch.column("start").to_pylist()
            row, start, end = [], [], []
            chunks, lists = batch.column("known"), batch.column("hashes")
            is_chunk = chunks.is_valid().to_numpy(zero_copy_only=False)
            hashes, cuts = lists.values.to_numpy(), lists.offsets.to_pylist()
            for i, key in enumerate(keys):
                if is_chunk[i]:
                    known, least = (chunks[i].values.field(c).to_numpy() for c in ("hash", "lo"))
                    order = np.argsort(known)
                    current, known, least = key, known[order], least[order]
                elif key == current:
                    own = hashes[cuts[i] : cuts[i + 1]]
                    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    hit = np.flatnonzero((known[at] == own) & (least[at] < docs[i]))
                    if len(hit):
                        gap = np.diff(hit) > 1
                        first, last = hit[np.append(True, gap)], hit[np.append(gap, True)]
                        row += [i] * len(first)
                        start += (first + starts[i]).tolist()
                        end += (last + starts[i] + window).tolist()
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("key").take(take), pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                names=["doc_id", "key", "start", "end"],
            )

    return rows


_INTERVALS = "doc_id long, key long, start long, end long"


def intervals(docs: DataFrame, window: int = WINDOW, seed: int = SEED, heavy: int = HEAVY):
    """(doc_id, key, text, intervals) of documents with words to remove: covered stretches of
    words, from start to before end."""
    bound_batches(docs.sparkSession)
    mine = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), "text")
        .filter(F.col("doc_id").isNotNull())
        .filter(F.octet_length("text") >= 2 * window - 1)  # fewer bytes hold no window
    )
    places = stage(
        mine.mapInArrow(_anchors(window, seed), "doc_id long, key long, place long, anchor long"), "anchors"
    )
    shared = (
        places.groupBy("anchor")
        .agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("n"))
        .filter("lo < hi")
        .select("anchor", (F.col("n") > heavy).alias("heavy"))
    )
    # stored first: a join with what was summed by the same key could not split a hot anchor
    shared = stage(shared, "shared-anchors")
    marks = places.join(shared, "anchor").groupBy("doc_id", "key").agg(
        F.collect_set(F.struct("place", "heavy")).alias("marks")
    )
    seeded = stage(mine.join(marks, ["doc_id", "key"]), "seeded")

    light = (
        seeded.mapInArrow(_windows(window, seed, False), _WINDOW_ROWS)
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_compare(window), _INTERVALS)
    )
    hot = stage(
        seeded.filter(F.exists("marks", lambda m: m["heavy"])).mapInArrow(_windows(window, seed, True), _WINDOW_ROWS),
        "hot-anchors",
    )
    least = stage(
        hot.mapInArrow(_distinct, "anchor long, hash long, lo long, hi long")
        .groupBy("anchor", "hash")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .filter("lo < hi"),
        "shared-windows",
    )
    # per hot anchor: into how many chunks its windows go, and its places into how many salts
    parts = stage(
        least.groupBy("anchor")
        .agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("long").alias("chunks"))
        .join(hot.groupBy("anchor").agg(F.ceil(F.count(F.lit(1)) / SALTED).cast("long").alias("salts")), "anchor"),
        "hot-parts",
    )
    place = ["doc_id", "key", "start", "hashes"]
    known = (
        least.join(parts, "anchor")
        .groupBy("anchor", "salts", F.pmod("hash", "chunks").alias("chunk"))
        .agg(F.collect_list(F.struct("hash", "lo")).alias("known"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
        .select("anchor", "chunk", "salt", "known")
    )
    looked_up = (
        hot.join(parts, "anchor")
        .withColumn("chunk", F.explode(F.array_distinct(F.transform("hashes", lambda h: F.pmod(h, F.col("chunks"))))))
        .select("anchor", "chunk", F.pmod(F.xxhash64("doc_id", "key", "start"), "salts").alias("salt"), *place)
    )
    order = ["anchor", "chunk", "salt"]
    heavy_rows = (
        looked_up.unionByName(known, allowMissingColumns=True)
        .repartition(*order)
        .sortWithinPartitions(*order, F.col("known").isNull())
        .mapInArrow(_covered(window), _INTERVALS)
    )
    covered = light.unionByName(heavy_rows).groupBy("doc_id", "key").agg(
        F.collect_set(F.struct("start", "end")).alias("intervals")
    )
    return seeded.drop("marks").join(covered, ["doc_id", "key"])


def _keep(digest: bool):
    def rows(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            removed, kept = [], []
            stretches = batch.column("intervals").to_pylist()
            for text, cover in zip(batch.column("text"), stretches):
                words = text.as_py().encode().split()
                ends = np.zeros(len(words) + 1, np.int64)
                for s in cover:
                    ends[s["start"]] += 1
                    ends[s["end"]] -= 1
                keep = np.cumsum(ends[:-1]) == 0
                left = b" ".join([words[i] for i in np.flatnonzero(keep)])
                removed.append(int(len(words) - keep.sum()))
                kept.append(hashlib.sha256(left).hexdigest() if digest else left.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "key", "n_removed", "kept"],
            )

    return rows


def _kept(docs: DataFrame, digest: bool, **options) -> DataFrame:
    return (
        intervals(docs, **options)
        .mapInArrow(_keep(digest), "doc_id long, key long, n_removed long, kept string")
        .select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "n_removed", "kept")
        .dropDuplicates(["_id", "_key"])
    )


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    plain = F.btrim(F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), SPACES, " "))
    base = docs.select("doc_id", text_key().alias("key"), plain.alias("plain")).select(
        "doc_id",
        "key",
        F.when(F.col("plain") == "", 0)
        .otherwise(F.length("plain") - F.length(F.replace("plain", F.lit(" "), F.lit(""))) + 1)
        .cast("long")
        .alias("n_words"),
        F.sha2("plain", 256).alias("whole"),
    )
    changed = _kept(docs, True, **options)
    return base.join(changed, (F.col("doc_id") == F.col("_id")) & (F.col("key") == F.col("_key")), "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("kept", "whole").alias("kept_sha256"),
    )


def remove(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with repeated passages cut out of the texts; texts that change are their kept
    words, joined by single spaces."""
    own, other, key, removed, kept = fresh(docs, "own", "other", "key", "removed", "kept")
    changed = _kept(docs, False, **options).toDF(other, key, removed, kept)
    joined = docs.withColumn(own, text_key()).join(
        changed, (F.col("doc_id") == F.col(other)) & (F.col(own) == F.col(key)), "left"
    )
    return joined.select(*(F.coalesce(kept, "text").alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns))
