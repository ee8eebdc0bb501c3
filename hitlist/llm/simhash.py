"""SimHash near duplicates by Golay-code fuzzy hashing.

1. A document's fingerprint has 64 bits, each the majority of that bit among the XXH64 hashes
   of its 4-word shingles, repeats included.
2. The fingerprint is cut into segments of 22, 21 and 21 bits, each a word of the (23, 12)
   Golay code's space. A segment has as keys the indices of the codewords within 4 bits of it:
   its own codeword and, where that is 3 bits away, the five others at 4 bits. Two segments
   that differ in at most 2 bits always have such a key in common.
3. At most 4 errors fall on three segments. Either a segment has none and another at most 2:
   its bits and the other's keys make a key, for each ordered two segments. Or all have one,
   two of them exactly one, so a half of each of these two is clean: both halves and the
   keys of the third segment make a key. A pair within 4 bits thus shares one of these keys.
4. Distinct fingerprints join on the keys and every candidate is verified on all 64 bits.
   Links' connected components give the result.

A key that more than ``BLOCK`` fingerprints share is dealt in pairs of blocks. Within a run of
one key, long runs are joined round pivots: everything near a pivot is linked to it, and two
such balls are compared only until a link joins them, so no run leaves all its pairs, and none
of its links is lost to the components.

Words are runs of characters other than ASCII white space, lower-cased in A-Z; fewer than four
are one shingle. Null and empty texts have fingerprint zero, which links like any other. Rows
that repeat an id are judged row by row. A row without an id joins no component of its own: it
gets that of the documents with its fingerprint, or null. Empty tables give empty results.
Other columns are ignored by ``near_duplicates`` and kept by ``fingerprints``.
"""

from __future__ import annotations

from functools import cache
from itertools import repeat

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlist.llm.graph import components
from hitlist.llm.shared import broadcast_if_small, stage

SHINGLE, SEED, ERRORS = 4, 42, 4
#: (shift, bits) of the segments, uppermost first; each has a half of 11 bits and the rest.
SEGMENTS = ((42, 22), (21, 21), (0, 21))
HALF = 11
#: The Golay code's generator, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b1010_1110_0011
CHECK_BITS, DATA_BITS, KEYS = 11, 12, 6
#: Fingerprints of one key that are compared at a time with as many others.
BLOCK = 4096
#: Rows of a run up to which all its pairs are looked at.
SHORT = 8
#: Shingles that are hashed at a time.
CHUNK = 1 << 16


def fingerprint(text: str | None) -> int:
    import numpy as np
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()  # bytes: only A-Z change
    if not words:
        return 0
    n = min(SHINGLE, len(words))
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - n + 1]
    ends = ends[n - 1 :]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist())
        hashes = np.fromiter(map(xxh64_intdigest, (joined[a:b] for a, b in spans), repeat(SEED)), np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, name: str = "fingerprint") -> DataFrame:
    """``docs`` without their texts and with their fingerprints, as signed longs."""
    kept = [c for c in docs.columns if c not in ("text", name)]

    def rows(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            made = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64)
            columns = [batch.column(c) for c in kept] + [pa.array(made.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, name])

    schema = docs.select(*(F.col(f"`{c}`") for c in kept), F.lit(0).cast("long").alias(name)).schema
    return docs.mapInArrow(rows, schema)


# ----------------------------------------------------------------------------- the code


@cache
def golay():
    """(remainders, errors, counts): the check bits of every 12 data bits; for every syndrome
    the errors that lead to codewords within 4 bits, the nearest first; and their number."""
    import numpy as np

    data = np.arange(1 << DATA_BITS, dtype=np.int64)
    rest = data << CHECK_BITS
    for bit in range(DATA_BITS + CHECK_BITS - 1, CHECK_BITS - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - CHECK_BITS)), rest)
    words = np.arange(1 << (DATA_BITS + CHECK_BITS), dtype=np.int64)
    weight = np.bitwise_count(words)
    leaders = words[weight <= 3]
    codewords = data << CHECK_BITS | rest
    sevens = codewords[np.bitwise_count(codewords) == 7]
    errors = np.zeros((1 << CHECK_BITS, KEYS), np.int64)
    counts = np.ones(1 << CHECK_BITS, np.int64)
    for leader in leaders.tolist():
        syndrome = int(rest[leader >> CHECK_BITS]) ^ (leader & (1 << CHECK_BITS) - 1)
        errors[syndrome] = leader
        if leader.bit_count() == 3:  # five codewords of weight 7 have all three bits
            errors[syndrome, 1:] = leader ^ sevens[sevens & leader == leader]
            counts[syndrome] = KEYS
    return rest, errors, counts


def near_codewords(words):
    """(indices, valid) of the codewords within 4 bits of each 23-bit word, six columns."""
    import numpy as np

    rest, errors, counts = golay()
    syndrome = rest[words >> CHECK_BITS] ^ (words & (1 << CHECK_BITS) - 1)
    return (words[:, None] ^ errors[syndrome]) >> CHECK_BITS, np.arange(KEYS) < counts[syndrome][:, None]


def keys_of(prints):
    """(keys, rows): the join keys of an array of fingerprints, and whose each is."""
    import numpy as np

    prints = prints.astype(np.uint64)
    cut = [((prints >> np.uint64(s)) & np.uint64((1 << b) - 1)).astype(np.int64) for s, b in SEGMENTS]
    near = [near_codewords(x) for x in cut]
    halves = [(x >> HALF, x & (1 << HALF) - 1) for x in cut]
    exact = []  # the key's clean bits, and the segment whose codewords complete it
    for i in range(3):
        exact += [(cut[i], j) for j in range(3) if j != i]
    for t in range(3):
        i, j = (k for k in range(3) if k != t)
        exact += [(x << HALF | y, t) for x in halves[i] for y in halves[j]]
    keys, rows = [], []
    for kind, (bits, segment) in enumerate(exact):
        index, valid = near[segment]
        made = (np.int64(kind) << np.int64(22 + DATA_BITS)) | bits[:, None] << DATA_BITS | index
        keys.append(made[valid])
        rows.append(np.nonzero(valid)[0])
    return np.concatenate(keys), np.concatenate(rows)


def _keys(batches):
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        prints = batch.column("fingerprint").to_numpy()
        for at in range(0, len(prints), 4096):
            part = prints[at : at + 4096]
            keys, rows = keys_of(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows])], names=["unit", "fingerprint"])


# ----------------------------------------------------------------------------- links


def spanning(prints, errors: int = ERRORS):
    """(a, b) places of links that connect whatever pairs within ``errors`` bits connect."""
    import numpy as np

    def distance(x, y):
        return np.bitwise_count(x ^ y)

    cluster = np.empty(len(prints), np.int64)
    left, pivots, found = np.arange(len(prints)), [], []
    while len(left):
        near = distance(prints[left], prints[left[0]]) <= errors
        cluster[left[near]] = len(pivots)
        pivots.append(left[0])
        found += [(left[0], x) for x in left[near][1:]]
        left = left[~near]
    label = np.arange(len(pivots))  # of clusters that are joined
    order = np.argsort(cluster, kind="stable")
    ends = np.searchsorted(cluster[order], np.arange(len(pivots) + 1))
    for c, pivot in enumerate(pivots):
        members, later = order[ends[c] : ends[c + 1]], order[ends[c + 1] :]
        if len(members) == 1:  # whatever is near the pivot is a member
            continue
        # near a member means within twice the errors of the pivot
        later = later[distance(prints[later], prints[pivot]) <= 2 * errors]
        for at in range(0, len(members), 256):
            later = later[label[cluster[later]] != label[c]]
            if not len(later):
                break
            some = members[at : at + 256]
            for k in range(0, len(later), 4096):
                part = later[k : k + 4096]
                near = distance(prints[some][:, None], prints[part][None, :]) <= errors
                for y in np.flatnonzero(near.any(axis=0)):
                    other = label[cluster[part[y]]]
                    if other != label[c]:
                        found.append((some[np.argmax(near[:, y])], part[y]))
                        label[label == other] = label[c]
    return found


def _linked(unit, prints, errors: int):
    """Links of fingerprints of the same unit; rows are sorted by unit."""
    import numpy as np

    new = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
    sizes = np.diff(np.append(new, len(unit)))
    short = np.repeat(sizes <= SHORT, sizes)
    a, b = [], []
    for d in range(1, min(SHORT, int(sizes.max()))):
        at = np.flatnonzero((unit[d:] == unit[:-d]) & short[d:])
        at = at[np.bitwise_count(prints[at] ^ prints[at + d]) <= errors]
        a.append(prints[at])
        b.append(prints[at + d])
    for run in np.flatnonzero(sizes > SHORT):
        part = prints[new[run] : new[run] + sizes[run]]
        if pairs := spanning(part, errors):
            x, y = np.array(pairs).T
            a.append(part[x])
            b.append(part[y])
    none = np.empty(0, prints.dtype)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _verify(errors: int):
    """Streams through rows sorted by unit, whole units at a time."""

    def rows(batches):
        import numpy as np
        import pyarrow as pa

        def made(unit, prints):
            a, b = _linked(unit, prints.view(np.uint64), errors)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        unit = prints = np.empty(0, np.int64)
        for batch in batches:
            unit = np.concatenate([unit, batch.column("unit").to_numpy()])
            prints = np.concatenate([prints, batch.column("fingerprint").to_numpy()])
            if not len(unit):
                continue
            cut = np.searchsorted(unit, unit[-1])  # the last unit may go on
            if cut:
                yield made(unit[:cut], prints[:cut])
                unit, prints = unit[cut:], prints[cut:]
        if len(unit):
            yield made(unit, prints)

    return rows


def links(prints: DataFrame, errors: int = ERRORS, block: int = BLOCK) -> DataFrame:
    """(a, b): pairs of distinct values of ``fingerprint`` within ``errors`` (at most 4) bits
    that connect all such pairs; not every pair of a long run."""
    spark = prints.sparkSession
    if not 0 <= errors <= ERRORS:
        raise ValueError("the keys hold for at most 4 errors")
    # a number of partitions of its own, as a row becomes about a hundred, and by an expression
    # of its own, else the planner takes the one of the distinct for it
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = prints.select("fingerprint").distinct().repartition(tasks, F.xxhash64("fingerprint"))
    keyed = stage(distinct.mapInArrow(_keys, "unit long, fingerprint long"), "golay-keys")
    hot = keyed.groupBy("unit").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    hot = stage(hot.select("unit", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "hot-keys")
    hot = broadcast_if_small(hot, 24)
    own = F.pmod(F.xxhash64("fingerprint"), "blocks").cast("int")
    dealt = (
        keyed.join(hot, "unit")
        .withColumn("own", own)
        .select("unit", "fingerprint", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select(F.xxhash64("unit", F.least("own", "other"), F.greatest("own", "other")).alias("unit"), "fingerprint")
    )
    units = keyed.join(hot, "unit", "left_anti").select("unit", "fingerprint").union(dealt)
    found = units.repartition("unit").sortWithinPartitions("unit").mapInArrow(_verify(errors), "a long, b long")
    return found.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, errors: int = ERRORS) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits) and component_id, the smallest id that can be
    reached over links of at most ``errors`` differing bits."""
    signed = stage(fingerprints(docs.select("doc_id", "text")), "fingerprints")
    classes = signed.groupBy("fingerprint").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    classes = stage(classes, "fingerprint-classes")
    roots = components(links(classes, errors)).withColumnRenamed("node", "fingerprint")
    least = classes.join(roots, "fingerprint").groupBy("root").agg(F.min("first").alias("least"))
    # the other classes are one document each, its own component
    known = (
        classes.join(roots, "fingerprint", "left")
        .join(least, "root", "left")
        .filter("n > 1 OR root IS NOT NULL")
        .select("fingerprint", F.coalesce("least", "first").alias("component_id"))
    )
    known = broadcast_if_small(stage(known, "components-of-fingerprints"), 40)
    return signed.join(known, "fingerprint", "left").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )
