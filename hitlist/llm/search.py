"""Ranked lexical search by MaxScore with pair bounds, exact.

1. ``index`` reads the documents once. Each shard of about ``SHARD`` documents leaves a row for
   every term (places of the documents that hold it, and how often) and one for its documents
   (ids and lengths). Nothing is shuffled, and every document and term is indexed.
2. ``search`` takes the queries in blocks of at most about ``QUERY_TERMS`` terms. A block's terms get
   their weights from the whole index. For pairs of its selective terms (in at most 1 of
   ``SELECTIVE`` documents), the shards' intersection lists are made beforehand, with the joint
   impact of each document and its maximum; the k-th highest joint impact of a pair is a
   threshold that the k-th result of a query with both terms reaches.
3. A shard's terms are put in the order of their maximum impact. A bound for the first ones
   together is the sum of their maxima, less what disjoint pairs among them save: a
   document with both has at most the joint maximum, one with a single term that term's. The longest
   run of terms whose bound is below the threshold can bring no result alone: only documents in
   the lists of the other terms are candidates, and these go as soon as score and bound of what is left
   stay below the threshold. What is left has its exact score.
4. The tasks' best are ranked for each query.

Which pairs have lists (each selective term with its ``PARTNERS`` next ones by document
frequency) changes the work, never the result.

Terms are runs of letters, digits and non-ASCII characters, lower-cased in A-Z. Scores are
integers. Null texts have no terms; documents without an id rank after others of their score;
rows that repeat an id are documents of their own. Rows of queries that repeat an id are one query with
the terms of all; one without an id is a query too. Queries without terms, or whose terms are
in no document, have no results, and empty tables neither. doc_id is an integer column.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitlist.llm.shared import broadcast_if_small, stage

#: Documents of a shard, and (document, term) pairs, whichever comes first.
SHARD, SHARD_POSTINGS = 2048, 1 << 20
QUERY_TERMS = 50_000
SELECTIVE, PARTNERS = 32, 8
#: A document's impact of a term is its weight times SCALE * tf div (1000 * tf + 8 * m).
SCALE = 1_000_000_000
#: In the place of a missing id, which ranks last among equals.
NO_ID = (1 << 63) - 1

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes to bytes: ASCII other than letters and digits to a space, capitals to small letters.
_TERM_BYTES = bytes(
    b if b > 127 or chr(b).isdigit() or chr(b).islower() else b + 32 if 65 <= b <= 90 else 32 for b in range(128)
) + bytes(range(128, 256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TERM_BYTES).split()


# ----------------------------------------------------------------------------- index


def _shard_rows(name: int, ids: list, sizes: list[int], vocabulary: dict[bytes, int], owner: list[int], number: list[int], often: list[int]):
    """A shard as rows of the index: its documents first, then its terms in their order."""
    import numpy as np
    import pyarrow as pa

    words = sorted(vocabulary)
    rank = np.empty(len(words), np.int64)
    rank[[vocabulary[w] for w in words]] = np.arange(len(words))
    of = rank[np.array(number, np.int64)]
    order = np.argsort(of, kind="stable")
    ends = len(ids) + np.cumsum(np.bincount(of, minlength=len(words)))
    offsets = pa.array(np.concatenate([[0, len(ids)], ends]), pa.int32())
    docs = pa.concat_arrays([pa.array(ids, pa.int64()), pa.array(np.array(owner, np.int64)[order])])
    counts = pa.concat_arrays([pa.array(sizes, pa.int64()), pa.array(np.array(often, np.int64)[order])])
    names = pa.concat_arrays([pa.nulls(1, pa.string()), pa.array(words, pa.binary()).cast(pa.string())])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(words) + 1, name)),
            names,
            pa.ListArray.from_arrays(offsets, docs),
            pa.ListArray.from_arrays(offsets, counts),
        ],
        names=["shard", "term", "docs", "counts"],
    )


def _index(shard_docs: int, shard_postings: int):
    def rows(batches):
        from collections import Counter

        from pyspark import TaskContext

        name = TaskContext.get().partitionId() << 32
        ids, sizes, vocabulary, owner, number, often = [], [], {}, [], [], []
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                found = terms(text.as_py())
                for term, n in Counter(found).items():
                    number.append(vocabulary.setdefault(term, len(vocabulary)))
                    often.append(n)
                owner += [len(ids)] * (len(number) - len(owner))
                ids.append(doc)
                sizes.append(len(found))
                if len(ids) >= shard_docs or len(number) >= shard_postings:
                    yield _shard_rows(name, ids, sizes, vocabulary, owner, number, often)
                    name += 1
                    ids, sizes, vocabulary, owner, number, often = [], [], {}, [], [], []
        if ids:
            yield _shard_rows(name, ids, sizes, vocabulary, owner, number, often)

    return rows


def index(docs: DataFrame, shard_docs: int = SHARD, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """The stored index of ``docs``: (shard, term, docs, counts). Of a term: the places in the shard of
    the documents that hold it, ascending, and its occurrences there; of the null term: the
    documents' ids and their numbers of terms."""
    made = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _index(shard_docs, shard_postings), "shard long, term string, docs array<long>, counts array<long>"
    )
    return stage(made, "search-index")


# ----------------------------------------------------------------------------- bounds


def prefix_bounds(maxima: list[int], joint: dict[tuple[int, int], int]) -> list[int]:
    """Bounds of the score that the first 0, 1, 2, ... terms give a document together, from each
    term's maximum and those of pairs (i, j), i < j; 0 for a pair that no document holds."""
    bounds, free = [0], [True] * len(maxima)
    partners: dict[int, list[int]] = {}
    for i, j in joint:
        partners.setdefault(j, []).append(i)
    for j, top in enumerate(maxima):
        saved, partner = 0, None
        for i in partners.get(j, ()):
            if free[i] and (less := maxima[i] + top - max(maxima[i], top, joint[i, j])) > saved:
                saved, partner = less, i
        if partner is not None:
            free[partner] = free[j] = False
        bounds.append(bounds[-1] + top - saved)
    return bounds


def best(lists: list[tuple], joint: dict[tuple[int, int], int], ids, size: int, k: int, threshold: int) -> list[tuple[int, int]]:
    """(score, place) of the documents of a shard that can be among the k best of a query with scores
    of at least ``threshold``. ``lists``: (places, impacts) of its terms, ``joint``: maxima of pairs
    of their positions, ``ids``: by which equal scores are put in order."""
    import numpy as np

    tops = [int(impacts.max()) for _, impacts in lists]
    order = sorted(range(len(lists)), key=lambda t: tops[t])
    at = {t: n for n, t in enumerate(order)}
    pairs = {tuple(sorted((at[s], at[t]))): top for (s, t), top in joint.items()}
    bounds = prefix_bounds([tops[t] for t in order], pairs)
    if bounds[-1] < threshold:
        return []
    alone = max(n for n, bound in enumerate(bounds) if bound < threshold) if threshold > 0 else 0
    score = np.zeros(size, np.int64)
    for t in order[alone:]:
        places, impacts = lists[t]
        score[places] += impacts
    found = np.flatnonzero(score)
    for n in reversed(range(alone)):
        if len(found) > k:
            threshold = max(threshold, int(np.partition(score[found], -k)[-k]))
        found = found[score[found] + bounds[n + 1] >= threshold]
        if not len(found):
            return []
        places, impacts = lists[order[n]]
        if len(found) * 8 < len(places):  # look the candidates up
            where = np.minimum(np.searchsorted(places, found), len(places) - 1)
            score[found] += np.where(places[where] == found, impacts[where], 0)
        else:
            score[places] += impacts
    found = found[score[found] >= max(threshold, 1)]
    first = np.lexsort((ids[found], -score[found]))[:k]
    return [(int(score[p]), int(p)) for p in found[first]]


# ----------------------------------------------------------------------------- search


def _impacts(docs, counts, weight: int, sizes, total: int, documents: int):
    m = 10 + (90 * sizes[docs] * documents) // total
    return weight * ((SCALE * counts) // (1000 * counts + 8 * m))


def _shards(batches) -> Iterator[tuple[int, object, object, dict[str, tuple]]]:
    """(name, ids, sizes, postings) of each shard; rows are sorted by shard, the null term first."""
    name, ids, sizes, postings = None, None, None, {}
    for batch in batches:
        columns = [batch.column(c) for c in ("docs", "counts")]
        for row, (shard, term) in enumerate(zip(batch.column("shard").to_pylist(), batch.column("term").to_pylist())):
            docs, counts = (c[row].values for c in columns)
            if term is None:
                if name is not None:
                    yield name, ids, sizes, postings
                ids = docs.fill_null(NO_ID).to_numpy(zero_copy_only=False)
                name, sizes, postings = shard, counts.to_numpy(zero_copy_only=False), {}
            else:
                postings[term] = docs.to_numpy(zero_copy_only=False), counts.to_numpy(zero_copy_only=False)
    if name is not None:
        yield name, ids, sizes, postings


def _pair_lists(pairs: list[tuple[str, str]], weights: dict[str, int], total: int, documents: int):
    def rows(batches):
        import numpy as np
        import pyarrow as pa

        for name, _, sizes, postings in _shards(batches):
            out = []
            for first, second in pairs:
                if first in postings and second in postings:
                    (a, ta), (b, tb) = postings[first], postings[second]
                    both, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
                    if len(both):
                        joint = _impacts(both, ta[i], weights[first], sizes, total, documents)
                        joint = joint + _impacts(both, tb[j], weights[second], sizes, total, documents)
                        out.append((name, first, second, both.tolist(), joint.tolist(), int(joint.max())))
            if out:
                kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(zip(*out), kinds)],
                    names=["shard", "first", "second", "docs", "joint", "top"],
                )

    return rows


def pair_lists(postings: DataFrame, pairs: list[tuple[str, str]], weights: dict[str, int], total: int, documents: int) -> DataFrame:
    """The stored intersection lists of pairs of terms: (shard, first, second, docs, joint, top), with
    the documents' joint impacts and the highest of them; no row where no document has both."""
    return stage(
        postings.mapInArrow(
            _pair_lists(pairs, weights, total, documents),
            "shard long, first string, second string, docs array<long>, joint array<long>, top long",
        ),
        "search-pairs",
    )


def _best(queries: list[list[str]], pairs: list[list[tuple[str, str]]], weights, start: list[int], total: int, documents: int, k: int):
    """Streams through shards; the k best of each query in the task."""

    def rows(batches):
        import heapq

        import pyarrow as pa

        # the worst of the best on top: lowest score, highest id
        tops: list[list[tuple[int, int]]] = [[] for _ in queries]
        for (_, ids, sizes, postings), joint in _with_pairs(batches):
            lists = {
                t: (docs, _impacts(docs, counts, weights[t], sizes, total, documents)) for t, (docs, counts) in postings.items()
            }
            for q, words in enumerate(queries):
                own = [t for t in words if t in lists]
                if not own:
                    continue
                at = {t: n for n, t in enumerate(own)}
                known = {(at[s], at[t]): joint.get((s, t), 0) for s, t in pairs[q] if s in at and t in at}
                least = max(start[q], tops[q][0][0] if len(tops[q]) == k else 1)
                for score, place in best([lists[t] for t in own], known, ids, len(ids), k, least):
                    new = (score, -int(ids[place]))
                    if len(tops[q]) < k:
                        heapq.heappush(tops[q], new)
                    else:
                        heapq.heappushpop(tops[q], new)
        out = [(q, None if negative == -NO_ID else -negative, score) for q, top in enumerate(tops) for score, negative in top]
        if out:
            columns = [pa.array(c, kind) for c, kind in zip(zip(*out), (pa.int32(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["query", "doc_id", "score"])

    return rows


def _with_pairs(batches):
    """Each shard with the joint maxima of its pairs, {(first, second): top}, which come as rows
    with a second term, ahead of the shard's documents."""
    import pyarrow.compute as pc

    pending: dict[int, dict] = {}

    def plain():
        for batch in batches:
            second = batch.column("second")
            is_pair = second.is_valid()
            for row in batch.filter(is_pair).select(["shard", "term", "second", "top"]).to_pylist():
                pending.setdefault(row["shard"], {})[row["term"], row["second"]] = row["top"]
            rest = batch.filter(pc.invert(is_pair))
            if len(rest):
                yield rest

    for shard in _shards(plain()):
        yield shard, pending.pop(shard[0], {})


def search(indexed: DataFrame, queries: DataFrame, k: int = 10, query_terms: int = QUERY_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of the highest scores above 0 for each query
    (item_id, text), equal scores by ascending id."""
    spark = indexed.sparkSession
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    wanted = queries.select("item_id", F.explode(F.split(text, NO_TERM)).alias("term")).filter("term != ''").distinct()
    wanted = stage(wanted, "search-queries")
    blocks = max(1, math.ceil(wanted.count() / query_terms))
    documents = indexed.filter("term IS NULL")
    plus = F.aggregate("counts", F.lit(0).cast("long"), lambda acc, n: acc + n)
    some = F.size(F.filter("counts", lambda n: n > 0)).cast("long")
    n_terms, n_docs = documents.agg(F.sum(plus), F.sum(some)).first()
    found = None
    for block in range(blocks if n_terms else 0):
        part = wanted.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        part = stage(_search(indexed, part, int(n_terms), int(n_docs), k), "search-best")
        found = part if found is None else found.union(part)
    if found is None:
        kinds = [T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]
        return spark.createDataFrame([], T.StructType([queries.schema["item_id"], *kinds]))
    return found


def _search(indexed: DataFrame, wanted: DataFrame, total: int, documents: int, k: int) -> DataFrame:
    """The results of one block of queries; the driver holds no more than its terms and pairs."""
    spark = indexed.sparkSession
    vocabulary = stage(wanted.select("term").distinct(), "search-terms")
    vocabulary = broadcast_if_small(vocabulary, F.octet_length("term") + 20)
    postings = stage(indexed.join(vocabulary, "term", "left_semi"), "search-postings")
    df = F.sum(F.size("docs")).cast("long")
    weight = F.floor(1000 * F.log(F.lit(2 * documents + 2).cast("double") / (2 * F.col("df") + 1).cast("double")))
    known = postings.groupBy("term").agg(df.alias("df")).select("term", "df", weight.cast("long").alias("weight")).collect()
    often, weights = {r["term"]: r["df"] for r in known}, {r["term"]: r["weight"] for r in known}
    items = wanted.groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms")).collect()
    queries = [[t for t in r["terms"] if t in weights] for r in items]
    pairs = []
    for words in queries:
        rare = sorted((t for t in words if often[t] * SELECTIVE <= documents), key=lambda t: (often[t], t))
        pairs.append([tuple(sorted(p)) for n, t in enumerate(rare) for p in zip([t] * PARTNERS, rare[n + 1 : n + 1 + PARTNERS])])
    distinct = sorted({p for own in pairs for p in own})

    # a shard's rows together, its documents first
    def by_shard(rows: DataFrame, *order: str) -> DataFrame:
        return rows.repartition("shard").sortWithinPartitions("shard", *order)

    rows = indexed.filter("term IS NULL").unionByName(postings)
    rare_terms = sorted({t for p in distinct for t in p})
    names = spark.createDataFrame([(t,) for t in rare_terms], "term string")
    few = indexed.filter("term IS NULL").unionByName(postings.join(F.broadcast(names), "term", "left_semi"))
    lists = pair_lists(by_shard(few, "term"), distinct, weights, total, documents)
    # no result of a query scores less than the k-th highest joint impact of a pair of its terms
    highest = lists.select("first", "second", F.explode(F.slice(F.sort_array("joint", asc=False), 1, k)).alias("joint"))
    place = F.row_number().over(Window.partitionBy("first", "second").orderBy(F.desc("joint")))
    highest = highest.withColumn("place", place).filter(F.col("place") == k)
    at_least = {(r["first"], r["second"]): r["joint"] for r in highest.collect()}
    start = [max([1, *(at_least.get(p, 1) for p in own)]) for own in pairs]
    given = lists.select("shard", F.col("first").alias("term"), "second", "top")
    both = given.unionByName(rows, allowMissingColumns=True).select("shard", "term", "second", "top", "docs", "counts")
    # pairs, then the documents, then the terms
    kind = F.when(F.col("second").isNotNull(), 0).when(F.col("term").isNull(), 1).otherwise(2)
    made = by_shard(both.withColumn("kind", kind), "kind", "term").mapInArrow(
        _best(queries, pairs, weights, start, total, documents, k), "query int, doc_id long, score long"
    )
    names = spark.createDataFrame(
        [(q, r["item_id"]) for q, r in enumerate(items)], T.StructType([T.StructField("query", T.IntegerType()), wanted.schema["item_id"]])
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = made.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(F.broadcast(names), "query").select("item_id", F.col("rank").cast("int"), "doc_id", "score")
