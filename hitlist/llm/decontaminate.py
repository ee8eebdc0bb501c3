"""Benchmark decontamination, in SQL expressions.

Windows of the items (10 consecutive words; a shorter item is one window) make a small table
keyed by a hash of the window. Every document's windows are hashed in its row, unfolded and
looked up there; a hit counts if the words themselves are equal. The table is broadcast if
its measured size is below ``BROADCAST_BYTES``, and words are compared in the document's row. A
larger one is joined by a shuffle of places and hashes alone, and the documents with candidates
meet them afterwards, one row each, for the words: what is shuffled is linear in the text.

``contamination`` reports per document, ``remove`` cuts the hit words out of the texts and
drops documents that are mostly hit.

Words are lower-cased in A-Z only and are runs of letters, digits and non-ASCII characters.
Null text and null items have no words; items without an id hit but are not listed. Rows that
repeat an id are reported row by row. Empty tables give empty results, and no items no hits.
Other columns are ignored by the report and kept by ``remove``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlist.llm.shared import BROADCAST_BYTES, broadcast_if_small, fresh, stage, text_key

N = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_OR_NOT = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, NO_WORD), "")


def item_windows(bench: DataFrame, n: int = N) -> DataFrame:
    """(size, hash, window, items): distinct windows with the ids of the items that have them."""
    ws = F.col("ws")
    windows = (
        bench.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("ws"))
        .filter(F.size("ws") > 0)
        .select(
            "item",
            F.explode(
                F.when(
                    F.size(ws) >= n,
                    F.transform(F.sequence(F.lit(1), F.greatest(F.size(ws) - (n - 1), F.lit(1))), lambda i: F.slice(ws, i, n)),
                ).otherwise(F.array(ws))
            ).alias("window"),
        )
    )
    return windows.groupBy("window").agg(F.collect_set("item").alias("items")).select(
        F.size("window").alias("size"), F.xxhash64("window").alias("hash"), "window", "items"
    )


def _places(docs: DataFrame, sizes: list[int], *kept: str) -> DataFrame:
    """(doc_id, key, at, size, hash, n) and the ``kept`` columns of what is a word array ``ws`` in
    the row: a row for each window of each size, and one of size 0 for the document, whose n is
    its number of words."""
    ws = F.col("ws")
    none = F.lit(None).cast("int")

    def found(size: int) -> Column:
        every = F.sequence(F.lit(0), F.greatest(F.size(ws) - size, F.lit(0)))
        places = F.transform(
            every,
            lambda i: F.struct(
                i.alias("at"), F.lit(size).alias("size"), F.xxhash64(F.slice(ws, i + 1, size)).alias("hash"), none.alias("n")
            ),
        )
        return F.when(F.size(ws) >= size, places).otherwise(F.array())

    # the first place stands for the document; it matches no window, as its size is 0
    own = F.array(F.struct(F.lit(-1).alias("at"), F.lit(0).alias("size"), F.col("key").alias("hash"), F.size(ws).alias("n")))
    return (
        docs.select("doc_id", text_key().alias("key"), words(F.col("text")).alias("ws"))
        .select("doc_id", "key", *kept, F.concat(own, *map(found, sizes)).alias("places"))
        # outer, though no array is empty: else a filter on the arrays' size is inferred and
        # pushed below, where it works out all windows once more
        .select("doc_id", "key", *kept, F.explode_outer("places").alias("p"))
        .select("doc_id", "key", *kept, "p.*")
    )


def _hits(docs: DataFrame, bench: DataFrame, n: int, broadcast_bytes: int) -> DataFrame:
    """Per row of (doc_id, text): n_words, rows (how often the row repeats), the hit places as
    (position, size) and the items found."""
    table = stage(item_windows(bench, n), "benchmark-windows")
    sizes = [r["size"] for r in table.select("size").distinct().collect()]  # at most n rows
    per_window = F.octet_length(F.array_join("window", " ")) + F.octet_length(F.array_join("items", " ")) + 100
    if (table.agg(F.sum(per_window)).first()[0] or 0) <= broadcast_bytes:
        hits = _hits_in_rows(docs, F.broadcast(table.drop("size")), sizes)
    else:
        hits = _hits_by_shuffle(docs, table, sizes)
    return hits.withColumn(
        "hit_words",
        F.array_sort(
            F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["at"], h["at"] + h["size"] - 1))))
        ),
    )


def _hits_in_rows(docs: DataFrame, table: DataFrame, sizes: list[int]) -> DataFrame:
    """Windows are looked up and compared where they are; only hits are shuffled."""
    joined = _places(docs, sizes, "ws").join(table, "hash", "left")
    real = F.slice("ws", F.col("at") + 1, F.col("size")) == F.col("window")
    return (
        joined.filter((F.col("size") == 0) | real)
        .select("doc_id", "key", "n", F.when(F.col("size") > 0, F.struct("at", "size")).alias("hit"), "items")
        .groupBy("doc_id", "key")
        .agg(
            F.max("n").cast("long").alias("n_words"),
            F.count("n").alias("rows"),
            F.collect_set("hit").alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )


def _hits_by_shuffle(docs: DataFrame, table: DataFrame, sizes: list[int]) -> DataFrame:
    """Windows are shuffled by their hash, without words; documents with a candidate meet theirs in
    one row each, and the words are compared there."""
    places = _places(docs, sizes)
    counts = places.filter("size = 0").groupBy("doc_id", "key").agg(F.max("n").cast("long").alias("n_words"), F.count("n").alias("rows"))
    candidates = (
        places.filter("size > 0")
        .join(table, ["hash", "size"])
        .groupBy("doc_id", "key")
        .agg(F.collect_set(F.struct("at", "size", "window", "items")).alias("found"))
        .select(F.col("doc_id").alias("_doc_id"), F.col("key").alias("_key"), "found")
    )
    candidates = stage(candidates, "benchmark-candidates")
    size = F.aggregate("found", F.lit(100), lambda acc, c: acc + 200 + F.octet_length(F.array_join(c["items"], " ")))
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("key") == F.col("_key"))
    texts = docs.withColumn("key", text_key()).join(broadcast_if_small(candidates, size), same)
    real = F.filter("found", lambda c: F.slice(F.col("ws"), c["at"] + 1, c["size"]) == c["window"])
    checked = (
        texts.select("doc_id", "key", words(F.col("text")).alias("ws"), "found")
        .select("doc_id", "key", real.alias("real"))
        .select(
            F.col("doc_id").alias("_doc_id"),
            F.col("key").alias("_key"),
            F.transform("real", lambda c: F.struct(c["at"].alias("at"), c["size"].alias("size"))).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.transform("real", lambda c: c["items"])))).alias("items"),
        )
        .dropDuplicates(["_doc_id", "_key"])  # rows that repeat
    )
    return counts.join(checked, same, "left").select(
        "doc_id",
        "key",
        "n_words",
        "rows",
        F.coalesce("hits", F.array().cast("array<struct<at:int,size:int>>")).alias("hits"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def contamination(docs: DataFrame, bench: DataFrame, n: int = N, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row."""
    hits = _hits(docs.select("doc_id", "text"), bench.select("item_id", "text"), n, broadcast_bytes)
    return hits.select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
        F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("_copy"),
    ).drop("_copy")


def remove(
    docs: DataFrame, bench: DataFrame, n: int = N, max_share: float = 0.2, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``docs`` without the hit words; documents of which more than ``max_share`` is hit go.

    Only the places of hits are shuffled by document, and with them the texts."""
    own, other, key, hit, mend = fresh(docs, "own", "other", "key", "hit", "mend")
    hits = (
        _hits(docs.select("doc_id", "text"), bench.select("item_id", "text"), n, broadcast_bytes)
        .filter(F.size("hit_words") > 0)
        .select(
            F.col("doc_id").alias(other),
            F.col("key").alias(key),
            F.col("hit_words").alias(hit),
            (F.size("hit_words") <= max_share * F.col("n_words")).alias(mend),
        )
    )
    hits = broadcast_if_small(stage(hits, "benchmark-hits"), 100 + 4 * F.size(hit))
    joined = docs.withColumn(own, text_key()).join(
        hits, F.col("doc_id").eqNullSafe(F.col(other)) & (F.col(own) == F.col(key)), "left"
    )
    text = F.when(F.col(hit).isNull(), F.col("text")).otherwise(cut_words(F.col("text"), F.col(hit)))
    return joined.filter(F.coalesce(mend, F.lit(True))).select(
        *(text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns)
    )


def cut_words(text: Column, positions: Column) -> Column:
    """The text without the words at ``positions`` (sorted) and what stands between two such
    neighbours. Words and what is between them alternate, so the text is the array of both
    without a slice for each run of positions."""
    parts = F.regexp_extract_all(text, F.lit(WORD_OR_NOT), 1)
    # the place of the first word among the parts
    first = F.when(F.regexp_extract(text, WORD_OR_NOT, 1).rlike(r"^[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"), 0).otherwise(1)

    def kept(x: Column) -> Column:
        ps, shift, at = x["parts"], x["first"], x["at"]

        def run_ends(step: int) -> Column:
            return F.filter(at, lambda p, i: F.coalesce(F.get(at, i + step) != p + step, F.lit(True)))

        def joined(runs: Column) -> Column:
            def segment(k: Column) -> Column:
                begin = F.coalesce(2 * F.get(runs["last"], k - 1) + shift + 1, F.lit(0))
                end = F.coalesce(2 * F.get(runs["first"], k) + shift, F.size(ps))
                return F.array_join(F.slice(ps, begin + 1, end - begin), "")

            return F.array_join(F.transform(F.sequence(F.lit(0), F.size(runs["first"])), segment), "")

        runs = F.array(F.struct(run_ends(-1).alias("first"), run_ends(1).alias("last")))
        return F.element_at(F.transform(runs, joined), 1)

    once = F.array(F.struct(parts.alias("parts"), first.alias("first"), positions.alias("at")))
    return F.element_at(F.transform(once, kept), 1)
