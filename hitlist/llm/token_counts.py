"""Token counts without token ids.

A pre-token is what the tokenizer's own split makes of a text: after its normaliser, a run of
letters, one digit, a run of other signs or a contraction's end. "word", "word," and "Word" share
one. No merge crosses a pre-token, so a text has as many tokens as its pre-tokens together:

1. ``vocabulary``: every distinct pre-token of the corpus, how often it occurs, and how
   many pieces the tokenizer cuts it into (counted once each).
2. ``frequencies``: per document, its distinct pre-tokens with their counts. The pieces of
   the most frequent pre-tokens (at most ``HEAD`` short ones, whatever the corpus) are
   broadcast and summed at once, so that no common word becomes a hot join key.
3. The remaining pre-tokens meet the vocabulary in a shuffled join; sums by document.

Null text counts as empty. Rows that repeat an id and text give one result row each. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlist.llm.shared import WHITE, bound_batches, load_tokenizer, stage, text_key

#: Bounds of the broadcast: so many pre-tokens, each of at most so many characters.
HEAD, HEAD_CHARS = 1 << 18, 32
#: What a task holds before it passes its counts on: distinct pre-tokens, and characters of texts read.
HOLD, HOLD_CHARS = 400_000, 64 << 20
#: Runs whose pre-tokens a task remembers, and the longest of them.
REMEMBERED, REMEMBERED_CHARS = 200_000, 32

_RUN = re.compile(f"[^{WHITE}]+")
#: Texts of ASCII and the composed letters of Latin-1 and Latin Extended-A, which the normaliser only
#: lower-cases, one character to one (U+0130 is not among them).
_LATIN = re.compile("[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u017f]*")
#: The split of the tokenizer's file for such texts in lower case; no two branches begin alike but the
#: last two, so the frequent ones come first.
_SPLIT = re.compile("[a-z\xdf-\xf6\xf8-\u017f]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^a-z0-9\xdf-\xf6\xf8-\u017f\t-\r ]+")


def cutter(path: str):
    """A function from a text to its pre-tokens, by the normaliser and the split of the tokenizer,
    neither of which works across white space. A run between white space that may hold the string
    of a special token stays whole: the tokenizer takes those out before it splits."""
    tok = load_tokenizer(path)
    normal, split = tok.normalizer.normalize_str, tok.pre_tokenizer.pre_tokenize_str
    remembered: dict[str, list[str]] = {}

    def plain(text: str) -> bool:
        return "<|" not in text and (text.isascii() or _LATIN.fullmatch(text) is not None)

    def odd(run: str) -> list[str]:
        found = remembered.get(run)
        if found is None:
            text = normal(run)
            found = [run] if "<|" in run else [text[a:b] for _, (a, b) in split(text)]
            if len(run) <= REMEMBERED_CHARS:
                if len(remembered) >= REMEMBERED:
                    remembered.clear()
                remembered[run] = found
        return found

    def cut(text: str) -> list[str]:
        if plain(text):
            return _SPLIT.findall(text.lower())
        latin, out = [], []
        for run in _RUN.findall(text):
            if plain(run):
                latin.append(run)
            else:
                out += odd(run)
        return out + _SPLIT.findall(" ".join(latin).lower())

    return cut


def _local_counter(path: str):
    """(pre-token, count) summed over what a task holds at a time."""

    def count(batches):
        import pyarrow as pa

        cut = cutter(path)

        def rows():
            return pa.RecordBatch.from_pydict(
                {"pretoken": pa.array(held.keys(), pa.string()), "freq": pa.array(held.values(), pa.int64())}
            )

        held: Counter = Counter()
        chars = 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                held.update(cut(text or ""))
                chars += len(text or "")
                if len(held) >= HOLD or chars >= HOLD_CHARS:
                    yield rows()
                    held.clear()
                    chars = 0
        if held:
            yield rows()

    return count


def _piece_counter(path: str):
    def count(batches):
        import pyarrow as pa

        tok = load_tokenizer(path)
        for batch in batches:
            words = batch.column("pretoken").to_pylist()
            n = [len(e) for e in tok.encode_batch_fast(words, add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("pretoken"), batch.column("freq"), pa.array(n, pa.int64())],
                names=["pretoken", "freq", "n_pieces"],
            )

    return count


def vocabulary(docs: DataFrame, path: str) -> DataFrame:
    """(pretoken, freq, n_pieces) of all texts, stored in the shared folder."""
    counts = (
        docs.select("text")
        .mapInArrow(_local_counter(path), "pretoken string, freq long")
        .groupBy("pretoken")
        .agg(F.sum("freq").alias("freq"))
    )
    return stage(
        counts.mapInArrow(_piece_counter(path), "pretoken string, freq long, n_pieces long"), "vocabulary"
    )


def head(vocab: DataFrame, most: int = HEAD) -> dict[str, int]:
    """Pieces of the most frequent pre-tokens, at most ``most`` of them, each of at most
    HEAD_CHARS characters: the frequency to start from is read off a histogram of at most a
    few hundred classes, so only rows that go into the result reach the driver."""
    short = vocab.filter(F.length("pretoken") <= HEAD_CHARS)
    cls = F.floor(F.log2("freq") * 16)
    classes = short.groupBy(cls.alias("cls")).count().orderBy(F.desc("cls")).collect()
    start, total = None, 0
    for row in classes:
        total += row["count"]
        if total > most:
            break
        start = row["cls"]
    if start is None:
        return {}
    return {r[0]: r[1] for r in short.filter(cls >= start).select("pretoken", "n_pieces").collect()}


def _document_counter(known, path: str):
    """Per document: an entry without a word, which holds the tokens of broadcast pre-tokens,
    and one entry for each other distinct pre-token."""

    def count(batches):
        import pyarrow as pa

        pieces, cut = known.value, cutter(path)
        for batch in batches:
            words, freqs, ends = [], [], [0]
            for text in batch.column("text").to_pylist():
                words.append(None)
                at, total = len(freqs), 0
                freqs.append(0)
                for w, f in Counter(cut(text or "")).items():
                    n = pieces.get(w)
                    if n is None:
                        words.append(w)
                        freqs.append(f)
                    else:
                        total += n * f
                freqs[at] = total
                ends.append(len(words))
            entries = pa.StructArray.from_arrays(
                [pa.array(words, pa.string()), pa.array(freqs, pa.int64())], ["pretoken", "freq"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("key"),
                    batch.column("n_bytes"),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries),
                ],
                names=["doc_id", "key", "n_bytes", "entries"],
            )

    return count


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) per row of (doc_id, text)."""
    spark = docs.sparkSession
    bound_batches(spark, 2000)
    docs = docs.select("doc_id", "text")
    vocab = vocabulary(docs, path)
    known = spark.sparkContext.broadcast(head(vocab))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    entries = (
        docs.select(
            "doc_id",
            text_key().alias("key"),
            F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
            "text",
        )
        .mapInArrow(
            _document_counter(known, path),
            f"doc_id {id_type}, key long, n_bytes long, entries array<struct<pretoken:string,freq:long>>",
        )
        .select("doc_id", "key", "n_bytes", F.inline("entries"))
    )
    # an entry without a word joins on a string no pre-token can be, spread over all tasks
    on = F.coalesce("pretoken", F.concat(F.lit(" "), F.hex("key")))
    pieces = vocab.select(F.col("pretoken").alias("word"), "n_pieces")
    joined = entries.withColumn("word", on).join(pieces, "word", "left")
    rows = F.count(F.when(F.col("pretoken").isNull(), 1))
    sums = joined.groupBy("doc_id", "key").agg(
        F.max("n_bytes").alias("n_bytes"),
        rows.alias("rows"),
        F.sum(F.col("freq") * F.coalesce("n_pieces", F.lit(1))).alias("total"),
    )
    return sums.select(
        "doc_id",
        "n_bytes",
        F.expr("total div rows").alias("n_tokens"),
        F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("_copy"),
    ).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
