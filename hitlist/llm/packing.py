"""Bounded-space online best-fit packing of token sequences.

1. ``pieces``: every text is encoded (ids, then the end id) and cut if it is longer than a
   sequence; only the first piece can be shorter than a sequence. What is kept of the ids is
   their digest and length.
2. ``pack``: pieces are dealt to shards of about ``shard_rows`` rows by a hash. A shard is
   packed on its own, long pieces first: a fixed number of bins is open; a piece goes into the open bin with the
   least free space that still holds it; if there is none a bin is opened, and if too many
   are open then, the fullest closes. The open bins are kept by their free space, and the
   free spaces in use are the bits of one integer, so the best bin is the lowest set bit at
   or above the piece's length.

Encoding runs on words between which the tokenizer never merges, and remembers their ids, in
bounded memory.

Null text counts as empty: a document of the end id alone. Rows that repeat an id are
packed one by one. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlist.llm.shared import WHITE, bound_batches, load_tokenizer, stage, text_key

LENGTH = 2048
END_ID = 0
#: Open bins of a shard, and rows that a shard is sized for.
OPEN_BINS, SHARD_ROWS = 4096, 16_384
#: Words whose ids a worker remembers, and the longest word it remembers.
MEMO, MEMO_CHARS = 1_000_000, 64

#: The tokenizer never merges across the end of such a chunk.
_CHUNK = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
#: A space before other white space or the end: such a text isn't split at single spaces.
_UNSPLIT = re.compile(f" (?:[{WHITE}]|\\Z)")
#: Between a letter and these the tokenizer always splits.
_MARKS = ".,;:!?#*$%&"


def _by_ranks(path: str):
    """The encoder of a vocabulary given as ranks, from text to a list of ids."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as fh:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, fh)}
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    ).encode_ordinary


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit integers, by a tokenizers file.

    Latin-1 texts are encoded whole by the same vocabulary in its form as ranks (the two
    libraries agree there on what a letter is, and it is several times faster). Other texts,
    and such with the string of a special token, go to the tokenizers file: a text is cut at
    single spaces, and ``memo`` has the ids of a word with the space before it."""

    _made: dict[tuple, "Encoder"] = {}

    def __init__(self, path: str, ranks_path: str | None = None):
        self.tok = load_tokenizer(path)
        self.memo: dict[str, bytes] = {}
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.whole = _by_ranks(ranks_path) if ranks_path else None

    @classmethod
    def of(cls, *paths) -> "Encoder":
        if paths not in cls._made:
            cls._made[paths] = cls(*paths)
        return cls._made[paths]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list = [None] * len(texts)
        if self.whole:
            for i, t in enumerate(texts):
                if _latin(t) and not any(s in t for s in self.special):
                    out[i] = array("I", self.whole(t)).tobytes()
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, self.by_words([texts[i] for i in rest])):
            out[i] = ids
        return out

    def _run(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of chunks, by the tokenizer; those of words after a space are remembered."""
        import numpy as np

        out, memo, todo = {}, self.memo, list(chunks)
        for at in range(0, len(todo), 4096):
            part = todo[at : at + 4096]
            for c, e in zip(part, self.tok.encode_batch_fast(part, add_special_tokens=False)):
                out[c] = ids = np.asarray(e.ids, dtype="<u4").tobytes()
                if c[0] == " " and len(c) <= MEMO_CHARS and len(memo) < MEMO:
                    memo[c[1:]] = ids
        return out

    def _steps(self, chunk: str) -> list[str]:
        """A chunk, or its word and the marks after it."""
        word = chunk.rstrip(_MARKS)
        return [word, chunk[len(word) :]] if word != chunk and word and word[-1].isalpha() else [chunk]

    def by_words(self, texts: list[str]) -> list[bytes]:
        memo = self.memo
        words = [[] if _UNSPLIT.search(t) else t.split(" ") for t in texts]
        new = set().union(*(w[1:] for w in words)).difference(memo)
        # what isn't remembered, as chunks, and these as words and marks
        chunks = {w: _CHUNK.findall(" " + w) for w in new}
        heads = [_CHUNK.findall(t if not w else w[0]) for t, w in zip(texts, words)]
        steps = {c: self._steps(c) for cs in (*chunks.values(), *heads) for c in cs}
        known = {s: memo.get(s[1:]) if s[0] == " " else None for ss in steps.values() for s in ss}
        known |= self._run({s for s, ids in known.items() if ids is None})
        whole = {c: b"".join([known[s] for s in ss]) for c, ss in steps.items()}
        extra = {}
        for w, cs in chunks.items():
            ids = b"".join([whole[c] for c in cs])
            if len(cs) == 1 and len(w) < MEMO_CHARS and len(memo) < MEMO:
                memo[w] = ids
            else:
                extra[w] = ids
        out = []
        for w, h in zip(words, heads):
            first = b"".join([whole[c] for c in h])
            rest = w[1:]
            try:
                out.append(first + b"".join(map(memo.__getitem__, rest)))
            except KeyError:
                out.append(first + b"".join([memo.get(x) or extra.get(x, b"") for x in rest]))
        return out


def cuts(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole sequences, the first piece may be shorter."""
    first = n % length or length
    return [(0, min(first, n))] + [(s, length) for s in range(first, n, length)]


def _piece_rows(paths: tuple, length: int, end_id: int):
    def rows(batches):
        import pyarrow as pa

        encoder, end = Encoder.of(*paths), end_id.to_bytes(4, "little")
        for batch in batches:
            at, piece, start, size, crc = [], [], [], [], []
            for i in range(0, len(batch), 64):
                texts = [t or "" for t in batch.column("text").slice(i, 64).to_pylist()]
                for k, ids in enumerate(encoder.encode(texts)):
                    ids += end
                    for p, (s, n) in enumerate(cuts(len(ids) // 4, length)):
                        at.append(i + k)
                        piece.append(p)
                        start.append(s)
                        size.append(n)
                        crc.append(zlib.crc32(ids[4 * s : 4 * (s + n)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(at, pa.int64())), batch.column("key").take(pa.array(at, pa.int64()))]
                + [pa.array(x, t) for x, t in ((piece, pa.int32()), (start, pa.int64()), (size, pa.int64()), (crc, pa.int64()))],
                names=["doc_id", "key", "piece", "start", "length", "ids_crc32"],
            )

    return rows


def pieces(docs: DataFrame, paths: tuple, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """(doc_id, key, piece, start, length, ids_crc32) of all documents."""
    bound_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_key().alias("key"), "text").mapInArrow(
        _piece_rows(paths, length, end_id),
        f"doc_id {id_type}, key long, piece int, start long, length long, ids_crc32 long",
    )


def best_fit(sizes: Iterable[int], length: int = LENGTH, open_bins: int = OPEN_BINS) -> Iterator[tuple[int, int]]:
    """(bin, offset) for each size (1 to ``length``), in order; at most ``open_bins`` bins are open at a time."""
    by_free: dict[int, list[int]] = defaultdict(list)
    free_bits = n_open = made = 0
    for size in sizes:
        fits = free_bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            stack = by_free[free]
            b = stack.pop()
            n_open -= 1
            if not stack:
                free_bits ^= 1 << free
        else:
            free, b = length, made
            made += 1
        yield b, length - free
        left = free - size
        if left:
            by_free[left].append(b)
            free_bits |= 1 << left
            n_open += 1
            if n_open > open_bins:  # the fullest closes
                least = (free_bits & -free_bits).bit_length() - 1
                by_free[least].pop()
                n_open -= 1
                if not by_free[least]:
                    free_bits ^= 1 << least


def _pack_shard(length: int, open_bins: int):
    def pack(shard):
        import numpy as np
        import pyarrow as pa

        shard = shard.sort_by([("length", "descending"), ("order", "ascending"), ("doc_id", "ascending"), ("key", "ascending"), ("piece", "ascending")])
        places = list(best_fit(shard.column("length").to_pylist(), length, open_bins))
        bins = np.fromiter((b for b, _ in places), np.int64, len(places))
        base = shard.column("shard").to_numpy() * (1 << 32)
        return pa.table(
            {c: shard.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
            | {"sequence_id": pa.array(base + bins), "offset": pa.array([o for _, o in places], pa.int64())}
        )

    return pack


def pack(
    made: DataFrame, length: int = LENGTH, open_bins: int = OPEN_BINS, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """Sequences for a stored table of pieces: sequence_id and offset for every piece."""
    shards = max(1, -(-made.count() // shard_rows))
    order = F.xxhash64("doc_id", "key", "piece")
    id_type = made.schema["doc_id"].dataType.simpleString()
    return (
        made.withColumn("order", order)
        .withColumn("shard", F.pmod("order", F.lit(shards)))
        .groupBy("shard")
        .applyInArrow(
            _pack_shard(length, open_bins),
            f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
        )
    )


def pack_documents(docs: DataFrame, paths: tuple, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with their places; ``paths``: the tokenizers file, and
    optionally the same vocabulary as ranks."""
    return pack(stage(pieces(docs, paths, length, end_id), "pieces"), length)
