"""Licence notices in texts: exact phrases, and short notices with a bounded number of edits.

Texts are looked at as their words: lower-cased in A-Z, joined by single spaces. ``PHRASES``
are found exactly. A notice of ``NOTICES`` may have up to ``edits`` edits of code points: it is
split into one more piece than that, so at least one piece of any match is unchanged. One
automaton finds all pieces of all notices; the few spans of whole words that a hit can belong
to are matched by the ``regex`` library within the bound, which gives the edits. Words that tell licences
apart (``EXACT``) must stand in it unchanged, and of overlapping matches of several notices the
one with the fewest edits stays (then the longest notice).

Null text has no words. Rows that repeat an id are scanned row by row. An empty table gives
an empty result. Other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlist.llm.shared import bound_batches

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Short notices, as words, and their labels.
NOTICES = [
    ("licensed under the mit license", "mit"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("gnu general public license as published by the free software foundation", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("released into the public domain", "public-domain"),
    ("all rights reserved", "reserved"),
]

# Words whose change makes another licence of a notice.
EXACT = {"mit", "apache", "lesser", "affero", "nc", "sa", "mozilla"}

#: One edit for so many characters of a notice, so pieces are about as long.
CHARS_AN_EDIT = 12

_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Runs of letters, digits and non-ASCII characters, lower-cased in A-Z."""
    return (text or "").encode().translate(_TABLE).split()


def edits(notice: str) -> int:
    return max(1, len(notice) // CHARS_AN_EDIT)


def pieces(notice: str) -> list[tuple[int, str]]:
    """(offset, piece): one more than the edits, of nearly equal length."""
    n, k = len(notice), edits(notice) + 1
    cuts = [n * i // k for i in range(k + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=4)
def _seeds(notices: tuple):
    import ahocorasick

    found: dict[str, list] = {}
    for number, (notice, _) in enumerate(notices):
        for at, piece in pieces(notice):
            found.setdefault(piece, []).append((number, at))
    automaton = ahocorasick.Automaton()
    for piece, where in found.items():
        automaton.add_word(piece, (len(piece), where))
    automaton.make_automaton()
    return automaton


@lru_cache(maxsize=256)
def _fuzzy(notice: str):
    import regex

    return regex.compile(rf"(?b)(?:{regex.escape(notice)}){{e<={edits(notice)}}}")


def exact(joined: bytes) -> list[tuple[int, str]]:
    """(word, label) of every phrase place."""
    if b"license" not in joined:
        return []
    padded, out = b" " + joined + b" ", []
    for phrase, label in PHRASES.items():
        phrase = f" {phrase} ".encode()
        word, seen, at = 0, 0, padded.find(phrase)
        while at >= 0:
            word, seen = word + padded.count(b" ", seen, at), at
            out.append((word, label))
            at = padded.find(phrase, at + 1)
    return out


def _candidates(joined: str, notices: tuple) -> set[tuple[int, int, int]]:
    """(notice, start, end): the spans of whole words that hold a piece of the notice, at most the
    allowed edits away from its place, and are long enough and not too long."""
    out = set()
    for last, (size, where) in _seeds(notices).iter(joined):
        for number, at in where:
            notice = notices[number][0]
            n, k, start = len(notice), edits(notice), last + 1 - size - at
            near = range(max(0, start - k), start + k + 1)
            firsts = [a for a in near if a == 0 or joined[a - 1 : a] == " "]
            if not firsts:
                continue
            ends = range(max(0, start + n - k), min(len(joined), start + n + k) + 1)
            lasts = [b for b in ends if b == len(joined) or joined[b] == " "]
            out.update((number, a, b) for a in firsts for b in lasts if abs(b - a - n) <= k)
    return out


def _best(found: list, notices: tuple) -> list:
    """Of overlapping matches the one with the fewest edits, then of the longest notice."""
    starts: list[int] = []
    kept: list = []
    for match in sorted(found, key=lambda m: (m[3], -len(notices[m[0]][0]), m[1])):
        at = bisect_right(starts, match[1])
        if (at and kept[at - 1][2] > match[1]) or (at < len(kept) and kept[at][1] < match[2]):
            continue
        starts.insert(at, match[1])
        kept.insert(at, match)
    return kept


def fuzzy(joined: str, notices: tuple) -> list[tuple[int, int, int, int]]:
    """(notice, start, end, edits) of the matches in a joined text, in order of their starts."""
    found = []
    for number, a, b in _candidates(joined, notices):
        notice = notices[number][0]
        if not EXACT.intersection(notice.split()).issubset(joined[a:b].split()):
            continue
        if m := _fuzzy(notice).fullmatch(joined, a, b):
            found.append((number, a, b, sum(m.fuzzy_counts)))
    return _best(found, notices)


def _scan(notices: tuple):
    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            made = []
            for text in batch.column("text"):
                ws = words(text.as_py())
                joined = b" ".join(ws)
                base = exact(joined)
                characters, found, word, seen = joined.decode(), [], 0, 0
                for n, a, b, e in fuzzy(characters, notices):
                    word, seen = word + characters.count(" ", seen, a), a
                    found.append(
                        {
                            "label": notices[n][1],
                            "first_word": word,
                            "last_word": word + characters.count(" ", a, b),
                            "edits": e,
                            "score": 1 - e / len(notices[n][0]),
                        }
                    )
                labels = {label for _, label in base}
                made.append(
                    (
                        len(ws),
                        len(base),
                        min((w for w, _ in base), default=None),
                        max((w for w, _ in base), default=None),
                        ",".join(sorted(labels)),
                        ",".join(sorted(labels | {f["label"] for f in found})),
                        max([1.0] * bool(base) + [f["score"] for f in found], default=0.0),
                        found,
                    )
                )
            kinds = [
                pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
                pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int64()), ("score", pa.float64())])),
            ]
            columns = list(zip(*made)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")] + [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices"],
            )

    return rows


def scan(docs: DataFrame, notices: list = NOTICES) -> DataFrame:
    """Per row: doc_id, n_words, the phrase places (n_base, first_word, last_word,
    base_labels), labels of both kinds, the best score, and the notices found with their span
    in words, edits and score (1 less the share of edited characters)."""
    bound_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _scan(tuple(notices)),
        f"doc_id {id_type}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, notices array<struct<label:string,first_word:long,last_word:long,edits:long,score:double>>",
    )
