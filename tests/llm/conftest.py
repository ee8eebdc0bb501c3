import re
from collections import Counter

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use for columns of their own.
CLASHES = ["key", "own", "other", "hit", "mend", "gone", "rejected", "removed", "kept", "new", "types", "n_entities", "host", "rows", "hash"]

LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(60_000))


def lines(seed: int, n: int) -> str:
    """n words that no other seed has."""
    return " ".join(f"s{seed}n{i}" for i in range(n))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows and ids, and columns with clashing names."""
    passage = lines(7, 80)
    rows = [
        (1, lines(1, 60) + " " + passage, "en", "a", 1),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, LONG, "en", None, 1),
        (5, passage + " " + lines(5, 60), "en", "a", 2),
        (5, passage + " " + lines(5, 60), "en", "a", 2),
        (6, lines(6, 70), "en", "b", 3),
        (6, "another text under the id", "en", "b", 3),
        (None, passage, "en", "b", 4),
        (None, None, None, None, None),
        (8, " \t\n\x0b\x0c\r ", "en", "b", 5),
        (9, lines(1, 60) + " " + passage, "de", "c", 6),
        (10, "tie tie tie", "de", "c", 6),
    ]
    df = spark.createDataFrame(rows, DOCUMENTS)
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def bag(df, *columns):
    """Rows as a multiset."""
    return Counter(tuple(r) for r in df.select(*columns).collect())


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
