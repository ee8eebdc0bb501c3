"""Files laid out for look-ups by any of several columns.

Rows are ordered on the interleaved bits of their columns' places, so that a file holds a
narrow range of every column, not of the first alone: a look-up by one column reads about the
``n``-th root of the files' number for each column it doesn't name, the rest are skipped by
the minima and maxima in their footers. A place is the number of quantiles of the column at
or below the value (one row of quantiles, from one aggregate), so hot values and uneven
ranges fill files evenly. A null has the first place. An empty table gives an empty one.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlist.session import shared_folder

#: Bits of a place: each column is cut at 2^LEVELS - 1 quantiles.
LEVELS = 6


def _place(column: Column, quantiles: list, at: int = 0) -> Column:
    """``at`` and the number of quantiles at or below the value, by halving."""
    if not quantiles:
        return F.lit(at)
    mid = len(quantiles) // 2
    upper = _place(column, quantiles[mid + 1 :], at + mid + 1)
    return F.when(column >= F.lit(quantiles[mid]), upper).otherwise(_place(column, quantiles[:mid], at))


def interleaved(places: list[Column]) -> Column:
    """The bits of the places in turn, the lowest first."""
    bits = [
        F.shiftleft(F.shiftright(p, i).bitwiseAND(F.lit(1)).cast("long"), i * len(places) + j)
        for i in range(LEVELS)
        for j, p in enumerate(places)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def ordered(stored: DataFrame, columns: list[str], files: int | None = None) -> DataFrame:
    """``stored`` in ranges of the interleaved places; it is read twice, so it should be a stored
    table. ``files`` is the number of ranges (by size, where the session adapts, if None)."""
    cuts = F.array(*(F.lit(k / (1 << LEVELS)) for k in range(1, 1 << LEVELS)))
    row = stored.agg(*(F.percentile_approx(F.col(f"`{c}`"), cuts) for c in columns)).first()
    places = [_place(F.col(f"`{c}`"), quantiles or []) for c, quantiles in zip(columns, row)]
    own = uuid.uuid4().hex
    # a step of their own: each place is used once for every bit
    placed = stored.withColumns({f"_p{i}_{own}": p for i, p in enumerate(places)})
    placed = placed.withColumn(f"_z_{own}", interleaved([F.col(f"_p{i}_{own}") for i in range(len(places))]))
    keys = [f"_z_{own}", *(f"`{c}`" for c in columns)]
    ranged = placed.repartitionByRange(files, *keys) if files else placed.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys).select(*(f"`{c}`" for c in stored.columns))


def store_clustered(stored: DataFrame, name: str, columns: list[str], files: int | None = None, path: str | None = None) -> DataFrame:
    """``stored`` written in that order and read back."""
    spark = stored.sparkSession
    where = path or f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    ordered(stored, columns, files).write.parquet(where)
    return spark.read.schema(stored.schema).parquet(where)
