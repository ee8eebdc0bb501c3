"""High-water-mark ingestion of a weekly chart drop.

The mark is a scalar subquery (``max(Date)`` of the stored rows) inside the filter
of the incoming rows, so it is computed by the executors and never collected to
the driver. A row dated at or before the mark is skipped (the only late-data
rule); with nothing stored yet every row is new. Persisted versions keep their mark beside
the data (``plans.pipeline``), so a refresh reads no stored row for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlist.operators import cleaning


def high_water_mark(stored: DataFrame) -> DataFrame:
    """Newest stored chart date as a one-row table."""
    return stored.agg(F.max("Date").alias("hwm"))


def new_rows(incoming_typed: DataFrame, stored: DataFrame) -> DataFrame:
    """S5 + S6: incoming rows strictly newer than the mark, tagged ``is_new``."""
    return rows_after(incoming_typed, stored.agg(F.max("Date")).scalar())


def rows_after(incoming_typed: DataFrame, mark: Column) -> DataFrame:
    """S5 + S6 for a mark that is known; a null mark lets every row through."""
    fresh = incoming_typed.filter(mark.isNull() | (F.col("Date") > mark))
    return cleaning.raw_columns(fresh).withColumn("is_new", F.lit(True))


def refresh_source(stored_clean: DataFrame, incoming_raw: DataFrame, standardize_featured: bool = False) -> DataFrame:
    """The stored chart after one weekly drop.

    The weekly sentinel rule (U3w) and casts apply to the incoming file, the weekly
    cleaning (U5-U10, plus U11 when asked) to the new rows only; stored rows are
    untouched. Flags are reset on commit.
    """
    fresh = new_rows(cleaning.typed_weekly(incoming_raw), stored_clean)
    cleaned = cleaning.clean_new_rows(fresh, standardize_featured)
    return cleaning.flags_reset(stored_clean.unionByName(cleaned))
