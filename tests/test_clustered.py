"""Files on interleaved bits: every row once, and look-ups by either column read few of them."""

import datetime as dt

from pyspark.sql import functions as F

from hitlist.session import store
from hitlist.sources.clustered import interleaved, store_clustered

START = dt.date(2020, 1, 4)


def _grid(spark):
    """Two hundred rows a week; one song has half of the rows."""
    song = F.floor(F.col("id") / 64)
    rows = spark.range(64 * 200).select(
        F.date_add(F.lit(START), (F.col("id") % 64 * 7).cast("int")).alias("EntryDate"),
        F.when(song % 2 == 1, song).otherwise(0).cast("long").alias("SongID"),
        F.col("id").alias("row"),
    )
    return store(rows, "grid")


def _files(df, condition=None):
    return (df.filter(condition) if condition is not None else df).select(F.input_file_name()).distinct().count()


def test_lookups_read_few_files(spark):
    grid = _grid(spark)
    made = store_clustered(grid, "grid-clustered", ["EntryDate", "SongID"], files=64)
    assert made.exceptAll(grid).count() == grid.exceptAll(made).count() == 0
    all_files = _files(made)
    dates = F.col("EntryDate").between(START, START + dt.timedelta(weeks=7))  # an eighth
    assert all_files >= 48 and _files(made, dates) <= all_files / 4
    assert _files(made, F.col("SongID") == 151) <= all_files / 4
    # ordered by the date alone, a song is in every file
    by_date = grid.repartitionByRange(64, "EntryDate", "row").sortWithinPartitions("EntryDate", "row")
    plain = store(by_date, "grid-by-date")
    assert _files(plain, F.col("SongID") == 0) == _files(plain) > 32


def test_bits_in_turn(spark):
    row = spark.range(1).select(interleaved([F.lit(0b101), F.lit(0b011)]).alias("z")).first()
    assert row.z == 0b011011


def test_nulls_and_empty_tables(spark):
    rows = spark.createDataFrame([(None, 1), (START, None), (START, 1), (START, 1)], "EntryDate date, SongID long")
    made = store_clustered(store(rows, "few"), "few-clustered", ["EntryDate", "SongID"])
    assert sorted(map(str, made.collect())) == sorted(map(str, rows.collect()))
    empty = store_clustered(store(rows.limit(0), "none"), "none-clustered", ["EntryDate", "SongID"])
    assert empty.count() == 0 and empty.columns == rows.columns
