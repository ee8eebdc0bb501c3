"""Conflicts on stored keys, and stored tables that joins leave in place."""

import re

from pyspark.sql import functions as F

from hitlist.operators import upsert
from hitlist.plans import catalog
from hitlist.session import shared_folder
from hitlist.sources.bucketed import attach, store_bucketed
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _stored_side(df) -> str:
    """The plan below the right side of the anti join."""
    plan = _plan(df)
    assert "LeftAnti" in plan
    join = plan[plan.index("LeftAnti") :].splitlines()
    mark = next(line for line in join[1:] if re.match(r"[ :|]*\+- ", line) and ":" not in line[: line.index("+-")].rstrip()[-1:])
    return "\n".join(join[join.index(mark) :])


def test_stored_rows_win_over_changed_ones(spark):
    f = catalog.Frames(spark, SF_SMALL)
    out = catalog.REGISTRY["entries_redelivered"](f).cache()
    old = f.stored_entries
    again = upsert.model.entries(f.redelivered, f.songs_refreshed)
    key = upsert.ENTRY_KEY
    clash = again.withColumnRenamed("SongRank", "r").join(old, key)
    assert clash.count() == old.count() > 100 and clash.filter("r = SongRank").count() == 0
    # every stored row as it was, every other row once
    assert old.exceptAll(out.select(old.columns)).count() == 0
    assert out.count() == again.select(*key).union(old.select(*key)).distinct().count() > old.count()


def test_stored_side_is_not_shuffled_or_sorted(spark):
    f = catalog.Frames(spark, SF_SMALL)
    for stored, key in ((f.stored_entries, upsert.ENTRY_KEY), (f.stored_features, upsert.FEATURE_KEY)):
        batch = spark.createDataFrame(stored.limit(20).collect(), stored.schema)
        side = _stored_side(upsert.absent(stored, batch, key))
        assert "Scan parquet" in side and "Exchange" not in side and "Bucketed: true" in side
    plain = spark.read.parquet(f.stored_entries.inputFiles()[0])
    assert "Exchange" in _stored_side(upsert.absent(plain, plain.limit(5), upsert.ENTRY_KEY))


def test_bucketed_files_are_attached_again(spark):
    rows = [(n % 50, str(n), n) for n in range(500)]
    df = spark.createDataFrame(rows, "`a key` int, other string, n long")
    where = f"{shared_folder(spark)}/bucketed-test"
    made = store_bucketed(df, "bucketed-test", ["a key"], buckets=4, path=where)
    assert sorted(made.collect()) == sorted(df.collect()) and len(made.inputFiles()) == 4
    again = attach(spark, where, "bucketed test".replace(" ", "_"), ["a key"], 4)
    assert sorted(again.collect()) == sorted(df.collect())
    assert "Exchange" not in _plan(again.groupBy("`a key`").agg(F.max("n")))


def test_odd_keys(spark):
    kind = "k string, v int"
    target = spark.createDataFrame([("a", 1), (None, 2)], kind)
    batch = spark.createDataFrame([("a", 9), (None, 3), ("b", 5), ("b", 4), ("b", 4)], kind)
    got = sorted(map(tuple, upsert.insert_if_absent(target, batch, ["k"]).collect()), key=str)
    # a null key never conflicts with a stored one; of equal new keys the first stays
    assert got == [("a", 1), ("b", 4), (None, 2), (None, 3)]
    empty = spark.createDataFrame([], kind)
    assert upsert.insert_if_absent(empty, batch, ["k"]).count() == 3
    assert upsert.insert_if_absent(target, empty, ["k"]).count() == 2
    names = spark.createDataFrame([("x",), ("x",), ("y",)], "ArtistName string")
    stored = spark.createDataFrame([(7, "x")], "ArtistID long, ArtistName string")
    assert sorted(map(tuple, upsert.artists_insert(stored, names).collect())) == [(7, "x"), (8, "y")]


def test_as_written_adds_copies_and_keeps_what_is_stored(spark):
    f = catalog.Frames(spark, SF_SMALL)
    out = catalog.REGISTRY["entries_append_as_written"](f)
    assert f.stored_entries.exceptAll(out.select(f.stored_entries.columns)).count() == 0
    assert out.groupBy(*upsert.ENTRY_KEY).count().filter("count > 1").count() == 0
    copies = f.songs_written.join(f.stored_songs.select("SongID"), "SongID", "left_anti")
    assert out.join(copies.select("SongID"), "SongID", "left_semi").count() > f.stored_entries.count()


def test_newest_batch_wins(spark):
    kind = "SongID long, v string"
    batches = [[(1, "a"), (2, "a"), (3, "a")], [(2, "b"), (4, "b")], [], [(2, "c"), (5, "c"), (3, "c")]]
    frames = [spark.createDataFrame(b, kind) for b in batches]
    got = sorted(map(tuple, upsert.newest(frames, "SongID").collect()))
    assert got == [(1, "a"), (2, "c"), (3, "c"), (4, "b"), (5, "c")]
    assert sorted(map(tuple, upsert.newest(frames[:1], "SongID").collect())) == batches[0]
