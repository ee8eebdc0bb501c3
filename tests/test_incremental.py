"""Weekly refresh properties on the derived chart (sf0.001)."""

import datetime as dt

from pyspark.sql import functions as F

from hitlist.operators import cleaning, model, quality, upsert
from hitlist.session import store
from hitlist.sources import bootstrap_flagged, chart_rows
from hitlist.streaming import refresh
from tests.conftest import SF_SMALL, chart_frame

SONG_NATURAL = ["SongTitle", "SongRank", "PeakPosition", "WeeksInCharts", "DebutDate"]


def _split(spark):
    raw = store(chart_rows(spark, SF_SMALL))
    first = raw.agg(F.min("Date")).first()[0]
    later = str(dt.date.fromisoformat(first) + dt.timedelta(weeks=20))  # titles come later, too
    return raw, raw.filter(F.col("Date") < later), later


def test_high_water_mark_and_new_rows(spark):
    raw, hist, later = _split(spark)
    stored = cleaning.clean(bootstrap_flagged(hist))
    assert str(refresh.high_water_mark(stored).first().hwm) < later
    fresh = refresh.new_rows(cleaning.typed_weekly(raw), stored)
    assert fresh.count() == raw.filter(F.col("Date") >= later).count()
    assert fresh.filter(~F.col("is_new")).count() == 0
    # nothing stored: every row is new
    empty = stored.limit(0)
    assert refresh.new_rows(cleaning.typed_weekly(raw), empty).count() == raw.count()
    # re-running the same drop adds nothing
    refreshed = store(refresh.refresh_source(stored, raw))
    assert refresh.new_rows(cleaning.typed_weekly(raw), refreshed).count() == 0


def test_upsert_equals_rebuild(spark):
    raw, hist, _ = _split(spark)
    stored = store(cleaning.clean(bootstrap_flagged(hist)))
    # U11 on in both, as the property requires
    refreshed = store(refresh.refresh_source(stored, raw, standardize_featured=True))
    full = store(cleaning.clean(bootstrap_flagged(raw)))
    assert sorted(map(tuple, refreshed.collect()), key=str) == sorted(map(tuple, full.collect()), key=str)

    new = store(refreshed.join(stored.select("Date").distinct(), "Date", "left_anti").select(refreshed.columns))
    for peak in model.PEAK_VARIANTS:
        s_old, s_full = store(model.songs(stored, peak)), store(model.songs(full, peak))
        s_now = store(upsert.songs_upsert(s_old, new, peak))
        assert s_now.count() > s_old.count()
        assert sorted(map(tuple, s_now.select(SONG_NATURAL).collect()), key=str) == sorted(
            map(tuple, s_full.select(SONG_NATURAL).collect()), key=str
        )
        # stored songs keep their ids
        assert s_old.join(s_now, ["SongID", "SongTitle", "DebutDate", "SongRank"]).count() == s_old.count()
    a_old, a_full = store(model.artists(stored)), store(model.artists(full))
    a_now = store(a_old.unionByName(upsert.new_artists(a_old, new)))
    assert {r.ArtistName for r in a_now.collect()} == {r.ArtistName for r in a_full.collect()}
    e_now = model.entries(stored, s_old).unionByName(upsert.new_entries(new, s_now))
    e_full = model.entries(full, s_full)
    nat = lambda e, s: sorted(map(tuple, e.join(s, "SongID").select("EntryDate", "SongTitle", "SongRank", "LastWeek").collect()), key=str)
    assert nat(e_now, s_now.select("SongID", "SongTitle")) == nat(e_full, s_full.select("SongID", "SongTitle"))
    f_old = store(model.features(stored, s_old, a_old))
    f_now = f_old.unionByName(upsert.new_features(f_old, new, s_now, a_now))
    f_full = model.features(full, s_full, a_full)
    pairs = lambda f, s, a: {(r.SongTitle, r.ArtistName) for r in f.join(s, "SongID").join(a, "ArtistID").collect()}
    assert pairs(f_now, s_now, a_now) == pairs(f_full, s_full, a_full)


def test_two_songs_of_one_title_keep_their_ids(spark):
    # one title, date and rank twice: two songs
    rows = [("2024-01-06", 1, "S", "A", "-", 1, 1), ("2024-01-06", 1, "S", "B", "-", 1, 1), ("2024-01-06", None, "T", "A", "-", 4, 1)]
    old = store(model.songs(cleaning.clean(bootstrap_flagged(chart_frame(spark, rows)))))
    more = [("2024-01-13", 2, "S", "A", "1", 1, 7), ("2024-01-13", 5, "T", "A", "1", 3, 9), ("2024-01-13", 5, "U", "A", "1", 3, 9)]
    now = store(upsert.songs_upsert(old, cleaning.clean(bootstrap_flagged(chart_frame(spark, more)))))
    got = sorted((r.SongID, r.SongTitle, r.WeeksInCharts) for r in now.collect())
    assert got == [(1, "S", 7), (2, "S", 7), (3, "T", 9), (4, "U", 9)]
    assert quality.pk_violations(now, "songs", ["SongID"]).count() == 0


def test_append_as_written_duplicates_every_song(spark):
    rows = [("2024-01-06", 1, "S", "A", "-", 1, 1)]
    c = cleaning.clean(bootstrap_flagged(chart_frame(spark, rows)))
    s = model.songs(c)
    out = upsert.songs_append_as_written(s, c).orderBy("SongID").collect()
    assert [(r.SongID, r.SongTitle) for r in out] == [(1, "S"), (2, "S")]


def test_insert_if_absent_keeps_stored_rows(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    cand = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "k int, v string")
    out = upsert.insert_if_absent(target, cand, ["k"]).orderBy("k").collect()
    assert [(r.k, r.v) for r in out] == [(1, "old"), (2, "a")]
