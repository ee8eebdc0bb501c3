from pyspark.sql import functions as F

from hitlist.operators import analyses, cleaning, model
from hitlist.sources import bootstrap_flagged
from tests.conftest import chart_frame


def _clean(spark, rows):
    return cleaning.clean(bootstrap_flagged(chart_frame(spark, rows)))


ROWS = [
    # Date, Rank, Song, Artist, Last Week, Peak, Weeks
    ("2024-01-06", 3, "Hit", "A Featuring B", "-", 3, 1),
    ("2024-01-13", 1, "Hit", "A Featuring B", "3", 1, 2),
    ("2024-01-13", 9, "Hit", "A Featuring B", "-", 9, 1),  # same title twice in a week
    ("2024-01-06", 5, "Other", "B & A", "-", 5, 1),  # B primary here
    ("2024-01-06", 7, "Twin", "C", "-", 7, 1),
    ("2024-01-06", 8, "Twin", "D", "-", 8, 1),  # same title, same debut: two songs
    ("2024-01-06", 10, "Tyler", "Tyler, The Creator Featuring E", "-", 10, 1),
    ("2024-01-06", 11, "Low", "F featuring G", "-", 11, 1),  # featured '' -> no artist
    ("2024-01-13", 12, "Self", "H Featuring H", "-", 12, 1),  # primary beats feature
]


def test_songs_debut_and_best_peak(spark):
    c = _clean(spark, ROWS)
    debut = {(r.SongTitle, r.SongRank): r for r in model.songs(c, "debut").collect()}
    assert debut[("Hit", 3)].PeakPosition == 3 and debut[("Hit", 3)].WeeksInCharts == 2
    assert ("Twin", 7) in debut and ("Twin", 8) in debut
    best = {(r.SongTitle, r.SongRank): r for r in model.songs(c, "best").collect()}
    assert best[("Hit", 3)].PeakPosition == 1
    ids = sorted(r.SongID for r in debut.values())
    assert ids == list(range(1, len(ids) + 1))


def test_entries_first_writer_rule(spark):
    c = _clean(spark, ROWS)
    s = model.songs(c)
    titles = s.select("SongID", "SongTitle")
    e = model.entries(c, s).join(titles, "SongID").filter(F.col("SongTitle") == "Hit").orderBy("EntryDate").collect()
    assert [(str(r.EntryDate), r.SongRank, r.LastWeek) for r in e] == [("2024-01-06", 3, 0), ("2024-01-13", 1, 3)]
    # Twin: two songs, each gets every Twin row of the date; one entry per (date, song)
    ent = model.entries(c, s).select("SongID", F.col("SongRank").alias("entry_rank"))
    twin = ent.join(titles.filter(F.col("SongTitle") == "Twin"), "SongID").collect()
    assert len(twin) == 2 and {r.entry_rank for r in twin} == {7}


def test_artists_and_features(spark):
    c = _clean(spark, ROWS)
    s, a = model.songs(c), model.artists(c)
    names = {r.ArtistName for r in a.collect()}
    assert names == {"A", "B", "C", "D", "E", "F featuring G", "H"}  # no '' name, no comma act
    f = model.features(c, s, a).join(s.select("SongID", "SongTitle"), "SongID").join(a, "ArtistID")
    got = {(r.SongTitle, r.ArtistName, r.Contribution) for r in f.collect()}
    assert ("Hit", "A", "Primary") in got and ("Hit", "B", "Feature") in got
    assert ("Other", "B", "Primary") in got and ("Other", "A", "Primary") in got
    assert ("Self", "H", "Primary") in got and ("Self", "H", "Feature") not in got
    assert ("Tyler", "E", "Feature") in got and not any(t == "Tyler" and c == "Primary" for t, _, c in got)
    prim = model.features_primary(c, s, a).select("Contribution").distinct().collect()
    assert [r.Contribution for r in prim] == ["Primary"]


def test_empty_credit_splits_to_nothing_but_inner_empties_kept(spark):
    c = _clean(spark, [("2024-01-06", 1, "S", "A,,B", "-", 1, 1)])
    assert sorted(r.ArtistName for r in model.artists(c).collect()) == ["", "A", "B"]


def test_chart_analyses(spark):
    c = _clean(spark, ROWS)
    s, a = model.songs(c), model.artists(c)
    e, f = model.entries(c, s), model.features(c, s, a)
    a1 = analyses.debut_month(s).collect()
    assert [(r.month_number, r.debut_month) for r in a1] == [(1, "January  ")]
    a2 = analyses.peak_month(s, e).collect()
    assert a2[0].month_number == 1
    a3 = {r.artistname: r for r in analyses.artist_longevity(s, f, a).collect()}
    # A is primary on Hit (debut peak 3, 2 weeks) and Other (peak 5, 1 week)
    assert (a3["A"].hit_songs, a3["A"].avg_weeks_in_chart) == (2, 1.5)
    assert (a3["B"].hit_songs, a3["B"].avg_weeks_in_chart) == (1, 1.0)
