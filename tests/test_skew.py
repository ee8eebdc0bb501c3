"""A title holding most of the chart: the skew-safe plans still give exact results."""

import datetime as dt

from pyspark.sql import functions as F

from hitlist.operators import analyses, cleaning, model
from hitlist.sources import bootstrap_flagged
from tests.conftest import chart_frame


def test_hot_title_and_hot_artist(spark):
    start = dt.date(2020, 1, 6)
    rows = []
    for w in range(300):
        d = str(start + dt.timedelta(weeks=w))
        # the hot title charts every week, twice in some weeks (two chart rows, one date)
        rows.append((d, 2 + (w % 7), "Hot", "Star Featuring Guest", str(1 + (w % 7)) if w else "-", 1, w + 1))
        if w % 10 == 0:
            rows.append((d, 40, "Hot", "Star Featuring Guest", "-", 40, 1))
        if w % 50 == 0:
            rows.append((d, 1, f"Cold {w}", "Star & Other", "-", 1, 1))
    c = cleaning.clean(bootstrap_flagged(chart_frame(spark, rows).repartition(6)))
    s = model.songs(c)
    hot = s.filter(F.col("SongTitle") == "Hot").collect()
    assert len(hot) == 2  # two rows on the debut date -> two songs
    assert {(r.SongRank, r.WeeksInCharts) for r in hot} == {(2, 300), (40, 300)}
    e = model.entries(c, s)
    # one entry per week per hot song; the smaller rank wins in duplicated weeks
    per_song = e.join(s.select("SongID", "SongTitle"), "SongID").filter(F.col("SongTitle") == "Hot").groupBy("SongID").count()
    assert sorted(r["count"] for r in per_song.collect()) == [300, 300]
    assert e.filter(F.col("SongRank") == 40).count() == 0
    a = model.artists(c)
    assert {r.ArtistName for r in a.collect()} == {"Star", "Guest", "Other"}
    f = model.features(c, s, a)
    a3 = {r.artistname: (r.hit_songs, r.avg_weeks_in_chart) for r in analyses.artist_longevity(s, f, a).collect()}
    # Star is primary on both Hot songs and the 6 Cold songs; the second Hot song's
    # debut row peaked at 40, so top-5 hits are one Hot song (300 weeks) + 6 Cold (1 week)
    assert a3["Star"] == (7, 43.71)
