"""Versions over several drops: songs merged on read, summaries kept up, compaction, expiry."""

import datetime as dt
import glob
import os
import random
import tempfile
import time

import pytest

from hitlist.operators import analyses, summaries
from hitlist.plans import pipeline
from hitlist.session import expire_stages, shared_folder, store
from tests.conftest import chart_frame

START = dt.date(2023, 1, 7)


def _weeks(n: int, seed: int = 4):
    """Chart rows of n weeks: titles come late, runs grow and fall back, peaks improve."""
    rng, rows, runs, peaks, last = random.Random(seed), [], {}, {}, {}
    for week in range(n):
        day = str(START + dt.timedelta(weeks=week))
        titles = rng.sample([f"Song {k}" for k in range(4 + 2 * week)], min(4 + 2 * week, 9))
        now = {}
        for rank, title in enumerate(titles, 1):
            runs[title] = runs.get(title, 0) + rng.choice([1, 1, 1, 0, -1])
            peaks[title] = min(peaks.get(title, 99), rank)
            artist = rng.choice(["A", "B Featuring C", "A & D", None, "C Featuring A"])
            rows.append((day, rank, title, artist, str(last.get(title, "-")), peaks[title], runs[title]))
            now[title] = rank
        last = now
    return rows


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _drops(spark, peak="debut", weeks=(3, 5, 6, 9), root=None):
    """Versions v1, v2, ... after each number of weeks; the last is returned."""
    root, rows = root or tempfile.mkdtemp(prefix="hitlist-versions-"), _weeks(max(weeks))
    for n, upto in enumerate(weeks, 1):
        raw = chart_frame(spark, [r for r in rows if r[0] < str(START + dt.timedelta(weeks=upto))])
        if n == 1:
            pipeline.bootstrap(spark, raw, root, "v1", peak)
        else:
            pipeline.weekly(spark, raw, root, f"v{n - 1}", f"v{n}", peak, standardize_featured=True)
    return root, f"v{len(weeks)}"


def _plain_summaries(m):
    return {
        "positions_and_longevity_by_debut_month": analyses.debut_month(m["songs"]),
        "positions_and_longevity_by_peak_month": analyses.peak_month(m["songs"], m["entries"]),
        "popular_song_longevity_by_artist": analyses.artist_longevity(m["songs"], m["features"], m["artists"]),
    }


@pytest.mark.parametrize("peak", ["debut", "best"])
def test_three_drops_equal_a_rebuild(spark, peak):
    root, last = _drops(spark, peak)
    m = pipeline.read_chart(spark, root, last)
    for name, rebuilt in _plain_summaries(m).items():
        assert _rows(pipeline.read_summary(spark, root, last, name)) == _rows(rebuilt), name
    whole = pipeline.bootstrap(spark, chart_frame(spark, _weeks(9)), tempfile.mkdtemp(prefix="hitlist-whole-"), "v1", peak)
    natural = ["SongTitle", "SongRank", "PeakPosition", "WeeksInCharts", "DebutDate"]
    assert _rows(m["songs"].select(natural)) == _rows(whole["songs"].select(natural))
    # A3 apart: a contribution stored as Feature stays one when a later drop has it as Primary
    for name in list(pipeline.CHART_SUMMARIES)[:2]:
        assert _rows(_plain_summaries(whole)[name]) == _rows(pipeline.read_summary(spark, root, last, name)), name
    assert pipeline.check_chart_model(m).count() == 0
    # a refresh writes the songs it changes, not those that the drop leaves alone
    old, new = (spark.read.parquet(pipeline.path(root, v, "model", "songs")) for v in ("v1", "v2"))
    before = {r.SongID: r for r in old.collect()}
    changed = {r.SongID: r for r in new.collect()}
    assert changed and all(before.get(k) != r for k, r in changed.items()) and set(before) - set(changed)


def test_states_are_exact_when_rows_are_taken_back(spark):
    kind = "SongID long, SongTitle string, SongRank int, PeakPosition int, WeeksInCharts int, DebutDate date"
    day = dt.date(2024, 5, 4)
    old = spark.createDataFrame([(1, "a", 1, 1, 3, day), (2, "b", 2, None, None, day), (3, "c", 3, 3, 5, dt.date(2024, 6, 1))], kind)
    new = spark.createDataFrame([(1, "a", 1, 1, 9, day), (2, "b", 2, None, None, day), (3, "c", 3, 3, 5, dt.date(2024, 7, 6))], kind)
    name = "positions_and_longevity_by_debut_month"
    ids = spark.createDataFrame([(1,), (3,)], "SongID long")
    now = summaries.refreshed(name, summaries.state(name, {"songs": old}), {"songs": old}, {"songs": new}, ids)
    # a month that lost its last row is gone; nulls count as rows, not as values
    assert _rows(summaries.finished(name, now)) == _rows(analyses.debut_month(new))
    nothing = spark.createDataFrame([], kind)
    assert summaries.state(name, {"songs": nothing}).count() == 0


def test_runs_of_small_batches():
    assert pipeline.packed_runs([], 10) == []
    assert pipeline.packed_runs([50, 1, 2, 3, 40, 4, 6, 1], 10) == [[0], [1, 2, 3], [4], [5, 6], [7]]
    assert pipeline.packed_runs([3, 3, 3, 3], 6) == [[0, 1], [2, 3]]


def test_compaction_and_expiry(spark, monkeypatch):
    root, last = _drops(spark, weeks=(3, 4, 5, 6, 7, 8))
    before = {n: _rows(df) for n, df in pipeline.read_chart(spark, root, last).items()}
    gold = {n: _rows(pipeline.read_summary(spark, root, last, n)) for n in pipeline.CHART_SUMMARIES}

    # a compaction that stops before its marker leaves the old version as it is
    real = pipeline._complete
    monkeypatch.setattr(pipeline, "_complete", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        pipeline.compact(spark, root, last, "c0")
    monkeypatch.setattr(pipeline, "_complete", real)
    assert pipeline.batches_of(spark, root, "c0") is None
    assert {n: _rows(df) for n, df in pipeline.read_chart(spark, root, last).items()} == before

    batches = pipeline.compact(spark, root, last, "c1")
    assert len(batches) == 1 < len(pipeline.batches_of(spark, root, last))
    assert {n: _rows(df) for n, df in pipeline.read_chart(spark, root, "c1").items()} == before
    assert {n: _rows(pipeline.read_summary(spark, root, "c1", n)) for n in pipeline.CHART_SUMMARIES} == gold
    for name in pipeline.CHART_MODEL:
        assert len(glob.glob(f"{pipeline.path(root, batches[0], 'model', name)}/*.parquet")) == 1

    # only what c1 needs stays, and the next drop goes on from it
    gone = pipeline.expire(spark, root, ["c1"])
    assert set(gone) >= {"v1", "v2", "v6", "c0-0"} and sorted(os.listdir(root)) == ["c1", "c1-0"]
    pipeline.weekly(spark, chart_frame(spark, _weeks(9)), root, "c1", "c2", standardize_featured=True)
    m = pipeline.read_chart(spark, root, "c2")
    assert pipeline.check_chart_model(m).count() == 0
    for name, rebuilt in _plain_summaries(m).items():
        assert _rows(pipeline.read_summary(spark, root, "c2", name)) == _rows(rebuilt)
    with pytest.raises(FileNotFoundError):
        pipeline.expire(spark, root, ["nothing"])
    with pytest.raises(ValueError):
        pipeline.compact(spark, root, "c2", "c1")


def test_stage_tables_expire_by_age(spark):
    df = store(spark.range(3), "short-lived")
    folder = os.path.dirname(df.inputFiles()[0].removeprefix("file://"))
    kept = f"{shared_folder(spark)}/not-a-stage"
    os.makedirs(kept, exist_ok=True)
    os.utime(folder, (time.time() - 7200, time.time() - 7200))
    os.utime(kept, (time.time() - 7200, time.time() - 7200))
    assert expire_stages(spark, 1) >= 1
    assert not os.path.exists(folder) and os.path.exists(kept)


def test_mark_is_kept_beside_the_data(spark):
    root, last = _drops(spark)
    for version in ["v1", "v2", "v3", last]:
        newest = pipeline.read_chart(spark, root, version)["clean"].agg({"Date": "max"}).first()[0]
        assert newest is not None and pipeline.newest_of(spark, root, version) == newest
    pipeline.compact(spark, root, last, "packed")
    assert pipeline.newest_of(spark, root, "packed") == newest
    # a drop without new weeks leaves the mark, and so does one onto an empty chart
    same = chart_frame(spark, _weeks(9))
    pipeline.weekly(spark, same, root, "packed", "again")
    assert pipeline.newest_of(spark, root, "again") == newest
    pipeline.bootstrap(spark, same.limit(0), root, "empty")
    assert pipeline.newest_of(spark, root, "empty") is None
    assert pipeline.weekly(spark, same, root, "empty", "filled")["clean"].count() == same.count()
    # a marker of a version stored before marks were kept
    old = pipeline.path(root, "filled", "source", pipeline.MARKER)
    batches = pipeline.batches_of(spark, root, "filled")
    spark.createDataFrame([(batches,)], "batches array<string>").write.mode("overwrite").parquet(old)
    assert pipeline.newest_of(spark, root, "filled") == newest
