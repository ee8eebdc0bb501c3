"""Row fixtures for the artist-credit rules (hand-derived expected values)."""

import pytest

from hitlist.operators import cleaning
from hitlist.sources import bootstrap_flagged
from hitlist.streaming import refresh
from tests.conftest import chart_frame

# Fixed value: must equal the anchor the rule strips.
ANCHOR = '<a href="https://www.billboard.com/artist/lil-Nas-x/">'

# (artist in, artist out, featured out (bootstrap), featured out (weekly) or same)
CASES = [
    ('"A"', "A", None, None),
    ("A Featuring B", "A", "B", "B"),
    ("A featuring B", "A featuring B", "", ""),
    ("A Featuring B Featuring C", "A", "B", "B"),
    ("A Feat. B Featuring C", "A", "B", "B"),
    ("A Featuring B Feat. C", "A", "B Feat. C", "B Feat. C"),
    ("A x B & C duet with D + E / F X G", "A , B , C , D , E , F , G", None, None),
    ("A & x B", "A , x B", None, None),
    ("Dan + Shay & A", "Dan + Shay , A", None, None),
    ("Lil Nas X & A", "Lil Nas X , A", None, None),
    ("lil nas x & A", "lil nas , & A", None, None),
    ("Simon & Garfunkel", "Simon & Garfunkel", None, None),
    ("A Featuring B & C", "A", "B , C", "B & C"),
    ("A Featuring Lil Nas X & B", "A", "Lil Nas X & B", "Lil Nas X & B"),
    ("A&B", "A&B", None, None),
    (ANCHOR + "Lil Nas X", "Lil Nas X", None, None),
    (None, None, None, None),
]


def _rows(cases):
    return [("2024-01-06", i + 1, f"song {i}", c[0], "-" if i % 2 else "7", 1, 1) for i, c in enumerate(cases)]


def test_bootstrap_rules(spark):
    out = cleaning.clean(bootstrap_flagged(chart_frame(spark, _rows(CASES)))).orderBy("Rank").collect()
    assert [(r.Artist, r.Featured_Artist) for r in out] == [(c[1], c[2]) for c in CASES]
    assert [r["Last Week"] for r in out] == [0 if i % 2 else 7 for i in range(len(CASES))]
    assert all(r.is_new is False for r in out)


def test_weekly_rules_skip_featured_standardisation(spark):
    empty = cleaning.clean(bootstrap_flagged(chart_frame(spark, []))).limit(0)
    refreshed = refresh.refresh_source(empty, chart_frame(spark, _rows(CASES)))
    out = refreshed.orderBy("Rank").collect()
    assert [(r.Artist, r.Featured_Artist) for r in out] == [(c[1], c[3]) for c in CASES]
    assert all(r.is_new is False for r in out)  # flags reset on commit


def test_steps_are_sequential(spark):
    raw = bootstrap_flagged(chart_frame(spark, _rows([('"A Feat. B"', None, None, None)])))
    assert cleaning.clean(raw, through="artist_unquoted").first().Artist == "A Feat. B"
    r = cleaning.clean(raw, through="featuring_split").first()
    assert (r.Artist, r.Featured_Artist) == ("A Feat. B", None)
    r = cleaning.clean(raw, through="feat_split").first()
    assert (r.Artist, r.Featured_Artist) == ("A", "B")


def test_sentinels(spark):
    rows = [("2024-01-06", 1, "-", "A", "-", 1, 1), ("2024-01-06", 2, "S", "A-B", "12", 1, 1)]
    weekly = cleaning.sentinel_any_column(chart_frame(spark, rows)).orderBy("Rank").collect()
    assert weekly[0].Song == "0" and weekly[0]["Last Week"] == "0"
    assert weekly[1].Artist == "A-B"  # only cells equal to '-' change
    typed = cleaning.typed(chart_frame(spark, rows)).orderBy("Rank").collect()
    assert typed[0].Song == "-" and typed[0]["Last Week"] == 0


@pytest.mark.parametrize("peak", ["debut", "best"])
def test_clean_schema(spark, peak):
    from hitlist.schemas import CHART_CLEAN

    df = cleaning.clean(bootstrap_flagged(chart_frame(spark, _rows(CASES[:2]))))
    assert [f.name for f in df.schema.fields] == [f.name for f in CHART_CLEAN.fields]
