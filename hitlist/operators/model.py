"""Star model M1-M6: songs, entries, artists, song-artist contributions.

All stages take the cleaned chart (``operators.cleaning.clean``) and are written to
stay balanced when one title or one act holds a large share of the rows:
per-title facts are map-side partial aggregates, the debut row is found by a join
on (title, date) so a long-running title spreads over its weeks, and every
credit list is de-duplicated before it is exploded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlist.functions import artist as A
from hitlist.operators.keys import with_dense_id

PEAK_VARIANTS = ("debut", "best")
SONG_ORDER = ["SongTitle", "DebutDate", "SongRank", "PeakPosition", "WeeksInCharts"]
SONG_COLUMNS = ["SongID", "SongTitle", "SongRank", "PeakPosition", "WeeksInCharts", "DebutDate"]


def _titled(chart: DataFrame) -> DataFrame:
    return chart.filter(F.col("Song").isNotNull())


def song_debuts(chart: DataFrame) -> DataFrame:
    """G1: first chart date per title (a NULL title is its own group, as in SQL)."""
    return chart.groupBy("Song").agg(F.min("Date").alias("DebutDate"))


def song_max_weeks(chart: DataFrame) -> DataFrame:
    """Longest run per title."""
    return chart.groupBy("Song").agg(F.max("`Weeks in Charts`").alias("max_weeks"))


def song_best_peak(chart: DataFrame) -> DataFrame:
    """Best (lowest) peak position per title."""
    return chart.groupBy("Song").agg(F.min("`Peak Position`").alias("highest_peak"))


def song_rows(chart: DataFrame, peak: str = "debut") -> DataFrame:
    """M1/M2 without ids: one song per chart row of a title on its debut date.

    ``peak="debut"``: PeakPosition of the debut row; ``"best"``: best over all rows.
    """
    if peak not in PEAK_VARIANTS:
        raise ValueError(f"peak must be one of {PEAK_VARIANTS}")
    src = _titled(chart).select("Song", "Date", "Rank", "`Peak Position`", "`Weeks in Charts`")
    per_title = src.groupBy(F.col("Song").alias("t_song")).agg(
        F.min("Date").alias("DebutDate"),
        F.max("`Weeks in Charts`").alias("WeeksInCharts"),
        F.min("`Peak Position`").alias("best_peak"),
    )
    debut = src.join(per_title, (src.Song == per_title.t_song) & (src.Date == per_title.DebutDate))
    peak_col = F.col("`Peak Position`") if peak == "debut" else F.col("best_peak")
    return debut.select(
        F.col("Song").alias("SongTitle"),
        F.col("Rank").alias("SongRank"),
        peak_col.cast("int").alias("PeakPosition"),
        F.col("WeeksInCharts").cast("int"),
        F.col("DebutDate"),
    )


def songs(chart: DataFrame, peak: str = "debut") -> DataFrame:
    """M1/M2 with K1 ids (rank of title, debut date, rank, peak, weeks)."""
    return with_dense_id(song_rows(chart, peak), SONG_ORDER, "SongID").select(*SONG_COLUMNS)


def entry_candidates(chart: DataFrame) -> DataFrame:
    """One candidate per (title, date): the smallest (Rank, Peak, LastWeek, Weeks) wins.

    This is the fixed rule for 'first writer wins' on (EntryDate, SongID); the
    candidates of a key do not depend on the song id, so the choice is made on the
    chart before the join, as a partial aggregate.
    """
    best = F.min(
        F.struct(
            F.col("Rank").alias("SongRank"),
            F.col("`Peak Position`").alias("PeakPosition"),
            F.col("`Last Week`").alias("LastWeek"),
            F.col("`Weeks in Charts`").alias("WeeksInCharts"),
        )
    )
    return (
        _titled(chart)
        .filter(F.col("Date").isNotNull())
        .groupBy("Song", "Date")
        .agg(best.alias("w"))
        .select("Song", F.col("Date").alias("EntryDate"), "w.*")
    )


def entries(chart: DataFrame, songs_df: DataFrame) -> DataFrame:
    """M3: weekly fact rows keyed (EntryDate, SongID)."""
    cand = entry_candidates(chart)
    s = songs_df.select("SongID", "SongTitle")
    return cand.join(s, cand.Song == s.SongTitle).select(
        "EntryDate", "SongID", "SongRank", "PeakPosition", "LastWeek", "WeeksInCharts"
    )


def _credits(chart: DataFrame, song: bool = True, featured: bool = True) -> DataFrame:
    """(Song, credit, Contribution) rows with usable credit lists; one scan gives both kinds.
    Credits repeat every week they chart: they are made distinct first, most in the map-side
    aggregate, and taken apart once each."""
    kinds = [("Artist", "Primary")] + [("Featured_Artist", "Feature")] * featured
    of = ["Song"] * song
    cells = [
        F.struct(A.names_without_comma_act(F.col(c)).alias("credit"), F.lit(kind).alias("Contribution")) for c, kind in kinds
    ]
    once = chart.select(*of, *(c for c, _ in kinds)).distinct()
    return once.select(*of, F.inline(F.array(*cells))).filter(F.col("credit").isNotNull())


def credited(chart: DataFrame) -> DataFrame:
    """(name, Contribution): distinct trimmed names with the kinds of credit they have."""
    credits = _credits(chart, song=False)
    return credits.select(F.explode(A.split_names(F.col("credit"))).alias("name"), "Contribution").distinct()


def artist_names(chart: DataFrame) -> DataFrame:
    """M4 without ids: distinct trimmed names from primary and featured credits."""
    return _credits(chart, song=False).select(F.explode(A.split_names(F.col("credit"))).alias("ArtistName")).distinct()


def artists(chart: DataFrame) -> DataFrame:
    """M4 with K1 ids (rank of the name)."""
    return with_dense_id(artist_names(chart), ["ArtistName"], "ArtistID").select("ArtistID", "ArtistName")


def contribution_pairs(chart: DataFrame, songs_df: DataFrame, artists_df: DataFrame, featured: bool = True) -> DataFrame:
    """(SongID, ArtistID, Contribution) candidates, joined by title and by name."""
    credits = _credits(chart, featured=featured).filter(F.col("Song").isNotNull())
    named = credits.select("Song", F.explode(A.split_names(F.col("credit"))).alias("name"), "Contribution").distinct()
    s = songs_df.select("SongID", "SongTitle")
    a = artists_df.select("ArtistID", "ArtistName")
    return named.join(s, named.Song == s.SongTitle).join(a, F.col("name") == a.ArtistName).select(
        "SongID", "ArtistID", "Contribution"
    )


def resolve_contributions(pairs: DataFrame) -> DataFrame:
    """One row per (SongID, ArtistID); a primary credit beats a featured one."""
    # max over a 0/1 flag stays in a (fixed-width) hash aggregate with a map-side
    # partial step; a max over the label itself would force a sort aggregate.
    flag = F.max((F.col("Contribution") == F.lit("Primary")).cast("int")).alias("_primary")
    return pairs.groupBy("SongID", "ArtistID").agg(flag).select(
        "SongID", "ArtistID", F.when(F.col("_primary") == 1, F.lit("Primary")).otherwise(F.lit("Feature")).alias("Contribution")
    )


def features_primary(chart: DataFrame, songs_df: DataFrame, artists_df: DataFrame) -> DataFrame:
    """M5: primary contributions only."""
    return resolve_contributions(contribution_pairs(chart, songs_df, artists_df, featured=False))


def features(chart: DataFrame, songs_df: DataFrame, artists_df: DataFrame) -> DataFrame:
    """M5 + M6: all contributions, primary first."""
    return resolve_contributions(contribution_pairs(chart, songs_df, artists_df, featured=True))


def build(chart: DataFrame, peak: str = "debut") -> dict[str, DataFrame]:
    """The four star tables from one cleaned chart."""
    s = songs(chart, peak)
    a = artists(chart)
    return {"songs": s, "artists": a, "entries": entries(chart, s), "features": features(chart, s, a)}
