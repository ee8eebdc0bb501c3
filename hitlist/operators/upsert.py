"""S12 insert-if-absent and surrogate-key continuation on immutable tables.

Parquet tables take no MERGE or UPDATE, so ``INSERT ... ON CONFLICT DO NOTHING``
becomes: pick one candidate per key by a fixed rule, drop candidates whose key is
already stored (left-anti join), and union with what is stored. A refresh
takes its candidates from the new rows alone, and the pipeline appends what is new.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitlist.operators import model
from hitlist.operators.keys import with_dense_id


def first_per_key(candidates: DataFrame, key_cols: list[str], order_cols: list[str] | None = None) -> DataFrame:
    """One row per key: the row with the smallest (order_cols, then the rest).

    A min over a struct is a partial aggregate, so a key holding a large share of
    the candidates is reduced map-side instead of landing whole in one task.
    """
    rest = [c for c in candidates.columns if c not in key_cols]
    if not rest:
        return candidates.distinct()
    order = list(order_cols or []) + [c for c in rest if c not in (order_cols or [])]
    picked = candidates.groupBy(*key_cols).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in order])).alias("_first"))
    return picked.select(*[F.col(f"`{c}`") for c in key_cols], *[F.col(f"_first.`{c}`").alias(c) for c in rest]).select(
        *[F.col(f"`{c}`") for c in candidates.columns]
    )


def absent(target: DataFrame, batch: DataFrame, key_cols: list[str]) -> DataFrame:
    """Rows of ``batch`` whose key isn't stored. The stored side, which grows with history, is
    neither broadcast nor, where it is bucketed by the key, shuffled or sorted. A key with a
    null is never stored, as in a UNIQUE constraint."""
    return batch.join(target.select(*key_cols).hint("merge"), key_cols, "left_anti").select(*batch.columns)


def insert_if_absent(
    target: DataFrame,
    candidates: DataFrame,
    key_cols: list[str],
    order_cols: list[str] | None = None,
    unique_candidates: bool = False,
) -> DataFrame:
    """Stored rows plus the candidates whose key is not stored yet: of a key in both, the stored
    row stays as it is."""
    batch = candidates if unique_candidates else first_per_key(candidates, key_cols, order_cols)
    return target.unionByName(absent(target, batch, key_cols).select(*target.columns))


def next_id(target: DataFrame, id_col: str) -> Column:
    """max(id) + 1 of the stored table as a scalar subquery (1 when empty)."""
    return target.agg((F.coalesce(F.max(id_col), F.lit(0)) + 1).alias("_next")).scalar()


def append_with_ids(target: DataFrame, new_rows: DataFrame, id_col: str, order_by: list[str]) -> DataFrame:
    """Ids for new rows continue after the stored maximum, in natural-key order."""
    return with_dense_id(new_rows, order_by, id_col, start=next_id(target, id_col))


# --------------------------------------------------------------------------- star model


def songs_upsert(stored_songs: DataFrame, new_chart: DataFrame, peak: str = "debut") -> DataFrame:
    """Songs after a refresh: stored songs keep their ids and take the new longest run (and
    best peak); titles first seen in the new rows are appended.

    ``new_chart`` holds cleaned rows newer than all stored ones, so a stored title's debut
    cannot change, and its longest run and best peak are those of the stored song and the
    new rows. They are joined by title, of which the new rows are first reduced to one row
    each: two songs of one title both match, and none twice. Equals a rebuild of songs from
    all rows up to the ids.
    """
    per_title = new_chart.groupBy(F.col("Song").alias("_title")).agg(
        F.max("`Weeks in Charts`").alias("_weeks"), F.min("`Peak Position`").alias("_peak")
    )
    best = F.least("PeakPosition", "_peak") if peak == "best" else F.col("PeakPosition")
    updated = stored_songs.join(per_title, F.col("SongTitle") == F.col("_title"), "left").select(
        "SongID",
        "SongTitle",
        "SongRank",
        best.cast("int").alias("PeakPosition"),
        F.greatest("WeeksInCharts", "_weeks").cast("int").alias("WeeksInCharts"),
        "DebutDate",
    )
    titles = stored_songs.select(F.col("SongTitle").alias("_stored"))
    unseen = new_chart.join(titles, F.col("Song") == F.col("_stored"), "left_anti")
    inserted = append_with_ids(stored_songs, model.song_rows(unseen, peak), "SongID", model.SONG_ORDER)
    return updated.select(*model.SONG_COLUMNS).unionByName(inserted.select(*model.SONG_COLUMNS))


def songs_changed(stored_songs: DataFrame, new_chart: DataFrame, peak: str = "debut") -> DataFrame:
    """What a refresh changes of songs: stored songs with another longest run (or best peak), in
    their new state, and new songs. Songs that the drop doesn't change are not written again."""
    per_title = new_chart.filter(F.col("Song").isNotNull()).groupBy(F.col("Song").alias("_title")).agg(
        F.max("`Weeks in Charts`").alias("_weeks"), F.min("`Peak Position`").alias("_peak")
    )
    old = stored_songs.join(per_title, F.col("SongTitle") == F.col("_title"))
    weeks = F.greatest("WeeksInCharts", "_weeks").cast("int")
    best = (F.least("PeakPosition", "_peak") if peak == "best" else F.col("PeakPosition")).cast("int")
    changed = old.filter(~weeks.eqNullSafe(F.col("WeeksInCharts")) | ~best.eqNullSafe(F.col("PeakPosition"))).select(
        "SongID", "SongTitle", "SongRank", best.alias("PeakPosition"), weeks.alias("WeeksInCharts"), "DebutDate"
    )
    titles = stored_songs.select(F.col("SongTitle").alias("_stored"))
    unseen = new_chart.join(titles, F.col("Song") == F.col("_stored"), "left_anti")
    inserted = append_with_ids(stored_songs, model.song_rows(unseen, peak), "SongID", model.SONG_ORDER)
    return changed.unionByName(inserted.select(*model.SONG_COLUMNS))


def newest(batches: list[DataFrame], key: str) -> DataFrame:
    """Merge on read: of each key the row of the last batch that has it. A key occurs once in a
    batch. The first batch, the bulk, is not shuffled for it while the ids of the later ones are
    few enough for Spark to broadcast."""
    if len(batches) == 1:
        return batches[0]
    base, later = batches[0], batches[1].withColumn("_batch", F.lit(1))
    for n, batch in enumerate(batches[2:], 2):
        later = later.unionByName(batch.withColumn("_batch", F.lit(n)))
    if len(batches) > 2:
        last = Window.partitionBy(key).orderBy(F.desc("_batch"))
        later = later.withColumn("_place", F.row_number().over(last)).filter("_place = 1").drop("_place")
    later = later.drop("_batch")
    return base.join(later.select(key), key, "left_anti").select(*base.columns).unionByName(later)


def songs_append_as_written(stored_songs: DataFrame, chart_all: DataFrame, peak: str = "debut") -> DataFrame:
    """The refresh as written: every song of the full history is inserted again
    under new ids (stale copies keep their old longest run)."""
    again = append_with_ids(stored_songs, model.song_rows(chart_all, peak), "SongID", model.SONG_ORDER)
    return stored_songs.select(*model.SONG_COLUMNS).unionByName(again.select(*model.SONG_COLUMNS))


ENTRY_KEY, FEATURE_KEY, ARTIST_KEY = ["EntryDate", "SongID"], ["SongID", "ArtistID"], ["ArtistName"]


def entries_append_as_written(stored_entries: DataFrame, chart_all: DataFrame, songs_written: DataFrame) -> DataFrame:
    """The refresh as written: the whole chart is joined with every song of its title, copies
    that were inserted again included, and what isn't stored yet is added."""
    return insert_if_absent(stored_entries, model.entries(chart_all, songs_written), ENTRY_KEY, unique_candidates=True)


def features_append_as_written(
    stored_features: DataFrame, chart_all: DataFrame, songs_written: DataFrame, artists_now: DataFrame
) -> DataFrame:
    """Likewise for contributions: primary credits first, then featured ones, each where the
    song and artist aren't stored yet."""
    candidates = model.features(chart_all, songs_written, artists_now)
    return insert_if_absent(stored_features, candidates, FEATURE_KEY, unique_candidates=True)


def artists_insert(stored_artists: DataFrame, names: DataFrame) -> DataFrame:
    """Artists after a drop with ``names`` (ArtistName): stored ones keep their ids."""
    unseen = absent(stored_artists, first_per_key(names, ARTIST_KEY), ARTIST_KEY)
    added = append_with_ids(stored_artists, unseen, "ArtistID", ARTIST_KEY)
    return stored_artists.unionByName(added.select(*stored_artists.columns))


def new_artists(stored_artists: DataFrame, new_chart: DataFrame) -> DataFrame:
    """Artists of the new rows that aren't stored, with ids after the stored ones."""
    names = model.artist_names(new_chart).join(stored_artists.select("ArtistName"), "ArtistName", "left_anti")
    return append_with_ids(stored_artists, names, "ArtistID", ["ArtistName"]).select("ArtistID", "ArtistName")


def new_entries(new_chart: DataFrame, songs_now: DataFrame) -> DataFrame:
    """Entries of the new rows: their dates are newer than every stored one, so no key is
    stored yet, and entries() yields one row per (EntryDate, SongID)."""
    return model.entries(new_chart, songs_now)


def new_features(stored_features: DataFrame, new_chart: DataFrame, songs_now: DataFrame, artists_now: DataFrame) -> DataFrame:
    """Contributions of the new rows whose (SongID, ArtistID) isn't stored; features() already
    resolves one contribution per key, primary first."""
    key = ["SongID", "ArtistID"]
    return model.features(new_chart, songs_now, artists_now).join(stored_features.select(*key), key, "left_anti")
