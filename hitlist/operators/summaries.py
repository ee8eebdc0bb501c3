"""A1-A3 kept up to date (S8): mergeable sums instead of a weekly pass over all history.

A summary's state has, per group, the number of rows and the exact scaled sum and count of
each value (N1), so two states add up and a row can be taken back. A refresh changes few songs:
what the songs that the drop touches contributed before is subtracted, what they contribute now is
added, and the means are finished from the sums. The result equals a rebuild exactly, as the
sums are whole numbers.

``touched`` names those songs: every song of a title in the drop, as its longest run or
best peak, its entries or its contributions may have changed. Nothing else can have: entries and
contributions of other songs have no new rows. Old rows of the tables are read through a
join with the touched songs' ids only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlist.functions.numeric import finish_mean, mean_parts
from hitlist.operators import analyses

Model = dict[str, DataFrame]


@dataclass(frozen=True)
class Summary:
    """``rows`` gives (keys, values) rows of a model; ``means`` names the means after the keys, by
    value, and ``count`` the number of rows, where the summary has it."""

    keys: list[str]
    values: list[str]
    rows: Callable[[Model], DataFrame]
    means: dict[str, str]
    count: str | None = None


SUMMARIES = {
    "positions_and_longevity_by_debut_month": Summary(
        ["month_number", "debut_month"],
        ["PeakPosition", "WeeksInCharts"],
        lambda m: analyses.month_rows(m["songs"], "DebutDate", "debut_month"),
        {"average_peak_position": "PeakPosition", "average_longevity": "WeeksInCharts"},
    ),
    "positions_and_longevity_by_peak_month": Summary(
        ["month_number", "peak_month"],
        ["PeakPosition", "WeeksInCharts"],
        lambda m: analyses.month_rows(analyses.at_peak(m["songs"], m["entries"]), "EntryDate", "peak_month"),
        {"average_peak_position": "PeakPosition", "average_longevity": "WeeksInCharts"},
    ),
    "popular_song_longevity_by_artist": Summary(
        ["artistname"],
        ["WeeksInCharts"],
        lambda m: analyses.hit_rows(m["songs"], m["features"], m["artists"]),
        {"avg_weeks_in_chart": "WeeksInCharts"},
        count="hit_songs",
    ),
}


def _columns(s: Summary) -> list[str]:
    return ["n_rows", *(f"{v}_{part}" for v in s.values for part in ("sum", "cnt"))]


def state(name: str, model: Model) -> DataFrame:
    """The keys, n_rows, and a sum and count of each value."""
    s = SUMMARIES[name]
    parts = [c for v in s.values for c in mean_parts(v, v)]
    return s.rows(model).groupBy(*s.keys).agg(F.count(F.lit(1)).alias("n_rows"), *parts)


def merged(name: str, plus: list[DataFrame], minus: list[DataFrame] = ()) -> DataFrame:
    """States added up, less those taken back. Groups without rows go."""
    s = SUMMARIES[name]
    signed = [(df, 1) for df in plus] + [(df, -1) for df in minus]
    frames = [df.select(*s.keys, *((F.col(c) * sign).alias(c) for c in _columns(s))) for df, sign in signed]
    every = frames[0]
    for frame in frames[1:]:
        every = every.unionByName(frame)
    # a sum of nulls is null: a value that is null throughout counts as nothing
    total = every.groupBy(*s.keys).agg(*(F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in _columns(s)))
    return total.filter("n_rows > 0")


def finished(name: str, state_: DataFrame) -> DataFrame:
    """The summary of a state, in the columns of A1, A2 or A3."""
    s = SUMMARIES[name]
    means = [finish_mean(f"{value}_sum", f"{value}_cnt").alias(mean) for mean, value in s.means.items()]
    return state_.select(*s.keys, *([F.col("n_rows").alias(s.count)] if s.count else []), *means)


def touched(songs_now: DataFrame, new_chart: DataFrame) -> DataFrame:
    """Ids of the songs that a drop can have changed."""
    titles = new_chart.select(F.col("Song").alias("SongTitle")).distinct()
    return songs_now.join(titles, "SongTitle", "left_semi").select("SongID")


def restricted(model: Model, ids: DataFrame) -> Model:
    """A model with only some songs, and the entries and contributions of these."""
    out = dict(model)
    for name in ("songs", "entries", "features"):
        if name in model:
            out[name] = model[name].join(ids, "SongID", "left_semi")
    return out


def refreshed(name: str, old_state: DataFrame, before: Model, after: Model, ids: DataFrame) -> DataFrame:
    """The state after a refresh from ``before`` to ``after`` that touched the songs ``ids``."""
    return merged(name, [old_state, state(name, restricted(after, ids))], [state(name, restricted(before, ids))])
