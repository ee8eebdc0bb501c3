"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per name.

Every query reads the driver tables (the chart is derived from lineitem, orders
and part; employees from customer, orders and nation), so its work grows with
them. A ``Frames`` object builds each intermediate table lazily and at most once
per query, so a query that needs songs twice numbers them once.

The weekly-refresh queries split the derived chart the way a drop arrives: the first
tenth of its time is the stored history (bootstrap load and cleaning), and the whole
derived file is the incoming drop, so that it brings new weeks and new titles.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlist.operators import analyses, cleaning, employee, model, quality, summaries, upsert
from hitlist.plans.pipeline import CHART_RULES
from hitlist.schemas import CHART_TYPED, LENGTH_LIMITS
from hitlist.session import store
from hitlist.sources import bootstrap_flagged, chart_rows, employee_rows, inferred
from hitlist.sources.bucketed import store_bucketed
from hitlist.sources.clustered import store_clustered
from hitlist.streaming import refresh


class Frames:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._songs: dict[str, DataFrame] = {}
        self._entries: dict[str, DataFrame] = {}
        self._features: dict[str, DataFrame] = {}

    # ---- chart source and cleaning
    @cached_property
    def raw(self) -> DataFrame:
        return chart_rows(self.spark, self.sf_dir)

    @cached_property
    def raw_stored(self) -> DataFrame:
        """The derived chart computed once, for queries that read it in several branches or clean
        all of it for several: deriving and cleaning rows in one stage takes longer than both
        apart, as one generated method then holds all credit shapes and rules."""
        return store(self.raw, "chart-raw")

    @cached_property
    def flagged(self) -> DataFrame:
        # If this query already stored the derived chart, read that copy instead of deriving
        # the chart from lineitem again.
        return bootstrap_flagged(self.__dict__.get("raw_stored", self.raw))

    @cached_property
    def clean_once(self) -> DataFrame:
        """The cleaned chart for queries that read it in one branch: nothing is stored."""
        return cleaning.clean(self.flagged)

    @cached_property
    def clean(self) -> DataFrame:
        return store(cleaning.clean(bootstrap_flagged(self.raw_stored)), "chart-clean")

    @cached_property
    def as_text(self) -> DataFrame:
        """The chart as its file has it, all text, with bad cells put in by rule: ranks of every
        seventh week count in letters, every eleventh date as day and month, empty weeks."""
        weeks, rank = F.col("Weeks in Charts"), F.col("Rank")
        faults = {
            "Date": F.when(rank % 11 == 0, F.concat(F.substring("Date", 9, 2), F.lit("."), F.substring("Date", 6, 2), F.lit("."))),
            "Rank": F.when(weeks % 7 == 0, F.concat(F.lit("no. "), rank.cast("string"))),
            "Weeks in Charts": F.when(rank % 13 == 0, F.lit("")),
        }
        columns = (
            F.coalesce(faults.get(c, F.lit(None)), F.col(f"`{c}`").cast("string")).alias(c) for c in self.raw.columns
        )
        return store(self.raw.select(*columns), "chart-text")

    # ---- star model (bootstrap over the whole chart)
    def songs(self, peak: str = "debut") -> DataFrame:
        if peak not in self._songs:
            self._songs[peak] = store(model.songs(self.clean, peak), "songs")
        return self._songs[peak]

    @cached_property
    def artists(self) -> DataFrame:
        return model.artists(self.clean)

    def entries(self, peak: str = "debut") -> DataFrame:
        if peak not in self._entries:
            self._entries[peak] = model.entries(self.clean, self.songs(peak))
        return self._entries[peak]

    def features(self, peak: str = "debut") -> DataFrame:
        if peak not in self._features:
            self._features[peak] = model.features(self.clean, self.songs(peak), self.artists)
        return self._features[peak]

    # ---- weekly drop: stored history (the first tenth of the chart's time) + incoming file
    def history(self, chart: DataFrame) -> DataFrame:
        day = F.col("Date").cast("date")
        split = self.raw_stored.agg(F.date_add(F.min(day), F.floor(F.datediff(F.max(day), F.min(day)) / 10).cast("int"))).scalar()
        return chart.filter(day < split)

    @cached_property
    def stored(self) -> DataFrame:
        # every rule reads one row: what this query has cleaned already is not cleaned again
        if "clean" in self.__dict__:
            return store(self.history(self.clean), "chart-stored")
        return store(cleaning.clean(bootstrap_flagged(self.history(self.raw_stored))), "chart-stored")

    @cached_property
    def new_rows(self) -> DataFrame:
        return refresh.new_rows(cleaning.typed_weekly(self.raw_stored), self.stored)

    @cached_property
    def new_clean(self) -> DataFrame:
        return store(cleaning.flags_reset(cleaning.clean_new_rows(self.new_rows)), "chart-new")

    @cached_property
    def refreshed(self) -> DataFrame:
        return self.stored.unionByName(self.new_clean)

    @cached_property
    def stored_songs(self) -> DataFrame:
        return store(model.songs(self.stored), "songs-stored")

    @cached_property
    def stored_artists(self) -> DataFrame:
        return store(model.artists(self.stored), "artists-stored")

    @cached_property
    def songs_now(self) -> DataFrame:
        return upsert.songs_upsert(self.stored_songs, self.new_clean)

    @cached_property
    def songs_refreshed(self) -> DataFrame:
        return store(self.songs_now, "songs-now")

    @cached_property
    def artists_now(self) -> DataFrame:
        return self.stored_artists.unionByName(upsert.new_artists(self.stored_artists, self.new_clean))

    @cached_property
    def entries_now(self) -> DataFrame:
        old = model.entries(self.stored, self.stored_songs)
        return old.unionByName(upsert.new_entries(self.new_clean, self.songs_refreshed))

    @cached_property
    def features_now(self) -> DataFrame:
        old = store(model.features(self.stored, self.stored_songs, self.stored_artists), "features-stored")
        artists = store(self.artists_now, "artists-now")
        return old.unionByName(upsert.new_features(old, self.new_clean, self.songs_refreshed, artists))

    # ---- conflicts: stored tables bucketed by their key
    @cached_property
    def stored_entries(self) -> DataFrame:
        return store_bucketed(model.entries(self.stored, self.stored_songs), "entries", upsert.ENTRY_KEY)

    @cached_property
    def stored_features(self) -> DataFrame:
        features = model.features(self.stored, self.stored_songs, self.stored_artists)
        return store_bucketed(features, "features", upsert.FEATURE_KEY)

    @cached_property
    def redelivered(self) -> DataFrame:
        """A drop that brings every stored week again, one place lower and with the credits the
        other way round, besides the new weeks."""
        swapped = F.col("Featured_Artist").isNotNull()
        changed = {c: (F.col(f"`{c}`") + 1).alias(c) for c in ["Rank", "Last Week", "Peak Position", "Weeks in Charts"]}
        changed["Artist"] = F.coalesce("Featured_Artist", "Artist").alias("Artist")
        changed["Featured_Artist"] = F.when(swapped, F.col("Artist")).alias("Featured_Artist")
        again = self.stored.select(*(changed.get(c, F.col(f"`{c}`")) for c in self.stored.columns))
        return store(again.unionByName(self.new_clean), "chart-again")

    @cached_property
    def songs_written(self) -> DataFrame:
        return store(upsert.songs_append_as_written(self.stored_songs, self.refreshed), "songs-written")

    # ---- summaries kept up through a refresh
    def summary_kept_up(self, name: str) -> DataFrame:
        before = {"songs": self.stored_songs, "entries": self.stored_entries}
        after = {"songs": self.songs_refreshed}
        if name == "popular_song_longevity_by_artist":
            artists = store(self.artists_now, "artists-now")
            old = self.stored_features
            new = upsert.new_features(old, self.new_clean, self.songs_refreshed, artists)
            before = {"songs": self.stored_songs, "features": old, "artists": artists}
            after |= {"features": old.unionByName(new), "artists": artists}
        else:
            after["entries"] = self.stored_entries.unionByName(upsert.new_entries(self.new_clean, self.songs_refreshed))
        state = store(summaries.state(name, before), "summary-state")
        ids = store(summaries.touched(self.songs_refreshed, self.new_clean), "touched-songs")
        return summaries.finished(name, summaries.refreshed(name, state, before, after, ids))

    # ---- employees
    @cached_property
    def emp_data(self) -> DataFrame:
        return employee_rows(self.spark, self.sf_dir)

    @cached_property
    def emp_stored(self) -> DataFrame:
        return store(self.emp_data, "employee-data")

    @cached_property
    def department(self) -> DataFrame:
        return employee.departments(self.emp_data)

    @cached_property
    def employee(self) -> DataFrame:
        return employee.employees(self.emp_data)


Q = Callable[[Frames], DataFrame]


def _step(name: str) -> Q:
    return lambda f: cleaning.clean(f.flagged, standardize_featured=(name == "featured_standardized"), through=name)


# The checks run on tables with faults put in by rule, next to sound ones: a check that finds
# nothing proves nothing.


def _loaded_twice(df: DataFrame, key: str) -> DataFrame:
    """Rows of every fiftieth key once more, as a load that was repeated in part leaves them."""
    return df.unionByName(df.filter(F.col(key) % 50 == 0))


def _stretched(df: DataFrame, columns: list[str]) -> DataFrame:
    """Texts whose length is a multiple of seven, thirty times over."""
    return df.select(
        *(F.when(F.length(c) % 7 == 0, F.repeat(F.col(f"`{c}`"), 30)).otherwise(F.col(f"`{c}`")).alias(c) for c in columns)
    )


def _pk(f: Frames) -> DataFrame:
    emp = f.emp_stored
    return quality.union_all(
        [
            # the chart keyed as the fact table would be if loaded without the first-writer
            # rule (a title can chart twice in one week)
            quality.pk_violations(cleaning.typed(f.raw_stored), "chart", ["Date", "Song"]),
            quality.pk_violations(_loaded_twice(f.songs(), "SongID"), "songs", ["SongID"]),
            quality.pk_violations(f.artists, "artists", ["ArtistID"]),
            quality.pk_violations(_loaded_twice(store(f.features(), "features"), "SongID"), "features", ["SongID", "ArtistID"]),
            quality.pk_violations(f.entries(), "entries", ["EntryDate", "SongID"]),
            quality.pk_violations(employee.departments(emp), "department", ["DepartmentID"]),
            quality.pk_violations(employee.employees(emp), "employee", ["EmployeeID"]),
            quality.pk_violations(_loaded_twice(employee.support_ratings(emp), "EmployeeID"), "support_ratings", ["EmployeeID"]),
            quality.pk_violations(_loaded_twice(employee.total_sales(emp), "EmployeeID"), "total_sales", ["EmployeeID"]),
        ]
    )


def _unique(f: Frames) -> DataFrame:
    return quality.union_all(
        [
            # song titles are not unique (two acts, one title)
            quality.unique_violations(f.songs(), "songs", "SongTitle"),
            quality.unique_violations(f.artists, "artists", "ArtistName"),
            quality.unique_violations(f.department, "department", "DepartmentName"),
        ]
    )


def _fk(f: Frames) -> DataFrame:
    emp = f.emp_stored
    # staff and departments as they were before the latest joiners
    earlier = employee.employees(emp).filter("YearsOfExperience > 0")
    sales_only = employee.department_names(emp).filter("DepartmentName = 'Sales'")
    songs, features = f.songs(), store(f.features(), "features")
    return quality.union_all(
        [
            # entries of the whole chart against the songs of its first tenth: a stale
            # dimension misses the titles that came later
            quality.fk_violations(f.entries(), "entries", "SongID", f.stored_songs, "SongID", "songs"),
            quality.fk_violations(features, "features", "SongID", songs, "SongID", "songs"),
            quality.fk_violations(features, "features", "ArtistID", f.artists, "ArtistID", "artists"),
            quality.fk_violations(earlier, "employee", "Department", sales_only, "DepartmentName", "department"),
            quality.fk_violations(employee.support_ratings(emp), "support_ratings", "EmployeeID", earlier, "EmployeeID", "employee"),
            quality.fk_violations(employee.total_sales(emp), "total_sales", "EmployeeID", earlier, "EmployeeID", "employee"),
        ]
    )


def _domain(f: Frames) -> DataFrame:
    label = F.when(F.col("SongID") % 50 == 0, F.lit("Guest")).otherwise(F.col("Contribution"))
    return quality.domain_violations(f.features().withColumn("Contribution", label), "features", "Contribution", ["Primary", "Feature"])


def _model(f: Frames) -> DataFrame:
    """The checks of a whole star model: songs loaded twice in part and with every 97th missing, a
    contribution that isn't allowed; what counts prove is not listed."""
    songs = store(_loaded_twice(f.songs().filter("SongID % 97 <> 0"), "SongID"), "songs-faulty")
    label = F.when(F.col("SongID") % 50 == 0, F.lit("Guest")).otherwise(F.col("Contribution"))
    tables = {
        "songs": songs,
        "artists": store(f.artists, "artists"),
        "features": store(f.features().withColumn("Contribution", label), "features"),
        "entries": store(f.entries(), "entries"),
        "chart": f.clean,
    }
    return quality.violations(tables, CHART_RULES)


def _length(f: Frames) -> DataFrame:
    # lengths do not depend on ids, so no table is numbered for this
    emp = f.emp_stored
    tables = {
        "songs": model.song_rows(f.clean),
        "artists": model.artist_names(f.clean),
        "features": model.credited(f.clean).select("Contribution"),
        "chart": f.clean,
        "department": employee.department_names(emp),
        "employee": employee.employees(emp),
    }
    return quality.union_all(
        [quality.too_long(_stretched(tables[t], list(limits)), t, limits) for t, limits in LENGTH_LIMITS.items()]
    )


REGISTRY: dict[str, Q] = {
    # source
    "chart_source": lambda f: f.raw,
    "chart_typed": lambda f: cleaning.typed(f.raw),
    "sentinel_any_column": lambda f: cleaning.sentinel_any_column(f.raw),
    "bootstrap_flagged": lambda f: f.flagged,
    "chart_inferred_types": lambda f: inferred.inferred_types(f.as_text),
    "chart_accepted": lambda f: inferred.accepted(f.as_text, CHART_TYPED),
    "chart_rejected": lambda f: inferred.rejected(f.as_text, CHART_TYPED),
    # cleaning
    **{name: _step(name) for name in cleaning.STEP_NAMES},
    "clean_full": lambda f: f.clean_once,
    "clean_weekly": lambda f: cleaning.clean_new_rows(f.new_rows),
    # model
    "song_debuts": lambda f: model.song_debuts(f.clean_once),
    "song_max_weeks": lambda f: model.song_max_weeks(f.clean_once),
    "song_best_peak": lambda f: model.song_best_peak(f.clean_once),
    "songs_debut_peak": lambda f: f.songs("debut"),
    "songs_best_peak": lambda f: f.songs("best"),
    "entries": lambda f: f.entries(),
    "entries_clustered": lambda f: store_clustered(store(f.entries(), "entries"), "entries-clustered", upsert.ENTRY_KEY),
    "artists": lambda f: f.artists,
    "features_primary": lambda f: model.features_primary(f.clean, f.songs(), f.artists),
    "features": lambda f: f.features(),
    # incremental
    "high_water_mark": lambda f: refresh.high_water_mark(f.stored),
    "new_rows": lambda f: f.new_rows,
    "flags_reset": lambda f: f.refreshed,
    "entries_insert_if_absent": lambda f: f.entries_now,
    "artists_insert_if_absent": lambda f: f.artists_now,
    "features_insert_if_absent": lambda f: f.features_now,
    "songs_append_as_written": lambda f: upsert.songs_append_as_written(f.stored_songs, f.refreshed),
    "weekly_upsert": lambda f: f.songs_now,
    "songs_merge_on_read": lambda f: upsert.newest(
        [f.stored_songs, store(upsert.songs_changed(f.stored_songs, f.new_clean), "songs-changed")], "SongID"
    ),
    # a stored key wins over a drop that brings it again
    "entries_redelivered": lambda f: upsert.insert_if_absent(
        f.stored_entries, model.entries(f.redelivered, f.songs_refreshed), upsert.ENTRY_KEY, unique_candidates=True
    ),
    "artists_redelivered": lambda f: upsert.artists_insert(
        store_bucketed(f.stored_artists, "artists", upsert.ARTIST_KEY), model.artist_names(f.redelivered)
    ),
    "features_redelivered": lambda f: upsert.insert_if_absent(
        f.stored_features,
        model.features(f.redelivered, f.songs_refreshed, store(f.artists_now, "artists-now")),
        upsert.FEATURE_KEY,
        unique_candidates=True,
    ),
    "entries_append_as_written": lambda f: upsert.entries_append_as_written(f.stored_entries, f.refreshed, f.songs_written),
    "features_append_as_written": lambda f: upsert.features_append_as_written(
        f.stored_features, f.refreshed, f.songs_written, store(f.artists_now, "artists-now")
    ),
    # chart analyses
    "debut_month": lambda f: analyses.debut_month(f.songs("debut")),
    "debut_month_best": lambda f: analyses.debut_month(f.songs("best")),
    "peak_month": lambda f: analyses.peak_month(f.songs("debut"), f.entries("debut")),
    "peak_month_best": lambda f: analyses.peak_month(f.songs("best"), f.entries("best")),
    "artist_longevity": lambda f: analyses.artist_longevity(f.songs("debut"), f.features("debut"), f.artists),
    "artist_longevity_best": lambda f: analyses.artist_longevity(f.songs("best"), f.features("best"), f.artists),
    # the same, kept up by what a drop touches
    "debut_month_kept_up": lambda f: f.summary_kept_up("positions_and_longevity_by_debut_month"),
    "peak_month_kept_up": lambda f: f.summary_kept_up("positions_and_longevity_by_peak_month"),
    "artist_longevity_kept_up": lambda f: f.summary_kept_up("popular_song_longevity_by_artist"),
    # employee
    "departments": lambda f: f.department,
    "employees": lambda f: f.employee,
    "support_ratings": lambda f: employee.support_ratings(f.emp_data),
    "total_sales": lambda f: employee.total_sales(f.emp_data),
    "performance_by_department": lambda f: analyses.performance_by_department(
        employee.employees(f.emp_stored), employee.department_names(f.emp_stored)
    ),
    "performance_by_salary": lambda f: analyses.performance_by_salary(f.employee),
    "performance_by_tenure": lambda f: analyses.performance_by_tenure(f.employee),
    "salary_by_department": lambda f: analyses.salary_by_department(f.employee),
    "salary_by_tenure": lambda f: analyses.salary_by_tenure(f.employee),
    "sales_by_performance": lambda f: analyses.sales_by_performance(
        employee.employees(f.emp_stored), employee.total_sales(f.emp_stored)
    ),
    # quality
    "pk_violations": _pk,
    "unique_violations": _unique,
    "fk_violations": _fk,
    "domain_violations": _domain,
    "length_violations": _length,
    "model_violations": _model,
}


def query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    fn = REGISTRY[name]
    return lambda spark, sf_dir: fn(Frames(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query(name) for name in REGISTRY}
