"""Persisted flows: bootstrap, weekly refresh, employee model and summaries.

Every stage is written as a Parquet table under ``{root}/{version}/{stage}/{table}``
and read back for the next stage: the written table cuts lineage (a lost executor
recomputes from it, not from the scans). A refresh writes a *new* version folder with
what is new (S7), of songs those that changed (merged on read); a marker written last lists
the versions a version consists of, so a refresh that stops midway is never read, and holds the
high-water mark (S4), counted while the chart is written, so that the next refresh reads no
stored row for it. ``compact``
packs small batches into one, and ``expire`` deletes folders that no kept version consists of.
Summaries are full-replace tables (S8), finished from mergeable sums that a refresh
changes by what its drop touched; their row order is applied on read (S13).
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitlist import schemas
from hitlist.operators import analyses, cleaning, employee, model, quality, summaries, upsert
from hitlist.session import store
from hitlist.sources import bootstrap_flagged
from hitlist.streaming import refresh

CHART_MODEL = {"songs": schemas.SONGS, "artists": schemas.ARTISTS, "entries": schemas.ENTRIES, "features": schemas.FEATURES}
HR_MODEL = {
    "department": schemas.DEPARTMENT,
    "employee": schemas.EMPLOYEE,
    "support_ratings": schemas.SUPPORT_RATINGS,
    "total_sales": schemas.TOTAL_SALES,
}
#: Table that marks a version as complete.
MARKER = "complete_version"

CHART_SUMMARIES = {
    "positions_and_longevity_by_debut_month": ["month_number"],
    "positions_and_longevity_by_peak_month": ["month_number"],
    "popular_song_longevity_by_artist": ["hit_songs DESC", "artistname"],
}
HR_SUMMARIES = {
    "performance_by_department_analysis": [],
    "performance_by_salary_analysis": ["performance_rating"],
    "performance_by_tenure_analysis": ["tenure_order"],
    "salary_to_department_analysis": [],
    "salary_to_tenure_analysis": ["tenure_order"],
    "sales_by_performance_analysis": ["performancerating"],
}


def path(root: str, version: str, stage: str, table: str) -> str:
    return f"{root.rstrip('/')}/{version}/{stage}/{table}"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns, in order and of the declared types."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def _store(spark: SparkSession, df: DataFrame, p: str, schema: T.StructType | None = None) -> DataFrame:
    (conform(df, schema) if schema else df).write.mode("overwrite").parquet(p)
    return spark.read.parquet(p)


def _read(spark: SparkSession, root: str, batches: list[str], stage: str, table: str) -> DataFrame:
    """A table that is stored in batches: one folder of each version it grew in."""
    return spark.read.parquet(*[path(root, b, stage, table) for b in batches])


def _store_chart(spark: SparkSession, df: DataFrame, root: str, version: str) -> tuple[DataFrame, dt.date | None]:
    """The cleaned chart of a batch as stored, and its newest date, found while it is written."""
    seen = Observation()
    counted = conform(df, schemas.CHART_CLEAN).observe(seen, F.max("Date").alias("newest"))
    return _store(spark, counted, path(root, version, "source", "clean")), seen.get["newest"]


def _complete(spark: SparkSession, root: str, version: str, batches: list[str], newest: dt.date | None) -> None:
    """The marker of a whole version, written last: the versions whose folders it consists of, and
    the newest date of its chart (null: no dated row)."""
    marker = spark.createDataFrame([(batches, newest)], "batches array<string>, newest date")
    marker.write.mode("overwrite").parquet(path(root, version, "source", MARKER))


def _marker(spark: SparkSession, root: str, version: str):
    try:
        return spark.read.parquet(path(root, version, "source", MARKER)).first()
    except AnalysisException:
        return None


def batches_of(spark: SparkSession, root: str, version: str) -> list[str] | None:
    """The versions that ``version`` consists of, itself last; None if it isn't complete."""
    row = _marker(spark, root, version)
    return None if row is None else list(row.batches)


def newest_of(spark: SparkSession, root: str, version: str) -> dt.date | None:
    """The high-water mark of a complete version, from its marker; a marker that was written
    without one has it read from the chart."""
    row = _marker(spark, root, version)
    if row is not None and "newest" in row:
        return row.newest
    return refresh.high_water_mark(read_chart(spark, root, version)["clean"]).first().hwm


def read_summary(spark: SparkSession, root: str, version: str, name: str) -> DataFrame:
    """Read back a summary in its stated order (NULLS LAST, as PostgreSQL)."""
    df = spark.read.parquet(path(root, version, "gold", name))
    order = {**CHART_SUMMARIES, **HR_SUMMARIES}[name]
    if "tenure_order" in order:
        return df.orderBy(F.split_part(F.col("tenure"), F.lit("-"), F.lit(1)).cast("int").asc_nulls_last())
    cols = []
    for spec in order:
        name_, _, direction = spec.partition(" ")
        cols.append(F.col(name_).desc_nulls_last() if direction == "DESC" else F.col(name_).asc_nulls_last())
    return df.orderBy(*cols) if cols else df


def _chart_summaries(spark: SparkSession, root: str, version: str, states: dict[str, DataFrame]) -> None:
    """The sums behind A1-A3, and A1-A3."""
    for name, df in states.items():
        stored = _store(spark, df, path(root, version, "state", name))
        summaries.finished(name, stored).write.mode("overwrite").parquet(path(root, version, "gold", name))


def _states(spark: SparkSession, root: str, version: str, m: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The stored sums of a version; worked out from its model where it has none."""
    out = {}
    for name in CHART_SUMMARIES:
        try:
            out[name] = spark.read.parquet(path(root, version, "state", name))
        except AnalysisException:
            out[name] = summaries.state(name, m)
    return out


def bootstrap(spark: SparkSession, raw: DataFrame, root: str, version: str = "v1", peak: str = "debut") -> dict[str, DataFrame]:
    """Raw load (S2, S3), cleaning (U1-U11), star model (M1-M6), summaries (A1-A3)."""
    stored_raw = _store(spark, bootstrap_flagged(raw), path(root, version, "source", "raw"))
    clean, newest = _store_chart(spark, cleaning.clean(stored_raw), root, version)
    m: dict[str, DataFrame] = {}

    def put(name: str, df: DataFrame) -> None:
        m[name] = _store(spark, df, path(root, version, "model", name), CHART_MODEL[name])

    # songs and artists first: entries and features reference them (FK order)
    put("songs", model.songs(clean, peak))
    put("artists", model.artists(clean))
    put("entries", model.entries(clean, m["songs"]))
    put("features", model.features(clean, m["songs"], m["artists"]))
    _chart_summaries(spark, root, version, {name: summaries.state(name, m) for name in CHART_SUMMARIES})
    _complete(spark, root, version, [version], newest)
    return {"clean": clean, **m}


def read_chart(spark: SparkSession, root: str, version: str) -> dict[str, DataFrame]:
    """The cleaned chart and star model of a complete version."""
    batches = batches_of(spark, root, version)
    if batches is None:
        raise FileNotFoundError(f"{root}/{version} is not a complete version")
    return _read_batches(spark, root, batches)


def _read_batches(spark: SparkSession, root: str, batches: list[str]) -> dict[str, DataFrame]:
    out = {"clean": _read(spark, root, batches, "source", "clean")}
    for name in ["artists", "entries", "features"]:
        out[name] = _read(spark, root, batches, "model", name)
    songs = [spark.read.parquet(path(root, b, "model", "songs")) for b in batches]
    return out | {"songs": upsert.newest(songs, "SongID")}


def weekly(
    spark: SparkSession,
    incoming_raw: DataFrame,
    root: str,
    from_version: str,
    to_version: str,
    peak: str = "debut",
    standardize_featured: bool = False,
) -> dict[str, DataFrame]:
    """One weekly drop against the stored version ``from_version``.

    S4-S7 + U12 + U13 on the new rows alone. Chart, artists, entries and features are
    appended: ``to_version`` holds what is new of them, and of songs those that are new or
    changed (longest run, best peak). Its marker lists the versions it consists of, whose
    files are not touched. The summaries change by what the touched songs contribute.
    """
    batches = batches_of(spark, root, from_version)
    if batches is None:
        raise FileNotFoundError(f"{root}/{from_version} is not a complete version")
    if to_version in batches or batches_of(spark, root, to_version) is not None:
        # overwriting Parquet files that a version consists of would take them from it
        raise ValueError("a refresh writes a new version; to_version is a complete one already")
    old = read_chart(spark, root, from_version)

    def put(stage: str, name: str, df: DataFrame, schema: T.StructType) -> DataFrame:
        return _store(spark, df, path(root, to_version, stage, name), schema)

    mark = newest_of(spark, root, from_version)
    fresh = refresh.rows_after(cleaning.typed_weekly(incoming_raw), F.lit(mark).cast("date"))
    cleaned = cleaning.flags_reset(cleaning.clean_new_rows(fresh, standardize_featured))
    new, newest = _store_chart(spark, cleaned, root, to_version)
    put("model", "songs", upsert.songs_changed(old["songs"], new, peak), schemas.SONGS)
    now = [*batches, to_version]
    songs = upsert.newest([spark.read.parquet(path(root, b, "model", "songs")) for b in now], "SongID")
    added = put("model", "artists", upsert.new_artists(old["artists"], new), schemas.ARTISTS)
    artists = old["artists"].unionByName(added)
    put("model", "entries", upsert.new_entries(new, songs), schemas.ENTRIES)
    put("model", "features", upsert.new_features(old["features"], new, songs, artists), schemas.FEATURES)
    m = _read_batches(spark, root, now)
    ids = store(summaries.touched(m["songs"], new), "touched-songs")
    states = {n: summaries.refreshed(n, s, old, m, ids) for n, s in _states(spark, root, from_version, old).items()}
    _chart_summaries(spark, root, to_version, states)
    _complete(spark, root, to_version, now, newest or mark)
    return read_chart(spark, root, to_version)


def _files(spark: SparkSession, p: str):
    """Spark's handle of a path and its file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(p)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def batch_bytes(spark: SparkSession, root: str, batch: str) -> int:
    """Bytes of a batch's chart tables, from the file system's metadata."""
    total = 0
    for stage, name in [("source", "clean"), *(("model", n) for n in CHART_MODEL)]:
        where, fs = _files(spark, path(root, batch, stage, name))
        total += fs.getContentSummary(where).getLength()
    return total


def packed_runs(sizes: list[int], target: int) -> list[list[int]]:
    """Places of batches in runs of neighbours of at most ``target`` bytes together; a larger
    batch is a run of its own. Their order stays, as a later batch of songs wins."""
    runs, size = [], 0
    for n, bytes_ in enumerate(sizes):
        if runs and size + bytes_ <= target:
            runs[-1].append(n)
            size += bytes_
        else:
            runs.append([n])
            size = bytes_
    return runs


def compact(spark: SparkSession, root: str, from_version: str, to_version: str, target: int = 128 << 20) -> list[str]:
    """``to_version`` is ``from_version`` in fewer batches, which are returned. Runs of small
    neighbouring batches are written as one file a table; large ones stay where they are. Nothing
    of ``from_version`` changes, and ``to_version`` can be read once its marker is there."""
    batches = batches_of(spark, root, from_version)
    if batches is None:
        raise FileNotFoundError(f"{root}/{from_version} is not a complete version")
    if batches_of(spark, root, to_version) is not None:
        raise ValueError("compaction writes a new version; to_version is a complete one already")
    now = []
    for run in packed_runs([batch_bytes(spark, root, b) for b in batches], target):
        if len(run) == 1:
            now.append(batches[run[0]])
            continue
        own, merged = [batches[n] for n in run], f"{to_version}-{len(now)}"
        for name, df in _read_batches(spark, root, own).items():
            stage, schema = ("source", schemas.CHART_CLEAN) if name == "clean" else ("model", CHART_MODEL[name])
            _store(spark, df.coalesce(1), path(root, merged, stage, name), schema)
        _complete(spark, root, merged, [*now, merged], newest_of(spark, root, own[-1]))
        now.append(merged)
    old = _states(spark, root, from_version, _read_batches(spark, root, batches))
    _chart_summaries(spark, root, to_version, old)
    _complete(spark, root, to_version, now, newest_of(spark, root, from_version))
    return now


def expire(spark: SparkSession, root: str, keep: list[str]) -> list[str]:
    """Delete the version folders that none of ``keep`` consists of; their names. Folders without a
    marker go too, so no refresh may be running."""
    needed = set(keep)
    for version in keep:
        batches = batches_of(spark, root, version)
        if batches is None:
            raise FileNotFoundError(f"{root}/{version} is not a complete version")
        needed |= set(batches)
    where, fs = _files(spark, root)
    gone = [s.getPath() for s in fs.listStatus(where) if s.isDirectory() and s.getPath().getName() not in needed]
    for p in gone:
        fs.delete(p, True)
    return sorted(p.getName() for p in gone)


def employees(spark: SparkSession, data: DataFrame, root: str, version: str = "v1") -> dict[str, DataFrame]:
    """Employee model (M7-M10, written in FK order) and summaries A4-A9."""
    tables = employee.build(data)
    m = {n: _store(spark, tables[n], path(root, version, "hr_model", n), schema) for n, schema in HR_MODEL.items()}
    out = {
        "performance_by_department_analysis": analyses.performance_by_department(m["employee"], m["department"]),
        "performance_by_salary_analysis": analyses.performance_by_salary(m["employee"]),
        "performance_by_tenure_analysis": analyses.performance_by_tenure(m["employee"]),
        "salary_to_department_analysis": analyses.salary_by_department(m["employee"]),
        "salary_to_tenure_analysis": analyses.salary_by_tenure(m["employee"]),
        "sales_by_performance_analysis": analyses.sales_by_performance(m["employee"], m["total_sales"]),
    }
    for name, df in out.items():
        df.write.mode("overwrite").parquet(path(root, version, "gold", name))
    return m


_LIMITS = schemas.LENGTH_LIMITS
CHART_RULES = {
    "songs": quality.Rules(key=("SongID",), limits=_LIMITS["songs"]),
    "artists": quality.Rules(key=("ArtistID",), unique=("ArtistName",), limits=_LIMITS["artists"]),
    "features": quality.Rules(
        key=("SongID", "ArtistID"),
        references={"SongID": ("songs", "SongID"), "ArtistID": ("artists", "ArtistID")},
        allowed={"Contribution": ("Primary", "Feature")},
        limits=_LIMITS["features"],
    ),
    "entries": quality.Rules(key=("EntryDate", "SongID"), references={"SongID": ("songs", "SongID")}),
    "chart": quality.Rules(limits=_LIMITS["chart"]),
}
HR_RULES = {
    "department": quality.Rules(key=("DepartmentID",), unique=("DepartmentName",), limits=_LIMITS["department"]),
    "employee": quality.Rules(
        key=("EmployeeID",), references={"Department": ("department", "DepartmentName")}, limits=_LIMITS["employee"]
    ),
    "support_ratings": quality.Rules(key=("EmployeeID",), references={"EmployeeID": ("employee", "EmployeeID")}),
    "total_sales": quality.Rules(key=("EmployeeID",), references={"EmployeeID": ("employee", "EmployeeID")}),
}


def check_chart_model(m: dict[str, DataFrame]) -> DataFrame:
    """Q1-Q5 over a stored star model: one violations table (empty = consistent)."""
    tables = {"chart" if t == "clean" else t: df for t, df in m.items()}
    return quality.violations(tables, CHART_RULES)


def check_hr_model(m: dict[str, DataFrame]) -> DataFrame:
    return quality.violations(m, HR_RULES)


def _tables(spark: SparkSession, root: str, version: str, stage: str, names: list[str]) -> dict[str, DataFrame]:
    """The stored tables of a stage; none if the stage is absent, an error if some are missing."""
    found, missing = {}, []
    for name in names:
        try:
            found[name] = spark.read.parquet(path(root, version, stage, name))
        except AnalysisException:
            missing.append(name)
    if found and missing:
        raise FileNotFoundError(f"{root}/{version}/{stage}: no table {', '.join(missing)}")
    return found


def check_stored(spark: SparkSession, root: str, version: str) -> DataFrame:
    """Q1-Q5 over the models that ``version`` holds (chart and/or employee)."""
    checks = []
    if _tables(spark, root, version, "model", list(CHART_MODEL)):
        checks.append(check_chart_model(read_chart(spark, root, version)))
    if hr := _tables(spark, root, version, "hr_model", list(HR_MODEL)):
        checks.append(check_hr_model(hr))
    if not checks:
        raise FileNotFoundError(f"no model tables under {root}/{version}")
    return quality.union_all(checks)


def store_check(spark: SparkSession, root: str, version: str) -> tuple[str, int]:
    """Write every violation of ``version`` below it; the table's path and its row count."""
    p = path(root, version, "checks", "violations")
    return p, _store(spark, check_stored(spark, root, version), p).count()
