import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from hitlist import schemas
from hitlist.__main__ import main
from hitlist.plans import pipeline
from hitlist.sources import chart_rows, employee_rows
from tests.conftest import SF_SMALL, chart_frame


def test_bootstrap_then_weekly_and_employees(spark):
    root = tempfile.mkdtemp(prefix="hitlist-pipe-")
    raw = chart_rows(spark, SF_SMALL)
    newest = raw.agg(F.max("Date")).first()[0]
    v1 = pipeline.bootstrap(spark, raw.filter(F.col("Date") < newest), root, "v1")
    assert pipeline.check_chart_model(v1).count() == 0
    files = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{root}/v1/**/*", recursive=True)}
    v2 = pipeline.weekly(spark, raw, root, "v1", "v2")
    assert pipeline.check_chart_model(v2).count() == 0
    assert v2["clean"].count() == raw.count()
    assert v2["clean"].filter("is_new").count() == 0
    # a refresh appends: what v1 wrote is neither rewritten nor copied
    again = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{root}/v1/**/*", recursive=True)}
    assert again == files
    assert spark.read.parquet(pipeline.path(root, "v2", "source", "clean")).count() == raw.filter(F.col("Date") >= newest).count()
    assert sorted(map(tuple, v2["clean"].collect()), key=str) == sorted(
        map(tuple, pipeline.read_chart(spark, root, "v2")["clean"].collect()), key=str
    )
    for name, schema in {**pipeline.CHART_MODEL, "clean": schemas.CHART_CLEAN}.items():
        assert [(f.name, f.dataType) for f in v2[name].schema] == [(f.name, f.dataType) for f in schema]
    a1 = pipeline.read_summary(spark, root, "v2", "positions_and_longevity_by_debut_month").collect()
    assert [r.month_number for r in a1] == sorted(r.month_number for r in a1)
    a3 = pipeline.read_summary(spark, root, "v2", "popular_song_longevity_by_artist").collect()
    assert [r.hit_songs for r in a3] == sorted((r.hit_songs for r in a3), reverse=True)
    hr = pipeline.employees(spark, employee_rows(spark, SF_SMALL), root, "v2")
    assert pipeline.check_hr_model(hr).count() == 0
    for name, schema in pipeline.HR_MODEL.items():
        assert [(f.name, f.dataType) for f in hr[name].schema] == [(f.name, f.dataType) for f in schema]
    a6 = pipeline.read_summary(spark, root, "v2", "performance_by_tenure_analysis").collect()
    assert [r.tenure for r in a6] == ["0-5", "6-10", "11-15", "16-20", None]


def test_weekly_refuses_partial_and_existing_versions(spark):
    rows = [("2024-01-06", 1, "S", "A", "-", 1, 1)]
    root = tempfile.mkdtemp(prefix="hitlist-pipe-")
    raw = chart_frame(spark, rows)
    pipeline.bootstrap(spark, raw, root, "v1")
    with pytest.raises(ValueError):
        pipeline.weekly(spark, raw, root, "v1", "v1")
    # a version without its marker, as a refresh that stopped midway leaves it
    raw.write.parquet(pipeline.path(root, "v2", "source", "clean"))
    with pytest.raises(FileNotFoundError):
        pipeline.weekly(spark, raw, root, "v2", "v3")


def test_all_violations_are_stored_and_missing_tables_named(spark):
    root = tempfile.mkdtemp(prefix="hitlist-pipe-")
    hr = {
        "department": spark.createDataFrame([(1, "D")], schemas.DEPARTMENT),
        "employee": spark.createDataFrame([], schemas.EMPLOYEE),
        "support_ratings": spark.createDataFrame([(i, 1) for i in range(60)], schemas.SUPPORT_RATINGS),
        "total_sales": spark.createDataFrame([], schemas.TOTAL_SALES),
    }
    for name, df in hr.items():
        df.write.parquet(pipeline.path(root, "v1", "hr_model", name))
    where, n = pipeline.store_check(spark, root, "v1")
    assert n == 60 and spark.read.parquet(where).count() == 60
    assert main(["check", "--root", root, "--version", "v1"], spark) == 1
    spark.createDataFrame([(1, "S"), (1, "S")], "SongID long, SongTitle string").write.parquet(pipeline.path(root, "v1", "model", "songs"))
    with pytest.raises(FileNotFoundError, match="artists, entries, features"):
        pipeline.check_stored(spark, root, "v1")
