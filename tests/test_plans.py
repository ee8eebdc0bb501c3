"""Plan properties that matter at scale, checked on the small fixture."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from hitlist.operators import model
from hitlist.plans import catalog
from hitlist.sources import chart_rows
from tests.conftest import SF_SMALL

def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_week_is_one_task(spark):
    plan = _plan(chart_rows(spark, SF_SMALL))
    assert "WindowGroupLimit" not in plan
    windows = re.findall(r"Window \[.*\], \[(\w+)#\d+L?\], \[", plan)
    assert set(windows) == {"pk"}
    # every (week, part) is charted, and ranks are dense within a week
    chart = chart_rows(spark, SF_SMALL)
    assert chart.count() == 5679
    bad = chart.groupBy("Date").agg(F.max("Rank").alias("m"), F.count("*").alias("n"), F.countDistinct("Rank").alias("d"))
    assert bad.filter("m != n OR d != n").count() == 0


def test_nothing_is_stored_for_a_projection(spark):
    frames = catalog.Frames(spark, SF_SMALL)
    catalog.REGISTRY["clean_full"](frames)
    assert not {"clean", "raw_stored"} & set(frames.__dict__)


def test_stored_features_are_read_once(spark):
    plan = _plan(catalog.query("features_insert_if_absent")(spark, SF_SMALL))
    # old features twice (kept, and as known keys), new chart twice (both credits), songs, artists
    assert "lineitem" not in plan and plan.count("Scan parquet") <= 6


def test_department_means_aggregate_before_join(spark):
    df = E.queries()["performance_by_department"](spark, SF_SMALL)
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    join_at = optimized.find("Join LeftOuter")
    agg_below = optimized.find("Aggregate [Department", join_at)
    assert join_at >= 0 and agg_below > join_at


def test_references_derive_and_clean_the_chart_once(spark, monkeypatch):
    stored, kept = [], catalog.store

    def store(df, name="stage"):
        stored.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return kept(df, name)

    monkeypatch.setattr(catalog, "store", store)
    catalog.query("fk_violations")(spark, SF_SMALL)
    assert [name for name, plan in stored if "row_number()" in plan] == ["chart-raw"]
    assert [name for name, plan in stored if "regexp_replace" in plan] == ["chart-clean"]


def test_credits_are_distinct_before_they_are_taken_apart(spark):
    frames = catalog.Frames(spark, SF_SMALL)
    for df in (model.artist_names(frames.clean), model.credited(frames.clean)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Aggregate") == 2 and plan.rfind("Aggregate") > plan.rfind("Generate")
