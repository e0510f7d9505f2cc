"""Plan shape of every registered query: JVM-side only, no cross joins, pruned scans."""

import re
import threading

import pytest

import __spark_entry__ as E
from reelstat.plans import dashboard as D
from reelstat.plans import pipeline, registry
from reelstat.plans import staging as S
from reelstat.plans.marts import content, users
from reelstat.session import written_once
from reelstat.sources import raw

from .conftest import SF_SMALL

FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas",
             "CartesianProduct", "BroadcastNestedLoopJoin", "Window ["]


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_plan_has_no_python_or_cross_join(spark, name):
    plan = physical_plan(E.queries()[name](spark, SF_SMALL))
    found = [op for op in FORBIDDEN if op in plan]
    if name in ("genre_trends",):
        # the week-over-week metrics are the one window, over the small weekly series
        found = [op for op in found if op != "Window ["]
    assert not found, f"{name}: {found}"


def test_genre_trends_uses_one_window_for_three_metrics(spark):
    plan = physical_plan(E.queries()["genre_trends"](spark, SF_SMALL))
    assert plan.count("Window [") == 1


def test_scans_read_only_needed_columns(spark):
    plan = physical_plan(E.queries()["kpi_summary"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    customer = [s for s in schemas if "c_custkey" in s]
    assert customer and all("c_name" not in s and "c_mktsegment" not in s for s in customer)


def test_conversion_joins_the_recommendations_once(spark):
    """The one expansion is the two blocks a session counts for, below its map-side combine."""
    plan = physical_plan(E.queries()["recommendation_flags"](spark, SF_SMALL))
    assert plan.count("Generate inline") == 1 and "BroadcastNestedLoopJoin" not in plan
    assert len(re.findall(r"(?:SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin) \[[^]]*\], \[[^]]*\], LeftOuter", plan)) == 1


def test_dated_mart_read_opens_only_its_months(spark):
    plan = physical_plan(registry.q_content_mart_dated(spark, SF_SMALL))
    assert re.search(r"PartitionFilters: \[isnotnull\(partition_month", plan)


def written_staging(spark, tmp_path, *names):
    """Staging over written raw tables, as in a production build: no exchange of the adapters to reuse."""
    frames = []
    for name in names:
        path = str(tmp_path / name)
        registry.raw_table(spark, SF_SMALL, name).write.parquet(path)
        frames.append(S.STAGING[name](spark.read.parquet(path)))
    return frames


def scans_of(df, name) -> int:
    """Scans of one written table in the plan, with paths in full."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        return len(re.findall(rf"FileScan parquet [^\n]*/{name}\]", physical_plan(df.select("*"))))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_content_mart_reads_sessions_once(spark, tmp_path):
    plans = []
    keep = lambda df, purpose: plans.append(df) or written_once(df, purpose)
    movies, watch, reviews = written_staging(spark, tmp_path, "movies", "watch_history", "reviews")
    mart = content.content_performance(movies, watch, reviews, keep=keep)
    assert [scans_of(plans[0], t) for t in ("movies", "watch_history", "reviews")] == [1, 1, 1]
    assert scans_of(mart, "watch_history") == 0 and mart.count() > 0


def test_user_mart_reads_sessions_twice_at_most(spark, tmp_path):
    plans = []
    keep = lambda df, purpose: plans.append(df) or written_once(df, purpose)
    frames = written_staging(spark, tmp_path, "users", "watch_history", "reviews", "search_logs", "recommendation_logs")
    mart = users.user_engagement(*frames, as_of=registry.AS_OF, keep=keep)
    assert scans_of(plans[0], "watch_history") == 2 and scans_of(mart, "watch_history") == 0


def test_recommendation_mart_does_not_expand_rows(spark):
    assert "Expand" not in physical_plan(E.queries()["recommendation_performance"](spark, SF_SMALL))


def test_dashboard_queries_compute_only_their_columns(spark, tmp_path):
    """Lazy marts: no mode, no distinct count and no other activity for the user figures."""
    frames = written_staging(spark, tmp_path, "users", "watch_history", "reviews", "search_logs", "recommendation_logs")
    mart = users.user_engagement(*frames, as_of=registry.AS_OF)
    figures = D.kpi_summary(mart, registry.DASH_PLANS, registry.DASH_COUNTRIES)
    plan = figures._jdf.queryExecution().optimizedPlan().toString()
    assert "mode(" not in plan and "Generate" not in plan
    assert [scans_of(figures, t) for t in ("reviews", "search_logs", "recommendation_logs")] == [0, 0, 0]
    assert scans_of(figures, "watch_history") == 1


def test_queries_of_two_marts_clean_the_sessions_once(spark, monkeypatch):
    for query in (registry.q_mart_rebuild, registry.q_mart_ready_written):
        files, write = [], pipeline.write_mart
        monkeypatch.setattr(pipeline, "write_mart", lambda df, *a: files.append(df.inputFiles()) or write(df, *a))  # noqa: B023
        query(spark, SF_SMALL)
        monkeypatch.undo()
        assert len(files) == 2 and not any("lineitem" in f for some in files for f in some)


def test_tables_are_loaded_at_the_same_time(spark, monkeypatch):
    both = threading.Barrier(2, timeout=60)

    def load(df, path, counters):
        both.wait()
        return raw.LoadReport(path.split("/")[-1], 0, 0, path, dict.fromkeys(counters, 0))

    monkeypatch.setattr(raw, "write_raw_table", load)
    assert registry.q_observed_quality(spark, SF_SMALL).count() == 52
