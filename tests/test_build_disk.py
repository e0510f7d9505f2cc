"""What a build leaves and holds on disk: no shuffle or intermediate table of a finished step, narrow rows in the marts' shuffles."""

import datetime as dt
import pathlib
import random
import time
from decimal import Decimal

from reelstat import config as C
from reelstat.functions import columns as X
from reelstat.plans import pipeline, registry
from reelstat.plans.marts import content, genres, recommendations
from reelstat.session import SHUFFLE_CLEANUP, kept_meanwhile
from reelstat.sources import adapters as A
from reelstat.sources import raw as R

from .conftest import SF_SMALL


def shuffle_files(spark):
    folders = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    return {f for d in folders for f in pathlib.Path(d).rglob("shuffle_*.data")}


def test_a_build_leaves_its_tables_alone(spark, tmp_dir, monkeypatch):
    shared = pathlib.Path(tmp_dir, "shared")
    monkeypatch.setattr("reelstat.session.ensure_checkpoint_dir", lambda _: str(shared))
    for table in C.TABLES:
        R.write_snapshot(A.RAW_ADAPTERS[table](spark, SF_SMALL), f"{tmp_dir}/snapshots", table, dt.date(2026, 3, 28))
    setting, before, written = spark.conf.get(SHUFFLE_CLEANUP), shuffle_files(spark), []
    monkeypatch.setattr(pipeline, "write_mart", lambda df, *a, write=pipeline.write_mart: (
        written.append({p.name.split("-")[0] for p in shared.iterdir()} if shared.exists() else set()), write(df, *a)))
    pipeline.build_all(spark, C.BuildConfig(warehouse=f"{tmp_dir}/wh", snapshots=f"{tmp_dir}/snapshots"), raise_on_test_failure=False, max_parallel=3)
    for _ in range(100):  # they are removed in the background
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert written == [{"content"}, {"user"}, set(), {"recommendation"}]  # of the mart that is written, not of those before
    assert not list(shared.iterdir()) and spark.conf.get(SHUFFLE_CLEANUP) == setting


def test_intermediate_tables_go_when_a_mart_fails(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr("reelstat.session.ensure_checkpoint_dir", lambda _: tmp_dir)
    try:
        with kept_meanwhile() as keep:
            assert keep(spark.range(3), "some").count() == 3 and len(list(pathlib.Path(tmp_dir).iterdir())) == 1
            raise KeyError
    except KeyError:
        assert not list(pathlib.Path(tmp_dir).iterdir())


def test_packed_columns(spark):
    values = [None, "", "~", ",", "~0", "~1", "a,b~,", "~~,,", "x"]
    rows = [(a, b, c) for a in values for b in values for c in (None, True, False)]
    df = spark.createDataFrame(rows, "a string, b string, c boolean")
    kept = df.select("*", X.packed(["a", "b", "c"], df).alias("_all"))
    assert kept.select("_all").distinct().count() == len(rows)
    assert all(tuple(r[:3]) == tuple(r[3:]) for r in kept.select("a", "b", "c", *X.unpacked(X.parts_of("_all"), ["a", "b", "c"], df)).collect())
    marks = df.select(X.marks([df.c, df.a == "x"]).alias("m"), "a", "c").select(X.marked("m", 0), X.marked("m", 1), "a", "c").collect()
    assert all(r[0] == (r.c is True) and r[1] == (r.a == "x") for r in marks)


def test_a_mart_travels_packed_and_arrives_as_it_was(spark, tmp_dir, monkeypatch):
    rows = [(d, t, n, x, b, Decimal(n) if n else None, [t], None) for d in (None, dt.date(2020, 1, 31), dt.date(1969, 2, 1)) for t in (None, "", "~", "a,~0~1", " x\n")
            for n, x, b in ((None, None, None), (0, float("nan"), True), (-2 ** 63 + 1, -0.0, False), (7, 1e-300, True))]
    df = spark.createDataFrame(rows, "day date, `a.text` string, n long, x double, b boolean, m decimal(20,0), l array<string>, v string")
    plans, parquet = [], pipeline.V.replace_table
    monkeypatch.setattr(pipeline.V, "replace_table", lambda s, p, write: plans.append(write.__self__._df) or parquet(s, p, write))
    pipeline.write_mart(df, f"{tmp_dir}/mart", "day", ["`a.text`", "n"])
    kept = pipeline.read_mart(spark, f"{tmp_dir}/mart")
    assert kept.dtypes == df.dtypes and rows_of(kept) == rows_of(df)
    lines = plans[0]._jdf.queryExecution().executedPlan().toString().splitlines()
    below, = [lines[i + 1] for i, line in enumerate(lines) if "REBALANCE" in line]
    assert "concat_ws" in below


def sessions(spark, n=600):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2, 3, 4, 5]), rng.choice([1, 2, 3]), rng.choice([None, dt.date(2020, 1, 31), dt.date(2020, 2, 1)]),
             rng.choice([None, "Mobile", "Tablet", "Radio"]), rng.choice([None, 0.1, 7.3, float("nan"), 1e300]), rng.choice([None, 99.9]),
             rng.choice([None, "4K", "SD", "?"]), rng.choice([None, True, False]), rng.choice([None, 1.0]), rng.choice([None, True, False]),
             rng.choice([None, "USA", "Canada"])) for _ in range(n)]
    return spark.createDataFrame(rows, "user_id long, movie_id long, watch_date date, device_type string, watch_duration_minutes double, "
                                 "progress_percentage double, quality string, is_download boolean, user_rating double, is_completed boolean, "
                                 "location_country string")


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_months_of_titles_in_one_read(spark):
    watch = sessions(spark)
    once = rows_of(content.watch_monthly(watch, once=True))
    assert once == rows_of(content.watch_monthly(watch)) and len(once) == 6
    assert rows_of(content.watch_monthly(watch.limit(0), once=True)) == []
    assert content.watch_monthly(sessions(spark, 5), once=True).count() > 0


def test_series_of_null_and_odd_keys(spark):
    movies = spark.createDataFrame([(1, None, "Movie", True), (2, "a,~", None, None), (3, "", "", False)],
                                   "movie_id long, genre_primary string, content_type string, is_original boolean")
    watch = sessions(spark)
    rows = genres.weekly_watch(watch, movies)
    assert {tuple(r) for r in rows.select("genre_primary", "content_type", "is_original").collect()} == {(None, "Movie", True), ("a,~", None, None), ("", "", False)}
    assert rows_of(rows) == rows_of(genres.weekly_watch(watch, movies, reread=True))
    users = watch.where("movie_id = 2 and watch_date = date'2020-01-31'").agg({"user_id": "approx_count_distinct"}).first()[0]
    assert rows.where("genre_primary = 'a,~'").orderBy("watch_week").first().unique_viewers == users


def test_monthly_maximum_is_joined_without_a_shuffle_of_the_mart(spark):
    movies, watch, reviews = (registry.staged(spark, SF_SMALL, t) for t in ("movies", "watch_history", "reviews"))
    mart = content.content_performance(movies, watch, reviews, keep=lambda df, _: df.localCheckpoint())
    plan = mart._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [watch_month" in plan and "SortMergeJoin" not in plan


def test_recommendations_travel_with_one_text(spark):
    recs, watch = registry.staged(spark, SF_SMALL, "recommendation_logs"), registry.staged(spark, SF_SMALL, "watch_history")
    kept = []
    mart = recommendations.recommendation_performance(recs, watch, keep=lambda df, purpose: kept.append(purpose) or df)
    assert kept == ["recommendation-ids"]
    lines = mart._jdf.queryExecution().executedPlan().toString().splitlines()
    below = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning(user_id" in line]
    assert below and all("AS _grain#" in line for line in below)
    assert rows_of(mart) == rows_of(recommendations.recommendation_performance(recs, watch))
