"""What the clean-up and the marts shuffle: no tie-break behind the columns that are read, no partial sums per user."""

import datetime as dt
import random

import pytest

from reelstat import config as C
from reelstat.operators.conversion import conversion_flags
from reelstat.operators.dedup import keep_latest
from reelstat.plans import registry, staging
from reelstat.plans.marts import content, recommendations
from reelstat.sources import adapters

SF = "/root/testdata/sf0.001"


def shuffles(df):
    """The columns below each shuffle of the plan, as text."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [(line, lines[i + 1]) for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]


def test_keep_latest_of_some_columns(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, 1, 2, 3, 4]), rng.choice([None, "a", "b"]), *[rng.choice([None, 1, 2]) for _ in range(4)]) for _ in range(400)]
    df = spark.createDataFrame(rows, "id long, day string, p int, q int, r int, s int")
    whole = keep_latest(df, ["id"], "day")
    for columns in (["id", "q"], ["q", "p"], ["id"], ["s"], ["day", "id"]):
        some = keep_latest(df, ["id"], "day", columns)
        assert some.columns == [c for c in df.columns if c in columns]
        assert sorted(some.collect(), key=str) == sorted(whole.select(*some.columns).collect(), key=str)
    [(_, below)] = shuffles(keep_latest(df, ["id"], "day", ["id", "q"]))
    assert "q#" in below and "r#" not in below and "s#" not in below
    assert keep_latest(df, ["missing"], "day", ["q", "id"]).columns == ["id", "q"]


@pytest.mark.parametrize("table", C.TABLES)
def test_each_staged_column_from_the_raw_columns_it_needs(spark, table):
    whole = registry.staged(spark, SF, table)
    raw = adapters.RAW_ADAPTERS[table](spark, SF)
    for column in whole.columns:
        assert staging.stage_some(table, raw, [column], lambda df, read: df.select(*read)).columns == [column]
    last = whole.columns[len(whole.columns) // 2:]
    assert registry.staged(spark, SF, table, last).exceptAll(whole.select(*last)).isEmpty()
    with pytest.raises(ValueError):
        registry.staged(spark, SF, table, ["missing"])


@pytest.mark.parametrize("days", [0, 1, 7, 31, 32, 61])
def test_conversion_flags_by_brute_force_for_all_widths(spark, days):
    rng, first = random.Random(days), dt.date(1969, 10, 1)
    day = lambda: rng.choice([None, *[first + dt.timedelta(rng.randrange(250))] * 9])
    recs = [(i, rng.choice([None, 1, 2]), rng.randrange(3), day()) for i in range(150)]
    watch = [(rng.choice([None, 1, 2]), rng.randrange(3), day(), rng.choice([None, True, False])) for _ in range(40)]
    r = spark.createDataFrame(recs, "recommendation_id long, user_id long, movie_id long, recommendation_date date")
    w = spark.createDataFrame(watch, "user_id long, movie_id long, watch_date date, is_completed boolean")

    def hit(rec, done):
        return any(rec[1] is not None and rec[3] and s[:2] == rec[1:3] and s[2] and 0 <= (s[2] - rec[3]).days <= days and (s[3] or not done) for s in watch)

    got = {x.recommendation_id: (x.led_to_watch, x.led_to_completion) for x in conversion_flags(r, w, days).collect()}
    assert got == {rec[0]: (hit(rec, False), hit(rec, True)) for rec in recs}


def test_a_session_counts_for_its_own_block_alone_outside_the_first_days(spark):
    watch = spark.createDataFrame([(1, 1, dt.date(1970, 1, 1) + dt.timedelta(d), True) for d in range(56)],
                                  "user_id long, movie_id long, watch_date date, is_completed boolean")
    recs = spark.createDataFrame([(1, 1, 1, dt.date(1970, 1, 5))], "recommendation_id long, user_id long, movie_id long, recommendation_date date")
    plan = conversion_flags(recs, watch, 7)._jdf.queryExecution().optimizedPlan().toString()
    assert "_w0" not in plan and "_watched" in plan  # two masks a block


def test_distinct_users_are_counted_apart_from_the_totals(spark):
    watch = spark.createDataFrame([], "user_id long, movie_id long, watch_date date, device_type string, watch_duration_minutes double, "
                                  "progress_percentage double, quality string, is_download boolean, user_rating double, is_completed boolean")
    recs = registry.staged(spark, SF, "recommendation_logs", recommendations.REC_COLUMNS)
    for df in (content.watch_monthly(watch), recommendations.recommendation_performance(recs, watch)):
        wide = [below for line, below in shuffles(df) if "user_id" in line.split("hashpartitioning")[1].split("ENSURE")[0]]
        assert all("completed" not in below and "score" not in below for below in wide if "HashAggregate" in below)


def test_distinct_users_and_titles_of_a_grain(spark):
    day = dt.date(2020, 1, 1)
    recs = spark.createDataFrame([(u, m, day, "trending", 0.5, True, 1, "TV", "night", v) for u, m, v in
                                  [(1, 1, None), (1, 2, None), (2, 2, None), (2, 2, "unknown"), (1, 1, "v1")]],
                                 "user_id long, movie_id long, recommendation_date date, recommendation_type string, recommendation_score double, "
                                 "was_clicked boolean, position_in_list long, device_type string, time_of_day string, algorithm_version string")
    watch = spark.createDataFrame([(1, 1, day, False)], "user_id long, movie_id long, watch_date date, is_completed boolean")
    rows = {r.algorithm_version: r for r in recommendations.recommendation_performance(recs, watch).collect()}
    assert {v: (r.total_recommendations, r.unique_users_targeted, r.unique_titles_recommended, r.watch_conversions)
            for v, r in rows.items()} == {"unknown": (4, 2, 2, 1), "v1": (1, 1, 1, 1)}


def test_monthly_maximum_counts_catalogued_titles_alone(spark):
    movies = registry.staged(spark, SF, "movies").where("movie_id in (1, 2)")
    watch = registry.staged(spark, SF, "watch_history", content.WATCH_COLUMNS)
    reviews = registry.staged(spark, SF, "reviews", content.REVIEW_COLUMNS)
    apart = content.content_performance(movies, watch, reviews)
    kept = content.content_performance(movies, watch, reviews, keep=lambda df, _: df)
    assert apart.exceptAll(kept).isEmpty() and apart.count() == kept.count() > 0
    assert staging.raw_columns("watch_history", ["is_completed"])[-2:] == ["action", "progress_percentage"]
