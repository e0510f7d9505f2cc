"""Scalar rules: dates, rounding, buckets and flags (each CASE branch and its NULL branch)."""

import datetime as dt

from pyspark.sql import functions as F

from reelstat.functions import columns as X


def one_col(spark, values, schema, expr):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr).collect()]


def test_ns_to_date_and_timestamp(spark):
    midnight = 1774656000 * 10**9                      # 2026-03-28 00:00:00 UTC
    afternoon = midnight + (12 * 3600 + 34 * 60 + 56) * 10**9 + 123456789
    last_ns = midnight + 86400 * 10**9 - 1            # rounds up to the next microsecond -> next day
    got = one_col(spark, [midnight, afternoon, None, last_ns], "v long", X.ns_to_date("v"))
    assert got == [dt.date(2026, 3, 28), dt.date(2026, 3, 28), None, dt.date(2026, 3, 29)]
    ts = one_col(spark, [afternoon], "v long", F.date_format(X.ns_to_timestamp("v"), "HH:mm:ss.SSSSSS"))
    assert ts == ["12:34:56.123457"]


def test_ns_to_date_ignores_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = one_col(spark, [1774656000 * 10**9 + 3600 * 10**9], "v long", X.ns_to_date("v"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [dt.date(2026, 3, 28)]


def test_lenient_date(spark):
    assert one_col(spark, ["2026-03-28", "bad", None], "v string", X.lenient_date("v")) == \
        [dt.date(2026, 3, 28), None, None]


def test_round_half_up_is_half_away_from_zero_on_binary_value(spark):
    got = one_col(spark, [2.5, -2.5, 1.005, 0.125, None], "v double", X.round_half_up("v", 0))
    assert got[:2] == [3.0, -3.0] and got[4] is None
    assert one_col(spark, [1.005, 0.125, -0.125], "v double", X.round_half_up("v", 2)) == [1.0, 0.13, -0.13]


def test_age_bucket(spark):
    ages = [24.0, 25.0, 34.0, 34.5, 35.0, 49.0, 50.0, None]
    got = one_col(spark, ages, "v double", X.age_bucket("v"))
    assert got == ["Gen Z (< 25)", "Millennial (25–34)", "Millennial (25–34)", "Unknown",
                   "Gen X (35–49)", "Gen X (35–49)", "Boomer+ (50+)", "Unknown"]


def test_age_text_is_lenient(spark):
    got = one_col(spark, ["41", "n/a"], "v string", F.col("v").try_cast("double"))
    assert got == [41.0, None]


def test_session_length_bucket(spark):
    got = one_col(spark, [None, 9.9, 10.0, 30.0, 90.0], "v double", X.session_length_bucket("v"))
    assert got == ["no_data", "bounce", "short", "medium", "long"]


def test_is_completed_three_valued(spark):
    df = spark.createDataFrame([("completed", None), ("stopped", 90.0), ("stopped", 89.9), (None, None)],
                               "a string, p double")
    assert [r[0] for r in df.select(X.is_completed("a", "p")).collect()] == [True, True, False, False]


def test_search_outcome_order(spark):
    df = spark.createDataFrame([(0, 2), (5, None), (5, 3), (5, 4)], "r long, p long")
    got = [r[0] for r in df.select(X.search_outcome("r", "p")).collect()]
    assert got == ["zero_results", "no_click", "top_3_click", "lower_click"]


def test_position_bucket(spark):
    got = one_col(spark, [5, 6, 10, 11, None], "v long", X.position_bucket("v"))
    assert got == ["top_5", "top_10", "top_10", "below_10", "below_10"]


def test_plan_rank_and_single_title(spark):
    assert one_col(spark, ["Basic", "Standard", "Premium", "Premium+", "Trial", None], "v string",
                   X.plan_tier_rank("v")) == [1, 2, 3, 4, 0, 0]
    assert one_col(spark, ["Movie", "TV Series", None], "v string", X.is_single_title("v")) == [True, False, False]


def test_helpfulness_and_sentiment(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (None, 5), (2, None)], "h long, t long")
    assert [r[0] for r in df.select(X.helpfulness_ratio("h", "t")).collect()] == [0.3333, None, None, None]
    assert one_col(spark, [5, 4, 3, 2, None], "v long", X.rating_sentiment("v")) == \
        ["positive", "positive", "neutral", "negative", "negative"]


def test_engagement_tier(spark):
    got = one_col(spark, [None, 0.0, 0.1, 199.9, 200.0, 1000.0, 3000.0], "v double", X.engagement_tier("v"))
    assert got == ["inactive", "inactive", "light_viewer", "light_viewer", "casual_viewer",
                   "regular_viewer", "power_viewer"]


def test_churn_risk(spark):
    end = dt.date(2026, 3, 31)
    rows = [(False, dt.date(2026, 3, 30)), (True, None), (True, dt.date(2026, 3, 1)),
            (True, dt.date(2026, 2, 28)), (None, dt.date(2026, 3, 30))]
    df = spark.createDataFrame(rows, "a boolean, d date")
    got = [r[0] for r in df.select(X.churn_risk("a", "d", F.lit(end))).collect()]
    assert got == [True, True, False, True, False]


def test_rate_pct_empty_group_and_zero(spark):
    df = spark.createDataFrame([(1, False), (1, False)], "k int, c boolean")
    assert df.groupBy("k").agg(X.count_rate_pct(F.col("c"), 1)).collect()[0][1] == 0.0
    assert df.filter("k = 2").groupBy("k").agg(X.count_rate_pct(F.col("c"), 1)).count() == 0


def test_cluster_conf_sizes_partitions_to_data():
    from reelstat.session import cluster_conf
    big = cluster_conf(100 * 10**12, executors=1000, cores_per_executor=8)
    partitions, split = int(big["spark.sql.shuffle.partitions"]), int(big["spark.sql.files.maxPartitionBytes"])
    assert partitions >= 16_000 and 0.9e9 < partitions * 100 * 10**12 / split < 1.1e9
    small = cluster_conf(10**9, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 80
