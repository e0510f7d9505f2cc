"""Mode, period-over-period, conversion flags (against brute force), quality, profile."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from reelstat.operators import profile as P
from reelstat.operators import quality as Q
from reelstat.operators.conversion import conversion_flags
from reelstat.operators.growth import period_over_period
from reelstat.operators.mode import exact_mode


def test_exact_mode_ties_and_null(spark):
    rows = [(1, "b"), (1, "a"), (1, "b"), (1, "a"),          # tie -> lowest
            (2, None), (2, None), (2, "z"),                   # NULL most frequent -> NULL
            (3, None), (3, "q"),                              # tie with NULL -> the value
            (4, "only")]
    df = spark.createDataFrame(rows, "k int, v string")
    got = {r.k: r.m for r in df.groupBy("k").agg(exact_mode("v").alias("m")).collect()}
    assert got == {1: "a", 2: None, 3: "q", 4: "only"}


def test_exact_mode_survives_sort_fallback(spark):
    rnd = random.Random(7)
    rows = [(rnd.randrange(400), rnd.choice(["A", "B", "C", None])) for _ in range(6000)]
    df = spark.createDataFrame(rows, "k int, v string").repartition(4)
    counts = {}
    for k, v in rows:
        counts.setdefault(k, {}).setdefault(v, 0)
        counts[k][v] += 1
    want = {k: min(c.items(), key=lambda kv: (-kv[1], kv[0] is None, kv[0] or ""))[0] for k, c in counts.items()}
    spark.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "2")
    try:
        got = {r.k: r.m for r in df.groupBy("k").agg(exact_mode("v").alias("m")).collect()}
    finally:
        spark.conf.unset("spark.sql.objectHashAggregate.sortBased.fallbackThreshold")
    assert got == want


def test_period_over_period_row_semantics(spark):
    w = [dt.date(2026, 1, 5), dt.date(2026, 1, 12), dt.date(2026, 1, 26), dt.date(2026, 2, 2), dt.date(2026, 2, 9)]
    rows = [("g", w[0], 10), ("g", w[1], 0), ("g", w[2], 5), ("g", w[3], 10), ("g", w[4], 4), ("h", w[0], 3)]
    df = spark.createDataFrame(rows, "genre string, week date, s long")
    out = period_over_period(df, ["genre"], "week", "s", "prev", "growth", "avg4")
    got = {(r.genre, r.week): (r.prev, r.growth, r.avg4) for r in out.collect()}
    assert got[("g", w[0])] == (None, None, 10.0)           # first row: no previous
    assert got[("g", w[1])] == (10, -100.0, 5.0)
    assert got[("g", w[2])] == (0, None, 5.0)               # previous row is week 2 (gap), zero -> NULL
    assert got[("g", w[3])] == (5, 100.0, 6.3)              # (10+0+5+10)/4 = 6.25 -> 6.3
    assert got[("g", w[4])] == (10, -60.0, 4.8)             # rows -3..0 only
    assert got[("h", w[0])] == (None, None, 3.0)


def _brute_force(recs, watch, days):
    out = {}
    for rid, u, m, d in recs:
        hits = [c for (wu, wm, wd, c) in watch
                if wu == u and wm == m and wd is not None and d is not None and d <= wd <= d + dt.timedelta(days)]
        out[rid] = (bool(hits), any(hits))
    return out


def test_conversion_flags_edges(spark):
    d = dt.date(2026, 3, 1)
    recs = [(1, 1, 1, d), (2, 2, 2, d), (3, 3, 3, d), (4, 4, 4, d), (5, 5, 5, d), (6, 6, 6, None)]
    watch = [(1, 1, d, False), (2, 2, d + dt.timedelta(7), True), (3, 3, d + dt.timedelta(8), True),
             (4, 4, d - dt.timedelta(1), True), (5, 5, d + dt.timedelta(2), False),
             (5, 5, d + dt.timedelta(2), True), (6, 6, d, True)]
    r = spark.createDataFrame(recs, "recommendation_id long, user_id long, movie_id long, recommendation_date date")
    w = spark.createDataFrame(watch, "user_id long, movie_id long, watch_date date, is_completed boolean")
    got = {x.recommendation_id: (x.led_to_watch, x.led_to_completion)
           for x in conversion_flags(r, w, 7).collect()}
    assert got == {1: (True, False), 2: (True, True), 3: (False, False), 4: (False, False),
                   5: (True, True), 6: (False, False)}
    assert conversion_flags(r, w, 7).count() == len(recs)


@pytest.mark.parametrize("days", [0, 61, 62, 63, 124, 200])
def test_conversion_flags_in_wide_windows(spark, days):
    rnd = random.Random(days)
    base = dt.date(2026, 1, 1)
    recs = [(i, rnd.randrange(3), rnd.randrange(3), base + dt.timedelta(rnd.randrange(300))) for i in range(150)]
    watch = [(rnd.randrange(3), rnd.randrange(3), base + dt.timedelta(rnd.randrange(400)), rnd.random() < 0.5) for _ in range(25)]
    r = spark.createDataFrame(recs, "recommendation_id long, user_id long, movie_id long, recommendation_date date")
    w = spark.createDataFrame(watch, "user_id long, movie_id long, watch_date date, is_completed boolean")
    flagged = conversion_flags(r, w, days)
    assert flagged.columns == [*r.columns, "led_to_watch", "led_to_completion"]
    got = {x.recommendation_id: (x.led_to_watch, x.led_to_completion) for x in flagged.collect()}
    for i, u, m, d in recs:
        hits = [c for wu, wm, wd, c in watch if (wu, wm) == (u, m) and 0 <= (wd - d).days <= days]
        assert got[i] == (bool(hits), any(hits))


def test_conversion_flags_match_brute_force(spark):
    rnd = random.Random(3)
    base = dt.date(2026, 1, 1)
    recs = [(i, rnd.randrange(5), rnd.randrange(4), base + dt.timedelta(rnd.randrange(40))) for i in range(400)]
    # one hot (user, title) pair holds a third of all sessions
    watch = [(0, 0, base + dt.timedelta(rnd.randrange(50)), rnd.random() < 0.3) for _ in range(300)]
    watch += [(rnd.randrange(5), rnd.randrange(4), base + dt.timedelta(rnd.randrange(50)), rnd.random() < 0.3)
              for _ in range(600)]
    r = spark.createDataFrame(recs, "recommendation_id long, user_id long, movie_id long, recommendation_date date")
    w = spark.createDataFrame(watch, "user_id long, movie_id long, watch_date date, is_completed boolean")
    got = {x.recommendation_id: (x.led_to_watch, x.led_to_completion) for x in conversion_flags(r, w, 7).collect()}
    assert got == _brute_force(recs, watch, 7)


def test_quality_rules_find_planted_defects(spark):
    df = spark.createDataFrame([(1, "Basic"), (None, "Gold"), (3, None)], "user_id long, plan string")
    rules = [Q.Rule("staging", "users", "user_id", Q.NOT_NULL),
             Q.Rule("staging", "users", "plan", Q.ACCEPTED_VALUES, ("Basic", "Premium"))]
    rep = {(r.column_name, r.test): r.failing_rows
           for r in Q.quality_report({("staging", "users"): df}, rules).collect()}
    assert rep == {("user_id", "not_null"): 1, ("plan", "accepted_values"): 1}   # NULL plan passes
    with pytest.raises(AssertionError, match="users.plan accepted_values: 1"):
        Q.raise_on_failures(Q.quality_report({("staging", "users"): df}, rules))
    clean = df.filter("user_id = 1")
    Q.raise_on_failures(Q.quality_report({("staging", "users"): clean}, rules))


def test_readiness(spark):
    full = spark.range(3)
    empty = spark.range(0)
    rows = {r.mart: (r.row_count, r.is_ready) for r in Q.mart_row_counts({"a": full, "b": empty}).collect()}
    assert rows == {"a": (3, True), "b": (0, False)}
    Q.check_marts_ready({"a": full})
    with pytest.raises(RuntimeError, match="b"):
        Q.check_marts_ready({"a": full, "b": empty})


def test_profile_small_file(spark, tmp_dir):
    rows = [(i, "cat" if i % 2 else None, float(i % 3), f"id-{i}") for i in range(100)]
    spark.createDataFrame(rows, "k long, c string, x double, s string").coalesce(1) \
         .write.parquet(f"{tmp_dir}/t")
    rep = {r.column_name: r for r in P.profile(spark.read.parquet(f"{tmp_dir}/t")).collect()}
    assert rep["c"].null_count == 50 and rep["c"].null_pct == 50.0
    assert rep["c"].distinct_values == ["cat"]
    assert rep["x"].distinct_values == ["0.0", "1.0", "2.0"]
    assert rep["k"].distinct_values is None and rep["s"].distinct_values is None
    assert rep["k"].rows == 100 and rep["k"].columns == 4
    assert '"k":"0"' in rep["k"].sample_row
    assert [r[:8] for r in rep["k"].sample_rows] == ['{"k":"0"', '{"k":"1"', '{"k":"2"']
    doc = P.json_report(P.profile(spark.read.parquet(f"{tmp_dir}/t"))).collect()[0].report
    assert '"unique_values":{"c":["cat"],"x":["0.0","1.0","2.0"]}' in doc


def test_profile_lists_values_up_to_the_limit_in_each_file(spark, tmp_dir):
    """30 values are listed, 31 are not, also where another file's column is unique."""
    for name, distinct in (("a", 30), ("b", 31), ("c", 400)):
        spark.range(400).selectExpr(f"id % {distinct} AS v").coalesce(1).write.parquet(f"{tmp_dir}/d/{name}")
    df = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_dir}/d")
    got = {r.file_path.split("/")[-2]: r.distinct_values for r in P.profile(df).collect()}
    assert got["a"] == [str(i) for i in range(30)] and got["b"] is None and got["c"] is None


def test_profile_folder_finds_files_in_all_folders(spark, tmp_dir):
    spark.range(3).coalesce(1).write.parquet(f"{tmp_dir}/p/table/year=2026/day=01")
    spark.range(5).coalesce(1).write.parquet(f"{tmp_dir}/p/table/year=2026/day=02")
    spark.range(2).selectExpr("id AS other").coalesce(1).write.parquet(f"{tmp_dir}/p/single")
    report = P.profile_folder(spark, f"{tmp_dir}/p")
    assert sorted((r.column_name, r.rows) for r in report.collect()) == [("id", 3), ("id", 5), ("other", 2)]
    assert spark.read.text(P.write_report(report, f"{tmp_dir}/out")).count() == 3
    spark.range(1).write.csv(f"{tmp_dir}/none/x")
    with pytest.raises(RuntimeError, match="no Parquet"):
        P.profile_folder(spark, f"{tmp_dir}/none")


def test_a_wide_window_is_one_join(spark):
    r = spark.createDataFrame([], "recommendation_id long, user_id long, movie_id long, recommendation_date date")
    w = spark.createDataFrame([], "user_id long, movie_id long, watch_date date, is_completed boolean")
    plan = conversion_flags(r, w, 365)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and conversion_flags(r, w, 365).collect() == []


def test_distinct_bitmaps_merge_to_exact_counts(spark):
    from reelstat.operators import distinct as DC

    rnd = random.Random(9)
    rows = [(rnd.randrange(3), rnd.randrange(6), rnd.choice([0, 1, 32_767, 32_768, 65_536, 10 ** 12, rnd.randrange(200_000), None])) for _ in range(4000)]
    df = spark.createDataFrame(rows, "k int, month int, id long")
    months = DC.id_bitmaps(df, [F.col("k"), F.col("month")], "id").checkpoint()

    def exact(key):
        ids = {}
        for k, m, i in rows:
            if i is not None:
                ids.setdefault(key(k, m), set()).add(i)
        return {k: len(v) for k, v in ids.items()}

    got = {(r.k, r.month): r.n for r in DC.distinct_counts(months, ["k", "month"], "n").collect()}
    assert got == exact(lambda k, m: (k, m))
    quarters = DC.merged_bitmaps(months, [F.col("k"), F.floor(F.col("month") / 3).alias("quarter")])
    assert {(r.k, r.quarter): r.n for r in DC.distinct_counts(quarters, ["k", "quarter"], "n").collect()} == exact(lambda k, m: (k, m // 3))
    with pytest.raises(Exception, match="whole numbers"):
        DC.id_bitmaps(spark.createDataFrame([(1, -5)], "k int, id long"), [F.col("k")], "id").collect()


def test_written_rows_are_counted_from_footers(spark, tmp_dir):
    from reelstat.operators import quality as Q

    path = f"{tmp_dir}/t"
    spark.range(1000).selectExpr("id", "id % 3 AS part").write.partitionBy("part").parquet(path)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    with Q.settings(spark, Q.FOOTER_COUNTS):
        plan = spark.read.parquet(path).groupBy().count()._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan
    rows = Q.written_row_counts(spark, {"m": path, "none": _empty(spark, f"{tmp_dir}/e")}).collect()
    assert [tuple(r) for r in rows] == [("m", 1000, True), ("none", 0, False)]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


def _empty(spark, path):
    spark.range(0).write.parquet(path)
    return path


def test_wide_mode_equals_plain_counts(spark):
    from collections import Counter

    from reelstat.operators.mode import wide_mode

    rnd = random.Random(4)
    rows = [(rnd.choice([0, 0, 1, 2, None]), rnd.choice([None, *range(300)]) if rnd.random() < 0.9 else 7) for _ in range(6000)]
    rows += [(9, None), (9, None), (9, 3), (8, 5), (8, 4), (8, None)]
    got = {r.k: (r.m, r.m_rows) for r in wide_mode(spark.createDataFrame(rows, "k int, v long").repartition(5), ["k"], "v", "m").collect()}
    for k in {k for k, _ in rows}:
        value, n = min(Counter(v for kk, v in rows if kk == k).items(), key=lambda x: (-x[1], x[0] is None, x[0] or 0))
        assert got[k] == (value, n)
    million = spark.range(1_000_000).selectExpr("0 AS k", "IF(id % 1000 = 0, 5, id) AS v")
    plan = wide_mode(million, ["k"], "v", "m")
    assert tuple(plan.first()) == (0, 5, 1000 + 1) and "mode(" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_profiled_values_are_not_shuffled_before_they_combine(spark, tmp_dir):
    path = f"{tmp_dir}/wide"
    spark.range(400).selectExpr("id", "id % 3 AS few", "if(id % 5 = 0, null, id % 2) AS two").repartition(2).write.parquet(path)
    df = spark.read.parquet(path)
    stats = P.file_stats(df).checkpoint()
    values = P.low_cardinality_values(df, stats, ["id", "few", "two"])
    plan = values._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    got = sorted((r.column_name, r.distinct_count, tuple(r.distinct_values)) for r in values.collect())
    assert got == [("few", 3, ("0", "1", "2"))] * 2 + [("two", 2, ("0", "1"))] * 2
