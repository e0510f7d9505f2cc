"""Registered queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

Every query starts from the driver's tables in ``sf_dir``, maps them onto the
six raw activity tables (``sources.adapters``), cleans them the way the raw
loader does (decode + keep-latest), stages them, and then builds the mart or
report. Most are lazy; the snapshot scans, the ingest, the content and user
marts, the whole build and the profile write or measure tables while the
query is built.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat import config as C
from reelstat.functions import columns as X
from reelstat.operators import distinct as DC
from reelstat.operators import profile as P
from reelstat.operators import quality as Q
from reelstat.operators.conversion import conversion_flags
from reelstat.operators.mode import exact_mode, wide_mode
from reelstat.plans import checks
from reelstat.plans import dashboard as D
from reelstat.plans import pipeline
from reelstat.plans import staging as S
from reelstat.plans.marts import content, genres, recommendations, users
from reelstat.session import ensure_checkpoint_dir, shuffles_removed, written_once
from reelstat.sources import adapters as A
from reelstat.sources import raw as R
from reelstat.sources import versions as V

# Tenure is measured to this date in registered queries so results are stable.
AS_OF = dt.date(2026, 4, 1)
# Dashboard filter values used by the registered dashboard queries: the
# app's defaults (every plan and country selected) and one date range.
DASH_PLANS = list(C.SUBSCRIPTION_PLANS)
DASH_COUNTRIES = list(C.COUNTRIES)
DASH_DATES = (dt.date(1998, 1, 1), dt.date(2000, 6, 30))
# Driver tables the profile query describes.
SAMPLED_TABLES = ["region", "nation", "part"]
PROFILE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def raw_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return R.clean_raw_table(A.RAW_ADAPTERS[table](spark, sf_dir), table)


def staged(spark: SparkSession, sf_dir: str, table: str, columns: list[str] | None = None) -> DataFrame:
    """A staged table; with ``columns`` only these, and the clean-up shuffles no more than they need. Branches of a query
    that read one table share its shuffle only if they name the same columns."""
    if columns is None:
        return S.STAGING[table](raw_table(spark, sf_dir, table))
    return S.stage_some(table, A.RAW_ADAPTERS[table](spark, sf_dir), columns,
                        lambda raw, read: R.clean_raw_table(raw, table, columns=read))


def staged_once(spark: SparkSession, sf_dir: str, table: str, columns: list[str] | None = None) -> DataFrame:
    """A staged table of which several branches of a query read ``columns``: cleaned once and written."""
    df = staged(spark, sf_dir, table)
    return written_once(df.select(*columns) if columns else df, f"staged-{table}")


def q_raw_dedup_latest(spark, sf_dir):
    return raw_table(spark, sf_dir, "watch_history")


def q_content_performance(spark, sf_dir):
    return content.content_performance(staged(spark, sf_dir, "movies", list(content.TITLE_COLUMNS.values())),
                                       staged(spark, sf_dir, "watch_history", content.WATCH_COLUMNS),
                                       staged(spark, sf_dir, "reviews", content.REVIEW_COLUMNS))


def q_content_monthly(spark, sf_dir):
    return content.watch_monthly(staged(spark, sf_dir, "watch_history", content.WATCH_COLUMNS))


def q_genre_trends(spark, sf_dir):
    return genres.genre_trends(staged(spark, sf_dir, "movies"), staged(spark, sf_dir, "watch_history"),
                               staged(spark, sf_dir, "reviews"))


def q_recommendation_flags(spark, sf_dir):
    flagged = recommendations.recommendation_flags(staged(spark, sf_dir, "recommendation_logs"),
                                                   staged(spark, sf_dir, "watch_history"))
    return flagged.select("recommendation_id", "led_to_watch", "led_to_completion")


def q_recommendation_performance(spark, sf_dir):
    return recommendations.recommendation_performance(staged(spark, sf_dir, "recommendation_logs", recommendations.REC_COLUMNS),
                                                      staged(spark, sf_dir, "watch_history", recommendations.WATCH_COLUMNS))


def q_user_mode_device(spark, sf_dir):
    return (staged(spark, sf_dir, "watch_history").groupBy("user_id")
            .agg(exact_mode("device_type").alias("preferred_device"),
                 exact_mode("quality").alias("preferred_quality")))


def user_engagement_mart(spark, sf_dir):
    return users.user_engagement(staged(spark, sf_dir, "users", users.PROFILE), staged(spark, sf_dir, "watch_history", users.WATCH_COLUMNS),
                                 staged(spark, sf_dir, "reviews", users.REVIEW_COLUMNS),
                                 staged(spark, sf_dir, "search_logs", users.SEARCH_COLUMNS),
                                 staged(spark, sf_dir, "recommendation_logs", users.REC_COLUMNS), as_of=AS_OF)


def q_user_engagement(spark, sf_dir):
    return user_engagement_mart(spark, sf_dir)


def content_mart(spark, sf_dir):
    return q_content_performance(spark, sf_dir)


def genre_mart(spark, sf_dir):
    return q_genre_trends(spark, sf_dir)


def q_kpi_summary(spark, sf_dir):
    return D.kpi_summary(user_engagement_mart(spark, sf_dir), DASH_PLANS, DASH_COUNTRIES)


def q_kpi_summary_dated(spark, sf_dir):
    return D.kpi_summary(user_engagement_mart(spark, sf_dir), ["Basic", "Premium"], ["USA"], DASH_DATES)


def q_active_users_by_month(spark, sf_dir):
    return D.active_users_by_month(user_engagement_mart(spark, sf_dir), DASH_PLANS, DASH_COUNTRIES, DASH_DATES)


def q_content_scatter(spark, sf_dir):
    return D.content_scatter(content_mart(spark, sf_dir))


def q_content_scatter_dated(spark, sf_dir):
    return D.content_scatter(content_mart(spark, sf_dir), DASH_DATES)


def q_content_mart_dated(spark, sf_dir):
    """Writes the content mart and reads the months of the dashboard's range back."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/mart-{uuid.uuid4().hex}"
    pipeline.write_mart(content_mart(spark, sf_dir), path, "watch_month", ["genre_primary"])
    return pipeline.read_mart(spark, path, "watch_month", DASH_DATES)


def q_mart_rebuild(spark, sf_dir):
    """Builds the monthly mart twice: first with all sessions, then with those that a retention rule leaves. The second
    table holds none of the first one's months."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rebuilt-{uuid.uuid4().hex}"
    watch = staged_once(spark, sf_dir, "watch_history", content.WATCH_COLUMNS)
    for sessions in (watch, watch.where(F.col("watch_date") >= F.lit(DASH_DATES[0]))):
        pipeline.write_mart(content.watch_monthly(sessions), path, "watch_month", ["movie_id"])
    return pipeline.read_mart(spark, path)


def q_catalog_tables(spark, sf_dir):
    """The monthly mart under its name in the session catalog, read for the months of the dashboard's range."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/catalog-{uuid.uuid4().hex}"
    cfg = C.BuildConfig(warehouse=root, layers={"marts": f" reel_{uuid.uuid4().hex} "})
    pipeline.write_mart(q_content_monthly(spark, sf_dir), cfg.layer_path("marts", "content_monthly"), "watch_month", ["movie_id"])
    table = spark.table(pipeline.register_table(spark, cfg, "marts", "content_monthly"))
    first, last = (F.lit(d.replace(day=1)) for d in DASH_DATES)
    return table.where(F.col(pipeline.PARTITION_COLUMN).between(first, last)).drop(pipeline.PARTITION_COLUMN)


def q_mart_ready_written(spark, sf_dir):
    """Two marts written and counted from their files' footers."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ready-{uuid.uuid4().hex}"
    watch = staged_once(spark, sf_dir, "watch_history", list(dict.fromkeys([*content.WATCH_COLUMNS, *genres.WATCH_COLUMNS])))
    pipeline.write_mart(content.watch_monthly(watch), f"{root}/content_monthly", "watch_month", ["movie_id"])
    weekly = genres.weekly_watch(watch, staged(spark, sf_dir, "movies"), reread=True)
    pipeline.write_mart(weekly, f"{root}/genre_weekly", "watch_week", ["genre_primary"])
    return Q.written_row_counts(spark, {m: V.current_path(spark, f"{root}/{m}") for m in ("content_monthly", "genre_weekly")})


def q_quarter_viewers(spark, sf_dir):
    """Distinct viewers by device of each quarter, from the bitmaps of its months, which are written as a table."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/viewers-{uuid.uuid4().hex}"
    watch = staged(spark, sf_dir, "watch_history").where(F.col("watch_date").isNotNull())
    months = DC.id_bitmaps(watch, [F.col("device_type"), X.month_start("watch_date").alias("watch_month")], "user_id")
    V.replace_table(spark, path, months.write.parquet)
    quarter = F.trunc("watch_month", "quarter").alias("watch_quarter")
    quarters = DC.merged_bitmaps(V.read_table(spark, path), [F.col("device_type"), quarter])
    return DC.distinct_counts(quarters, ["device_type", "watch_quarter"], "unique_viewers")


def q_yearly_conversions(spark, sf_dir):
    """Recommendations that led to a watch within a year."""
    watch = staged(spark, sf_dir, "watch_history").select("user_id", "movie_id", "watch_date", "is_completed")
    flagged = conversion_flags(staged(spark, sf_dir, "recommendation_logs"), watch, 365)
    return flagged.select("recommendation_id", "led_to_watch", "led_to_completion")


def q_title_top_viewer(spark, sf_dir):
    """The user with the most sessions of each title: a mode over as many values as there are users."""
    return wide_mode(staged(spark, sf_dir, "watch_history"), ["movie_id"], "user_id", "top_user")


def q_clustered_mart(spark, sf_dir):
    """The monthly mart laid out by ranges of titles, read for some of them."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/clustered-{uuid.uuid4().hex}"
    pipeline.write_mart(q_content_monthly(spark, sf_dir), path, None, ["movie_id"], by_range=True)
    return pipeline.read_mart(spark, path).where(F.col("movie_id").between(100, 150))


def q_genre_share(spark, sf_dir):
    return D.genre_share(genre_mart(spark, sf_dir))


def q_quality_report(spark, sf_dir):
    return checks.declared_report({t: raw_table(spark, sf_dir, t) for t in C.TABLES})


def q_mart_ready(spark, sf_dir):
    tables = {t: staged(spark, sf_dir, t) for t in C.TABLES}  # whole, so that the marts share the shuffles of the clean-up
    return Q.mart_row_counts({
        "mart_content_performance": content.content_performance(tables["movies"], tables["watch_history"], tables["reviews"]),
        "mart_user_engagement": users.user_engagement(tables["users"], tables["watch_history"], tables["reviews"], tables["search_logs"],
                                                      tables["recommendation_logs"], as_of=AS_OF),
        "mart_genre_trends": genres.genre_trends(tables["movies"], tables["watch_history"], tables["reviews"]),
        "mart_recommendation_performance": recommendations.recommendation_performance(tables["recommendation_logs"], tables["watch_history"]),
    })


def q_profile_columns(spark, sf_dir):
    report = P.profile_paths(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in PROFILE_TABLES])
    return report.select("file_name", "ordinal", "column_name", "rows", "columns", "null_count", "null_pct",
                         F.array_join("distinct_values", "|").alias("distinct_values"))


def q_profile_samples(spark, sf_dir):
    """The first rows of each profiled file, one row per value as text."""
    report = P.profile_paths(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in SAMPLED_TABLES])
    rows = (report.groupBy("file_name").agg(F.first("sample_rows").alias("rows"))
                  .select("file_name", F.posexplode("rows").alias("position", "json")))
    return rows.select("file_name", "position", F.explode(F.from_json("json", "map<string,string>")).alias("column_name", "value"))


def q_profile_report(spark, sf_dir):
    """Profiles all Parquet data in the folder, writes the JSON report and reads it back: one row per column."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/profile-{uuid.uuid4().hex}"
    P.write_report(P.profile_folder(spark, sf_dir), path)
    doc = F.from_json("value", "path string, rows long, columns int, schema map<string,string>, "
                               "unique_values map<string,array<string>>")
    read = spark.read.text(path).select(doc.alias("d")).select("d.*")
    return (read.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "rows", "columns", "unique_values",
                        F.explode(F.map_keys("schema")).alias("column_name"))
                .select("file_name", "rows", "columns", "column_name",
                        F.array_join(F.try_element_at("unique_values", F.col("column_name")), "|").alias("distinct_values")))


def q_genre_weekly(spark, sf_dir):
    return genres.weekly_watch(staged(spark, sf_dir, "watch_history"), staged(spark, sf_dir, "movies"))


SNAPSHOT_DAYS = (dt.date(2026, 3, 27), dt.date(2026, 3, 28))


def _write_movie_snapshots(spark, sf_dir) -> str:
    """Write the two movies snapshots (older narrow one, current one) as daily
    snapshot folders under the session's checkpoint folder; return the root."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/snapshots-{uuid.uuid4().hex}"
    old_day, new_day = SNAPSHOT_DAYS
    R.write_snapshot(A.raw_movies_previous_snapshot(spark, sf_dir), root, "movies", old_day)
    R.write_snapshot(A.raw_movies(spark, sf_dir), root, "movies", new_day)
    return root


def q_scan_parquet_snapshots(spark, sf_dir):
    root = _write_movie_snapshots(spark, sf_dir)
    tables = R.list_snapshot_tables(spark, root)
    if tables != ["movies"]:
        raise RuntimeError(f"unexpected snapshot folders {tables} under {root}")
    return R.clean_raw_table(R.read_snapshots(spark, root, "movies"), "movies")


def q_snapshot_retention(spark, sf_dir):
    root = _write_movie_snapshots(spark, sf_dir)
    return R.decode_binary_columns(R.read_snapshots(spark, root, "movies", run_date=SNAPSHOT_DAYS[1],
                                                    retention_days=1))


def q_ingest_snapshot(spark, sf_dir):
    """Ingests two record sets whose names and columns need cleaning (a third fails), reads one snapshot back."""
    def given(table):
        df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
        return df.toDF(*[f"{table}/{c.replace('_', ' ').upper()}" for c in df.columns])

    def broken():
        raise OSError("no such record set")

    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ingested-{uuid.uuid4().hex}"
    readers = {"Customer List.csv": lambda: given("customer"), "part": lambda: given("part"), "gone": broken,
               "README.md": broken}
    pipeline.ingest_snapshots(readers, root, SNAPSHOT_DAYS[1], "tables")
    if (tables := R.list_snapshot_tables(spark, root)) != ["customer_list", "part"]:
        raise RuntimeError(f"unexpected snapshot folders {tables} under {root}")
    return R.read_snapshots(spark, root, "customer_list")


def q_build_report(spark, sf_dir):
    """The whole build on snapshots of the six tables: rows written per raw table and mart, failing rows per test."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/build-{uuid.uuid4().hex}"

    def snapshot(table):
        return R.write_snapshot(A.RAW_ADAPTERS[table](spark, sf_dir), f"{root}/snapshots", table, SNAPSHOT_DAYS[1])

    with shuffles_removed(spark), ThreadPoolExecutor(max_workers=3) as pool:
        list(pool.map(snapshot, C.TABLES))
    cfg = C.BuildConfig(warehouse=f"{root}/warehouse", snapshots=f"{root}/snapshots", as_of=AS_OF)
    built = pipeline.build_all(spark, cfg, raise_on_test_failure=False, max_parallel=3)
    rows = [("raw", r.table, r.rows) for r in built.raw]
    rows += [("test", f"{r['layer']}.{r['table_name']}.{r['column_name']}.{r['test']}", r["failing_rows"])
             for r in built.quality]
    written = Q.mart_row_counts({m: pipeline.read_mart(spark, path) for m, path in built.marts.items()})
    return (spark.createDataFrame(rows, "kind string, name string, value long")
                 .unionByName(written.select(F.lit("mart").alias("kind"), F.col("mart").alias("name"),
                                             F.col("row_count").alias("value"))))


def q_raw_load_errors(spark, sf_dir):
    """The raw load of three tables, one of which has two days without a common type: what each table came to."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/load-{uuid.uuid4().hex}"
    for table in ("movies", "users", "reviews"):
        R.write_snapshot(A.RAW_ADAPTERS[table](spark, sf_dir), f"{root}/snapshots", table, SNAPSHOT_DAYS[0])
    broken = A.RAW_ADAPTERS["reviews"](spark, sf_dir).withColumn("review_date", F.lit("not a number"))
    R.write_snapshot(broken, f"{root}/snapshots", "reviews", SNAPSHOT_DAYS[1])
    reports, errors = R.load_tables(spark, C.BuildConfig(warehouse=f"{root}/warehouse", snapshots=f"{root}/snapshots"))
    return spark.createDataFrame([(r.table, r.rows, None) for r in reports] + [(t, None, why) for t, why in errors.items()],
                                 "table_name string, rows long, error string")


def q_failed_tests(spark, sf_dir):
    """The lines of the error that the failing declared tests raise."""
    try:
        Q.raise_on_failures(q_quality_report(spark, sf_dir))
    except AssertionError as failed:
        return spark.createDataFrame([(line,) for line in str(failed).splitlines()[1:]], "failure string")
    return spark.createDataFrame([], "failure string")


def q_observed_quality(spark, sf_dir):
    """The declared tests as the raw load counts them while it writes the tables."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/observed-{uuid.uuid4().hex}"

    def load(table):
        return R.write_raw_table(raw_table(spark, sf_dir, table), f"{root}/{table}", checks.rule_counters(table))

    with ThreadPoolExecutor(max_workers=3) as pool:
        reports = list(pool.map(load, C.TABLES))
    rows = checks.observed_report({r.table: r.counted for r in reports})
    return spark.createDataFrame(rows, "layer string, table_name string, column_name string, test string, failing_rows long")


def q_raw_union_by_name(spark, sf_dir):
    return R.decode_binary_columns(R.union_snapshots([A.raw_movies(spark, sf_dir),
                                                      A.raw_movies_previous_snapshot(spark, sf_dir)]))


def q_raw_snapshot_latest(spark, sf_dir):
    return R.clean_raw_table(R.union_snapshots([A.raw_movies_previous_snapshot(spark, sf_dir),
                                                A.raw_movies(spark, sf_dir)]), "movies")


def _stg(table: str):
    def run(spark, sf_dir):
        return staged(spark, sf_dir, table)
    run.__name__ = f"q_stg_{table}"
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "raw_dedup_latest": q_raw_dedup_latest,
        "raw_union_by_name": q_raw_union_by_name,
        "raw_snapshot_latest": q_raw_snapshot_latest,
        "scan_parquet_snapshots": q_scan_parquet_snapshots,
        "snapshot_retention": q_snapshot_retention,
        "ingest_snapshot": q_ingest_snapshot,
        "build_report": q_build_report,
    }
    for t in C.TABLES:
        out[f"stg_{t}"] = _stg(t)
    out.update({
        "content_monthly": q_content_monthly,
        "content_performance": q_content_performance,
        "genre_weekly": q_genre_weekly,
        "genre_trends": q_genre_trends,
        "recommendation_flags": q_recommendation_flags,
        "recommendation_performance": q_recommendation_performance,
        "user_mode_device": q_user_mode_device,
        "user_engagement": q_user_engagement,
        "kpi_summary": q_kpi_summary,
        "kpi_summary_dated": q_kpi_summary_dated,
        "active_users_by_month": q_active_users_by_month,
        "content_scatter": q_content_scatter,
        "content_scatter_dated": q_content_scatter_dated,
        "content_mart_dated": q_content_mart_dated,
        "mart_rebuild": q_mart_rebuild,
        "catalog_tables": q_catalog_tables,
        "genre_share": q_genre_share,
        "quality_report": q_quality_report,
        "observed_quality": q_observed_quality,
        "failed_tests": q_failed_tests,
        "raw_load_errors": q_raw_load_errors,
        "mart_ready": q_mart_ready,
        "mart_ready_written": q_mart_ready_written,
        "quarter_viewers": q_quarter_viewers,
        "title_top_viewer": q_title_top_viewer,
        "clustered_mart": q_clustered_mart,
        "yearly_conversions": q_yearly_conversions,
        "profile_columns": q_profile_columns,
        "profile_report": q_profile_report,
        "profile_samples": q_profile_samples,
    })
    return out
