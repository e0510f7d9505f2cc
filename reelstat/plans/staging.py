"""Staging: type, rename and classify each raw table (one row per source row).

Each table is a spec: the row filter (NULL keys, rating range) and the list
of output columns, both plain ``Column`` expressions over the raw table, so
the data tests can evaluate staging rules inside the same scan as the source
rules. Staging frames are lazy: marts inline them and Catalyst prunes the
columns a mart does not read. Casts are strict (ANSI; fractions round to
whole numbers), except the lenient
ones the domain asks for (``age``, text ingestion dates). Users' personal
columns are never selected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.functions import columns as X


def _ingestion_date() -> Column:
    return X.lenient_date("_ingestion_date").alias("ingestion_date")


def _not_null(*cols: str) -> Column:
    cond = F.col(cols[0]).isNotNull()
    for c in cols[1:]:
        cond = cond & F.col(c).isNotNull()
    return cond


def spec_movies() -> tuple[Column, list]:
    return _not_null("movie_id"), [
        "movie_id", "title", "content_type", "genre_primary", "genre_secondary",
        F.col("rating").alias("age_rating"), "language", "country_of_origin",
        X.to_long("release_year").alias("release_year"),
        X.ns_to_date("added_to_platform").alias("added_to_platform_date"),
        F.col("duration_minutes").cast("double").alias("duration_minutes"),
        F.col("imdb_rating").cast("double").alias("imdb_rating"),
        F.col("production_budget").cast("double").alias("production_budget"),
        F.col("box_office_revenue").cast("double").alias("box_office_revenue"),
        X.to_long("number_of_seasons").alias("number_of_seasons"),
        X.to_long("number_of_episodes").alias("number_of_episodes"),
        F.col("is_original").cast("boolean").alias("is_original"),
        F.col("content_warning").cast("boolean").alias("has_content_warning"),
        X.is_single_title("content_type").alias("is_single_title"),
        _ingestion_date(),
    ]


def spec_users() -> tuple[Column, list]:
    age = F.col("age").try_cast("double")
    return _not_null("user_id"), [
        "user_id",
        age.alias("age"),
        "gender", "country", "state_province", "city", "subscription_plan",
        X.ns_to_date("subscription_start_date").alias("subscription_start_date"),
        F.col("is_active").cast("boolean").alias("is_active"),
        F.col("monthly_spend").cast("double").alias("monthly_spend"),
        "primary_device",
        X.to_long("household_size").alias("household_size"),
        X.ns_to_timestamp("created_at").alias("created_at"),
        _ingestion_date(),
        X.plan_tier_rank("subscription_plan").alias("plan_tier_rank"),
        X.age_bucket(age).alias("age_bucket"),
    ]


def spec_watch_history() -> tuple[Column, list]:
    minutes = F.col("watch_duration_minutes").cast("double")
    progress = F.col("progress_percentage").cast("double")
    return _not_null("session_id", "user_id", "movie_id"), [
        "session_id", "user_id", "movie_id",
        X.ns_to_date("watch_date").alias("watch_date"),
        "device_type", "location_country",
        minutes.alias("watch_duration_minutes"),
        progress.alias("progress_percentage"),
        "action", "quality",
        F.col("is_download").cast("boolean").alias("is_download"),
        F.col("user_rating").cast("double").alias("user_rating"),
        X.is_completed("action", progress).alias("is_completed"),
        X.session_length_bucket(minutes).alias("session_length_bucket"),
        _ingestion_date(),
    ]


def spec_reviews() -> tuple[Column, list]:
    rating = X.to_long("rating")
    return _not_null("review_id", "user_id", "movie_id") & F.col("rating").between(1, 5), [
        "review_id", "user_id", "movie_id",
        rating.alias("rating"),
        X.ns_to_date("review_date").alias("review_date"),
        "device_type",
        F.col("is_verified_watch").cast("boolean").alias("is_verified_watch"),
        X.to_long("helpful_votes").alias("helpful_votes"),
        X.to_long("total_votes").alias("total_votes"),
        "review_text", "sentiment",
        F.col("sentiment_score").cast("double").alias("sentiment_score"),
        X.helpfulness_ratio("helpful_votes", "total_votes").alias("helpfulness_ratio"),
        X.rating_sentiment(rating).alias("rating_sentiment"),
        _ingestion_date(),
    ]


def spec_recommendation_logs() -> tuple[Column, list]:
    position = X.to_long("position_in_list")
    return _not_null("recommendation_id", "user_id", "movie_id"), [
        "recommendation_id", "user_id", "movie_id",
        X.ns_to_date("recommendation_date").alias("recommendation_date"),
        "recommendation_type",
        F.col("recommendation_score").cast("double").alias("recommendation_score"),
        F.col("was_clicked").cast("boolean").alias("was_clicked"),
        position.alias("position_in_list"),
        "device_type", "time_of_day", "algorithm_version",
        X.position_bucket(position).alias("position_bucket"),
        _ingestion_date(),
    ]


def spec_search_logs() -> tuple[Column, list]:
    position = X.to_long("clicked_result_position")
    return _not_null("search_id", "user_id"), [
        "search_id", "user_id", "search_query",
        X.ns_to_date("search_date").alias("search_date"),
        X.to_long("results_returned").alias("results_returned"),
        position.alias("clicked_result_position"),
        "device_type",
        F.col("search_duration_seconds").cast("double").alias("search_duration_seconds"),
        F.col("had_typo").cast("boolean").alias("had_typo"),
        F.col("used_filters").cast("boolean").alias("used_filters"),
        "location_country",
        position.isNotNull().alias("had_click"),
        X.search_outcome("results_returned", "clicked_result_position").alias("search_outcome"),
        _ingestion_date(),
    ]


SPECS = {
    "movies": spec_movies,
    "users": spec_users,
    "watch_history": spec_watch_history,
    "reviews": spec_reviews,
    "recommendation_logs": spec_recommendation_logs,
    "search_logs": spec_search_logs,
}


# Raw columns that each table's row filter reads, and those of staged columns with other names.
FILTER_COLUMNS = {"movies": ["movie_id"], "users": ["user_id"], "watch_history": ["session_id", "user_id", "movie_id"],
                  "reviews": ["review_id", "user_id", "movie_id", "rating"],
                  "recommendation_logs": ["recommendation_id", "user_id", "movie_id"], "search_logs": ["search_id", "user_id"]}
RAW_COLUMNS = {
    "ingestion_date": ["_ingestion_date"], "age_rating": ["rating"], "added_to_platform_date": ["added_to_platform"],
    "has_content_warning": ["content_warning"], "is_single_title": ["content_type"], "plan_tier_rank": ["subscription_plan"],
    "age_bucket": ["age"], "is_completed": ["action", "progress_percentage"], "session_length_bucket": ["watch_duration_minutes"],
    "helpfulness_ratio": ["helpful_votes", "total_votes"], "rating_sentiment": ["rating"], "position_bucket": ["position_in_list"],
    "had_click": ["clicked_result_position"], "search_outcome": ["results_returned", "clicked_result_position"],
}


def raw_columns(table: str, columns: list[str]) -> list[str]:
    """The raw columns that ``stage_some`` reads for these staged columns."""
    return list(dict.fromkeys([*FILTER_COLUMNS[table], *[r for c in columns for r in RAW_COLUMNS.get(c, [c])]]))


def stage(table: str, raw: DataFrame) -> DataFrame:
    cond, cols = SPECS[table]()
    return raw.filter(cond).select(*cols)


def stage_some(table: str, raw: DataFrame, columns: list[str], clean: Callable[[DataFrame, list[str]], DataFrame]) -> DataFrame:
    """Some staged columns of a raw table, of which ``clean`` gets the raw columns that they need."""
    cond, cols = SPECS[table]()
    names = raw.select(*cols).columns
    if unknown := set(columns) - set(names):
        raise ValueError(f"no staged columns {', '.join(sorted(unknown))} of {table}")
    return clean(raw, raw_columns(table, columns)).filter(cond).select(*[c for c, n in zip(cols, names, strict=True) if n in columns])


def _stager(table: str):
    def run(raw: DataFrame) -> DataFrame:
        return stage(table, raw)
    run.__name__ = f"stg_{table}"
    return run


STAGING = {t: _stager(t) for t in SPECS}
stg_movies, stg_users, stg_watch_history = STAGING["movies"], STAGING["users"], STAGING["watch_history"]
stg_reviews, stg_recommendation_logs = STAGING["reviews"], STAGING["recommendation_logs"]
stg_search_logs = STAGING["search_logs"]


def stage_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {t: stage(t, df) for t, df in raw.items()}
