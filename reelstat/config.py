"""Configuration: layer names, primary keys, thresholds and the fixed vocabularies.

Everything a build needs to know that is not data lives here, so the
functions elsewhere stay plain DataFrame transformations.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

# The six activity tables of the domain, in build order.
TABLES = (
    "movies",
    "users",
    "watch_history",
    "reviews",
    "recommendation_logs",
    "search_logs",
)

# Primary key per raw table: the keep-latest deduplication runs on these.
PRIMARY_KEYS: dict[str, list[str]] = {
    "movies": ["movie_id"],
    "users": ["user_id"],
    "watch_history": ["session_id"],
    "reviews": ["review_id"],
    "recommendation_logs": ["recommendation_id"],
    "search_logs": ["search_id"],
}

# Lineage columns every raw snapshot carries.
INGESTION_DATE = "_ingestion_date"
RECORD_SET = "_record_set"
SOURCE = "_source"
LINEAGE_COLUMNS = (INGESTION_DATE, RECORD_SET, SOURCE)

# Record-set names containing one of these words are not tables.
SKIP_RECORD_SET_WORDS = ("readme", "license", "changelog")

# ---------------------------------------------------------------------------
# Fixed values. These must equal the domain's accepted values and labels
# exactly, so they are written out in full and in their natural order.
# ---------------------------------------------------------------------------
CONTENT_TYPES = ["Movie", "TV Series", "Documentary", "Limited Series", "Stand-up Comedy"]
SINGLE_TITLE_TYPES = ["Movie", "Stand-up Comedy", "Documentary"]
AGE_RATINGS = ["G", "PG", "PG-13", "R", "NC-17", "TV-G", "TV-PG", "TV-14", "TV-MA", "TV-Y", "TV-Y7"]
COUNTRIES = ["USA", "Canada"]
SUBSCRIPTION_PLANS = ["Basic", "Standard", "Premium", "Premium+"]  # rank = position + 1
WATCH_ACTIONS = ["started", "paused", "stopped", "completed"]
QUALITIES = ["SD", "HD", "4K", "Ultra HD"]
DEVICES = ["Smart TV", "Mobile", "Laptop", "Desktop", "Tablet"]
SENTIMENTS = ["positive", "neutral", "negative"]
REVIEW_RATINGS = [1, 2, 3, 4, 5]
RECOMMENDATION_TYPES = ["personalized", "genre_based", "trending", "similar_users", "new_releases"]
TIMES_OF_DAY = ["morning", "afternoon", "evening", "night"]
SEARCH_OUTCOMES = ["zero_results", "no_click", "top_3_click", "lower_click"]
AGE_BUCKETS = ["Gen Z (< 25)", "Millennial (25–34)", "Gen X (35–49)", "Boomer+ (50+)", "Unknown"]
ENGAGEMENT_TIERS = ["power_viewer", "regular_viewer", "casual_viewer", "light_viewer", "inactive"]
# Engagement tier lower bounds in watch minutes (power, regular, casual; light is > 0).
ENGAGEMENT_TIER_MINUTES = (3000, 1000, 200)
# Session length bucket upper bounds in minutes (bounce, short, medium; long otherwise).
SESSION_LENGTH_MINUTES = (10, 30, 90)
COMPLETION_PROGRESS_PCT = 90
CHURN_DAYS = 30
CONVERSION_WINDOW_DAYS = 7
# Engagement score weights: volume, completion, progress, review rating.
SCORE_WEIGHTS = (35, 30, 20, 15)
# Profile: list the distinct values of columns with at most this many.
PROFILE_MAX_DISTINCT = 30
PROFILE_SAMPLE_ROWS = 3
SNAPSHOT_RETENTION_DAYS = 30

# Default layer (database) names; a custom name is used verbatim, trimmed.
DEFAULT_LAYERS = {"raw": "raw", "staging": "curated", "marts": "marts"}


def layer_name(custom: str | None, default: str) -> str:
    """Layer naming rule: a custom name verbatim (trimmed), else the default."""
    return default if custom is None else custom.strip()


@dataclass(frozen=True)
class BuildConfig:
    """Parameters of one end-to-end build.

    ``warehouse`` is the root folder every layer is written under; on a cluster
    it must be shared storage. ``as_of`` replaces "today" in tenure so that a
    rebuild is reproducible. ``column_aliases`` maps, per table, column names of
    the given snapshots to the names staging reads.
    """

    warehouse: str
    snapshots: str | None = None
    as_of: _dt.date | None = None
    retention_days: int | None = None
    layers: dict = field(default_factory=lambda: dict(DEFAULT_LAYERS))
    tables: tuple = TABLES
    column_aliases: dict = field(default_factory=dict)

    def layer_path(self, layer: str, table: str) -> str:
        db = layer_name(self.layers.get(layer), DEFAULT_LAYERS[layer])
        return f"{self.warehouse.rstrip('/')}/{db}/{table}"
