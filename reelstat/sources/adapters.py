"""Derive the six raw activity tables from the driver's TPC-H-like tables.

The driver ships order/line-item style tables, not viewing activity, so these
adapters map them onto the domain with integer arithmetic and CASE only; the
oracle SQL in ``duck_oracle`` restates the same mapping independently.
The raw tables come out in the shape the loader meets in the wild: dates as
integer nanoseconds since epoch, one column as UTF-8 bytes, whole numbers as
doubles (some fractional) or text, text ingestion
dates (some NULL or unparsable), repeated primary keys, NULL-bearing columns.

Mapping (sizes grow with the driver scale factor):

* movies               <- part (every part is a title)
* users                <- customer
* watch_history        <- lineitem x orders; session = (order, line), repeats;
                          sessions of parts with ``p_partkey % 97 = 0`` point at
                          a title id outside the catalogue (all rows are kept)
* reviews              <- orders
* recommendation_logs  <- lineitem x orders; date offset -3..10 days from a watch
* search_logs          <- events
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat import config as C

# Fixed values used only to label the synthetic mapping.
GENRES_BY_PART_TYPE = {
    "ECONOMY": "Drama", "LARGE": "Action", "MEDIUM": "Comedy",
    "PROMO": "Documentary", "SMALL": "Horror", "STANDARD": "Romance",
}
SECONDARY_GENRES = ["Thriller", "Sci-Fi", "Family", "Crime"]
LANGUAGES = ["English", "Spanish", "Korean", "Hindi"]
ORIGIN_COUNTRIES = ["USA", "UK", "India", "South Korea"]
GENDERS = ["Female", "Male", "Other", "Prefer not to say"]
SESSION_COUNTRIES = ["USA", "Canada", "USA", "Mexico"]
SNAPSHOT_DATE = "2026-03-28"
PREVIOUS_SNAPSHOT_DATE = "2026-03-27"
NS_PER_SECOND = 1_000_000_000
NS_PER_DAY = 86_400 * NS_PER_SECOND
EPOCH_DAY_2015_01_01 = 16436
EPOCH_DAY_2018_01_01 = 17532
# Sessions of some titles carry an id this far above every catalogue id.
UNCATALOGUED_OFFSET = 1_000_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# Spark SQL expression text for the mapping
# ---------------------------------------------------------------------------
def _q(v: str) -> str:
    if "'" in v or "\\" in v:
        raise ValueError(f"unexpected quote in {v!r}")
    return f"'{v}'"


def _pick(index: str, values: list) -> str:
    """values[index mod len(values)]."""
    return f"element_at(array({', '.join(_q(v) for v in values)}), CAST(({index}) % {len(values)} + 1 AS INT))"


def _half(condition: str) -> str:
    """0.5 where the condition holds, else 0: makes a double column of whole and fractional values."""
    return f"CASE WHEN {condition} THEN 0.5D ELSE 0.0D END"


def _epoch_ns(ts_ntz: str) -> str:
    """TIMESTAMP_NTZ -> integer nanoseconds since epoch, from the wall-clock
    fields, so no session time zone is involved (casting NTZ to TIMESTAMP
    would shift by the zone's offset and DST)."""
    seconds = f"(CAST(unix_date(to_date({ts_ntz})) AS BIGINT) * 86400 + hour({ts_ntz}) * 3600 + minute({ts_ntz}) * 60)"
    micros = f"CAST(date_part('SECOND', {ts_ntz}) * 1000000 AS BIGINT)"
    return f"(({seconds} * 1000000 + {micros}) * 1000)"


def _day_text(ts_ntz: str) -> str:
    return f"CAST(to_date({ts_ntz}) AS STRING)"


def _lineage(record_set: str, source: str, ingestion: str) -> list[str]:
    return [f"{ingestion} AS {C.INGESTION_DATE}", f"{_q(record_set)} AS {C.RECORD_SET}",
            f"{_q(source)} AS {C.SOURCE}"]


def _time_of_day_ns(a: str, b: str) -> str:
    return f"((({a}) * 7919 + ({b}) * 104729) % 86400) * {NS_PER_SECOND}"


def raw_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    genre = "CASE p_type " + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in GENRES_BY_PART_TYPE.items()) + " END"
    series = "p_partkey % 5 IN (1, 3)"
    return read_table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS movie_id",
        "encode(p_name, 'UTF-8') AS title",
        f"{_pick('p_partkey', C.CONTENT_TYPES)} AS content_type",
        f"CASE WHEN p_partkey % 41 != 0 THEN {genre} END AS genre_primary",
        f"CASE WHEN p_size % 3 = 0 THEN {_pick('p_size', SECONDARY_GENRES)} END AS genre_secondary",
        f"CASE WHEN p_partkey % 89 = 0 THEN 'UNRATED' ELSE {_pick('p_partkey', C.AGE_RATINGS)} END AS rating",
        f"{_pick('p_size', LANGUAGES)} AS language",
        f"{_pick('p_partkey + p_size', ORIGIN_COUNTRIES)} AS country_of_origin",
        "CAST(1990 + p_size % 35 AS BIGINT) AS release_year",
        f"({EPOCH_DAY_2015_01_01} + (p_partkey * 37) % 3650) * {NS_PER_DAY} + (p_partkey % 86400) * {NS_PER_SECOND}"
        " AS added_to_platform",
        "CAST(20 + p_size * 3 AS DOUBLE) AS duration_minutes",
        "CASE WHEN p_partkey % 7 != 0 THEN 1.0D + (p_size % 17) / 2.0D END AS imdb_rating",
        "CASE WHEN p_partkey % 3 = 0 THEN p_retailprice * 1000 END AS production_budget",
        "CASE WHEN p_partkey % 4 = 0 THEN p_retailprice * 2500 END AS box_office_revenue",
        f"CASE WHEN {series} THEN CAST(1 + p_size % 5 AS STRING) END AS number_of_seasons",
        f"CASE WHEN {series} THEN (1 + p_size % 5) * 8 + {_half('p_partkey % 4 = 0')} END AS number_of_episodes",
        "p_partkey % 3 = 0 AS is_original",
        "p_partkey % 6 = 0 AS content_warning",
        *_lineage("movies", "tpch/part", _q(SNAPSHOT_DATE)),
    )


def raw_movies_previous_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older, narrower snapshot of every title: upper-case titles that are
    text rather than bytes, years as doubles, and without the two columns a
    later schema added."""
    new = raw_movies(spark, sf_dir)
    return (new.withColumn("title", F.upper(F.decode("title", "UTF-8")))
               .withColumn("release_year", F.col("release_year").cast("double"))
               .withColumn(C.INGESTION_DATE, F.lit(PREVIOUS_SNAPSHOT_DATE))
               .drop("content_warning", "box_office_revenue"))


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    start_ns = (f"(({EPOCH_DAY_2018_01_01} + (c_custkey * 37) % 2500) * {NS_PER_DAY}"
                f" + (c_custkey % 86400) * {NS_PER_SECOND})")
    return read_table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS user_id",
        "CASE WHEN c_custkey % 8 = 0 THEN NULL WHEN c_custkey % 50 = 1 THEN 'n/a'"
        " ELSE concat(CAST(18 + (c_custkey * 7) % 60 AS STRING), CASE WHEN c_custkey % 13 = 0 THEN '.5' ELSE '' END)"
        " END AS age",
        f"CASE WHEN c_custkey % 12 != 5 THEN {_pick('c_custkey', GENDERS)} END AS gender",
        "CASE WHEN c_nationkey % 2 = 0 THEN 'USA' ELSE 'Canada' END AS country",
        "concat('State ', CAST(c_nationkey AS STRING)) AS state_province",
        "concat('City ', CAST(c_custkey % 50 AS STRING)) AS city",
        f"CASE WHEN c_custkey % 97 = 0 THEN 'Trial' ELSE {_pick('c_custkey', C.SUBSCRIPTION_PLANS)} END"
        " AS subscription_plan",
        f"{start_ns} AS subscription_start_date",
        "CASE WHEN c_custkey % 31 != 0 THEN c_acctbal >= 0 END AS is_active",
        "CASE WHEN c_custkey % 10 != 3 THEN 7.99D + (c_custkey % 4) * 4.0D END AS monthly_spend",
        f"{_pick('c_custkey + c_nationkey', C.DEVICES)} AS primary_device",
        f"CASE WHEN c_custkey % 7 != 2 THEN 1 + c_custkey % 5 + {_half('c_custkey % 11 = 0')} END AS household_size",
        f"{start_ns} + (c_custkey % 3600) * {NS_PER_SECOND} + (c_custkey * 123457) % {NS_PER_SECOND} AS created_at",
        "concat('user', CAST(c_custkey AS STRING), '@example.com') AS email",
        "'Customer' AS first_name",
        "CAST(c_custkey AS STRING) AS last_name",
        *_lineage("users", "tpch/customer", _q(SNAPSHOT_DATE)),
    )


def _line_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey, "inner")


def raw_watch_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_orders(spark, sf_dir).selectExpr(
        "l_orderkey * 100 + l_linenumber AS session_id",
        "o_custkey AS user_id",
        f"CASE WHEN l_partkey % 97 = 0 THEN l_partkey + {UNCATALOGUED_OFFSET} ELSE l_partkey END AS movie_id",
        f"{_epoch_ns('l_shipdate')} + {_time_of_day_ns('l_orderkey', 'l_linenumber')}"
        " + (l_partkey % 1000) * 1000 + l_suppkey % 1000 AS watch_date",
        f"{_pick('l_suppkey', C.DEVICES)} AS device_type",
        f"{_pick('l_orderkey', SESSION_COUNTRIES)} AS location_country",
        # thirds, seven decimals, whole minutes and a few values of 1e15
        "CASE WHEN CAST(l_quantity AS BIGINT) % 8 = 0 THEN NULL WHEN l_orderkey % 1999 = 0 THEN 1.0E15D"
        " WHEN l_linenumber % 3 = 0 THEN l_quantity * 10.0D / 3.0D"
        " WHEN l_linenumber % 3 = 1 THEN l_quantity * 3.0D + CAST(l_partkey * 7919 % 10000000 AS DOUBLE) / 1.0E7D"
        " ELSE l_quantity * 3.0D END AS watch_duration_minutes",
        # progress 0..100 in steps of 9.9: discount x 100 rounded half up (sign * floor(|x| + 0.5)), x 9.9
        "CASE WHEN l_orderkey % 13 != 0 THEN CAST(CAST(signum(l_discount * 100) * floor(abs(l_discount * 100) + 0.5)"
        " AS BIGINT) * 10 AS DOUBLE) * 0.99D END AS progress_percentage",
        f"{_pick('l_orderkey + l_linenumber', C.WATCH_ACTIONS)} AS action",
        f"{_pick('l_partkey + l_suppkey', C.QUALITIES)} AS quality",
        "l_returnflag = 'A' AS is_download",
        "CASE WHEN l_orderkey % 5 = 0 THEN CAST(1 + l_partkey % 5 AS DOUBLE) END AS user_rating",
        *_lineage("watch_history", "tpch/lineitem",
                  "CASE WHEN l_partkey % 53 = 0 THEN NULL WHEN l_partkey % 59 = 0 THEN 'unknown'"
                  f" ELSE {_day_text('l_shipdate')} END"),
    )


def raw_recommendation_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_orders(spark, sf_dir).selectExpr(
        "l_orderkey * 100 + l_linenumber AS recommendation_id",
        "o_custkey AS user_id",
        "l_partkey AS movie_id",
        # recommended 3 days after to 10 days before the watch (ship) date
        f"{_epoch_ns('l_shipdate')} - ((l_orderkey + l_linenumber) % 14 - 3) * {NS_PER_DAY}"
        f" + {_time_of_day_ns('l_linenumber', 'l_orderkey')} AS recommendation_date",
        f"{_pick('l_suppkey', C.RECOMMENDATION_TYPES)} AS recommendation_type",
        "CASE WHEN l_orderkey % 10 != 0 THEN (l_partkey % 127) / 127.0D END AS recommendation_score",
        "(l_orderkey + l_partkey) % 3 = 0 AS was_clicked",
        "CASE WHEN l_orderkey % 37 != 0 THEN CAST(1 + l_partkey % 20 AS STRING) END AS position_in_list",
        f"{_pick('l_orderkey', C.DEVICES)} AS device_type",
        f"{_pick('l_linenumber', C.TIMES_OF_DAY)} AS time_of_day",
        "CASE WHEN l_orderkey % 20 != 0 THEN concat('v', CAST(1 + l_orderkey % 3 AS STRING)) END AS algorithm_version",
        *_lineage("recommendation_logs", "tpch/lineitem", _day_text("l_shipdate")),
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_titles = read_table(spark, sf_dir, "part").agg(F.count(F.lit(1))).scalar()
    return read_table(spark, sf_dir, "orders").withColumn("_n_titles", n_titles).selectExpr(
        "o_orderkey AS review_id",
        "o_custkey AS user_id",
        "(o_orderkey * 7) % _n_titles AS movie_id",
        "CAST(CASE WHEN o_orderkey % 89 = 0 THEN 0 WHEN o_orderkey % 97 = 0 THEN 6 WHEN o_orderkey % 101 = 0 THEN NULL"
        f" ELSE CAST(substring(o_orderpriority, 1, 1) AS BIGINT) END AS BIGINT) - {_half('o_orderkey % 7 = 0')} AS rating",
        f"{_epoch_ns('o_orderdate')} + (o_orderkey % 86400) * {NS_PER_SECOND} AS review_date",
        f"{_pick('o_orderkey', C.DEVICES)} AS device_type",
        "o_orderstatus = 'F' AS is_verified_watch",
        f"CASE WHEN o_orderkey % 9 != 0 THEN o_orderkey % 11 + {_half('o_orderkey % 17 = 0')} END AS helpful_votes",
        f"CASE WHEN o_orderkey % 9 != 0 THEN o_orderkey % 11 + o_custkey % 7 + {_half('o_orderkey % 19 = 0')} / 2 END AS total_votes",
        "CASE WHEN o_orderkey % 20 != 0 THEN concat('review of order ', CAST(o_orderkey AS STRING)) END"
        " AS review_text",
        "CASE o_orderstatus WHEN 'F' THEN 'positive' WHEN 'O' THEN 'neutral' ELSE 'negative' END AS sentiment",
        "CASE WHEN o_orderkey % 12 != 0 THEN CAST((o_orderkey % 15) - 7 AS DOUBLE) / 7 END AS sentiment_score",
        *_lineage("reviews", "tpch/orders", _q(SNAPSHOT_DATE)),
    )


def raw_search_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = "CAST(get_json_object(props, '$.k') AS BIGINT)"
    return read_table(spark, sf_dir, "events").selectExpr(
        "event_id AS search_id",
        "user_id",
        f"CASE WHEN NOT (event_type = 'signup' AND event_id % 9 = 0) THEN concat(event_type, ' ', CAST({k} AS STRING))"
        " END AS search_query",
        f"{_epoch_ns('ts')} + event_id % 1000 AS search_date",
        f"CASE WHEN {k} < 10 THEN {_half('event_id % 3 = 0')} / 2 ELSE CAST({k} AS DOUBLE) END AS results_returned",
        f"CASE WHEN event_id % 2 != 0 THEN 1 + event_id % 7 + {_half('event_id % 4 = 1')} END AS clicked_result_position",
        f"{_pick('user_id', C.DEVICES)} AS device_type",
        "CASE WHEN event_id % 20 != 0 THEN value END AS search_duration_seconds",
        "event_type = 'error' AS had_typo",
        "event_type IN ('click', 'purchase') AS used_filters",
        f"{_pick('user_id', C.COUNTRIES)} AS location_country",
        *_lineage("search_logs", "events", _day_text("ts")),
    )


RAW_ADAPTERS = {
    "movies": raw_movies,
    "users": raw_users,
    "watch_history": raw_watch_history,
    "reviews": raw_reviews,
    "recommendation_logs": raw_recommendation_logs,
    "search_logs": raw_search_logs,
}


def raw_tables(spark: SparkSession, sf_dir: str, tables=None) -> dict[str, DataFrame]:
    """The six raw tables, as lazily built DataFrames."""
    return {t: RAW_ADAPTERS[t](spark, sf_dir) for t in (tables or C.TABLES)}
