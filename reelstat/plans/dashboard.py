"""The dashboard's four summary queries over the marts, with optional filters.

Filters are ``Column`` predicates, never spliced SQL text, so values with
quotes are matched literally. An empty (or missing) value list means no
filter; a date range filters only when both ends are given (inclusive).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.functions import columns as X
from reelstat.functions import sums


def in_filter(column: str, values: Sequence | None) -> Column:
    """``column IN values``, or no filter when ``values`` is empty."""
    return F.col(column).isin(list(values)) if values else F.lit(True)


def date_range_filter(column: str, date_range: Sequence[dt.date] | None) -> Column:
    """Inclusive ``BETWEEN`` when exactly two dates are given, else no filter."""
    if date_range is not None and len(date_range) == 2:
        start, end = date_range
        return F.col(column).between(F.lit(start), F.lit(end))
    return F.lit(True)


def user_filter(plans=None, countries=None, date_range=None) -> Column:
    return (in_filter("subscription_plan", plans) & in_filter("country", countries)
            & date_range_filter("last_watch_date", date_range))


def kpi_summary(user_mart: DataFrame, plans=None, countries=None, date_range=None) -> DataFrame:
    """One row: users, percent active, mean watch hours per user."""
    n = F.count(F.lit(1))
    return (user_mart.filter(user_filter(plans, countries, date_range))
                     .agg(n.alias("total_users"),
                          (F.try_divide(F.count_if("is_active"), n) * 100).alias("active_rate"),
                          (F.try_divide(sums.exact_sum("total_watch_minutes"), n) / 60).alias("avg_watch_hours")))


def active_users_by_month(user_mart: DataFrame, plans=None, countries=None, date_range=None) -> DataFrame:
    """Active users per month of their last watch, in month order."""
    return (user_mart.filter(F.col("is_active") & user_filter(plans, countries, date_range))
                     .groupBy(X.month_start("last_watch_date").alias("month"))
                     .agg(F.count(F.lit(1)).alias("users"))
                     .orderBy("month"))


def content_scatter(content_mart: DataFrame, date_range=None) -> DataFrame:
    """Sessions and (unweighted) mean completion percent per genre."""
    return (content_mart.filter(date_range_filter("watch_month", date_range))
                        .groupBy("genre_primary")
                        .agg(F.sum("total_sessions").alias("sessions"),
                             sums.exact_avg("completion_rate_pct").alias("completion")))


def genre_share(genre_mart: DataFrame) -> DataFrame:
    """Sessions per genre, largest first."""
    return (genre_mart.groupBy("genre_primary")
                      .agg(F.sum("sessions").alias("sessions"))
                      .orderBy(F.desc("sessions")))
