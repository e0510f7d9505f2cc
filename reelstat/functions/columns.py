"""Column expressions shared by staging, marts and dashboard queries.

Every helper returns a built-in Spark ``Column`` so that whole expressions stay
inside whole-stage code generation; there is no Python UDF in the library.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstat import config as C

NANOS_PER_MICRO = 1000
MICROS_PER_DAY = 86_400_000_000


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# Rounding and ratios
# ---------------------------------------------------------------------------
def round_half_up(c, digits: int) -> Column:
    """Round half away from zero: sign(x) * floor(|x| * 10^d + 0.5) / 10^d.

    Written out instead of ``F.round`` because the latter rounds the shortest
    decimal text of a double (1.005 -> 1.01) while most SQL engines round
    its binary value (1.005 -> 1.0); this formula is the same IEEE
    arithmetic everywhere, so marts are value-identical across engines.
    """
    x = col(c).cast("double")
    scale = float(10 ** digits)
    shifted = F.abs(x) * scale + 0.5
    # FLOOR gives a BIGINT; doubles beyond its range (and NaN) have no fraction to cut
    whole = F.when(shifted < float(2 ** 62), F.floor(shifted).cast("double")).otherwise(shifted)
    return F.signum(x) * whole / scale


def rate_pct(hits: Column, total: Column, digits: int) -> Column:
    """Percent of ``hits`` in ``total``, NULL when ``total`` is 0, rounded."""
    return round_half_up(F.try_divide(hits, total) * 100, digits)


def count_rate_pct(cond: Column, digits: int) -> Column:
    """Aggregate: percent of rows in the group where ``cond`` is true."""
    return rate_pct(F.count_if(cond), F.count(F.lit(1)), digits)


def to_long(c) -> Column:
    """BIGINT of a number or of integer text; fractions round half away from zero.

    A plain cast would cut fractions off. Text must be a whole number: other
    text raises. ``typeof`` is constant, so the plan keeps only one branch.
    """
    kind = F.typeof(col(c))
    fractional = kind.isin("float", "double") | kind.startswith("decimal")
    return F.when(fractional, F.round(col(c).cast("double")).cast("long")).otherwise(col(c).cast("long"))


# ---------------------------------------------------------------------------
# Dates
# ---------------------------------------------------------------------------
def ns_to_micros(c) -> Column:
    """Nanoseconds since epoch (integer) -> microseconds, rounded half away from zero.

    Goes through a double like the original loader did, so sub-microsecond
    digits round rather than truncate. ``floor(|x| + 0.5)`` is exact here
    (x is n/1000) and several times faster than ``round``, which builds a
    BigDecimal per row.
    """
    return round_half_up(col(c).cast("double") / NANOS_PER_MICRO, 0).cast("long")


def ns_to_date(c) -> Column:
    """Nanoseconds since epoch -> UTC calendar date, independent of session zone."""
    return F.date_from_unix_date(F.floor(ns_to_micros(c) / MICROS_PER_DAY).cast("int"))


def ns_to_timestamp(c) -> Column:
    """Nanoseconds since epoch -> TIMESTAMP (an instant)."""
    return F.timestamp_micros(ns_to_micros(c))


def lenient_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    """Parse text as a date; NULL instead of an error on bad text."""
    return F.try_to_date(col(c), fmt)


def month_start(c) -> Column:
    return F.trunc(col(c), "month")


def week_start(c) -> Column:
    """Monday of the week (returns DATE)."""
    return F.trunc(col(c), "week")


# ---------------------------------------------------------------------------
# Derived labels and flags (one function per business rule)
# ---------------------------------------------------------------------------
def false_if_null(cond: Column) -> Column:
    """CASE WHEN cond THEN true ELSE false: a NULL condition becomes false."""
    return F.coalesce(cond, F.lit(False))


def is_single_title(content_type) -> Column:
    return false_if_null(col(content_type).isin(C.SINGLE_TITLE_TYPES))


def plan_tier_rank(plan) -> Column:
    expr = F.lit(0)
    for rank, name in reversed(list(enumerate(C.SUBSCRIPTION_PLANS, start=1))):
        expr = F.when(col(plan) == name, F.lit(rank)).otherwise(expr)
    return expr


def age_bucket(age) -> Column:
    a = col(age)
    gen_z, millennial, gen_x, boomer, unknown = C.AGE_BUCKETS
    return (F.when(a < 25, gen_z)
             .when(a.between(25, 34), millennial)
             .when(a.between(35, 49), gen_x)
             .when(a >= 50, boomer)
             .otherwise(unknown))


def session_length_bucket(minutes) -> Column:
    m = col(minutes)
    bounce, short, medium = C.SESSION_LENGTH_MINUTES
    return (F.when(m.isNull(), "no_data")
             .when(m < bounce, "bounce")
             .when(m < short, "short")
             .when(m < medium, "medium")
             .otherwise("long"))


def is_completed(action, progress) -> Column:
    return false_if_null((col(action) == "completed") | (col(progress) >= C.COMPLETION_PROGRESS_PCT))


def helpfulness_ratio(helpful, total) -> Column:
    """Ratio of the votes as they came; NULL unless the whole number of total votes is positive."""
    return F.when(to_long(total) > 0,
                  round_half_up(F.try_divide(col(helpful).cast("double"), col(total).cast("double")), 4))


def rating_sentiment(rating) -> Column:
    r = col(rating)
    return F.when(r >= 4, "positive").when(r == 3, "neutral").otherwise("negative")


def search_outcome(results, click_position) -> Column:
    """Zero results is asked of the raw count, the top 3 of the whole position."""
    return (F.when(col(results) == 0, "zero_results")
             .when(col(click_position).isNull(), "no_click")
             .when(to_long(click_position) <= 3, "top_3_click")
             .otherwise("lower_click"))


def position_bucket(position) -> Column:
    p = col(position)
    return F.when(p <= 5, "top_5").when(p <= 10, "top_10").otherwise("below_10")


def engagement_tier(minutes) -> Column:
    m = F.coalesce(col(minutes), F.lit(0.0))
    power, regular, casual = C.ENGAGEMENT_TIER_MINUTES
    return (F.when(m >= power, "power_viewer")
             .when(m >= regular, "regular_viewer")
             .when(m >= casual, "casual_viewer")
             .when(m > 0, "light_viewer")
             .otherwise("inactive"))


def churn_risk(is_active, last_watch, dataset_last_watch) -> Column:
    """Inactive, never watched, or idle more than CHURN_DAYS before the data's end.

    A NULL ``is_active`` falls through to the date rules, as CASE does.
    """
    return (F.when(~col(is_active), True)
             .when(col(last_watch).isNull(), True)
             .when(F.date_diff(dataset_last_watch, col(last_watch)) > C.CHURN_DAYS, True)
             .otherwise(False))


def engagement_score(sessions, month_max_sessions, completion_pct, progress_pct, review_rating) -> Column:
    """Composite 0-100 score; each missing term counts 0; rounded to 2."""
    w_volume, w_completion, w_progress, w_rating = C.SCORE_WEIGHTS
    volume = col(sessions) / F.nullif(col(month_max_sessions), F.lit(0)) * w_volume
    return round_half_up(
        F.coalesce(volume, F.lit(0.0))
        + F.coalesce(col(completion_pct) / 100 * w_completion, F.lit(0.0))
        + F.coalesce(col(progress_pct) / 100 * w_progress, F.lit(0.0))
        + F.coalesce(col(review_rating) / 5.0 * w_rating, F.lit(0.0)),
        2,
    )


# ---------------------------------------------------------------------------
# Narrow rows: what is shuffled takes a fraction of the space in fewer columns
# ---------------------------------------------------------------------------
def packed(names: list[str], of: DataFrame) -> Column:
    """Columns of ``of`` as one text, which ``unpacked`` takes apart again: texts, whole numbers, booleans and dates.

    They are parted by commas and NULL is ``~``; in a text ``~`` is ``~0`` and a comma ``~1``."""
    def part(name: str) -> Column:
        value = F.col(f"`{name}`").cast("string")
        if isinstance(of.schema[name].dataType, T.StringType):
            value = F.replace(F.replace(value, F.lit("~"), F.lit("~0")), F.lit(","), F.lit("~1"))
        return F.coalesce(value, F.lit("~"))
    return F.concat_ws(",", *map(part, names))


def packable(of: DataFrame) -> list[str]:
    """The columns that ``packed`` takes."""
    kinds = (T.StringType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)
    return [f.name for f in of.schema if isinstance(f.dataType, kinds)]


def parts_of(c) -> Column:
    """The parts of a text that ``packed`` made, as it found them."""
    def value(part: Column) -> Column:
        return F.when(part != "~", F.replace(F.replace(part, F.lit("~1"), F.lit(",")), F.lit("~0"), F.lit("~")))
    return F.transform(F.split(col(c), ","), value)


def unpacked(parts: Column, names: list[str], of: DataFrame) -> list[Column]:
    """The packed columns from ``parts_of`` their text, in the types that they have in ``of``."""
    return [parts[i].cast(of.schema[name].dataType).alias(name) for i, name in enumerate(names)]


def marks(conditions: list[Column]) -> Column:
    """Up to 31 conditions as the bits of one INT; NULL is false."""
    return reduce(Column.bitwiseOR, [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(conditions)])


def marked(c, i: int) -> Column:
    """Whether the ``i``-th of the conditions is true."""
    return col(c).bitwiseAND(F.lit(1 << i)) != 0
