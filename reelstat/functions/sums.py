"""Sums of doubles that do not depend on the order of rows.

A double is cut into whole parts on fixed steps of 2^22 (units of 2^22, 1,
2^-22, 2^-44 and 2^-66), each part is summed as a BIGINT, and the five sums
are put together at the end. Cutting is exact for a double of at least 2^-14 in
size (smaller ones are rounded off below 2^-66, about 1.4e-20); so is summing,
up to 2^41 rows a group. The total is one double, the true sum but for the
rounding of its last bit (of the last bit of 1 where a negative sum is smaller than 1),
and has the same bits for any order or partitioning of the rows.

Values of 2^62 and more, infinities and NaN have no such parts. They are
summed as doubles beside the others (a NaN makes the sum NaN) and that
sum is added at the end. NULLs do not count; the sum of no value is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

#: Names of the partial sums of one value, as ``partial_sums`` gives them.
PARTS = ("p22", "p0", "m22", "m44", "m66", "beyond", "values")
_STEP = float(2 ** 22)
_BITS = 22
_LIMIT = float(2 ** 62)


def _cut(x: Column) -> list[Column]:
    """The whole parts of a double below the limit, highest first, all of its sign. Each step is exact, as only leading
    bits go."""
    size, sign = F.abs(x), F.signum(x).cast("long")
    high, whole = F.floor(size / _STEP), F.floor(size)
    parts = [high, whole - high * (1 << _BITS)]
    rest = size - whole.cast("double")
    for _ in range(2):
        rest = rest * _STEP
        parts.append(F.floor(rest))
        rest = rest - F.floor(rest).cast("double")
    parts.append(F.floor(rest * _STEP + 0.5))
    return [p * sign for p in parts]


def partial_sums(c) -> dict[str, Column]:
    """Aggregates by name, which ``merged_sums`` adds up and ``total`` puts together."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    inside = F.abs(x) < _LIMIT  # false for NaN and infinities
    sums = [F.sum(F.when(inside, p)) for p in _cut(x)]
    return dict(zip(PARTS, [*sums, F.sum(F.when(~inside, x)), F.count(x)], strict=True))


def merged_sums(columns: dict[str, str]) -> dict[str, Column]:
    """Aggregates by name over rows of partial sums; ``columns``: their column names."""
    return {part: F.sum(name) for part, name in columns.items()}


def total(parts: dict[str, Column]) -> Column:
    """The sum as a double; NULL where no value was summed. Carries make every part but the highest 0 to 2^22 - 1."""
    high, one, *below = (F.coalesce(parts[p], F.lit(0).cast("long")) for p in PARTS[:5])
    carry = F.lit(0).cast("long")
    digits = []
    for part in reversed(below):
        digits.append(F.pmod(part + carry, F.lit(1 << _BITS)))
        carry = F.shiftright(part + carry, _BITS)
    m66, m44, m22 = digits
    fraction = (m22 * (1 << _BITS) + m44).cast("double") / float(2 ** 44) + m66.cast("double") / float(2 ** 66)
    inside = high.cast("double") * _STEP + (one + carry).cast("double") + fraction
    return F.when(parts["values"] > 0, F.coalesce(parts["beyond"], F.lit(0.0)) + inside)


def aggregated(grouped: GroupedData, aggregates: list[Column], summed: dict[str, Column | str]) -> DataFrame:
    """The grouping's rows with ``aggregates`` and what ``sum_of`` and ``mean_of`` read of each of the ``summed`` columns.

    The totals are put together in a projection of their own: inside the aggregate every use of
    one would repeat the whole expression of its parts.
    """
    parts = {(name, p): c for name, column in summed.items() for p, c in partial_sums(column).items()}
    rows = grouped.agg(*aggregates, *[c.alias(f"_{name}_{p}") for (name, p), c in parts.items()])
    others = [c for c in rows.columns if c not in {f"_{name}_{p}" for name, p in parts}]
    return rows.select(*others, *[total({p: F.col(f"_{name}_{p}") for p in PARTS}).alias(f"_{name}_sum") for name in summed],
                       *[F.col(f"_{name}_values").alias(f"_{name}_n") for name in summed])


def sum_of(name: str) -> Column:
    return F.col(f"_{name}_sum")


def mean_of(name: str) -> Column:
    """NULL where there is no value."""
    return F.try_divide(F.col(f"_{name}_sum"), F.col(f"_{name}_n"))


def exact_sum(c) -> Column:
    """Aggregate: sum of a numeric column, the same for any order of rows."""
    return total(partial_sums(c))


def exact_avg(c) -> Column:
    """Aggregate: ``exact_sum`` over the number of values; NULL where there is none."""
    parts = partial_sums(c)
    return F.try_divide(total(parts), parts["values"])
