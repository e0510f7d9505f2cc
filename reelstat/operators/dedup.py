"""Keep-latest deduplication on a primary key.

Written as an aggregate, ``max(struct(order, every other column))`` per key,
rather than ``row_number()`` over a window: the aggregate combines copies on
the map side before the shuffle, so a key with millions of copies (a third
of the table, say) shrinks to one row per map task instead of landing whole
in one sort-and-rank task. Ties on the order column are broken by the other
columns in schema order, largest first, so the result is deterministic; NULL
sorts lowest, so a dated row beats an undated one. NULL keys are one group.
A reader of some columns names them: tie-breaks behind the last of them cannot
change what it gets, so they are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LATEST = "__latest"


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return False
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    return True


def keep_latest(df: DataFrame, keys: list[str], order_col: str, columns: list[str] | None = None) -> DataFrame:
    """One row per ``keys``: the one with the greatest ``order_col``.

    Order of ties: the remaining columns, compared left to right, descending,
    NULLs last. Returns ``df`` unchanged when a key is missing (the table
    has no usable key). Raises when there is a key but no order column:
    the copies could not be told apart and would inflate every count.
    With ``columns`` the rows have only these (in the order of ``df``), with the values that they have without.
    """
    wanted = [c for c in df.columns if columns is None or c in columns]
    if not keys or any(k not in df.columns for k in keys):
        return df if columns is None else df.select(*[F.col(f"`{c}`") for c in wanted])
    if order_col not in df.columns:
        raise ValueError(f"no column {order_col} to choose the latest copy of {', '.join(keys)} by")
    rest = [c for c in df.columns if c not in keys and c != order_col]
    ordered = [order_col] + rest
    if not all(_orderable(df.schema[c].dataType) for c in ordered):
        raise TypeError("keep_latest needs orderable columns; map columns cannot be tie-breaks")
    while len(ordered) > 1 and ordered[-1] not in wanted:
        ordered.pop()
    latest = F.max(F.struct(*[F.col(f"`{c}`") for c in ordered])).alias(_LATEST)
    out = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(latest)
    return out.select(*[F.col(f"`{c}`") if c in keys else F.col(_LATEST)[c].alias(c) for c in wanted])
