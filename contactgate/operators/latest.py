"""Latest-record selection ("one row per key, chosen by an order").

The default plan is a single hash-partitioned aggregate,
``groupBy(keys).agg(max_by(row, order))``.  Unlike ``row_number() = 1`` over a
window it aggregates partially before the shuffle, so a key that holds a third
of all rows still sends one row per map task, never the whole group to one
sorter.  The window form is kept for comparison and for callers that need it.

Ordering semantics (identical in both forms): ``order`` is compared as a tuple,
left to right, and a NULL component is the smallest value.  ``newest=True``
keeps the greatest tuple (SQL ``DESC NULLS LAST``); ``newest=False`` keeps the
smallest (``ASC NULLS FIRST``).  Give a total order -- append a unique column
-- and the result is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ColumnLike = str | Column


def _c(c: ColumnLike) -> Column:
    """A column name, a SQL expression string, or a Column."""
    if isinstance(c, str):
        return F.col(c) if c.isidentifier() else F.expr(c)
    return c


def order_key(order: Sequence[ColumnLike]) -> Column:
    """A struct that orders lexicographically by ``order`` (NULL smallest)."""
    return F.struct(*[_c(o).alias(f"o{i}") for i, o in enumerate(order)])


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnLike],
              newest: bool = True, method: str = "aggregate") -> DataFrame:
    """One row per ``keys`` group: the row with the greatest (``newest``) or
    smallest ``order`` tuple.  Keeps every input column, in input order.

    NULL keys form their own group, as in SQL GROUP BY / PARTITION BY.
    """
    keys = list(keys)
    if method == "window":
        direction = [(_c(o).desc() if newest else _c(o).asc()) for o in order]
        w = Window.partitionBy(*keys).orderBy(*direction)
        return (df.withColumn("__rn", F.row_number().over(w))
                .where(F.col("__rn") == 1).drop("__rn"))
    if method != "aggregate":
        raise ValueError(f"unknown method {method!r}")
    cols = df.columns
    payload = F.struct(*[F.col(f"`{c}`") for c in cols])
    pick = F.max_by if newest else F.min_by
    return (df.groupBy(*keys)
            .agg(pick(payload, order_key(order)).alias("__w"))
            .select(*[F.col(f"__w.`{c}`").alias(c) for c in cols]))


def dedup_by(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnLike],
             method: str = "aggregate") -> DataFrame:
    """Keep the first row (smallest ``order``) of each ``keys`` group."""
    return latest_by(df, keys, order, newest=False, method=method)
