"""Delete detection.

* Absence: a key missing from the newest full snapshot is deleted as of the
  last snapshot that still listed it.  Implemented as one group-max per key
  compared with one scalar subquery -- no pairwise snapshot diff and no
  ``collect()`` of the global maximum to the driver.
* Flag: the newest change record of a key carries an explicit delete flag.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactgate.operators.latest import ColumnLike, _c, latest_by


def latest_snapshot_date(snapshots: DataFrame, date_col: str = "_file_date") -> Column:
    """Newest snapshot date as a scalar-subquery column (evaluated once, by
    a partial + final aggregate, and inlined into the consuming plan)."""
    return snapshots.agg(F.max(date_col)).scalar()


def absent_from_latest(snapshots: DataFrame, keys: Sequence[str],
                       date_col: str = "_file_date", dates: DataFrame | None = None) -> DataFrame:
    """Per key: ``last_seen_date``, ``is_hard_deleted`` (last seen before the
    newest snapshot) and ``hard_deleted_at`` (the last-seen date when deleted).
    ``dates`` is the frame the newest date is taken from (default: ``snapshots``)."""
    latest = latest_snapshot_date(snapshots if dates is None else dates, date_col)
    return (
        snapshots.groupBy(*keys)
        .agg(F.max(date_col).alias("last_seen_date"))
        .withColumn("is_hard_deleted", F.col("last_seen_date") < latest)
        .withColumn("hard_deleted_at",
                    F.when(F.col("is_hard_deleted"), F.col("last_seen_date")))
    )


def flag_deletes(changes: DataFrame, keys: Sequence[str], date_col: ColumnLike,
                 flag_col: str, order: Sequence[ColumnLike] = (),
                 flag_value: str = "Y") -> DataFrame:
    """Per key, from the newest change record (by ``date_col`` then ``order``):
    the raw flag, ``is_soft_deleted`` and ``soft_deleted_at``."""
    dated = changes.withColumn("__d", _c(date_col))
    newest = latest_by(dated, keys, ["__d", *order])
    return newest.select(
        *keys,
        F.col(flag_col).alias("soft_delete_flag"),
        F.col("__d").alias("soft_deleted_at"),
        (F.col(flag_col) == flag_value).alias("is_soft_deleted"),
    )


def complete_dates(snapshots: DataFrame, date_col: str = "_file_date", min_ratio: float = 0.5) -> DataFrame:
    """Dates of the snapshots that count as complete: with at least ``min_ratio`` of the rows
    of the largest one before.  (Windows run over one row per snapshot.)"""
    before = Window.orderBy(date_col).rowsBetween(Window.unboundedPreceding, -1)
    per_date = snapshots.where(F.col(date_col).isNotNull()).groupBy(date_col).agg(F.count(F.lit(1)).alias("__n"))
    largest = F.coalesce(F.max("__n").over(before), F.lit(0))
    return per_date.withColumn("__most", largest).where(F.col("__n") >= F.col("__most") * F.lit(min_ratio)).select(date_col)


def presence(snapshots: DataFrame, keys: Sequence[str], date_col: str = "_file_date",
             complete: DataFrame | None = None) -> DataFrame:
    """When each key was listed: ``keys, listed_from, listed_to, gone_at, back_at``, one row
    per unbroken stretch of snapshots.

    A stretch ends only where a complete snapshot (``complete``: a frame of dates, default
    :func:`complete_dates`) does not list the key: ``gone_at`` is the first such one after
    ``listed_to`` and NULL while the key is still listed; ``back_at`` is the first snapshot that
    lists it again.  A partial snapshot proves presence but no absence.  NULL keys form a group
    of their own; rows without a date are passed over.

    One aggregate per key collects its distinct dates (partially before the shuffle; as many as
    there are snapshots at most); gaps and islands are found within that list."""
    dates = complete_dates(snapshots, date_col) if complete is None else complete
    calendar = dates.agg(F.array_sort(F.collect_set(date_col))).scalar()
    listed = (snapshots.groupBy(*keys).agg(F.array_sort(F.collect_set(date_col)).alias("__d"))
              .withColumn("__c", calendar))

    def missed(a: Column, b: Column) -> Column:
        return F.exists("__c", lambda x: (x > a) & (x < b))

    starts = F.filter("__d", lambda d, i: (i == 0) | missed(F.get("__d", i - 1), d))
    ends = F.filter("__d", lambda d, i: (i == F.size("__d") - 1) | missed(d, F.get("__d", i + 1)))
    found = listed.withColumn("__s", starts).withColumn("__e", ends)
    spans = F.transform("__s", lambda s, i: F.struct(
        s.alias("listed_from"), F.get("__e", i).alias("listed_to"), F.get("__s", i + 1).alias("back_at")))
    each = found.select(*keys, "__c", F.explode(spans).alias("__p")).select(*keys, "__c", "__p.*")
    gone = F.get(F.filter("__c", lambda x: x > F.col("listed_to")), F.lit(0))
    return each.select(*keys, "listed_from", "listed_to", gone.alias("gone_at"), "back_at")
