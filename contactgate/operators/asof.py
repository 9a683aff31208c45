"""What held on a given day: validity intervals and bulk as-of answers.

A history has records with a key, a date and a rank (a struct that orders records, its
greatest one holds).  What holds for a key on a day is the record of greatest rank among
those dated no later.  That is a running maximum along the key's history, and a
maximum splits: into the greatest record of all earlier periods (months, say) and the running
maximum within the day's own period.  So no window runs along a whole history:

1. records are reduced to the greatest one of a key and day before any shuffle of
   whole groups (partial aggregation, so a key with a third of all records sends one row a
   task and day),
2. windows over (key, period) give the running maximum within a period,
3. one row per (key, period) carries the maximum of the periods before.

Records without a date take no part.  NULL keys form a group of their own in a history, and
match no request.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERIOD = "month"


def _days(history: DataFrame, keys: Sequence[str], when: str, rank: Column, values: Sequence[str], period: str) -> DataFrame:
    """``keys, __day, __period, __held``: the greatest record of each key and day."""
    held = F.struct(rank.alias("rank"), F.struct(*[F.col(v) for v in values]).alias("values"))
    return (history.where(F.col(when).isNotNull())
            .groupBy(*keys, F.col(when).cast("date").alias("__day")).agg(F.max(held).alias("__held"))
            .withColumn("__period", F.trunc("__day", period)))


def _carried(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, __period, __before``: the greatest record of the key's earlier periods."""
    earlier = Window.partitionBy(*keys).orderBy("__period").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.groupBy(*keys, "__period").agg(F.max("__held").alias("__most"))
            .select(*keys, "__period", F.max("__most").over(earlier).alias("__before")))


def _joined(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``a`` with the columns of ``b`` for its key (NULL meets NULL) and period."""
    names = [*keys, "__period"]
    right = b.select(*[F.col(c).alias(f"__r{i}") for i, c in enumerate(names)], *[c for c in b.columns if c not in names])
    on = F.lit(True)
    for i, c in enumerate(names):
        on = on & F.col(c).eqNullSafe(F.col(f"__r{i}"))
    return a.join(right, on).drop(*[f"__r{i}" for i in range(len(names))])


def as_of(requests: DataFrame, history: DataFrame, keys: Sequence[str], at: str, when: str, rank: Column,
          values: Sequence[str], period: str = PERIOD) -> DataFrame:
    """Each request row with ``values`` as they held for its key on its day ``at`` (NULL if
    nothing did, or the day or the key is NULL).

    Each distinct (key, day) asked for is answered once and joined back to the requests, two
    plain shuffles, so a key asked for by a third of all requests can be split at run time.
    ``period`` is a unit of ``trunc``: year, quarter, month or week."""
    keys = list(keys)
    days = _days(history, keys, when, rank, values, period)
    asked = (requests.select(*keys, F.col(at).cast("date").alias("__day")).distinct()
             .where(F.col("__day").isNotNull())
             .withColumn("__held", F.lit(None).cast(days.schema["__held"].dataType))
             .withColumn("__period", F.trunc("__day", period)))
    rows = days.withColumn("__asked", F.lit(False)).unionByName(asked.withColumn("__asked", F.lit(True)))
    # a request comes after the records of its own day
    along = Window.partitionBy(*keys, "__period").orderBy("__day", "__asked").rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumn("__inside", F.max("__held").over(along)).where("__asked").drop("__held", "__asked")
    answers = _joined(inside, _carried(rows, keys), keys).withColumn("__held", F.greatest("__inside", "__before"))
    answers = answers.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__day").alias("__at"),
                             F.col("__held.values").alias("__values"))
    on = F.col(at).cast("date") == F.col("__at")
    for i, k in enumerate(keys):
        on = on & (F.col(k) == F.col(f"__k{i}"))
    return requests.join(answers, on, "left").select(*requests.columns, *[F.col(f"__values.{v}").alias(v) for v in values])


def validity(history: DataFrame, keys: Sequence[str], when: str, rank: Column, values: Sequence[str],
             period: str = PERIOD) -> DataFrame:
    """``keys, values, valid_from, valid_to``: the intervals in which a record held for its
    key.  ``valid_to`` is the day the next one began to hold (exclusive), NULL if none did; a
    record that a day's later one displaced, or that never held, has no interval."""
    keys = list(keys)
    days = _days(history, keys, when, rank, values, period)
    inside = Window.partitionBy(*keys, "__period").orderBy("__day")
    now = (_joined(days.withColumn("__inside", F.max("__held").over(inside)), _carried(days, keys), keys)
           .withColumn("__now", F.greatest("__inside", "__before")))
    # a day's record begins to hold if nothing held before, or something smaller did
    previous = F.greatest(F.lag("__inside").over(inside), F.col("__before"))
    begins = (now.withColumn("__previous", previous)
              .where(F.col("__previous").isNull() | (F.col("__previous") < F.col("__now")))
              .select(*keys, "__period", "__day", "__now"))
    later = Window.partitionBy(*keys).orderBy("__period")
    after = (begins.groupBy(*keys, "__period").agg(F.min("__day").alias("__first"))
             .select(*keys, "__period", F.lead("__first").over(later).alias("__after")))
    ended = _joined(begins.withColumn("__next", F.lead("__day").over(inside)), after, keys)
    return ended.select(*keys, *[F.col(f"__now.values.{v}").alias(v) for v in values], F.col("__day").alias("valid_from"),
                        F.coalesce("__next", "__after").alias("valid_to"))
