"""Mix sources to target weights: weighted fair queueing over shuffled documents.

Every document of a source waits in that source's queue, in a fixed shuffled
order.  A document's virtual finish time is the words its queue has served up
to and including it, divided by the source's target, so every queue reaches
its target at time one.  All documents are then range-sorted by finish time
over the whole corpus, and the mix stops at the total budget.  A queue may be
served up to ``max_repeats`` times over (later rounds start where the earlier one
ended), which is how a small source reaches a target above its own size.

Only DataFrame functions run here.  Two running sums are needed, one along each
queue and one along the global order; neither is a single window: a queue is
cut into range partitions of its shuffled order, the global order into those of the
sort, and a running sum over the totals of the parts supplies each part's start.
With a number of parts near sqrt(rows) both the parts and the list of totals stay
near sqrt(rows), however large one source is and however many rows share an id.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialized

DEFAULT_WEIGHTS = (1, 2, 3)


def word_count(text: str) -> Column:
    """Words of a text column; null texts have none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights=DEFAULT_WEIGHTS, max_repeats: int = 3) -> DataFrame:
    """One row per source: ``source, source_size, target``.

    ``sized`` has ``source`` and ``size``.  Sources in code point order, null last,
    weigh ``weights`` in turn and share the sum of all sizes; a target stops at
    ``max_repeats`` times its source's size and the excess is shared again by
    weight.  That ends where ``min(cap, level * weight)`` sums to the total, and
    the capped sources are those with the smallest cap per weight, so one
    running sum over the sources in that order finds the level.  The table has
    one row per source, which its windows (one task) assume to be a list that
    weights can be assigned to."""
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = per_source.select(
        "source", "source_size",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                     (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
                     % F.lit(len(weights)) + 1).alias("w"),
        (F.col("source_size") * max_repeats).alias("cap"))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = ranked.select(
        "source", "source_size", "w", "cap",
        # the level if this and all later sources are uncapped
        ((F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
         / F.sum("w").over(after)).alias("level"))
    # the first source whose cap is above its share at that level ends the capped prefix
    return levels.select(
        "source", "source_size", "w", "cap",
        F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "level")))
        .over(whole)["level"].alias("level"),
    ).select("source", "source_size",
             F.least(F.col("cap").cast("double"), F.col("level") * F.col("w")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights=DEFAULT_WEIGHTS, max_repeats: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken``
    and the columns named in ``carry``, if any, as the struct ``carried``.

    ``copies`` (0 to ``max_repeats``) says how often the mix takes the document and
    ``taken = copies * size``.  The copy that would pass the total budget and all
    later ones are left out.  The shuffled order is the md5 of the id, then a hash of
    the text, so reruns agree.

    Null texts have size 0 and are never counted; null sources form a source of
    their own; a null id sorts as the empty string; rows that repeat an id are
    separate documents (ordered among themselves by a hash of the text, size and
    ``carried``, which leaves equal ones interchangeable); an empty table gives no rows; other columns are
    not read.
    """
    kept = ["carried"] if carry else []
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    sized = materialized(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                     word_count(text_col).alias("size"), key.alias("key"), F.xxhash64(text_col).alias("tie"),
                                     *[F.struct(*[F.col(f"`{c}`") for c in carry]).alias(c) for c in kept]))
    rows = sized.count()
    targets = materialized(source_targets(sized, weights, max_repeats))

    # running words along each queue: inside a bucket, plus the buckets before it; rows that
    # share an id are told apart by their texts, so they too are cut into buckets
    along = ["key", "doc_id", "tie", "size", *kept]
    buckets = max(1, math.isqrt(rows) // 8)
    queues = materialized(sized.repartitionByRange(buckets, F.col("source").asc_nulls_last(), *along[:4])
                          .withColumn("bucket", F.spark_partition_id()))
    inside = Window.partitionBy("source", "bucket").orderBy(*along)
    queued = queues.select("*", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("run"),
                           F.row_number().over(inside).alias("rn"))
    starts = (queues.groupBy("source", "bucket").agg(F.sum("size").alias("total"))
              .select("source", "bucket",
                      F.coalesce(F.sum("total").over(
                          Window.partitionBy("source").orderBy("bucket")
                          .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start")))
    starts = starts.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    q, s = queued.alias("q"), starts.alias("s")
    served = materialized(
        q.join(s, F.col("q.source").eqNullSafe(F.col("s.source")) & (F.col("q.bucket") == F.col("s.bucket")))
        .select("q.doc_id", "q.source", "q.bucket", "q.rn", "q.size", "q.key", "q.tie", "s.source_size", "s.target",
                (F.col("s.start") + F.col("q.run")).alias("run"), *[f"q.{c}" for c in kept]))

    # every copy with its finish time, sorted over the corpus
    turns = (served.where("size > 0")
             .select("doc_id", "source", "bucket", "rn", "size", "key", "tie",
                     F.explode(F.transform(
                         F.sequence(F.lit(0), F.lit(max_repeats - 1)),
                         lambda e: (F.col("run") + e * F.col("source_size")) / F.col("target"))).alias("finish")))
    order = ["finish", F.col("source").asc_nulls_last(), "key", "doc_id", "tie", "bucket", "rn"]
    parts = max(1, math.isqrt(rows * max_repeats) // 8)
    ranged = materialized(turns.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    part_starts = (ranged.groupBy("part").agg(F.sum("size").alias("total"))
                   .select("part", F.coalesce(F.sum("total").over(
                       Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"),
                       F.sum("total").over(Window.orderBy(F.lit(1)).rowsBetween(
                           Window.unboundedPreceding, Window.unboundedFollowing)).alias("all_copies")))
    upto = F.sum("size").over(Window.partitionBy("part").orderBy(*order)
                              .rowsBetween(Window.unboundedPreceding, 0))
    budget = sized.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    copies = (ranged.withColumn("upto", upto).join(part_starts, "part")
              .where(F.col("start") + F.col("upto") <= F.lit(budget))
              .groupBy("source", "bucket", "rn").agg(F.count(F.lit(1)).alias("copies")))
    v, c = served.alias("v"), copies.alias("c")
    n = F.coalesce(F.col("c.copies"), F.lit(0))
    return (v.join(c, F.col("v.source").eqNullSafe(F.col("c.source")) & (F.col("v.bucket") == F.col("c.bucket"))
                   & (F.col("v.rn") == F.col("c.rn")), "left")
            .select("v.doc_id", "v.source", "v.size", "v.source_size", "v.target", n.cast("int").alias("copies"),
                    (n * F.col("v.size")).cast("long").alias("taken"), *[f"v.{c}" for c in kept]))


SQL = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         1.0::DOUBLE + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS w
  FROM sized GROUP BY source),
lv AS (
  SELECT *, 3 * source_size AS cap,
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
           / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev,
         3 * source_size / w AS ratio
  FROM per WINDOW o AS (ORDER BY 3 * source_size / w, source ASC NULLS LAST)),
tg AS (
  SELECT source, source_size, least(cap::DOUBLE, w * (
           SELECT arg_min(lev, ratio) FROM lv WHERE lev * w <= cap)) AS target FROM lv),
queued AS (
  SELECT s.doc_id, s.source, s.size, s.k, t.source_size, t.target,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size ROWS UNBOUNDED PRECEDING)::BIGINT AS run
  FROM sized s JOIN tg t ON s.source IS NOT DISTINCT FROM t.source),
turns AS (
  SELECT *, (run + e * source_size)::DOUBLE / target AS finish FROM queued, (VALUES (0), (1), (2)) r(e) WHERE size > 0),
cut AS (
  SELECT doc_id, source, sum(size) OVER (ORDER BY finish, source ASC NULLS LAST, k, doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM turns),
n AS (
  SELECT doc_id, count(*) AS copies FROM cut WHERE upto <= (SELECT sum(size) FROM sized) GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, (coalesce(n.copies, 0) * q.size)::BIGINT AS taken
FROM queued q LEFT JOIN n USING (doc_id)
"""
