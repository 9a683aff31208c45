"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# a word is a run of anything but space, tab, line feed, vertical tab, form feed, return
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the executors this package, for the Python functions that run there.

    A zip of the package's sources is handed to ``addPyFile`` once per
    application, so a cluster needs no installed copy."""
    sc = spark.sparkContext
    if getattr(sc, "_contactgate_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="contactgate-src-"), "contactgate_src.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(target)
    sc._contactgate_shipped = True


def give_back() -> None:
    """Return the memory that this Python worker has freed to the system.

    Spark keeps a worker for later tasks, of other stages too, and all that it holds counts
    against its executor; the allocators keep what was freed unless they are asked."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc has it
    if trim is not None:
        trim(0)


def materialized(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder (eager
    ``checkpoint()``): later uses neither recompute it nor depend on the
    executors that computed it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def union(a: DataFrame, b: DataFrame) -> DataFrame:
    """``a`` and ``b``, claiming no partitioning.

    Spark 4.1 may take a union of two frames for partitioned by a key although their
    rows are not, and then leaves out the shuffle of a later grouping by that key.
    ``coalesce`` to more partitions than there are moves nothing and drops the claim."""
    return a.union(b).coalesce(1 << 20)


def bounded_sample(rows: DataFrame, most: int, *key: str) -> DataFrame:
    """About ``most`` of the rows, those whose hashed key is in the lowest part of the
    hash range (all rows, if there are no more than that).

    The part is ``most`` / number of rows, so a task filters its own rows and nothing is
    sorted or gathered; reruns choose the same keys.  Rows that share a key are chosen
    together; twice ``most`` rows are never exceeded."""
    n = rows.count()
    if n <= most:
        return rows
    return rows.where(hash_part(*key) < int(most / n * HASH_RANGE)).limit(2 * most)


HASH_RANGE = 1 << 32


def hash_part(*key: str) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(HASH_RANGE))


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an edge list.

    ``edges`` has long columns ``u`` and ``v``; the result has one row
    (``node``, ``component``) per node that has an edge, ``component`` being the
    smallest node reachable.  Every round a node takes the smallest label among
    its neighbours and then its label's own label (pointer jumping); rounds
    stop when no label changed.  Labels live in checkpointed tables, never on
    the driver; the per-node minimum aggregates before its shuffle, and the
    label joins read two plain shuffles, so a hub's rows can be split.

    No edges give no rows; repeated edges and self loops change nothing.
    """
    ways = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    both = materialized(edges.where("u IS NOT NULL AND v IS NOT NULL").select(F.explode(ways).alias("e"))
                        .select("e.u", "e.v").distinct())
    labels = materialized(both.groupBy(F.col("u").alias("node"))
                          .agg(F.min("v").alias("m"))
                          .select("node", F.least("node", "m").alias("component")))
    while True:
        near = (both.join(labels.select(F.col("node").alias("v"), "component"), "v")
                .groupBy(F.col("u").alias("node")).agg(F.min("component").alias("near")))
        step = materialized(
            labels.join(near, "node")
            .select("node", F.col("component").alias("old"),
                    F.least("component", "near").alias("component")))
        jump = step.select(F.col("node").alias("component"), F.col("component").alias("next"))
        labels = materialized(step.join(jump, "component")
                              .select("node", "old", F.least("component", "next").alias("component")))
        if is_empty(labels.where("old <> component")):
            return labels.select("node", "component")
        labels = labels.select("node", "component")
