"""A served table kept current by the change stream.

Each micro-batch is reduced to one row per key and written as a run of its own (``_waiting``,
named by the stream's epoch).  Once the runs that wait have as many rows as the table, they
are merged into it: a :class:`KeyedTable` that holds the newest change record per (legacy id,
phone).  A merge rewrites what it touches, as a rule the whole table, so merging every
micro-batch would cost micro-batches times table; waiting for as many rows as the table has
keeps all merges together in proportion to what was delivered.  Readers get the
table folded with the runs that still wait, never the history.  A stored row is replaced only
by a record that precedes it; runs and merges are named by the epoch, so a replayed epoch ends
in the same rows.

Which record is newest is not one comparison of two records: of records with one raw
date text the *lowest* history id counts, among those the newest date and then the
*highest* history id.  A late record can therefore lower the record of its raw date, and
another spelling of the same date may come to win.  So a row keeps, beside its winner, the
records that still compete: one per raw date text of the key's newest date (``_tied``, as
many as the date has spellings, one as a rule).  Merging two rows' records by the
same rule is associative and repeatable, so files may come in any order, late, and
twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contactgate.operators.latest import order_key
from contactgate.plans.phone_state import change_date, dedup_change, row_key
from contactgate.sources import schemas as S
from contactgate.sources.tables import RUN_COL, KeyedTable, RunTable
from contactgate.streaming.change_stream import change_stream

KEYS = ["cnsmr_idntfr_lgcy_txt", "cnsmr_phn_nmbr_txt"]
TIED = "_tied"
ROW = [*S.CHANGE_COLUMNS, *S.LINEAGE_COLUMNS]


def reduce_changes(changes: DataFrame) -> DataFrame:
    """One row per key: its newest change record, ``record_date_parsed`` and the records
    that compete for it (``_tied``)."""
    first = dedup_change(changes.select(*ROW))      # one per key and raw date text
    record = F.struct(F.col("cnsmr_phn_hst_id").alias("id"), F.expr(row_key(first, S.CHANGE_COLUMNS)).alias("text"),
                      F.struct(*ROW).alias("row"))
    by_date = first.groupBy(*KEYS, change_date(first).alias("at")).agg(F.collect_set(record).alias(TIED))
    newest = by_date.groupBy(*KEYS).agg(F.max_by(F.struct("at", TIED), order_key(["at"])).alias("n"))
    winner = F.array_max(f"n.{TIED}")
    return newest.select(winner.alias("w"), F.col("n.at").alias("record_date_parsed"), F.col(f"n.{TIED}").alias(TIED)).select(
        *[F.col(f"w.row.{c}").alias(c) for c in ROW], "record_date_parsed", TIED)


def _same_key(old: DataFrame, new: DataFrame) -> Column:
    on = F.lit(True)
    for k in KEYS:
        on = on & old[k].eqNullSafe(new[k])
    return on


def fold_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both, each key once: where both have it, their competing records reduced again."""
    keys = new.select(*KEYS)
    met = old.join(keys, _same_key(old, keys), "left_semi")
    return old.join(keys, _same_key(old, keys), "left_anti").unionByName(_reduced(met.unionByName(new)).select(*old.columns))


def _reduced(rows: DataFrame) -> DataFrame:
    """Reduced rows with some keys more than once, reduced to one row per key."""
    return reduce_changes(rows.select(F.explode(TIED).alias("t")).select("t.row.*"))


def served_table(spark: SparkSession, path: str, buckets: int = 64) -> KeyedTable:
    return KeyedTable(spark, path, KEYS, buckets)


def _runs(spark: SparkSession, path: str) -> RunTable:
    return RunTable(spark, f"{path.rstrip('/')}_waiting")


def _waiting(spark: SparkSession, path: str, table: KeyedTable) -> DataFrame | None:
    """Reduced rows of the micro-batches not merged yet (a key once for each), None if there are none."""
    runs, last = _runs(spark, path), table.last_run()
    found = [r for r in runs.runs() if last is None or r > last]
    if not found:
        return None
    return (spark.read.option("basePath", runs.path).parquet(*[f"{runs.path}/{RUN_COL}={r}" for r in found]).drop(RUN_COL))


def apply_changes(spark: SparkSession, path: str, batch: DataFrame, epoch: int, buckets: int = 64) -> None:
    """Apply one micro-batch.  An epoch that was applied last is applied again to the same end,
    one before it is refused."""
    table, runs = served_table(spark, path, buckets), _runs(spark, path)
    merged = table.last_run()
    newest = max((r for r in (merged, runs.last_run()) if r is not None), default=None)
    if newest is not None and epoch < newest:
        raise ValueError(f"run {newest} was merged after run {epoch}")
    if epoch != merged:
        runs.write(reduce_changes(batch), epoch)
        rows = _waiting(spark, path, table)
        size = rows.count()
        if not size or (merged is not None and size < table.read().count()):
            return
        batch = rows.select(F.explode(TIED).alias("t")).select("t.row.*")
    table.merge(reduce_changes(batch), epoch, fold_changes)


def serve_changes(spark: SparkSession, data_dir: str, path: str, checkpoint: str, layout: str = "file",
                  max_files_per_trigger: int | None = None, buckets: int = 64, available_now: bool = True):
    """Start (and, for ``available_now``, finish) the stream that keeps ``path`` current.

    One stream writes a table; a new checkpoint for an old table must not start its epochs
    anew (merges refuse an epoch below the last one)."""
    def apply(batch: DataFrame, epoch: int) -> None:
        apply_changes(spark, path, batch, epoch, buckets)

    q = (change_stream(spark, data_dir, layout, max_files_per_trigger)
         .writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    handle = q.start()
    if available_now:
        handle.awaitTermination()
    return handle


def served_changes(spark: SparkSession, path: str, buckets: int = 64) -> DataFrame:
    """The newest change record per (legacy id, phone): the served table and what waits to be merged."""
    table = served_table(spark, path, buckets)
    rows, waiting = table.read(), _waiting(spark, path, table)
    return (rows if waiting is None else fold_changes(rows, _reduced(waiting))).drop(TIED)
