"""Incremental application of change files with Structured Streaming.

New change deliveries are picked up by a file stream (``availableNow`` for a
scheduled catch-up run, or a processing-time trigger).  Each micro-batch is
deduplicated on (legacy id, phone, raw record date) and written, idempotently
per epoch, as one batch directory of a parquet state folder.  The current
change state is a read-time view: the same dedup over all batches, then the
newest record per key.  Because both steps are order-insensitive
(min / max over a total order), late or re-delivered files give the same
result as one batch run over all files, with no watermark: nothing is ever
finalised early, so no late record can be dropped.

:func:`compact` folds the applied batches into a run of survivors named by the
newest epoch it covers; reads then take that run plus only the newer batch
folders.

The streaming checkpoint and the state folder must live on shared storage
(under ``spark.checkpoint.dir``); a restarted query resumes from the
checkpoint and re-runs an unfinished epoch, which rewrites the same batch
directory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactgate.plans.phone_state import dedup_change, latest_change_state
from contactgate.sources import schemas as S
from contactgate.sources.delivery import DELIVERY_DIR, with_lineage
from contactgate.sources.tables import RunTable, read_or_none

BATCH_COL = "batch"
BATCHES = "batches"        # <state>/batches/batch=<epoch>/   one folder per micro-batch
COMPACTED = "compacted"    # <state>/compacted/run=<epoch>/   survivors up to that epoch
MARKS = "compactions"      # <state>/compactions/run=<epoch>/ one row per finished compaction


def change_stream(spark: SparkSession, data_dir: str, layout: str = "file",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over change delivery files (raw strings + lineage)."""
    root = data_dir.rstrip("/")
    if layout == "file":
        path = f"{root}/{S.CHANGE_GLOB}"
    else:
        path = f"{root}/MAINTENANCE/{DELIVERY_DIR}=*SUPPLFWD*/*.csv.gz"
    reader = (spark.readStream.schema(S.CHANGE_SCHEMA)
              .option("sep", "|").option("header", "true").option("enforceSchema", "false"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = with_lineage(reader.csv(path))
    return df.select(*S.CHANGE_COLUMNS, *S.LINEAGE_COLUMNS)


def _apply_batch(state_path: str):
    def apply(batch: DataFrame, epoch_id: int) -> None:
        (dedup_change(batch).write.mode("overwrite")
         .parquet(f"{state_path}/{BATCHES}/{BATCH_COL}={epoch_id}"))
    return apply


def run_change_stream(spark: SparkSession, data_dir: str, state_path: str,
                      checkpoint: str, layout: str = "file",
                      max_files_per_trigger: int | None = None,
                      available_now: bool = True):
    """Start (and, for ``available_now``, finish) the incremental apply."""
    q = (change_stream(spark, data_dir, layout, max_files_per_trigger)
         .writeStream.foreachBatch(_apply_batch(state_path))
         .option("checkpointLocation", checkpoint))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    handle = q.start()
    if available_now:
        handle.awaitTermination()
    return handle


def _survivors(spark: SparkSession, state_path: str) -> tuple[DataFrame, int | None]:
    """Deduplicated change rows over every applied batch, and the newest
    epoch they include: the newest compacted run plus the batch folders
    after it (pruned on the ``batch`` partition column).  The epochs a
    compaction covers are the id of its run, not a column of its rows, so a run without
    rows covers them too.  Before the first batch there are no rows."""
    empty = spark.createDataFrame([], S.CHANGE_SCHEMA).select(
        *S.CHANGE_COLUMNS, F.lit(None).cast("string").alias("_source_file"), F.lit(None).cast("date").alias("_file_date"))
    batches = read_or_none(spark, f"{state_path}/{BATCHES}")
    marks = RunTable(spark, f"{state_path}/{MARKS}")
    upto = marks.last_run()
    if batches is None:
        return empty, upto
    applied = batches if upto is None else batches.where(F.col(BATCH_COL) > upto)
    newest = batches.agg(F.max(BATCH_COL)).first()[0]
    applied = applied.drop(BATCH_COL)
    if upto is not None:
        applied = RunTable(spark, f"{state_path}/{COMPACTED}").read(upto).unionByName(applied)
    return dedup_change(applied), (newest if newest is not None else upto)


def compact(spark: SparkSession, state_path: str) -> int | None:
    """Fold every applied batch into a compacted run named by the newest epoch it
    covers (nothing is deleted; later reads skip the covered batch
    folders).  The mark that makes it count is written after its rows.  Returns the epoch,
    or None when there is nothing new to fold."""
    survivors, newest = _survivors(spark, state_path)
    marks = RunTable(spark, f"{state_path}/{MARKS}")
    if newest is None or newest in marks.runs():
        return None
    RunTable(spark, f"{state_path}/{COMPACTED}").write(survivors, newest)
    marks.write(spark.range(1).select(F.lit(newest).cast("long").alias("upto")), newest)
    return newest


def current_changes(spark: SparkSession, state_path: str) -> DataFrame:
    """Newest change record per (legacy id, phone) over every applied batch."""
    survivors, _ = _survivors(spark, state_path)
    return latest_change_state(survivors)
