"""Incremental phone state: fold new deliveries into stored reductions
instead of re-reading every historical snapshot.

Tables, each a :class:`RunTable` (every fold writes a run of its own, which also
cuts lineage):

``buffer``     one row per key: the best snapshot/enrollment candidate, its
               precedence and the newest snapshot date that listed the key.
               Folding a batch is one union + aggregate over (buffer, batch).
``survivors``  the change history, each fold's records deduplicated to one row per
               (legacy id, phone, raw record date) and appended as a run of their
               own; reading deduplicates across the runs.  Change dedup keeps the
               lowest history id of a raw date, which can *lower* a key's best
               change record, so the history is kept and not only the winner.
``recent``     the deduplicated snapshot rows of the newest ``open_dates`` dates, not
               yet in the buffer
``dates``      the snapshot dates that a fold put into the buffer; written last, so a
               fold counts once its run of this table is complete (with rows or without)

The current state combines them in the same aggregate the batch plan uses.
Because every reduction is a max over a total order, the result equals the
batch result over all deliveries, in any fold order.

Snapshot dedup is per delivery date, so a date must be whole before it enters the buffer.  The
newest ``open_dates`` dates stay open: a second file of such a date may arrive in a later
fold.  A batch that brings rows of a date already in the buffer is refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactgate.functions.columns import account_from_legacy_sql
from contactgate.operators.reconcile import (
    CANDIDATE_COLUMNS, candidates, delete_status, finish, reduce_candidates, tiebreak_width,
)
from contactgate.plans import phone_state as P
from contactgate.sources import schemas as S
from contactgate.sources.tables import RunTable


class SplitDeliveryError(ValueError):
    """A snapshot date was folded before; its rows must come while the date is open."""


class IncrementalState:
    def __init__(self, spark: SparkSession, path: str, open_dates: int = 0):
        self.spark = spark
        root = path.rstrip("/")
        self.buffer = RunTable(spark, f"{root}/buffer")
        self.survivors = RunTable(spark, f"{root}/survivors")
        self.recent = RunTable(spark, f"{root}/recent")
        self.dates = RunTable(spark, f"{root}/dates")
        self.open_dates = open_dates
        self.cfg = P._config()

    def last_run(self) -> int | None:
        """Newest complete fold, whatever it brought; ``dates`` is written last."""
        return self.dates.last_run()

    def _candidates(self, snapshot: DataFrame, enrollment: DataFrame | None, width: int) -> DataFrame:
        specs = [P.snapshot_source(snapshot)] + ([P.enrollment_source(enrollment)] if enrollment is not None else [])
        return candidates(specs, self.cfg, P.EVENT_COLUMNS, width).select(*P.KEYS, *CANDIDATE_COLUMNS)

    def apply(self, nonfin: DataFrame, supplfwd: DataFrame, enrollment: DataFrame, run: int | None = None) -> int:
        """Fold one batch of deliveries (any feed may be empty); returns the fold's run.

        ``run`` is the caller's number for the fold (default: one more than the last).  A
        number that was folded completely is not folded again, so a retried fold changes
        nothing; one below the last is refused."""
        last = self.last_run()
        run = (0 if last is None else last + 1) if run is None else run
        if last is not None and run <= last:
            if run in self.dates.runs():
                return run
            raise ValueError(f"fold {last} came after fold {run}")
        nonfin, supplfwd = P.prune(nonfin, P.SNAPSHOT_USED), P.prune(supplfwd, P.CHANGE_USED)
        enrollment = P.prune(enrollment, P.ENROLLMENT_USED)
        snapshot, closed = nonfin, None
        if last is not None:
            closed = self.dates.history().where(F.col("run") <= last).select("_file_date")
            split = nonfin.select("_file_date").distinct().join(closed, "_file_date", "left_semi").take(1)
            if split:
                raise SplitDeliveryError(f"snapshot date {split[0][0]} was folded before")
            snapshot = nonfin.unionByName(self.recent.read(last))
        # one row per date reaches the driver
        dates = sorted(r[0] for r in snapshot.select("_file_date").distinct().collect() if r[0] is not None)
        still_open = F.col("_file_date").isin(dates[-self.open_dates:] if self.open_dates else [])
        is_open = F.coalesce(still_open, F.lit(False))
        deduped = P.dedup_snapshot(snapshot)
        width = tiebreak_width([P.snapshot_source(deduped), P.enrollment_source(enrollment), P.change_source(supplfwd)])
        cands = self._candidates(deduped.where(~is_open), enrollment, width)
        if last is not None:
            cands = cands.unionByName(self.buffer.read(last))
        self.buffer.write(reduce_candidates(cands, self.cfg).select(*P.KEYS, *CANDIDATE_COLUMNS), run)
        self.recent.write(deduped.where(is_open), run)
        self.survivors.write(P.dedup_change(supplfwd), run)
        self.dates.write(snapshot.where(~is_open).select("_file_date").distinct().withColumn("fold", F.lit(run)), run)
        return run

    def apply_deliveries(self, nonfin_table, supplfwd_table, enrollment_table,
                         since=None, until=None, run: int | None = None) -> int:
        """Fold the deliveries dated ``since <= _file_date < until`` from three
        date-partitioned bronze tables (:class:`DeliveryTable`); only those
        partitions are read."""
        return self.apply(nonfin_table.read(since, until), supplfwd_table.read(since, until),
                          enrollment_table.read(since, until), run)

    def state(self) -> DataFrame:
        """Silver state as of the last fold (same 17 columns as the batch plan)."""
        last = self.last_run()
        if last is None:
            raise FileNotFoundError("nothing has been folded yet")
        buf = self.buffer.read(last)
        width = len(buf.schema["__ord"].dataType["__tb"].dataType.fields)
        changes = P.dedup_change(self.survivors.history().where(F.col("run") <= last).drop("run"))
        chg = candidates([P.change_source(changes)], self.cfg, P.EVENT_COLUMNS, width) \
            .select(*P.KEYS, *CANDIDATE_COLUMNS)
        held = buf.unionByName(self._candidates(self.recent.read(last), None, width))
        latest = held.agg(F.max("__seen")).scalar()
        reduced = reduce_candidates(held.unionByName(chg), self.cfg)
        df = delete_status(finish(reduced, self.cfg, P.EVENT_COLUMNS, latest, S.SRC_SNAPSHOT))
        return df.selectExpr(
            f"{account_from_legacy_sql('legacy_identifier')} AS account_number",
            *[c for c in S.STATE_COLUMNS if c != "account_number"])
