"""Plain parquet tables partitioned by what the caller names.

``RunTable``       one folder per run id.  The caller supplies the id (a scheduler's
                   run number, an epoch); writing a run replaces that run alone, so a
                   retried run is idempotent, and two runs never touch each other's
                   rows.  A run has the schema it was written with.
``KeyedTable``     the current rows of a table, in folders by key bucket.  Merging a
                   source rewrites the buckets it has keys of and no others.
``DeliveryTable``  bronze rows of one feed, one partition per delivery date and delivery.

All are ordinary partitioned directories written by Spark's file committer.  A run counts
once its folder holds the committer's ``_SUCCESS`` mark, whether or not it has rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contactgate.operators.merge import changed_buckets, diff, require_unique, upsert

RUN_COL = "run"
_NO_TABLE = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A parquet folder, or None while nothing has been written to it."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if (e.getCondition() or "").split(".")[0] not in _NO_TABLE:
            raise
        return None


class MissingRunError(FileNotFoundError):
    """The run asked for has not been written."""


class RunTable:
    """A table in runs: folder ``run=<id>`` holds that run's rows, with its own schema."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _folder(self, run: int) -> str:
        return f"{self.path}/{RUN_COL}={int(run)}"

    # -- reads ----------------------------------------------------------------
    def runs(self) -> list[int]:
        """Ids of all complete runs in order, those without rows included (one folder
        name each is listed on the driver)."""
        marks = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{RUN_COL}=*/_SUCCESS")
        found = marks.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(marks)
        return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or [])

    def last_run(self) -> int | None:
        """The greatest complete run, None before the first."""
        return max(self.runs(), default=None)

    def exists(self) -> bool:
        return bool(self.runs())

    def history(self) -> DataFrame:
        """Rows of every run, with the run id.  Runs are aligned by column name: a column
        that a run does not have is NULL there; one whose type changed has the wider
        type if the types are numeric, else it is text."""
        runs = self.runs()
        if not runs:
            raise FileNotFoundError(f"nothing written to {self.path}")
        try:    # one scan, if the schemas only differ in the columns they have
            found = (self.spark.read.option("mergeSchema", True).option("basePath", self.path)
                     .parquet(*map(self._folder, runs)))
        except (Py4JJavaError, AnalysisException) as e:
            if "CANNOT_MERGE_SCHEMAS" not in str(e):
                raise
            found = self._aligned(runs)
        return found.withColumn(RUN_COL, F.col(RUN_COL).cast("long"))

    def _aligned(self, runs: list[int]) -> DataFrame:
        frames = [self.read(r).withColumn(RUN_COL, F.lit(r)) for r in runs]
        types: dict[str, set] = {}
        for f in frames:
            for field in f.schema:
                types.setdefault(field.name, set()).add(field.dataType)
        text = {c for c, found in types.items()
                if len(found) > 1 and not all(isinstance(t, T.NumericType) for t in found)}
        frames = [f.select(*[F.col(f"`{c}`").cast("string").alias(c) if c in text else F.col(f"`{c}`") for c in f.columns])
                  for f in frames]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

    def read(self, run: int) -> DataFrame:
        """The table as of ``run``, with that run's columns (only its folder is scanned).
        A run that does not exist raises :class:`MissingRunError`."""
        if int(run) not in self.runs():
            raise MissingRunError(f"{self.path} has no run {run}")
        found = self.spark.read.option("basePath", self.path).parquet(self._folder(run))
        return found.where(F.col(RUN_COL) == F.lit(int(run))).drop(RUN_COL)

    # -- writes -----------------------------------------------------------------
    def write(self, df: DataFrame, run: int, sort_by: Sequence[str] = ()) -> int:
        """``df`` as the contents of ``run``, replacing an earlier attempt at it.  Rows are
        range-partitioned and sorted by ``sort_by`` so that parquet min/max
        statistics let key lookups skip row groups."""
        out = df
        if sort_by:
            out = out.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
        out.write.mode("overwrite").parquet(self._folder(run))
        return run

    def upsert(self, source: DataFrame, keys: Sequence[str], run: int, base: int | None,
               sort_by: Sequence[str] = ()) -> int:
        """MERGE ``source`` into the contents of run ``base`` (None: create) and write
        the result as ``run``.  A ``base`` that does not exist is refused.

        ``source`` is computed once, into a staging run of its own; its keys are checked
        there and the merge reads it from there."""
        if base == run:
            raise ValueError("a run cannot be merged into itself")
        target = None if base is None else self.read(base)
        staged = RunTable(self.spark, f"{self.path}_staging")
        staged.write(source, run)
        rows = staged.read(run).select(*source.columns)
        require_unique(rows, keys)
        merged = rows if target is None else upsert(target, rows, keys)
        return self.write(merged, run, sort_by)

    def changes(self, start: int, end: int, keys: Sequence[str], buckets: int = 256) -> DataFrame:
        """Row-level change feed from run ``start`` to run ``end``.  Both runs are scanned
        once for a digest per key bucket; only rows of buckets that differ are joined."""
        old, new = self.read(start), self.read(end)
        if old.schema != new.schema:
            return diff(old, new, keys)
        bucket = key_bucket(keys, buckets)
        differ = bucket.isin(changed_buckets(old, new, bucket))
        return diff(old.where(differ), new.where(differ), keys)


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


class KeyedTable:
    """The current rows of a table keyed by ``keys``, in one folder per key bucket.

    :meth:`merge` finds the buckets its source has keys of, reads only those (partition
    pruning), combines them with the source and replaces only those (dynamic partition
    overwrite), so a small source costs its share of the table.  Choose ``buckets`` so that a
    bucket is some hundred MB to a few GB; the number is part of the folder names, and a table
    opened with another number is refused."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.buckets = list(keys), buckets
        self.bucket_col = f"_bucket_of_{buckets}"
        self._merged = RunTable(spark, f"{self.path}_merged")
        self._staged = RunTable(spark, f"{self.path}_staging")

    def _found(self) -> DataFrame | None:
        found = read_or_none(self.spark, self.path)
        if found is not None and self.bucket_col not in found.columns:
            raise ValueError(f"{self.path} does not have {self.buckets} buckets")
        return found

    def read(self) -> DataFrame:
        """All rows."""
        found = self._found()
        if found is None:
            raise FileNotFoundError(f"nothing written to {self.path}")
        return found.drop(self.bucket_col)

    def last_run(self) -> int | None:
        """The run merged last, None before the first."""
        return self._merged.last_run()

    def rows_of(self, buckets: Sequence[int]) -> DataFrame | None:
        """Rows of some buckets (only their folders are scanned); None before the first merge."""
        found = self._found()
        return None if found is None else found.where(F.col(self.bucket_col).isin(list(buckets))).drop(self.bucket_col)

    def merge(self, source: DataFrame, run: int,
              combine: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> list[int]:
        """Merge ``source`` (unique on the keys) and return the buckets that were replaced.

        ``combine(old, new)`` makes the new rows of the touched buckets from their rows and
        the source's; by default as MERGE does (:func:`upsert`: a source row replaces the row
        of its key, other rows stay, a NULL key matches nothing and is inserted).  It must not
        change a row's key.

        The result of the touched buckets is first written as ``run`` beside the table,
        then put in place.  A ``run`` that was merged before is put in place again from
        there, so a retry after a crash at any point ends in the same rows and inserts nothing
        twice; a run older than the last merged one is refused.  An empty source
        changes nothing."""
        last = self._merged.last_run()
        if last is not None and run < last:
            raise ValueError(f"run {last} was merged after run {run}")
        if run != last:
            bucket = key_bucket(self.keys, self.buckets)
            self._staged.write(source.withColumn(self.bucket_col, bucket), run)
            rows = self._staged.read(run)
            touched = sorted(r[0] for r in rows.select(self.bucket_col).distinct().collect())
            if not touched:
                return []
            rows = rows.select(*source.columns)
            require_unique(rows, self.keys)
            old = self.rows_of(touched)
            if old is not None:
                rows = combine(old, rows) if combine else upsert(old, rows, self.keys)
            (rows.withColumn(self.bucket_col, bucket)
             .repartitionByRange(self.bucket_col, *self.keys).sortWithinPartitions(self.bucket_col, *self.keys)
             .write.mode("overwrite").partitionBy(self.bucket_col).parquet(f"{self._merged.path}/{RUN_COL}={run}"))
        made = self.spark.read.parquet(f"{self._merged.path}/{RUN_COL}={run}")
        (made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(self.bucket_col).parquet(self.path))
        return sorted(r[0] for r in made.select(self.bucket_col).distinct().collect())


class DeliveryTable:
    """Bronze table of one feed, partitioned by delivery date and delivery.

    A delivery is known by the whole path of the file (or ``delivery=`` folder) its rows
    came from, so equal file names under two roots are two deliveries.  Re-ingesting a
    delivery replaces only its own partition (dynamic partition overwrite), so a
    retried or repeated load is idempotent, deliveries of one date and
    undated ones stand beside each other, and a reader asking for deliveries
    since a date touches only those partitions (pruning on ``_file_date``)."""

    PART_COL = "_file_date"
    DELIVERY_COL = "_delivery"

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    @staticmethod
    def delivery_of(source_file: str = "_source_file") -> Column:
        """Name of the delivery: the last part of its path and a hash of the whole of it.
        Rows that name no file cannot be told apart from other deliveries and are refused."""
        file = F.col(source_file)
        # the pattern is searched only where it can be found: a search costs a row more than the rest
        folder = F.when(file.contains("delivery="), F.regexp_extract(file, r"^(.*delivery=[^/]+)/", 1)).otherwise("")
        whole = F.when(folder != "", folder).otherwise(file)
        part = F.substring_index(whole, "/", -1)
        last = F.when(part.startswith("delivery=") & (part != "delivery="),
                      F.substring(part, F.lit(len("delivery=") + 1), F.length(part))).otherwise(part)
        return F.when(file.isNull(), F.raise_error(F.lit(f"a delivered row has no {source_file}"))).otherwise(
            F.concat_ws("-", last, F.lower(F.hex(F.xxhash64(whole)))))

    def append(self, df: DataFrame) -> None:
        (df.withColumn(self.DELIVERY_COL, self.delivery_of())
           .write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic")
           .partitionBy(self.PART_COL, self.DELIVERY_COL)
           .parquet(self.path))

    def read(self, since=None, until=None) -> DataFrame:
        """Deliveries with ``since <= _file_date < until`` (either optional); without
        bounds undated deliveries are included."""
        df = read_or_none(self.spark, self.path)
        if df is None:
            raise FileNotFoundError(f"nothing delivered to {self.path}")
        df = df.drop(self.DELIVERY_COL)
        if dict(df.dtypes)[self.PART_COL] != "date":    # nothing but undated deliveries
            df = df.withColumn(self.PART_COL, F.col(self.PART_COL).cast("date"))
        if since is not None:
            df = df.where(F.col(self.PART_COL) >= F.lit(since).cast("date"))
        if until is not None:
            df = df.where(F.col(self.PART_COL) < F.lit(until).cast("date"))
        return df
