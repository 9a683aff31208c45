"""Raw delivery files: pipe-delimited, gzip, header, every column a string.

Ingest adds lineage (``_source_file``) and the delivery date parsed from the
file name (``_file_date``).  The declared schema is enforced against the
header (``enforceSchema=false``), so a renamed or reordered column fails the
read instead of silently shifting values.  gzip files are not splittable:
each file is one task, which is what bounds a delivery's read parallelism.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from contactgate.functions.columns import file_date_from_name
from contactgate.sources import schemas as S

DELIVERY_DIR = "delivery"   # directory-per-delivery layout written by :func:`deliver`


def read_pipe_csv(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """Pipe-delimited CSV with header, no inference; empty fields are NULL.
    The header must match the declared columns (checked per file)."""
    return (spark.read.schema(schema)
            .option("sep", "|").option("header", "true")
            .option("enforceSchema", "false")
            .option("mode", "PERMISSIVE")   # a short row is NULL-padded, as delivered
            .csv(path))


def with_lineage(df: DataFrame) -> DataFrame:
    """``_source_file`` (full path) and ``_file_date`` from the file name; a
    name without a stamp falls back to the stamp of its parent directory."""
    from_name = file_date_from_name(F.col("_metadata.file_name"))
    parent = F.substring_index(F.substring_index(F.col("_metadata.file_path"), "/", -2), "/", 1)
    from_path = file_date_from_name(parent)
    return (df.withColumn("_source_file", F.col("_metadata.file_path"))
              .withColumn("_file_date", F.coalesce(from_name, from_path)))


def delivery_stem(source_file: str) -> Column:
    """Name of a delivery: the last part of ``<path>/<name>.csv.gz`` without its ending, empty
    for other paths.  No pattern is searched, which costs a row more than reading it."""
    name = F.substring_index(source_file, "/", -1)
    return F.when(name.endswith(".csv.gz"), F.substring(name, F.lit(1), F.length(name) - len(".csv.gz"))).otherwise(
        F.when(name.isNotNull(), F.lit("")))


def _path(data_dir: str, glob: str, layout: str) -> str:
    root = data_dir.rstrip("/")
    if layout == "file":
        return f"{root}/{glob}"
    if layout == "directory":
        folder, pattern = glob.split("/", 1)
        stem = pattern.removesuffix(".csv.gz")
        return f"{root}/{folder}/{DELIVERY_DIR}={stem}/*.csv.gz"
    raise ValueError(f"unknown layout {layout!r}")


def _ingest(spark: SparkSession, data_dir: str, glob: str, schema: StructType,
            layout: str) -> DataFrame:
    df = with_lineage(read_pipe_csv(spark, _path(data_dir, glob, layout), schema))
    return df.select(*schema.fieldNames(), *S.LINEAGE_COLUMNS)


RAW, REASON = "_raw", "_reject_reason"
UNDECODABLE = "\ufffd"      # what a reader puts in place of bytes that are no UTF-8


def ingest_lines(spark: SparkSession, data_dir: str, glob: str, schema: StructType, layout: str = "file") -> DataFrame:
    """Every delivered line once: the declared columns, lineage, and for a line that does not
    fit the layout why (``_reject_reason``: ``short``, ``long``, ``undecodable`` or
    ``malformed``) and the line itself (``_raw``); both are NULL for a good line.

    The reader keeps a line with too few or too many fields in its corrupt-record
    column; a line whose bytes are no UTF-8 shows by the replacement character.  Blank lines
    are no lines."""
    columns = schema.fieldNames()
    with_raw = StructType([*schema.fields]).add(RAW, StringType())
    read = with_lineage(spark.read.schema(with_raw).option("sep", "|").option("header", "true")
                        .option("enforceSchema", "false").option("mode", "PERMISSIVE")
                        .option("columnNameOfCorruptRecord", RAW).csv(_path(data_dir, glob, layout)))
    fields = F.size(F.split(RAW, r"\|", -1))
    joined = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in columns])
    garbled = F.coalesce(F.col(RAW), joined).contains(UNDECODABLE)
    reason = (F.when(garbled, F.lit("undecodable"))
              .when(F.col(RAW).isNull(), F.lit(None))
              .when(fields < len(columns), F.lit("short"))
              .when(fields > len(columns), F.lit("long"))
              .otherwise(F.lit("malformed")))
    return (read.withColumn(REASON, reason)
            .withColumn(RAW, F.when(F.col(REASON).isNotNull(), F.coalesce(F.col(RAW), joined)))
            .select(*columns, *S.LINEAGE_COLUMNS, RAW, REASON))


def good_rows(lines: DataFrame) -> DataFrame:
    return lines.where(F.col(REASON).isNull()).drop(RAW, REASON)


def rejects(lines: DataFrame) -> DataFrame:
    """The rejects table of a feed: the line, why it was rejected, and where it came from."""
    return lines.where(F.col(REASON).isNotNull()).select(RAW, REASON, *S.LINEAGE_COLUMNS)


def reject_share_check(lines: DataFrame, max_share: float, name: str = "reject_share") -> DataFrame:
    """Check result (see ``operators.quality``): observed are the rejected lines; passes
    while they are at most ``max_share`` of all lines.  One aggregate over the lines."""
    if not 0 <= max_share <= 1:
        raise ValueError("max_share must be from 0 to 1")
    counted = lines.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(REASON).isNotNull()).alias("bad"))
    return counted.select(F.lit(name).alias("name"), (F.col("bad") <= F.col("n") * F.lit(max_share)).alias("passed"),
                          F.col("bad").cast("long").alias("observed"), F.lit(f"share<={max_share:g}").alias("expected"))


def ingest_enrollment(spark: SparkSession, data_dir: str, layout: str = "file") -> DataFrame:
    return _ingest(spark, data_dir, S.ENROLLMENT_GLOB, S.ENROLLMENT_SCHEMA, layout)


def ingest_snapshot(spark: SparkSession, data_dir: str, layout: str = "file") -> DataFrame:
    return _ingest(spark, data_dir, S.SNAPSHOT_GLOB, S.SNAPSHOT_SCHEMA, layout)


def ingest_change(spark: SparkSession, data_dir: str, layout: str = "file") -> DataFrame:
    return _ingest(spark, data_dir, S.CHANGE_GLOB, S.CHANGE_SCHEMA, layout)


def deliver(feed: DataFrame, root: str, folder: str, columns: list[str], layout: str = "directory") -> None:
    """Write a feed as gzip pipe-delimited delivery files, one directory per
    delivery (``<root>/<folder>/delivery=<name stem>/part-*.csv.gz``), the
    directory named after the feed's ``_source_file``.  No shuffle: each task
    writes one part file per delivery it holds (``EXPORT_000..NNN`` style).

    ``layout="file"`` names the directories like files (``<folder>/<name>.csv.gz/``), one
    write per delivery: for the few deliveries of a catch-up, not for a history."""
    if layout == "file":
        names = [r[0] for r in feed.select("_source_file").distinct().collect()]    # one per delivery
        for name in names:
            (feed.where(F.col("_source_file") == name).select(*columns)
                 .write.mode("overwrite").option("sep", "|").option("header", "true").option("compression", "gzip")
                 .csv(f"{root.rstrip('/')}/{folder}/{name.rsplit('/', 1)[-1]}"))
        return
    (feed.select(*columns, delivery_stem("_source_file").alias(DELIVERY_DIR))
         .sortWithinPartitions(DELIVERY_DIR)
         .write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")   # replace only these deliveries
         .partitionBy(DELIVERY_DIR)
         .option("sep", "|").option("header", "true")
         .option("compression", "gzip")
         .csv(f"{root.rstrip('/')}/{folder}"))
