"""Key-based merges: gap fill, upsert and row-level change feed; bag equality by digest.

The merges are joins on the key, never a pairwise scan; they shuffle both sides
on the key once (or broadcast a side only when Spark has measured it small).  Digests are
one aggregate over each side: the rows themselves are not shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gap_fill(primary: DataFrame, fallback: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``primary`` plus the ``fallback`` rows whose key ``primary`` lacks
    (left anti join).  NULL keys never match, so NULL-key fallback rows are
    always kept."""
    missing = fallback.join(primary.select(*keys), on=list(keys), how="left_anti")
    return primary.unionByName(missing)


class RepeatedKeyError(ValueError):
    """A merge source holds a key more than once."""


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``df`` that occur more than once (empty when unique).  Keys with a
    NULL part are not counted: they match nothing."""
    complete = df.dropna(subset=list(keys))
    return complete.groupBy(*keys).count().where(F.col("count") > 1)


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise unless ``df`` is unique on ``keys`` (one aggregate job, one row fetched)."""
    found = repeated_keys(df, keys).take(1)
    if found:
        raise RepeatedKeyError(f"merge source repeats key {found[0].asDict()}")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           delete_missing: bool = False) -> DataFrame:
    """MERGE semantics: matched target rows are replaced by the source row,
    unmatched source rows are inserted, unmatched target rows are kept
    (or dropped with ``delete_missing``).  ``source`` must be unique on keys
    (:func:`require_unique`).  NULL keys match nothing, as in a MERGE on
    equality, so a source row with a NULL key is inserted by every upsert."""
    if delete_missing:
        return source.select(*target.columns)
    kept = target.join(source.select(*keys), on=list(keys), how="left_anti")
    return kept.unionByName(source.select(*target.columns))


def diff(old: DataFrame, new: DataFrame, keys: Sequence[str],
         change_col: str = "_change_type") -> DataFrame:
    """Row-level change feed between two versions of a table keyed by ``keys``:
    ``insert``, ``delete``, ``update_preimage`` and ``update_postimage`` rows
    (keys and value columns are compared NULL-safely, so a row with a NULL in
    its key meets itself in the other version).  One full outer join on the
    key; both versions must be unique on it."""
    keys = list(keys)
    values = [c for c in old.columns if c not in keys]
    o = old.select(F.struct(*keys).alias("__ko"), F.struct(*values).alias("__o"), F.lit(True).alias("__in_o"))
    n = new.select(F.struct(*keys).alias("__kn"), F.struct(*values).alias("__n"), F.lit(True).alias("__in_n"))
    same_key = F.lit(True)
    for k in keys:
        same_key = same_key & F.col(f"__ko.{k}").eqNullSafe(F.col(f"__kn.{k}"))
    j = o.join(n, on=same_key, how="full_outer")
    j = j.select(*[F.when(F.col("__in_o"), F.col(f"__ko.{k}")).otherwise(F.col(f"__kn.{k}")).alias(k) for k in keys],
                 "__o", "__in_o", "__n", "__in_n")
    same = F.lit(True)
    for c in values:
        same = same & F.col(f"__o.{c}").eqNullSafe(F.col(f"__n.{c}"))
    kind = (F.when(F.col("__in_o").isNull(), F.lit("insert"))
            .when(F.col("__in_n").isNull(), F.lit("delete"))
            .when(~same, F.lit("update")))
    j = j.withColumn("__k", kind).where(F.col("__k").isNotNull())
    img = lambda t, side: F.struct(F.lit(t).alias("t"), F.col(side).alias("v"))
    images = (F.when(F.col("__k") == "insert", F.array(img("insert", "__n")))
              .when(F.col("__k") == "delete", F.array(img("delete", "__o")))
              .otherwise(F.array(img("update_preimage", "__o"), img("update_postimage", "__n"))))
    return (j.select(*keys, F.explode(images).alias("__i"))
             .select(*keys, *[F.col(f"__i.v.{c}").alias(c) for c in values],
                     F.col("__i.t").alias(change_col)))


def row_hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row, independent of each other; a NULL counts, and where it is."""
    parts = [x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)


def bag_digest(df: DataFrame, group: Column | None = None) -> DataFrame:
    """Order-free fingerprint of a bag of rows: their number, and sum and xor of both row
    hashes (``rows, sum1, sum2, xor1, xor2``); one row, or one per value of ``group`` (column
    ``part``).  Partial aggregation leaves one row a task and group to shuffle."""
    first, second = row_hashes(df.columns)
    hashed = df.select(*([group.alias("part")] if group is not None else []), first.alias("h1"), second.alias("h2"))
    total = lambda h: F.sum(F.col(h).cast("decimal(28,0)"))
    return hashed.groupBy(*(["part"] if group is not None else [])).agg(
        F.count(F.lit(1)).alias("rows"), total("h1").alias("sum1"), total("h2").alias("sum2"),
        F.bit_xor("h1").alias("xor1"), F.bit_xor("h2").alias("xor2"))


def changed_buckets(old: DataFrame, new: DataFrame, bucket: Column) -> list[int]:
    """Values of ``bucket`` (a function of the key with a bounded range) whose rows differ
    between two versions of a table."""
    a = bag_digest(old, bucket)
    b = bag_digest(new.select(*old.columns), bucket)
    b = b.select(*[F.col(c).alias(f"_{c}") for c in b.columns])
    same = F.lit(True)
    for c in ("rows", "sum1", "sum2", "xor1", "xor2"):
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    differ = a.join(b, F.col("part") == F.col("_part"), "full_outer").where(~same)
    return sorted(r[0] for r in differ.select(F.coalesce("part", "_part")).collect())


def bag_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: ``only_in_first, only_in_second, first_rows`` (repeated rows count).

    Each side is computed once, for its digest.  Equal digests mean equal bags; only if they
    differ are the rows themselves compared."""
    b = b.select(*[F.col(f"`{c}`") for c in a.columns])
    first, second = bag_digest(a).first(), bag_digest(b).first()
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    if first == second:
        return a.sparkSession.range(1).select(
            F.lit(0).cast("long").alias("only_in_first"), F.lit(0).cast("long").alias("only_in_second"),
            F.lit(first["rows"]).cast("long").alias("first_rows"))
    return count(a.exceptAll(b), "only_in_first").select(
        "only_in_first", count(b.exceptAll(a), "only_in_second").scalar().alias("only_in_second"),
        F.lit(first["rows"]).cast("long").alias("first_rows"))
