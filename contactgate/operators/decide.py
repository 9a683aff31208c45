"""Bulk permission decisions.

A permission question is a row (account, phone).  Answering a batch is a left
join of the questions against the published table, pre-reduced to one row per
key.  If a key has several published rows (two legacy suffixes of one
account), the most restrictive answer wins (``bool_and``), so the result never
depends on row order.  Unknown keys are denied.

Plan shape: the published side is reduced to one row per key and dealt again, so
both sides of the join are plain shuffles, which is what AQE's skew-join handling
needs to split a hot question key (an aggregate straight under the join would not be
split); a side that Spark measures as small is broadcast instead.  Nothing runs
while the plan is built.  :func:`decision_table` writes that side once for callers
that ask the same published run often; :func:`decide` can also salt hot keys explicitly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactgate.functions.columns import SEND_SOURCES, can_send_rule, normalize_phone_input
from contactgate.session import checkpoint_dir, fresh_path

KEYS = ("account_number", "phone_number")
MAX_BROADCAST_HOT_KEYS = 100_000    # longest list of hot keys that is broadcast
ALL_PARTITIONS = 1 << 20            # more than any stage has


def keyed_decisions(consent: DataFrame, keys: Sequence[str] = KEYS,
                    allowed_sources: tuple[str, ...] = SEND_SOURCES,
                    out: str = "can_send_sms") -> DataFrame:
    """One row per published key with its decision."""
    rule = can_send_rule(allowed_sources=allowed_sources)
    return consent.groupBy(*keys).agg(F.bool_and(rule).alias(out))


def decision_table(consent: DataFrame, path: str | None = None, keys: Sequence[str] = KEYS,
                   allowed_sources: tuple[str, ...] = SEND_SOURCES, out: str = "can_send_sms") -> DataFrame:
    """:func:`keyed_decisions`, written once to ``path`` (default: a new folder in the
    shared checkpoint directory) and read back."""
    spark = consent.sparkSession
    path = path or fresh_path(spark, "decisions")
    keyed_decisions(consent, keys, allowed_sources, out).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def hot_keys(requests: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """Keys holding more than ``share`` of all request rows.  At most
    ``1 / share`` keys can qualify, so the result has a proven size bound."""
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    total = requests.agg(F.count(F.lit(1))).scalar()
    return (requests.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
            .where(F.col("__n") > total * F.lit(share))
            .select(*keys, F.lit(True).alias("__hot")))


def decide(requests: DataFrame, consent: DataFrame, keys: Sequence[str] = KEYS,
           allowed_sources: tuple[str, ...] = SEND_SOURCES, phone_col: str = "phone_number",
           out: str = "can_send_sms", hot_key_share: float | None = None,
           salt_buckets: int = 64, decisions: DataFrame | None = None) -> DataFrame:
    """Answer every request row; keeps the request columns, with the phone
    normalised (a bare 10-digit number gets the country prefix), and adds
    ``out`` (never NULL).

    ``decisions`` is a decision table to join (see :func:`decision_table`); by default
    the decisions are computed within the query.  Skew: a hot request key is split at run time by AQE's skew
    join.  With ``hot_key_share`` the split is explicit: keys above that share of all
    requests (a list of at most ``1 / hot_key_share`` rows, broadcast if that is no
    more than ``MAX_BROADCAST_HOT_KEYS``) are salted -- their request rows are spread
    over ``salt_buckets`` buckets by a row number, whatever columns they have, and their
    single decision row is replicated to each bucket; all other keys join unsalted."""
    keys = list(keys)
    req = requests.withColumn(phone_col, normalize_phone_input(phone_col))
    # coalesce to more partitions than there are moves nothing, but drops the aggregate's
    # partitioning: the join then shuffles both sides, and AQE may split either
    decided = decisions if decisions is not None else \
        keyed_decisions(consent, keys, allowed_sources, out).coalesce(ALL_PARTITIONS)
    if hot_key_share is None:
        joined = req.join(decided, on=keys, how="left")
    else:
        checkpoint_dir(req.sparkSession)
        hot = hot_keys(req, keys, hot_key_share).checkpoint()
        hot = F.broadcast(hot) if 1 / hot_key_share <= MAX_BROADCAST_HOT_KEYS else hot
        salt = F.pmod(F.monotonically_increasing_id(), F.lit(salt_buckets))
        req_s = (req.withColumn("__salt", salt).join(hot, on=keys, how="left")
                 .withColumn("__salt", F.when(F.col("__hot"), F.col("__salt")).otherwise(F.lit(0)))
                 .drop("__hot"))
        buckets = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salt_buckets - 1).cast("long")))
        dec_s = (decided.join(hot, on=keys, how="left")
                 .withColumn("__salt", F.explode(F.coalesce(buckets, F.array(F.lit(0).cast("long")))))
                 .drop("__hot"))
        joined = req_s.join(dec_s, on=[*keys, "__salt"], how="left")
    return (joined.withColumn(out, F.coalesce(F.col(out), F.lit(False)))
                  .select(*req.columns, out))


def lookup(spark: SparkSession, consent: DataFrame, account_number: str,
           phone_number: str) -> DataFrame:
    """One permission question as a one-row DataFrame.  The key equality is
    pushed into the scan of a parquet table (row groups whose min/max exclude
    the key are skipped; write the table sorted by key for that), and the
    rows found are reduced by one aggregate; there is no join."""
    phone = normalize_phone_input(F.lit(phone_number))
    narrowed = consent.where((F.col("account_number") == account_number) & (F.col("phone_number") == phone))
    return narrowed.agg(F.coalesce(F.bool_and(can_send_rule()), F.lit(False)).alias("can_send_sms")).select(
        F.lit(account_number).alias("account_number"), phone.alias("phone_number"), "can_send_sms")


def can_send_sms(spark: SparkSession, consent: DataFrame, account_number: str,
                 phone_number: str) -> bool:
    """Single question; the one-row case of :func:`decide`.  The lookup is a
    pushed-down equality filter, so only row groups that can hold the key are
    read."""
    row = lookup(spark, consent, account_number, phone_number).select("can_send_sms").first()
    return bool(row[0]) if row is not None else False


def denial_reason(consent: DataFrame, allowed_sources: tuple[str, ...] = SEND_SOURCES,
                  out: str = "reason") -> DataFrame:
    """First failing rule per row: not an allowed source, deleted, consent
    withdrawn, else ``can_send``."""
    reason = (F.when(~F.col("phone_source").isin(*allowed_sources), F.lit("not_client_source"))
              .when(F.col("is_deleted") == F.lit(True), F.lit("deleted"))
              .when(F.col("has_sms_consent") == F.lit(False), F.lit("consent_withdrawn"))
              .otherwise(F.lit("can_send")))
    return consent.withColumn(out, reason)
