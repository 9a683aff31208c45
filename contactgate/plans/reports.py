"""Validation reports over every layer, registered in the catalog.

Each report is one aggregate pass (``count_if`` for conditional counts).
Shares of a total are computed on the already-grouped rows (a handful of
categories), with exact integer half-up rounding to one decimal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactgate.functions.columns import NORMALIZED_PHONE_PATTERN, PHONE_PREFIX, can_send_rule, tri_state
from contactgate.operators.decide import denial_reason
from contactgate.operators.quality import (
    bad_rows, evaluate, row_count_positive, verdict,
)
from contactgate.plans.catalog import Layers, register
from contactgate.sources import schemas as S


def _count(name: str = "cnt") -> Column:
    return F.count(F.lit(1)).alias(name)


def with_share(grouped: DataFrame, cnt: str = "cnt", out: str = "pct") -> DataFrame:
    """Percent of the grouped total, half-up to one decimal (exact)."""
    total = F.sum(cnt).over(Window.partitionBy())
    tenths = F.expr(f"(2000 * {cnt} + __t) div (2 * __t)")
    return (grouped.withColumn("__t", total)
            .withColumn(out, tenths.cast("double") / 10).drop("__t"))


def _pct_sql(cnt: str = "cnt") -> str:
    return (f"CAST((2000 * {cnt} + sum({cnt}) OVER ()) // (2 * sum({cnt}) OVER ()) AS DOUBLE) / 10")


def _ci(cond: Column, name: str) -> Column:
    return F.count_if(cond).alias(name)


# ============================ delivered feeds =================================

def _tagged_dates(L: Layers) -> DataFrame:
    return (L.enrollment.select(F.lit("enrollment").alias("table_name"), "_file_date")
            .unionByName(L.nonfin.select(F.lit("nonfin").alias("table_name"), "_file_date"))
            .unionByName(L.supplfwd.select(F.lit("supplfwd").alias("table_name"), "_file_date")))


_TAGGED_SQL = """(SELECT 'enrollment' AS table_name, _file_date FROM enrollment
  UNION ALL SELECT 'nonfin', _file_date FROM nonfin
  UNION ALL SELECT 'supplfwd', _file_date FROM supplfwd)"""


@register("feed_coverage", f"""
SELECT table_name, count(*) AS row_count, min(_file_date) AS earliest, max(_file_date) AS latest,
       count(DISTINCT _file_date) AS distinct_dates
FROM {_TAGGED_SQL} t GROUP BY table_name""", "B10 U2 A4 A8")
def q_feed_coverage(spark, sf):
    return _tagged_dates(Layers(spark, sf)).groupBy("table_name").agg(
        _count("row_count"), F.min("_file_date").alias("earliest"),
        F.max("_file_date").alias("latest"),
        F.countDistinct("_file_date").alias("distinct_dates"))


@register("null_file_dates", f"""
SELECT table_name, count(*) FILTER (WHERE _file_date IS NULL) AS null_file_dates
FROM {_TAGGED_SQL} t GROUP BY table_name""", "A6 U2 Q1")
def q_null_file_dates(spark, sf):
    return _tagged_dates(Layers(spark, sf)).groupBy("table_name").agg(
        _ci(F.col("_file_date").isNull(), "null_file_dates"))


@register("null_counts_snapshot", """
SELECT count(*) FILTER (WHERE cnsmr_phn_nmbr_txt IS NULL) AS null_phone,
       count(*) FILTER (WHERE cnsmr_idntfr_lgcy_txt IS NULL) AS null_legacy_id,
       count(*) FILTER (WHERE cnsmr_phn_id IS NULL) AS null_phone_id
FROM nonfin""", "Q6 P8 A6")
def q_null_counts_snapshot(spark, sf):
    return Layers(spark, sf).nonfin.agg(
        _ci(F.col("cnsmr_phn_nmbr_txt").isNull(), "null_phone"),
        _ci(F.col("cnsmr_idntfr_lgcy_txt").isNull(), "null_legacy_id"),
        _ci(F.col("cnsmr_phn_id").isNull(), "null_phone_id"))


@register("null_counts_change", """
SELECT count(*) FILTER (WHERE cnsmr_phn_nmbr_txt IS NULL) AS null_phone,
       count(*) FILTER (WHERE cnsmr_idntfr_lgcy_txt IS NULL) AS null_legacy_id,
       count(*) FILTER (WHERE record_date IS NULL) AS null_record_date,
       count(*) FILTER (WHERE cnsmr_phn_sft_dlt_flg IS NULL) AS null_soft_delete_flag
FROM supplfwd""", "Q6 P8 A6")
def q_null_counts_change(spark, sf):
    return Layers(spark, sf).supplfwd.agg(
        _ci(F.col("cnsmr_phn_nmbr_txt").isNull(), "null_phone"),
        _ci(F.col("cnsmr_idntfr_lgcy_txt").isNull(), "null_legacy_id"),
        _ci(F.col("record_date").isNull(), "null_record_date"),
        _ci(F.col("cnsmr_phn_sft_dlt_flg").isNull(), "null_soft_delete_flag"))


@register("null_counts_enrollment", """
SELECT count(*) FILTER (WHERE phone_number IS NULL) AS null_phone,
       count(*) FILTER (WHERE consumer_legacy_identifier IS NULL) AS null_legacy_id,
       count(*) FILTER (WHERE enrollment_date IS NULL) AS null_enrollment_date
FROM enrollment""", "Q6 P8 A6")
def q_null_counts_enrollment(spark, sf):
    return Layers(spark, sf).enrollment.agg(
        _ci(F.col("phone_number").isNull(), "null_phone"),
        _ci(F.col("consumer_legacy_identifier").isNull(), "null_legacy_id"),
        _ci(F.col("enrollment_date").isNull(), "null_enrollment_date"))


def _dup_sql(table: str, a: str, b: str, total: str, dup: str) -> str:
    return f"""
SELECT count(*) AS {total},
       count(DISTINCT CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN ({a}, {b}) END) AS distinct_keys,
       count(*) - count(DISTINCT CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN ({a}, {b}) END)
         AS {dup}
FROM {table}"""


def _dups(df: DataFrame, a: str, b: str, total: str, dup: str) -> DataFrame:
    """Total rows vs distinct keys.  The distinct count is a two-level
    aggregate (key dedup first), so a hot key is collapsed map-side."""
    per_key = df.groupBy(a, b).agg(_count("n"))
    return per_key.agg(
        F.sum("n").cast("long").alias(total),
        F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull()).alias("distinct_keys"),
    ).select(F.coalesce(F.col(total), F.lit(0)).alias(total), "distinct_keys",
             (F.coalesce(F.col(total), F.lit(0)) - F.col("distinct_keys")).alias(dup))


@register("duplicate_keys_snapshot",
          _dup_sql("nonfin", "cnsmr_phn_id", "_file_date", "total_rows", "duplicate_rows"), "A5 A10")
def q_duplicate_keys_snapshot(spark, sf):
    return _dups(Layers(spark, sf).nonfin, "cnsmr_phn_id", "_file_date", "total_rows",
                 "duplicate_rows")


@register("snapshot_source_counts", """
SELECT cnsmr_phn_src_val_txt AS phone_source, count(*) AS cnt FROM nonfin
GROUP BY cnsmr_phn_src_val_txt""", "A4 S1")
def q_snapshot_source_counts(spark, sf):
    return (Layers(spark, sf).nonfin.groupBy(F.col("cnsmr_phn_src_val_txt").alias("phone_source"))
            .agg(_count()).orderBy(F.desc("cnt")))


@register("format_check_phone", """
SELECT count(*) AS total,
       count(*) FILTER (WHERE regexp_matches(cnsmr_phn_nmbr_txt, '^[0-9]{10}$')) AS valid_10_digit,
       count(*) FILTER (WHERE NOT regexp_matches(cnsmr_phn_nmbr_txt, '^[0-9]{10}$')) AS invalid_format
FROM nonfin""", "P7 A6")
def q_format_check_phone(spark, sf):
    ok = F.col("cnsmr_phn_nmbr_txt").rlike(r"^[0-9]{10}$")
    return Layers(spark, sf).nonfin.agg(_count("total"), _ci(ok, "valid_10_digit"),
                                        _ci(~ok, "invalid_format"))


# ================================ state =======================================

@register("duplicate_keys_state",
          _dup_sql("silver", "account_number", "phone_number", "total_rows", "duplicates"), "A5")
def q_duplicate_keys_state(spark, sf):
    return _dups(Layers(spark, sf).state, "account_number", "phone_number", "total_rows",
                 "duplicates")


@register("format_check_account", """
SELECT sum(n)::BIGINT AS total, coalesce(sum(n) FILTER (ok), 0)::BIGINT AS valid_format,
       coalesce(sum(n) FILTER (NOT ok), 0)::BIGINT AS bad_format
FROM (SELECT regexp_full_match(account_number, '[0-9]{16}') AS ok, count(*) AS n FROM silver GROUP BY ok) by_form""", "P7 F1 A6")
def q_format_check_account(spark, sf):
    ok = F.col("account_number").rlike("^[0-9]{16}$")
    return Layers(spark, sf).state.agg(_count("total"), _ci(ok, "valid_format"), _ci(~ok, "bad_format"))


@register("delete_consistency", """
SELECT coalesce(sum(n) FILTER (gone AND NOT typed), 0)::BIGINT AS deleted_missing_type,
       coalesce(sum(n) FILTER (NOT gone AND typed), 0)::BIGINT AS not_deleted_has_type,
       coalesce(sum(n) FILTER (NOT gone AND dated), 0)::BIGINT AS has_date_not_deleted,
       coalesce(sum(n) FILTER (gone AND NOT dated), 0)::BIGINT AS deleted_missing_date
FROM (SELECT is_deleted AS gone, delete_type IS NOT NULL AS typed, deleted_at IS NOT NULL AS dated, count(*) AS n
      FROM silver GROUP BY ALL) by_status""", "Q5 A6")
def q_delete_consistency(spark, sf):
    gone, typed, dated = F.col("is_deleted"), F.col("delete_type").isNotNull(), F.col("deleted_at").isNotNull()
    return Layers(spark, sf).state.agg(
        _ci(gone & ~typed, "deleted_missing_type"), _ci(~gone & typed, "not_deleted_has_type"),
        _ci(~gone & dated, "has_date_not_deleted"), _ci(gone & ~dated, "deleted_missing_date"))


@register("delete_summary", """
SELECT is_deleted, delete_type, count(*) AS cnt FROM silver GROUP BY is_deleted, delete_type""",
          "A4 S1")
def q_delete_summary(spark, sf):
    return Layers(spark, sf).state.groupBy("is_deleted", "delete_type").agg(_count()) \
        .orderBy("is_deleted", "delete_type")


@register("record_source_share", f"""
SELECT record_source, count(*) AS cnt, {_pct_sql()} AS pct FROM silver GROUP BY record_source""",
          "A9 W7 F9 S1")
def q_record_source_share(spark, sf):
    return with_share(Layers(spark, sf).state.groupBy("record_source").agg(_count())).orderBy(F.desc("cnt"))


@register("phone_source_share", f"""
SELECT phone_source, count(*) AS cnt, {_pct_sql()} AS pct FROM silver GROUP BY phone_source""",
          "A9 W7")
def q_phone_source_share(spark, sf):
    return with_share(Layers(spark, sf).state.groupBy("phone_source").agg(_count())).orderBy(F.desc("cnt"))


def _shared(state: DataFrame) -> DataFrame:
    return (state.groupBy("phone_number")
            .agg(F.countDistinct("account_number").alias("num_accounts"))
            .where(F.col("num_accounts") > 1))


@register("top_shared_entities", """
SELECT phone_number, count(DISTINCT account_number) AS num_accounts FROM silver
GROUP BY phone_number HAVING count(DISTINCT account_number) > 1
ORDER BY num_accounts DESC, phone_number LIMIT 10""", "A7 S2")
def q_top_shared_entities(spark, sf):
    return _shared(Layers(spark, sf).state).orderBy(F.desc("num_accounts"), "phone_number").limit(10)


@register("shared_entity_sample", """
WITH spread AS (SELECT phone_number, min(account_number) AS low, max(account_number) AS high
                FROM silver GROUP BY ALL),
pick AS (SELECT min(phone_number) AS phone_number FROM spread WHERE low < high)
SELECT s.account_number, pick.phone_number, s.is_deleted, s.delete_type, s.consent_flag, s.phone_source
FROM pick JOIN silver s USING (phone_number)""", "J7")
def q_shared_entity_sample(spark, sf):
    st = Layers(spark, sf).state
    first = _shared(st).agg(F.min("phone_number")).scalar()
    return st.where(F.col("phone_number") == first).select(
        "account_number", "phone_number", "is_deleted", "delete_type", "consent_flag",
        "phone_source").orderBy("account_number")


def _flagged_phones(L: Layers) -> DataFrame:
    """Distinct, so that a phone flagged in a great many records is one row."""
    return (L.supplfwd.where(F.col("cnsmr_phn_sft_dlt_flg") == "Y")
            .select(F.col("cnsmr_phn_nmbr_txt").alias("phone_number")).distinct())


@register("readded_entities", """
WITH flagged AS (SELECT DISTINCT cnsmr_phn_nmbr_txt AS phone_number FROM supplfwd
                 WHERE cnsmr_phn_sft_dlt_flg = 'Y'),
live AS (SELECT phone_number, count(*) AS n FROM silver
         WHERE NOT is_deleted AND record_source = 'NON-FIN' GROUP BY phone_number)
SELECT COALESCE(sum(n), 0)::BIGINT AS readded_count FROM live JOIN flagged USING (phone_number)""", "J6 C2")
def q_readded_entities(spark, sf):
    L = Layers(spark, sf)
    live = L.state.where((F.col("record_source") == S.SRC_SNAPSHOT) & ~F.col("is_deleted"))
    return live.join(_flagged_phones(L), "phone_number", "left_semi").agg(_count("readded_count"))


@register("readded_entities_by_key", """
SELECT count(*) AS readded_count FROM silver s
WHERE record_source = 'NON-FIN' AND is_deleted = false
  AND EXISTS (SELECT 1 FROM supplfwd c WHERE c.cnsmr_phn_sft_dlt_flg = 'Y'
              AND c.cnsmr_idntfr_lgcy_txt = s.legacy_identifier
              AND c.cnsmr_phn_nmbr_txt = s.phone_number)""", "J6 C2 D17")
def q_readded_entities_by_key(spark, sf):
    L = Layers(spark, sf)
    live = L.state.where((F.col("record_source") == S.SRC_SNAPSHOT) & ~F.col("is_deleted"))
    flagged = (L.supplfwd.where(F.col("cnsmr_phn_sft_dlt_flg") == "Y")
               .select(F.col("cnsmr_idntfr_lgcy_txt").alias("legacy_identifier"),
                       F.col("cnsmr_phn_nmbr_txt").alias("phone_number")))
    return live.join(flagged, ["legacy_identifier", "phone_number"], "left_semi") \
        .agg(_count("readded_count"))


@register("consent_summary", """
SELECT consent_flag, count(*) AS cnt FROM silver GROUP BY consent_flag""", "A4 S1")
def q_consent_summary(spark, sf):
    return Layers(spark, sf).state.groupBy("consent_flag").agg(_count()).orderBy(F.desc("cnt"))


@register("consent_date_profile", """
SELECT min(consent_date) AS earliest_consent, max(consent_date) AS latest_consent,
       count(*) AS records_with_consent_date
FROM silver WHERE consent_date IS NOT NULL""", "A8")
def q_consent_date_profile(spark, sf):
    return Layers(spark, sf).state.where(F.col("consent_date").isNotNull()).agg(
        F.min("consent_date").alias("earliest_consent"),
        F.max("consent_date").alias("latest_consent"), _count("records_with_consent_date"))


@register("change_winner_count", """
SELECT count(*) AS supplfwd_wins FROM silver WHERE record_source = 'SUPPLFWD'""", "A4 W5")
def q_change_winner_count(spark, sf):
    return Layers(spark, sf).state.where(F.col("record_source") == S.SRC_CHANGE) \
        .agg(_count("supplfwd_wins"))


@register("change_winner_nulls", """
SELECT count(*) FILTER (WHERE phone_source IS NULL) AS null_source,
       count(*) FILTER (WHERE phone_number IS NULL) AS null_phone,
       count(*) FILTER (WHERE event_date IS NULL) AS null_event_date
FROM silver WHERE record_source = 'SUPPLFWD'""", "A6 Q6")
def q_change_winner_nulls(spark, sf):
    return Layers(spark, sf).state.where(F.col("record_source") == S.SRC_CHANGE).agg(
        _ci(F.col("phone_source").isNull(), "null_source"),
        _ci(F.col("phone_number").isNull(), "null_phone"),
        _ci(F.col("event_date").isNull(), "null_event_date"))


@register("layer_row_parity", """
SELECT (SELECT count(*) FROM nonfin) AS bronze_nonfin_rows,
       (SELECT count(*) FROM silver) AS silver_rows,
       (SELECT count(*) FROM gold) AS gold_rows""", "A12 Q7")
def q_layer_row_parity(spark, sf):
    L = Layers(spark, sf)
    n = L.nonfin.agg(_count("bronze_nonfin_rows"))
    s = L.state.agg(_count("silver_rows"))
    g = L.consent.agg(_count("gold_rows"))
    return n.select("bronze_nonfin_rows", s.scalar().alias("silver_rows"),
                    g.scalar().alias("gold_rows"))


@register("hard_delete_profile", """
SELECT min(deleted_at) AS earliest_hard_delete, max(deleted_at) AS latest_hard_delete,
       count(*) AS hard_delete_count, (SELECT max(_file_date) FROM nonfin) AS latest_snapshot_date
FROM silver WHERE delete_type = 'hard_delete'""", "A8 A3")
def q_hard_delete_profile(spark, sf):
    L = Layers(spark, sf)
    latest = L.nonfin.agg(F.max("_file_date")).scalar()
    return L.state.where(F.col("delete_type") == S.HARD_DELETE).agg(
        F.min("deleted_at").alias("earliest_hard_delete"),
        F.max("deleted_at").alias("latest_hard_delete"), _count("hard_delete_count"),
    ).select("*", latest.alias("latest_snapshot_date"))


@register("hard_deleted_in_latest", """
WITH newest AS (
  SELECT DISTINCT cnsmr_idntfr_lgcy_txt AS legacy_identifier, cnsmr_phn_nmbr_txt AS phone_number
  FROM (FROM nonfin QUALIFY dense_rank() OVER (ORDER BY _file_date DESC) = 1) n)
SELECT count(newest.phone_number) AS hard_deleted_in_latest
FROM silver LEFT JOIN newest USING (legacy_identifier, phone_number)
WHERE silver.delete_type = 'hard_delete'""", "J8")
def q_hard_deleted_in_latest(spark, sf):
    L = Layers(spark, sf)
    latest = L.nonfin.agg(F.max("_file_date")).scalar()
    in_latest = (L.nonfin.where(F.col("_file_date") == latest)
                 .select(F.col("cnsmr_idntfr_lgcy_txt").alias("legacy_identifier"),
                         F.col("cnsmr_phn_nmbr_txt").alias("phone_number")))
    return (L.state.where(F.col("delete_type") == S.HARD_DELETE)
            .join(in_latest, ["legacy_identifier", "phone_number"], "left_semi")
            .agg(_count("hard_deleted_in_latest")))


@register("soft_delete_sources", """
SELECT record_source, count(*) AS cnt FROM silver WHERE delete_type = 'soft_delete'
GROUP BY record_source""", "A4 C1")
def q_soft_delete_sources(spark, sf):
    return Layers(spark, sf).state.where(F.col("delete_type") == S.SOFT_DELETE) \
        .groupBy("record_source").agg(_count())


@register("change_soft_delete_keys", """
SELECT count(DISTINCT CASE WHEN cnsmr_idntfr_lgcy_txt IS NOT NULL AND cnsmr_phn_nmbr_txt IS NOT NULL
                           THEN (cnsmr_idntfr_lgcy_txt, cnsmr_phn_nmbr_txt) END) AS supplfwd_soft_deletes
FROM supplfwd WHERE cnsmr_phn_sft_dlt_flg = 'Y'""", "A5 C1")
def q_change_soft_delete_keys(spark, sf):
    return Layers(spark, sf).supplfwd.where(F.col("cnsmr_phn_sft_dlt_flg") == "Y").agg(
        F.countDistinct("cnsmr_idntfr_lgcy_txt", "cnsmr_phn_nmbr_txt").alias("supplfwd_soft_deletes"))


# =============================== consent ======================================

@register("duplicate_keys_consent",
          _dup_sql("gold", "account_number", "phone_number", "total_rows", "duplicates"), "A5")
def q_duplicate_keys_consent(spark, sf):
    return _dups(Layers(spark, sf).consent, "account_number", "phone_number", "total_rows",
                 "duplicates")


@register("format_check_consent_phone", r"""
SELECT count(*) AS total,
       count(*) FILTER (WHERE regexp_matches(phone_number, '^\+1[0-9]{10}$')) AS valid_format,
       count(*) FILTER (WHERE NOT regexp_matches(phone_number, '^\+1[0-9]{10}$')) AS bad_format
FROM gold""", "P7")
def q_format_check_consent_phone(spark, sf):
    ok = F.col("phone_number").rlike(r"^\+1[0-9]{10}$")
    return Layers(spark, sf).consent.agg(_count("total"), _ci(ok, "valid_format"),
                                         _ci(~ok, "bad_format"))


@register("published_prefix", """
SELECT count(*) AS total, count(*) FILTER (WHERE left(phone_number, 2) = '+1') AS with_prefix,
       count(*) FILTER (WHERE left(phone_number, 2) <> '+1') AS without_prefix
FROM gold""", "P10")
def q_published_prefix(spark, sf):
    """Published numbers by whether they carry the country code."""
    has = F.col("phone_number").startswith(PHONE_PREFIX)
    return Layers(spark, sf).consent.agg(_count("total"), _ci(has, "with_prefix"), _ci(~has, "without_prefix"))


@register("consent_share", f"""
SELECT has_sms_consent, count(*) AS cnt, {_pct_sql()} AS pct FROM gold GROUP BY has_sms_consent
ORDER BY has_sms_consent NULLS FIRST""", "A9 S1")
def q_consent_share(spark, sf):
    return with_share(Layers(spark, sf).consent.groupBy("has_sms_consent").agg(_count())).orderBy("has_sms_consent")


@register("consent_delete_summary", """
SELECT is_deleted, delete_type, count(*) AS cnt FROM gold GROUP BY is_deleted, delete_type
ORDER BY is_deleted, delete_type NULLS FIRST""", "A4 S1")
def q_consent_delete_summary(spark, sf):
    return Layers(spark, sf).consent.groupBy("is_deleted", "delete_type").agg(_count()).orderBy("is_deleted", "delete_type")


@register("consent_delete_consistency", """
SELECT count(*) FILTER (WHERE is_deleted = true AND delete_type IS NULL) AS deleted_missing_type,
       count(*) FILTER (WHERE is_deleted = false AND delete_type IS NOT NULL) AS not_deleted_has_type
FROM gold""", "Q5 A6")
def q_consent_delete_consistency(spark, sf):
    d = F.col("is_deleted")
    return Layers(spark, sf).consent.agg(
        _ci(d & F.col("delete_type").isNull(), "deleted_missing_type"),
        _ci(~d & F.col("delete_type").isNotNull(), "not_deleted_has_type"))


_DECISION_SQL = """if(COALESCE(phone_source, '-') = 'CLIENT' AND is_deleted IS FALSE
              AND has_sms_consent IS DISTINCT FROM false, 'CAN_SEND', 'CANNOT_SEND')"""


def _decision() -> Column:
    return F.when(can_send_rule(), F.lit("CAN_SEND")).otherwise(F.lit("CANNOT_SEND"))


@register("decision_breakdown", f"""
SELECT {_DECISION_SQL} AS sms_decision, count(*) AS cnt, {_pct_sql()} AS pct
FROM gold GROUP BY 1""", "C6 A9 A11")
def q_decision_breakdown(spark, sf):
    return with_share(Layers(spark, sf).consent.groupBy(_decision().alias("sms_decision"))
                      .agg(_count()))


@register("denial_reasons", f"""
SELECT COALESCE(if(phone_source <> 'CLIENT', 'not_client_source', NULL), if(is_deleted, 'deleted', NULL),
                if(has_sms_consent IS FALSE, 'consent_withdrawn', NULL), 'can_send') AS reason,
       count(*) AS cnt, {_pct_sql()} AS pct
FROM gold GROUP BY ALL""", "C7 A9 A11")
def q_denial_reasons(spark, sf):
    return with_share(denial_reason(Layers(spark, sf).consent).groupBy("reason").agg(_count())) \
        .orderBy(F.desc("cnt"))


@register("shared_entity_divergence", """
SELECT phone_number, count(DISTINCT account_number) AS num_accounts,
       min(phone_source) <> max(phone_source) AS sources_differ,
       min(is_deleted) <> max(is_deleted) AS delete_states_differ,
       min(account_number) AS first_account, max(account_number) AS last_account
FROM gold GROUP BY phone_number
HAVING count(DISTINCT account_number) > 1
   AND (min(phone_source) <> max(phone_source) OR min(is_deleted) <> max(is_deleted))""", "J4")
def q_shared_entity_divergence(spark, sf):
    """Phones whose accounts disagree on source or delete status.  One
    aggregate per phone instead of an account-pair self join, so a phone on
    a third of all accounts costs one group, not a quadratic pair list.
    "More than one distinct value" is tested as min <> max, which leaves a
    single distinct aggregate (no row expansion)."""
    g = Layers(spark, sf).consent
    return (g.groupBy("phone_number").agg(
        F.countDistinct("account_number").alias("num_accounts"),
        (F.min("phone_source") != F.max("phone_source")).alias("sources_differ"),
        (F.min("is_deleted") != F.max("is_deleted")).alias("delete_states_differ"),
        F.min("account_number").alias("first_account"),
        F.max("account_number").alias("last_account"))
        .where((F.col("num_accounts") > 1)
               & (F.col("sources_differ") | F.col("delete_states_differ"))))


@register("readded_phones", """
WITH flagged AS (SELECT '+1' || cnsmr_phn_nmbr_txt AS phone_number, count(*) AS n FROM supplfwd
                 WHERE cnsmr_phn_sft_dlt_flg = 'Y' GROUP BY ALL)
SELECT count(*) FILTER (WHERE f.n > 0) AS readded_phones
FROM (FROM gold WHERE NOT is_deleted) live LEFT JOIN flagged f USING (phone_number)""", "J6 C2")
def q_readded_phones(spark, sf):
    L = Layers(spark, sf)
    flagged = _flagged_phones(L).select(F.concat(F.lit("+1"), "phone_number").alias("phone_number"))
    return L.consent.where(~F.col("is_deleted")).join(flagged, "phone_number", "left_semi") \
        .agg(_count("readded_phones"))


@register("compliance_boundaries", """
SELECT coalesce(sum(n) FILTER (live AND client AND said = 'no'), 0)::BIGINT AS consent_withdrawn,
       coalesce(sum(n) FILTER (live AND client AND said = 'no' AND sends), 0)::BIGINT AS withdrawn_can_send,
       coalesce(sum(n) FILTER (live AND client AND said = 'nothing' AND sends), 0)::BIGINT AS null_consent_can_send,
       coalesce(sum(n) FILTER (live AND client AND said = 'nothing' AND NOT sends), 0)::BIGINT AS null_consent_cannot_send,
       coalesce(sum(n) FILTER (live AND NOT client AND said <> 'no'), 0)::BIGINT AS non_client_sendable,
       coalesce(sum(n) FILTER (NOT live AND client AND said <> 'no'), 0)::BIGINT AS deleted_would_send
FROM (SELECT *, live AND coalesce(client, false) AND said <> 'no' AS sends
      FROM (SELECT NOT is_deleted AS live, phone_source = 'CLIENT' AS client,
                   CASE has_sms_consent WHEN true THEN 'yes' WHEN false THEN 'no' ELSE 'nothing' END AS said, count(*) AS n
            FROM gold GROUP BY ALL) grouped) g""", "C8 A11")
def q_compliance_boundaries(spark, sf):
    """Counts over one grouped table of (deleted, client, consent, decision)."""
    said = F.when(F.col("has_sms_consent"), "yes").when(~F.col("has_sms_consent"), "no").otherwise("nothing")
    g = Layers(spark, sf).consent.groupBy(
        (~F.col("is_deleted")).alias("live"), (F.col("phone_source") == "CLIENT").alias("client"), said.alias("said"),
        can_send_rule().alias("sends")).agg(_count("n"))
    live, client, sends, said = (F.col(c) for c in ("live", "client", "sends", "said"))

    def rows(condition, name):
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long").alias(name)
    return g.agg(
        rows(live & client & (said == "no"), "consent_withdrawn"),
        rows(live & client & (said == "no") & sends, "withdrawn_can_send"),
        rows(live & client & (said == "nothing") & sends, "null_consent_can_send"),
        rows(live & client & (said == "nothing") & ~sends, "null_consent_cannot_send"),
        rows(live & ~client & (said != "no"), "non_client_sendable"),
        rows(~live & client & (said != "no"), "deleted_would_send"))


@register("consent_null_share", """
SELECT count(*) FILTER (WHERE has_sms_consent IS NULL) AS null_consent,
       count(*) FILTER (WHERE has_sms_consent IS NOT NULL) AS explicit_consent,
       CAST((2000 * count(*) FILTER (WHERE has_sms_consent IS NULL) + count(*)) // (2 * count(*))
            AS DOUBLE) / 10 AS null_pct
FROM gold""", "A6 A9")
def q_consent_null_share(spark, sf):
    c = F.col("has_sms_consent")
    agg = Layers(spark, sf).consent.agg(_ci(c.isNull(), "null_consent"),
                                        _ci(c.isNotNull(), "explicit_consent"), _count("__n"))
    pct = F.expr("(2000 * null_consent + __n) div (2 * __n)").cast("double") / 10
    return agg.select("null_consent", "explicit_consent", pct.alias("null_pct"))


@register("winner_source_profile", """
WITH won AS (SELECT account_number, '+1' || phone_number AS phone_number, count(*) AS n
             FROM silver WHERE record_source = 'SUPPLFWD' GROUP BY ALL)
SELECT phone_source, has_sms_consent, is_deleted, sum(n)::BIGINT AS cnt
FROM won JOIN gold USING (account_number, phone_number)
GROUP BY ALL""", "J5 A4 S1 D16")
def q_winner_source_profile(spark, sf):
    """Published rows of the keys that a change record won.  The consent columns are made
    of the state's own rows, so the state is planned once: rows are counted per key and
    published values, and each count is weighted by the key's change winners."""
    state = Layers(spark, sf).state
    rows = state.select(
        "account_number", "phone_number", "phone_source", tri_state("consent_flag").alias("has_sms_consent"),
        "is_deleted", (F.col("record_source") == S.SRC_CHANGE).cast("long").alias("won"))
    key = ["account_number", "phone_number"]
    counted = rows.groupBy(*key, "phone_source", "has_sms_consent", "is_deleted").agg(
        _count("n"), F.sum("won").alias("won"))
    weighted = counted.withColumn("won", F.sum("won").over(Window.partitionBy(*key)))
    complete = F.col("account_number").isNotNull() & F.col("phone_number").isNotNull()
    return (weighted.where(complete & (F.col("won") > 0))
            .groupBy("phone_source", "has_sms_consent", "is_deleted")
            .agg(F.sum(F.col("n") * F.col("won")).alias("cnt")).orderBy(F.desc("cnt")))


@register("decision_sample", f"""
SELECT account_number, phone_number, phone_source, is_deleted, delete_type, has_sms_consent,
       sms_consent_updated_at,
       CASE WHEN {_DECISION_SQL} = 'CAN_SEND' THEN true ELSE false END AS can_send_sms
FROM gold ORDER BY account_number, phone_number LIMIT 20""", "C6 S2 S3")
def q_decision_sample(spark, sf):
    return (Layers(spark, sf).consent.select(
        "account_number", "phone_number", "phone_source", "is_deleted", "delete_type",
        "has_sms_consent", "sms_consent_updated_at", can_send_rule().alias("can_send_sms"))
        .orderBy("account_number", "phone_number").limit(20))


@register("source_ratio", """
SELECT CAST(count(*) FILTER (WHERE phone_source = 'CLIENT') AS DOUBLE) / count(*) AS client_ratio
FROM gold""", "A13")
def q_source_ratio(spark, sf):
    g = Layers(spark, sf).consent
    return g.agg((F.count_if(F.col("phone_source") == "CLIENT").cast("double")
                  / F.count(F.lit(1))).alias("client_ratio"))


# =============================== quality ======================================

def bronze_checks(df: DataFrame, source: str):
    return [row_count_positive(f"{source}_row_count_positive"),
            bad_rows(f"{source}_no_null_file_dates", F.col("_file_date").isNull())]


def state_checks():
    return [
        Check_dups("silver_no_duplicate_account_phone"),
        bad_rows("silver_no_null_accounts", F.col("account_number").isNull()),
    ]


def Check_dups(name: str):
    from contactgate.operators.quality import Check
    # rows minus distinct keys, evaluated on the per-key pre-aggregate
    return Check(name, F.sum(F.col("__n") - 1), "eq0")


def consent_checks():
    return [
        bad_rows("gold_phones_normalized",
                 F.coalesce(~F.col("phone_number").rlike(NORMALIZED_PHONE_PATTERN), F.lit(True))),
        bad_rows("gold_valid_phone_sources",
                 F.coalesce(~F.col("phone_source").isin(*S.PHONE_SOURCES), F.lit(True))),
        bad_rows("gold_valid_delete_types",
                 F.col("delete_type").isNotNull() & ~F.col("delete_type").isin(*S.DELETE_TYPES)),
    ]


def _quality_sql(rows: list[tuple[str, str, str]]) -> str:
    parts = [f"SELECT '{n}' AS name, CAST(({obs}) AS BIGINT) AS observed, '{exp}' AS expected"
             for n, obs, exp in rows]
    body = "\nUNION ALL ".join(parts)
    return f"""
SELECT name, COALESCE(CASE WHEN expected = 'eq0' THEN observed = 0 ELSE observed > 0 END, false)
         AS passed, observed, expected
FROM ({body}) q"""


def _bronze_sql_rows():
    out = []
    for t in ("nonfin", "supplfwd", "enrollment"):
        out.append((f"{t}_row_count_positive", f"SELECT count(*) FROM {t}", "gt0"))
        out.append((f"{t}_no_null_file_dates",
                    f"SELECT count(*) FILTER (WHERE _file_date IS NULL) FROM {t}", "eq0"))
    return out


@register("quality_bronze", _quality_sql(_bronze_sql_rows()), "Q1")
def q_quality_bronze(spark, sf):
    L = Layers(spark, sf)
    res = None
    for name, df in (("nonfin", L.nonfin), ("supplfwd", L.supplfwd), ("enrollment", L.enrollment)):
        r = evaluate(df, bronze_checks(df, name))
        res = r if res is None else res.unionByName(r)
    return res


_SILVER_Q = [
    ("silver_no_duplicate_account_phone",
     "SELECT count(*) - count(DISTINCT (account_number, phone_number)) FROM silver", "eq0"),
    ("silver_no_null_accounts",
     "SELECT count(*) FILTER (WHERE account_number IS NULL) FROM silver", "eq0"),
]


def silver_quality(state: DataFrame) -> DataFrame:
    """Key uniqueness via a per-key pre-aggregate (collapses hot keys), then
    all checks in one aggregate over the per-key rows."""
    per_key = state.groupBy("account_number", "phone_number").agg(F.count(F.lit(1)).alias("__n"))
    dup = evaluate(per_key, [Check_dups("silver_no_duplicate_account_phone")])
    nulls = evaluate(state, [bad_rows("silver_no_null_accounts", F.col("account_number").isNull())])
    return dup.unionByName(nulls)


@register("quality_silver", _quality_sql(_SILVER_Q), "Q2 Q7")
def q_quality_silver(spark, sf):
    return silver_quality(Layers(spark, sf).state)


_GOLD_Q = [
    ("gold_phones_normalized",
     r"SELECT count(*) FILTER (WHERE COALESCE(NOT regexp_matches(phone_number, '^\+1\d{10}$'), true)) FROM gold",
     "eq0"),
    ("gold_valid_phone_sources",
     "SELECT count(*) FILTER (WHERE COALESCE(phone_source NOT IN ('CLIENT', 'CONSUMER', 'THIRD_PARTY', 'OTHER'), true)) FROM gold",
     "eq0"),
    ("gold_valid_delete_types",
     "SELECT count(*) FILTER (WHERE delete_type IS NOT NULL AND delete_type NOT IN ('hard_delete', 'soft_delete')) FROM gold",
     "eq0"),
]


@register("quality_gold", _quality_sql(_GOLD_Q), "Q3 P9 D13")
def q_quality_gold(spark, sf):
    return evaluate(Layers(spark, sf).consent, consent_checks())


def feed_checks(nonfin: DataFrame, supplfwd: DataFrame, enrollment: DataFrame) -> DataFrame:
    """Bronze checks of all three feeds in one job over their tagged union."""
    feeds = (nonfin.select(F.lit("nonfin").alias("__src"), "_file_date")
             .unionByName(supplfwd.select(F.lit("supplfwd").alias("__src"), "_file_date"))
             .unionByName(enrollment.select(F.lit("enrollment").alias("__src"), "_file_date")))
    from contactgate.operators.quality import Check
    checks = []
    for t in ("nonfin", "supplfwd", "enrollment"):
        mine = F.col("__src") == t
        checks.append(Check(f"{t}_row_count_positive", F.count_if(mine), "gt0"))
        checks.append(Check(f"{t}_no_null_file_dates",
                            F.count_if(mine & F.col("_file_date").isNull()), "eq0"))
    return evaluate(feeds, checks)


def feed_quality(nonfin: DataFrame, supplfwd: DataFrame, enrollment: DataFrame) -> DataFrame:
    """What the gate on the feeds asks: the bronze checks, and that the newest
    snapshot is not a partial one."""
    from contactgate.plans.phone_state import dedup_snapshot
    return feed_checks(nonfin, supplfwd, enrollment).unionByName(
        snapshot_drop_check(dedup_snapshot(nonfin)))


def state_gate(state: DataFrame) -> DataFrame:
    """What the gate on the state asks: rows, unique keys, accounts."""
    from contactgate.operators.quality import Check
    per_key = state.groupBy("account_number", "phone_number").agg(F.count(F.lit(1)).alias("__n"))
    return evaluate(per_key, [
        Check("silver_row_count_positive", F.sum("__n"), "gt0"),
        Check_dups("silver_no_duplicate_account_phone"),
        Check("silver_no_null_accounts", F.sum(F.when(F.col("account_number").isNull(), F.col("__n"))), "eq0")])


def consent_row_checks(state_rows: int | None = None) -> list:
    """Checks of the published table that are counted row by row: rows, delete columns that
    agree with each other and, given the state's rows, as many as it has."""
    from contactgate.operators.quality import Check
    deleted, kind = F.col("is_deleted"), F.col("delete_type")
    own = [row_count_positive("gold_row_count_positive"),
           bad_rows("gold_deleted_has_type", deleted & kind.isNull()),
           bad_rows("gold_live_has_no_type", ~deleted & kind.isNotNull())]
    if state_rows is not None:
        own.append(Check("gold_row_count_as_silver", F.abs(F.count(F.lit(1)) - F.lit(state_rows)), "eq0"))
    return own


def consent_gate(consent: DataFrame, state: DataFrame | None = None, seen: DataFrame | None = None) -> DataFrame:
    """What the gate on the published table asks: the row checks (``seen``: their results, if
    they were counted while the table was written) and the published checks."""
    if seen is None:
        seen = evaluate(consent, consent_row_checks(state.count() if state is not None else None))
    return seen.unionByName(published_quality(consent))


def published_quality(consent: DataFrame) -> DataFrame:
    """State and consent checks in one pass: one per-key pre-aggregate of the
    consent table (collapses hot keys map-side), then one aggregate over it.
    The consent key is the state key with an injective phone prefix, so key
    uniqueness and non-null accounts hold for both layers alike."""
    from contactgate.operators.quality import Check
    bad_phone = F.coalesce(~F.col("phone_number").rlike(NORMALIZED_PHONE_PATTERN), F.lit(True))
    bad_source = F.coalesce(~F.col("phone_source").isin(*S.PHONE_SOURCES), F.lit(True))
    bad_type = F.col("delete_type").isNotNull() & ~F.col("delete_type").isin(*S.DELETE_TYPES)
    per_key = consent.groupBy("account_number", "phone_number").agg(
        F.count(F.lit(1)).alias("__n"), F.count_if(bad_phone).alias("__bp"),
        F.count_if(bad_source).alias("__bs"), F.count_if(bad_type).alias("__bt"))
    return evaluate(per_key, [
        Check("silver_no_duplicate_account_phone", F.sum(F.col("__n") - 1), "eq0"),
        Check("silver_no_null_accounts",
              F.sum(F.when(F.col("account_number").isNull(), F.col("__n"))), "eq0"),
        Check("gold_phones_normalized", F.sum("__bp"), "eq0"),
        Check("gold_valid_phone_sources", F.sum("__bs"), "eq0"),
        Check("gold_valid_delete_types", F.sum("__bt"), "eq0"),
    ])


@register("quality_verdict", f"""
SELECT COALESCE(bool_and(passed), false) AS all_passed,
       count(*) FILTER (WHERE NOT passed) AS failed
FROM ({_quality_sql(_bronze_sql_rows() + _SILVER_Q + _GOLD_Q)}) r""", "Q4")
def q_quality_verdict(spark, sf):
    L = Layers(spark, sf)
    return verdict(feed_checks(L.nonfin, L.supplfwd, L.enrollment).unionByName(published_quality(L.consent)))


@register("quality_published", _quality_sql(_SILVER_Q + _GOLD_Q), "Q2 Q3 Q7")
def q_quality_published(spark, sf):
    return published_quality(Layers(spark, sf).consent)


# =============================== history ======================================

@register("consent_withdrawals", """
SELECT s.legacy_identifier, s.phone_number, s.consent_flag, s.consent_date,
       h.last_yes_date, h.last_no_date, s.event_date, s.record_source,
       CASE WHEN s.consent_flag = 'N' AND h.last_yes_date IS NOT NULL THEN 'withdrawn'
            WHEN (s.consent_flag IS NULL OR s.consent_flag = '') AND h.last_no_date IS NOT NULL
              THEN 'erased' END AS consent_change
FROM silver s JOIN (
  SELECT legacy_identifier, phone_number,
         max(event_date) FILTER (WHERE consent_flag = 'Y') AS last_yes_date,
         max(event_date) FILTER (WHERE consent_flag = 'N') AS last_no_date
  FROM (SELECT cnsmr_idntfr_lgcy_txt AS legacy_identifier, cnsmr_phn_nmbr_txt AS phone_number,
               cnsmr_phn_cnsnt_flg AS consent_flag, _file_date AS event_date FROM nf_dedup
        UNION ALL
        SELECT cnsmr_idntfr_lgcy_txt, cnsmr_phn_nmbr_txt, cnsmr_phn_cnsnt_flg,
               CAST(try_strptime(record_date, '%Y-%m-%d') AS DATE) FROM sf_dedup) e
  GROUP BY 1, 2) h
  ON s.legacy_identifier = h.legacy_identifier AND s.phone_number = h.phone_number
WHERE (s.consent_flag = 'N' AND h.last_yes_date IS NOT NULL)
   OR ((s.consent_flag IS NULL OR s.consent_flag = '') AND h.last_no_date IS NOT NULL)""",
          "I6 D12")
def q_consent_withdrawals(spark, sf):
    from contactgate.plans.phone_state import consent_history
    L = Layers(spark, sf)
    return consent_history(L.nonfin, L.supplfwd, L.enrollment)


@register("consent_transitions", """
SELECT legacy_identifier, phone_number, given_at, event_date AS withdrawn_at, record_source
FROM (SELECT *, lag(consent_flag) OVER w AS before, lag(event_date) OVER w AS given_at
      FROM (SELECT cnsmr_idntfr_lgcy_txt AS legacy_identifier, cnsmr_phn_nmbr_txt AS phone_number,
                   cnsmr_phn_cnsnt_flg AS consent_flag, _file_date AS event_date, 'NON-FIN' AS record_source,
                   0 AS prio, _source_file AS t0, _row_id AS t1 FROM nf_dedup
            UNION ALL
            SELECT cnsmr_idntfr_lgcy_txt, cnsmr_phn_nmbr_txt, cnsmr_phn_cnsnt_flg,
                   CAST(try_strptime(record_date, '%Y-%m-%d') AS DATE), 'SUPPLFWD', 1, cnsmr_phn_hst_id, _row_id
            FROM sf_dedup) e
      WHERE consent_flag IN ('Y', 'N')
      WINDOW w AS (PARTITION BY legacy_identifier, phone_number
                   ORDER BY event_date NULLS FIRST, prio, t0 NULLS FIRST, t1 NULLS FIRST)) h
WHERE before = 'Y' AND consent_flag = 'N'""", "I6")
def q_consent_transitions(spark, sf):
    from contactgate.plans.phone_state import consent_transitions
    L = Layers(spark, sf)
    return consent_transitions(L.nonfin, L.supplfwd, L.enrollment)


# ============================ extra checks ====================================

@register("idempotency_diff", """
SELECT CAST(0 AS BIGINT) AS only_in_first, CAST(0 AS BIGINT) AS only_in_second,
       (SELECT count(*) FROM silver) AS state_rows""", "U3")
def q_idempotency_diff(spark, sf):
    """Two runs over differently partitioned and ordered inputs are equal as bags of rows:
    one digest a run, and a comparison of the rows only if the digests differ."""
    from contactgate.operators.merge import bag_difference
    from contactgate.plans.phone_state import build_state
    L = Layers(spark, sf)
    a = build_state(L.nonfin, L.supplfwd, L.enrollment)
    # as many partitions as the session's setting, so that they grow with it
    b = build_state(L.nonfin.repartition("cnsmr_phn_nmbr_txt"),
                    L.supplfwd.repartition("record_date"),
                    L.enrollment.repartition("phone_number"))
    return bag_difference(a, b).withColumnRenamed("first_rows", "state_rows")


@register("domain_check", """
SELECT count(*) FILTER (WHERE phone_source IS NOT NULL AND phone_source NOT IN ('CLIENT', 'CONSUMER', 'THIRD_PARTY', 'OTHER')) AS bad_source,
       count(*) FILTER (WHERE phone_type IS NOT NULL AND phone_type NOT IN ('CELL', 'HOME', 'WORK', 'OTHER')) AS bad_type,
       count(*) FILTER (WHERE phone_status IS NOT NULL AND phone_status NOT IN ('ACTIVE', 'INACTIVE', 'DISCONNECTED')) AS bad_status,
       count(*) FILTER (WHERE phone_technology IS NOT NULL AND phone_technology NOT IN ('WIRELESS', 'LANDLINE', 'VOIP')) AS bad_technology,
       count(*) FILTER (WHERE record_source NOT IN ('NON-FIN', 'SUPPLFWD', 'ENRLMT')) AS bad_record_source
FROM silver""", "P9 A10")
def q_domain_check(spark, sf):
    """Out-of-domain values per attribute; the domains are literal lists
    (fixed size), so each test is an in-list predicate inside one aggregate."""
    st = Layers(spark, sf).state

    def bad(col, dom):
        return _ci(F.col(col).isNotNull() & ~F.col(col).isin(*dom), f"bad_{col.split('_', 1)[1]}")
    return st.agg(bad("phone_source", S.PHONE_SOURCES), bad("phone_type", S.PHONE_TYPES),
                  bad("phone_status", S.PHONE_STATUSES),
                  bad("phone_technology", S.PHONE_TECHNOLOGIES),
                  _ci(~F.col("record_source").isin(S.SRC_SNAPSHOT, S.SRC_CHANGE, S.SRC_ENROLLMENT),
                      "bad_record_source"))


@register("snapshot_drop_ratio", """
SELECT _file_date, rows, lag(rows) OVER (ORDER BY _file_date) AS previous_rows,
       CASE WHEN lag(rows) OVER (ORDER BY _file_date) IS NULL THEN NULL
            ELSE CAST(rows AS DOUBLE) / lag(rows) OVER (ORDER BY _file_date) END AS ratio_to_previous
FROM (SELECT _file_date, count(*) AS rows FROM nf_dedup GROUP BY _file_date) d""", "D6 Q1")
def q_snapshot_drop_ratio(spark, sf):
    """Rows per snapshot against the previous snapshot: a partial last
    delivery shows as a low ratio before it turns every absent key into a
    hard delete.  The window runs over one row per snapshot date."""
    per_date = Layers(spark, sf).nonfin_dedup.groupBy("_file_date").agg(_count("rows"))
    prev = F.lag("rows").over(Window.orderBy("_file_date"))
    return per_date.select("_file_date", "rows", prev.alias("previous_rows"),
                           (F.col("rows").cast("double") / prev).alias("ratio_to_previous"))


# ============================ monitoring ======================================

def snapshot_drop_check(nonfin: DataFrame, min_ratio: float = 0.5) -> DataFrame:
    """Anomaly check for a partial last delivery: rows of the newest snapshot
    against the one before it (one row per snapshot date is all that is
    windowed).  Observed = the ratio in percent, rounded down; passes at or
    above ``min_ratio``; a single snapshot passes."""
    from contactgate.operators.quality import Check
    per_date = nonfin.groupBy("_file_date").agg(_count("rows"))
    ranked = per_date.withColumn("__r", F.row_number().over(Window.orderBy(F.desc("_file_date"))))
    last_two = ranked.where("__r <= 2").agg(
        F.max(F.when(F.col("__r") == 1, F.col("rows"))).alias("latest"),
        F.max(F.when(F.col("__r") == 2, F.col("rows"))).alias("previous"))
    pct = F.floor(F.col("latest") * 100 / F.col("previous"))
    out = last_two.select(
        F.lit("snapshot_drop_ratio").alias("name"),
        F.coalesce(pct >= F.lit(min_ratio * 100), F.lit(True)).alias("passed"),
        F.coalesce(pct, F.lit(100)).cast("long").alias("observed"),
        F.lit(f"ge{int(min_ratio * 100)}").alias("expected"))
    return out


@register("quality_snapshot_drop", """
SELECT 'snapshot_drop_ratio' AS name,
       COALESCE(floor(latest * 100 / previous) >= 50, true) AS passed,
       CAST(COALESCE(floor(latest * 100 / previous), 100) AS BIGINT) AS observed,
       'ge50' AS expected
FROM (SELECT max(CASE WHEN rn = 1 THEN rows END) AS latest,
             max(CASE WHEN rn = 2 THEN rows END) AS previous
      FROM (SELECT rows, row_number() OVER (ORDER BY _file_date DESC) AS rn
            FROM (SELECT _file_date, count(*) AS rows FROM nf_dedup GROUP BY _file_date) d) r
      WHERE rn <= 2) t""", "D6 Q1")
def q_quality_snapshot_drop(spark, sf):
    return snapshot_drop_check(Layers(spark, sf).nonfin_dedup)
