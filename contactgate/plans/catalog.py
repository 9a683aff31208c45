"""Registered queries: name -> (spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)``, reads the shared test tables through
the stand-in feeds and returns a lazy DataFrame over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactgate.functions.columns import (
    account_from_legacy, file_date_from_name, normalize_phone, parse_date, tri_state,
)
from contactgate.operators.decide import decide
from contactgate.operators.merge import gap_fill
from contactgate.operators.reconcile import reconcile
from contactgate.plans import phone_state as P
from contactgate.plans.oracle import with_ctes
from contactgate.sources import schemas as S
from contactgate.sources.standin import feeds, permission_requests

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    build: Builder
    oracle: str | None
    ids: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, oracle: str | None, ids: str = ""):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = Query(name, fn, with_ctes(oracle) if oracle else None, ids)
        return fn
    return deco


class Layers:
    """Lazy handles on every layer for one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, where=None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.nonfin, self.supplfwd, self.enrollment = feeds(spark, sf_dir)
        if where is not None:   # deliveries restricted by file date
            self.nonfin, self.supplfwd, self.enrollment = (
                self.nonfin.where(where), self.supplfwd.where(where), self.enrollment.where(where))

    @property
    def nonfin_dedup(self) -> DataFrame:
        return P.dedup_snapshot(self.nonfin)

    @property
    def supplfwd_dedup(self) -> DataFrame:
        return P.dedup_change(self.supplfwd)

    @property
    def state(self) -> DataFrame:
        return P.build_state(self.nonfin, self.supplfwd, self.enrollment)

    @property
    def consent(self) -> DataFrame:
        return P.build_consent(self.state)


# --- core layers ---------------------------------------------------------------

@register("phone_state", "SELECT * FROM silver", "C4 P4")
def q_phone_state(spark, sf):
    return Layers(spark, sf).state


@register("phone_consent", "SELECT * FROM gold", "C5 P4")
def q_phone_consent(spark, sf):
    return Layers(spark, sf).consent


@register("bulk_permission", """
SELECT r.request_id, r.account_number, '+1' || r.phone_number AS phone_number,
       COALESCE(d.can_send_sms, false) AS can_send_sms
FROM requests r LEFT JOIN decisions d
  ON r.account_number = d.account_number AND '+1' || r.phone_number = d.phone_number""", "C6")
def q_bulk_permission(spark, sf):
    return decide(permission_requests(spark, sf), Layers(spark, sf).consent)


@register("bulk_permission_salted", """
SELECT r.request_id, r.account_number, '+1' || r.phone_number AS phone_number,
       COALESCE(d.can_send_sms, false) AS can_send_sms
FROM requests r LEFT JOIN decisions d
  ON r.account_number = d.account_number AND '+1' || r.phone_number = d.phone_number""", "C6 J2")
def q_bulk_permission_salted(spark, sf):
    """Same answers with the explicit hot-key split: keys above 0.02 % of
    the requests (at most 5,000 keys, broadcast) are salted over 16 buckets."""
    return decide(permission_requests(spark, sf), Layers(spark, sf).consent,
                  hot_key_share=0.0002, salt_buckets=16)


@register("permission_hot_key", f"""
SELECT r.request_id, r.account_number, '+1' || r.phone_number AS phone_number,
       COALESCE(d.can_send_sms, false) AS can_send_sms
FROM (SELECT request_id, if(request_id % 3 = 0, '0000000000000001', account_number) AS account_number,
             if(request_id % 3 = 0, '0000000005', phone_number) AS phone_number FROM requests) r
LEFT JOIN decisions d ON r.account_number = d.account_number AND '+1' || r.phone_number = d.phone_number""", "C6")
def q_permission_hot_key(spark, sf):
    """Every third request asks for one and the same key."""
    hot = F.col("request_id") % 3 == 0
    requests = permission_requests(spark, sf).withColumns({
        "account_number": F.when(hot, F.lit(LOOKUP_ACCOUNT)).otherwise(F.col("account_number")),
        "phone_number": F.when(hot, F.lit(LOOKUP_PHONE)).otherwise(F.col("phone_number"))})
    return decide(requests, Layers(spark, sf).consent, hot_key_share=0.2)


LOOKUP_ACCOUNT = "0000000000000001"   # customer 1 exists at every scale
LOOKUP_PHONE = "0000000005"           # its enrollment phone


@register("permission_lookup", f"""
SELECT '{LOOKUP_ACCOUNT}' AS account_number, '+1{LOOKUP_PHONE}' AS phone_number,
       COALESCE((SELECT can_send_sms FROM decisions
                 WHERE account_number = '{LOOKUP_ACCOUNT}'
                   AND phone_number = '+1{LOOKUP_PHONE}'), false) AS can_send_sms""", "P6 C6")
def q_permission_lookup(spark, sf):
    """One key from the raw feeds, reconciling only the rows that can affect
    it (see ``phone_state.state_for_keys``)."""
    from contactgate.operators.decide import lookup
    L = Layers(spark, sf)
    req = spark.createDataFrame([(LOOKUP_ACCOUNT, LOOKUP_PHONE)], ["account_number", "phone_number"])
    state = P.state_for_keys(L.nonfin, L.supplfwd, L.enrollment, req)
    return lookup(spark, P.build_consent(state), LOOKUP_ACCOUNT, LOOKUP_PHONE)


# --- building blocks -------------------------------------------------------

@register("dedup_snapshot", "SELECT * FROM nf_dedup", "W1 P5")
def q_dedup_snapshot(spark, sf):
    return Layers(spark, sf).nonfin_dedup


@register("dedup_change", "SELECT * FROM sf_dedup", "W2")
def q_dedup_change(spark, sf):
    return Layers(spark, sf).supplfwd_dedup


@register("latest_snapshot_state", "SELECT * FROM nf_latest", "W3")
def q_latest_snapshot_state(spark, sf):
    return P.latest_snapshot_state(Layers(spark, sf).nonfin_dedup)


@register("latest_change_state", "SELECT * FROM sf_latest", "W4")
def q_latest_change_state(spark, sf):
    return P.latest_change_state(Layers(spark, sf).supplfwd_dedup)


@register("latest_enrollment", """
SELECT * FROM enrollment
QUALIFY row_number() OVER (PARTITION BY consumer_legacy_identifier, phone_number
                           ORDER BY CAST(try_strptime(enrollment_date, '%Y-%m-%d') AS DATE) DESC NULLS LAST,
                                    _source_file DESC NULLS LAST, _row_id DESC NULLS LAST) = 1""", "W6")
def q_latest_enrollment(spark, sf):
    from contactgate.operators.latest import latest_by
    en = Layers(spark, sf).enrollment
    return latest_by(en, ["consumer_legacy_identifier", "phone_number"],
                     [parse_date("enrollment_date"), "_source_file", "_row_id"])


@register("merge_precedence", "SELECT * FROM merged", "W5")
def q_merge_precedence(spark, sf):
    L = Layers(spark, sf)
    specs = [P.snapshot_source(L.nonfin_dedup), P.change_source(L.supplfwd_dedup)]
    return reconcile(specs, P._config(), P.EVENT_COLUMNS).select(*P.EVENT_COLUMNS)


_ALIGNED_SQL = """
SELECT cnsmr_idntfr_lgcy_txt AS legacy_identifier, cnsmr_phn_nmbr_txt AS phone_number,
       cnsmr_phn_id AS phone_id, cnsmr_phn_typ_val_txt AS phone_type,
       cnsmr_phn_stts_val_txt AS phone_status, cnsmr_phn_src_val_txt AS phone_source,
       cnsmr_phn_tchnlgy_typ_val_txt AS phone_technology, cnsmr_phn_qlty_score_nmbr AS quality_score,
       cnsmr_phn_cnsnt_flg AS consent_flag,
       CAST(try_strptime(cnsmr_phn_cnsnt_dt, '%Y-%m-%d') AS DATE) AS consent_date,
       _file_date AS event_date, CAST(NULL AS VARCHAR) AS soft_delete_flag,
       'NON-FIN' AS record_source, _source_file
FROM nf_dedup
UNION ALL BY NAME
SELECT cnsmr_idntfr_lgcy_txt, cnsmr_phn_nmbr_txt, CAST(NULL AS VARCHAR), cnsmr_phn_typ_val_txt,
       cnsmr_phn_stts_val_txt, cnsmr_phn_src_val_txt, cnsmr_phn_tchnlgy_typ_val_txt,
       cnsmr_phn_qlty_score_nmbr, cnsmr_phn_cnsnt_flg,
       CAST(try_strptime(cnsmr_phn_cnsnt_dt, '%Y-%m-%d') AS DATE),
       CAST(try_strptime(record_date, '%Y-%m-%d') AS DATE), cnsmr_phn_sft_dlt_flg,
       'SUPPLFWD', _source_file
FROM sf_dedup
UNION ALL BY NAME
SELECT consumer_legacy_identifier, phone_number, CAST(NULL AS VARCHAR), phone_type, phone_status,
       phone_source, phone_technology, quality_score, CAST(NULL AS VARCHAR), CAST(NULL AS DATE),
       CAST(try_strptime(enrollment_date, '%Y-%m-%d') AS DATE), CAST(NULL AS VARCHAR),
       'ENRLMT', _source_file
FROM enrollment"""


def _aligned_sql() -> str:
    # UNION ALL BY NAME needs names in every branch; name them via a VALUES-free rewrite
    cols = P.EVENT_COLUMNS
    branches = _ALIGNED_SQL.split("UNION ALL BY NAME")
    fixed = [branches[0]]
    for b in branches[1:]:
        head, tail = b.split("FROM", 1)
        exprs = _split_top(head.strip()[len("SELECT"):])
        named = ", ".join(f"{e.strip()} AS {c}" for e, c in zip(exprs, cols))
        fixed.append(f"\nSELECT {named}\nFROM{tail}")
    return "UNION ALL BY NAME".join(fixed)


def _split_top(s: str) -> list[str]:
    out, depth, cur = [], 0, ""
    for ch in s:
        if ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        if ch == "," and depth == 0:
            out.append(cur)
            cur = ""
        else:
            cur += ch
    out.append(cur)
    return out


@register("align_event_schema", _aligned_sql(), "P1 P2 U1")
def q_align_event_schema(spark, sf):
    L = Layers(spark, sf)
    return P.aligned_events(L.nonfin, L.supplfwd, L.enrollment)


@register("derive_account_number", """
SELECT consumer_legacy_identifier AS legacy_identifier,
       substr(consumer_legacy_identifier, 1, length(consumer_legacy_identifier) - 1) AS derived_account,
       substr(consumer_legacy_identifier, 1, length(consumer_legacy_identifier) - 1) = account_number
         AS matches_feed
FROM enrollment""", "P3 F1")
def q_derive_account_number(spark, sf):
    en = Layers(spark, sf).enrollment
    acct = account_from_legacy("consumer_legacy_identifier")
    return en.select(F.col("consumer_legacy_identifier").alias("legacy_identifier"),
                     acct.alias("derived_account"),
                     (acct == F.col("account_number")).alias("matches_feed"))


@register("latest_snapshot", "SELECT max(_file_date) AS latest_snapshot_date FROM nonfin", "A1")
def q_latest_snapshot(spark, sf):
    return Layers(spark, sf).nonfin.agg(F.max("_file_date").alias("latest_snapshot_date"))


@register("last_seen", """
SELECT cnsmr_idntfr_lgcy_txt, cnsmr_phn_nmbr_txt, max(_file_date) AS last_seen_date
FROM nf_dedup GROUP BY 1, 2""", "A2")
def q_last_seen(spark, sf):
    return (Layers(spark, sf).nonfin_dedup
            .groupBy("cnsmr_idntfr_lgcy_txt", "cnsmr_phn_nmbr_txt")
            .agg(F.max("_file_date").alias("last_seen_date")))


@register("detect_hard_deletes", """
SELECT h_legacy AS cnsmr_idntfr_lgcy_txt, h_phone AS cnsmr_phn_nmbr_txt, last_seen_date,
       is_hard_deleted, CASE WHEN is_hard_deleted THEN last_seen_date END AS hard_deleted_at
FROM hard""", "A3")
def q_detect_hard_deletes(spark, sf):
    L = Layers(spark, sf)
    return P.hard_deletes(L.nonfin_dedup, raw=L.nonfin)


@register("detect_soft_deletes", """
SELECT s_legacy AS legacy_identifier, s_phone AS phone_number, soft_delete_flag,
       soft_deleted_at, is_soft_deleted
FROM soft""", "C1")
def q_detect_soft_deletes(spark, sf):
    return P.soft_deletes(Layers(spark, sf).supplfwd_dedup)


@register("gap_fill_anti", """
SELECT * FROM enrl_latest e
WHERE NOT EXISTS (SELECT 1 FROM merged m WHERE m.legacy_identifier = e.legacy_identifier
                  AND m.phone_number = e.phone_number)""", "J1 U1")
def q_gap_fill_anti(spark, sf):
    L = Layers(spark, sf)
    merged = q_merge_precedence(spark, sf)
    enrl = reconcile([P.enrollment_source(L.enrollment)], P._config(), P.EVENT_COLUMNS) \
        .select(*P.EVENT_COLUMNS)
    filled = gap_fill(merged, enrl, P.KEYS)
    return filled.where(F.col("record_source") == S.SRC_ENROLLMENT)


@register("attach_hard_delete", """
SELECT legacy_identifier, phone_number, record_source, is_hard_deleted, hard_deleted_at
FROM silver_flags""", "J2")
def q_attach_hard_delete(spark, sf):
    L = Layers(spark, sf)
    return P.reconciled(L.nonfin, L.supplfwd, L.enrollment).select(
        "legacy_identifier", "phone_number", "record_source", "is_hard_deleted", "hard_deleted_at")


@register("attach_soft_delete", """
SELECT legacy_identifier, phone_number, record_source, is_soft_deleted, soft_deleted_at
FROM silver_flags""", "J3")
def q_attach_soft_delete(spark, sf):
    L = Layers(spark, sf)
    return P.reconciled(L.nonfin, L.supplfwd, L.enrollment).select(
        "legacy_identifier", "phone_number", "record_source", "is_soft_deleted", "soft_deleted_at")


@register("readd_override", """
SELECT legacy_identifier, phone_number, event_date, soft_deleted_at
FROM silver_flags
WHERE is_soft_deleted AND record_source = 'NON-FIN' AND event_date > soft_deleted_at""", "C2")
def q_readd_override(spark, sf):
    L = Layers(spark, sf)
    r = P.reconciled(L.nonfin, L.supplfwd, L.enrollment)
    return r.where(F.col("is_soft_deleted") & (F.col("record_source") == S.SRC_SNAPSHOT)
                   & (F.col("event_date") > F.col("soft_deleted_at"))) \
            .select("legacy_identifier", "phone_number", "event_date", "soft_deleted_at")


@register("delete_status", """
SELECT legacy_identifier, phone_number, is_deleted, delete_type, deleted_at FROM silver""",
          "C3 F6 F7 F8")
def q_delete_status(spark, sf):
    return Layers(spark, sf).state.select("legacy_identifier", "phone_number", "is_deleted",
                                          "delete_type", "deleted_at")


@register("normalize_phone", """
SELECT legacy_identifier, phone_number AS raw_phone, '+1' || phone_number AS phone_number
FROM silver""", "F2 P10")
def q_normalize_phone(spark, sf):
    st = Layers(spark, sf).state
    return st.select("legacy_identifier", F.col("phone_number").alias("raw_phone"),
                     normalize_phone("phone_number").alias("phone_number"))


@register("derive_consent", """
SELECT legacy_identifier, phone_number, consent_flag,
       CASE WHEN consent_flag = 'Y' THEN true WHEN consent_flag = 'N' THEN false END AS has_sms_consent
FROM silver""", "F5")
def q_derive_consent(spark, sf):
    st = Layers(spark, sf).state
    return st.select("legacy_identifier", "phone_number", "consent_flag",
                     tri_state("consent_flag").alias("has_sms_consent"))


@register("parse_dates", """
SELECT cnsmr_phn_hst_id, record_date,
       CAST(try_strptime(record_date, '%Y-%m-%d') AS DATE) AS record_date_parsed,
       CAST(try_strptime(cnsmr_phn_cnsnt_dt, '%Y-%m-%d') AS DATE) AS consent_date
FROM supplfwd""", "F4")
def q_parse_dates(spark, sf):
    ch = Layers(spark, sf).supplfwd
    return ch.select("cnsmr_phn_hst_id", "record_date",
                     parse_date("record_date").alias("record_date_parsed"),
                     parse_date("cnsmr_phn_cnsnt_dt").alias("consent_date"))


@register("file_date_parse", r"""
SELECT _source_file,
       CAST(try_strptime(regexp_extract(_source_file, '-(\d{8})\d+-', 1), '%Y%m%d') AS DATE)
         AS parsed_file_date,
       count(*) AS row_count
FROM (SELECT _source_file FROM nonfin UNION ALL SELECT _source_file FROM supplfwd
      UNION ALL SELECT _source_file FROM enrollment) f
GROUP BY _source_file""", "B3 F3")
def q_file_date_parse(spark, sf):
    L = Layers(spark, sf)
    files = (L.nonfin.select("_source_file").unionByName(L.supplfwd.select("_source_file"))
             .unionByName(L.enrollment.select("_source_file")))
    return files.groupBy("_source_file").agg(F.count(F.lit(1)).alias("row_count")) \
        .select("_source_file", file_date_from_name("_source_file").alias("parsed_file_date"),
                "row_count")


def queries() -> dict[str, Builder]:
    _load_all()
    return {k: q.build for k, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: q.oracle for k, q in REGISTRY.items() if q.oracle}


def _load_all() -> None:
    # importing registers the remaining query families
    from contactgate.plans import reports, tables_catalog  # noqa: F401
