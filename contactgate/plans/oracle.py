"""DuckDB SQL twins of the registered queries (the correctness oracle).

The oracle spells out the *reference semantics* step by step -- deduplicating
windows, latest-state windows, a precedence window, an anti join for gap fill
and two left joins for delete status -- so that the single-aggregate Spark plan
is checked against an independent formulation.  Only DuckDB runs this text.
"""

from __future__ import annotations

import re

_PAD = "lpad(CAST({x} AS VARCHAR), {n}, '0')"


def pad(x: str, n: int) -> str:
    return _PAD.format(x=x, n=n)


def _pick(index: str, values: tuple[str, ...]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} {arms} END"


_TYPES = ("CELL", "HOME", "WORK", "OTHER")
_STATUSES = ("ACTIVE", "INACTIVE", "DISCONNECTED")
_TECHS = ("WIRELESS", "LANDLINE", "VOIP")


def _date(x: str) -> str:
    return f"CAST(try_strptime({x}, '%Y-%m-%d') AS DATE)"


CTES: dict[str, str] = {}

CTES["nonfin"] = f"""
SELECT
  CAST(k * 4 + o_orderkey % 4 AS VARCHAR) AS cnsmr_phn_id,
  {pad('k', 16)} || 'P' AS cnsmr_idntfr_lgcy_txt,
  'AGN' || {pad('k % 1000000', 6)} AS cnsmr_idntfr_agncy_id,
  {pad('k * 7919 % 1000000000', 9)} AS cnsmr_idntfr_ssn_txt,
  'F' || CAST(k AS VARCHAR) AS cnsmr_nm_frst_txt,
  'L' || CAST(k AS VARCHAR) AS cnsmr_nm_lst_txt,
  {pad('o_custkey % 50 * 4 + o_orderkey % 4', 10)} AS cnsmr_phn_nmbr_txt,
  {_pick('o_orderkey % 4', _TYPES)} AS cnsmr_phn_typ_val_txt,
  {_pick('o_orderkey % 3', _STATUSES)} AS cnsmr_phn_stts_val_txt,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'CLIENT' WHEN '2' THEN 'CLIENT'
       WHEN '3' THEN 'CONSUMER' WHEN '4' THEN 'THIRD_PARTY' WHEN '5' THEN 'OTHER' END
    AS cnsmr_phn_src_val_txt,
  {_pick('o_custkey % 3', _TECHS)} AS cnsmr_phn_tchnlgy_typ_val_txt,
  CAST(o_orderkey % 100 AS VARCHAR) AS cnsmr_phn_qlty_score_nmbr,
  CASE o_orderstatus WHEN 'F' THEN 'Y' WHEN 'O' THEN 'N' END AS cnsmr_phn_cnsnt_flg,
  CASE WHEN o_orderstatus IN ('F', 'O') THEN strftime(o_orderdate, '%Y-%m-%d') END
    AS cnsmr_phn_cnsnt_dt,
  'MAINTENANCE/MAINTFEED-' || strftime(make_date(year(o_orderdate), 1, 1), '%Y%m%d')
    || '000000000-NON-FIN-BDL_EXPORT_000.csv.gz' AS _source_file,
  make_date(year(o_orderdate), 1, 1) AS _file_date,
  's' || {pad('o_orderkey', 10)} AS _row_id
FROM (SELECT *, o_custkey + CASE WHEN o_custkey % 10 = 9 THEN 1000000000 ELSE 0 END AS k FROM orders) o"""

CTES["supplfwd"] = f"""
SELECT
  'h' || {pad('event_id', 10)} AS cnsmr_phn_hst_id,
  {pad('c', 16)} || 'P' AS cnsmr_idntfr_lgcy_txt,
  'AGN' || {pad('c % 1000000', 6)} AS cnsmr_idntfr_agncy_id,
  {pad('c * 7919 % 1000000000', 9)} AS cnsmr_idntfr_ssn_txt,
  'F' || CAST(c AS VARCHAR) AS cnsmr_nm_frst_txt,
  'L' || CAST(c AS VARCHAR) AS cnsmr_nm_lst_txt,
  {pad('c % 50 * 4 + event_id % 4', 10)} AS cnsmr_phn_nmbr_txt,
  {_pick('event_id % 4', _TYPES)} AS cnsmr_phn_typ_val_txt,
  {_pick('event_id % 3', _STATUSES)} AS cnsmr_phn_stts_val_txt,
  CASE WHEN value < 5 THEN 'CLIENT' ELSE 'CONSUMER' END AS cnsmr_phn_src_val_txt,
  {_pick('c % 3', _TECHS)} AS cnsmr_phn_tchnlgy_typ_val_txt,
  CAST(event_id % 100 AS VARCHAR) AS cnsmr_phn_qlty_score_nmbr,
  CASE event_type WHEN 'signup' THEN 'Y' WHEN 'click' THEN 'N' END AS cnsmr_phn_cnsnt_flg,
  CASE WHEN event_type IN ('signup', 'click') THEN CAST(DATE '1998-01-01' + off AS VARCHAR) END
    AS cnsmr_phn_cnsnt_dt,
  CASE WHEN event_type = 'error' THEN 'Y' ELSE 'N' END AS cnsmr_phn_sft_dlt_flg,
  CAST(DATE '1998-01-01' + off AS VARCHAR) AS record_date,
  'MAINTENANCE/MAINTFEED-' || strftime(DATE '1998-01-01' + (off - off % 7 + 7), '%Y%m%d')
    || '000000000-SUPPLFWD-BDL_EXPORT_000.csv.gz' AS _source_file,
  DATE '1998-01-01' + (off - off % 7 + 7) AS _file_date,
  'h' || {pad('event_id', 10)} AS _row_id
FROM (SELECT *, user_id * 10 + event_id % 3 * 3
                + CASE WHEN event_id % 2 = 1 THEN 500000000 ELSE 0 END AS c,
             CAST(event_id % 1462 AS INTEGER) AS off
      FROM events) e"""

CTES["enrollment"] = f"""
SELECT
  {pad('c_custkey', 16)} AS account_number,
  {pad('c_custkey', 16)} || 'P' AS consumer_legacy_identifier,
  'AGN' || {pad('c_custkey % 1000000', 6)} AS agency_id,
  {pad('c_custkey * 7919 % 1000000000', 9)} AS ssn,
  'F' || CAST(c_custkey AS VARCHAR) AS first_name,
  'L' || CAST(c_custkey AS VARCHAR) AS last_name,
  {pad('c_custkey % 50 * 4 + c_custkey % 4', 10)} AS phone_number,
  {_pick('c_custkey % 4', _TYPES)} AS phone_type,
  {_pick('c_custkey % 3', _TECHS)} AS phone_technology,
  {_pick('c_custkey % 3', _STATUSES)} AS phone_status,
  CASE WHEN c_nationkey % 2 = 0 THEN 'CLIENT' ELSE 'OTHER' END AS phone_source,
  CAST(c_custkey % 100 AS VARCHAR) AS quality_score,
  CAST(d AS VARCHAR) AS enrollment_date,
  'ENROLLMENT/ENROLLFEED-' || strftime(make_date(year(d), month(d), 1), '%Y%m%d')
    || '000000000-ENRLMT-EXPORT_000.csv.gz' AS _source_file,
  make_date(year(d), month(d), 1) AS _file_date,
  'e' || {pad('c_custkey', 10)} AS _row_id
FROM (SELECT *, DATE '1995-01-01' + CAST(c_custkey % 365 AS INTEGER) AS d FROM customer) c"""

CTES["requests"] = f"""
SELECT o_orderkey AS request_id,
       {pad('o_custkey', 16)} AS account_number,
       {pad('o_custkey % 50 * 4 + o_orderkey % 4', 10)} AS phone_number
FROM orders"""

# --- reference semantics, step by step ---------------------------------------
CTES["nf_dedup"] = """
SELECT * FROM nonfin
QUALIFY row_number() OVER (PARTITION BY cnsmr_phn_id, _file_date
                           ORDER BY _source_file ASC NULLS FIRST, _row_id ASC NULLS FIRST) = 1"""

CTES["sf_dedup"] = """
SELECT * FROM supplfwd
QUALIFY row_number() OVER (PARTITION BY cnsmr_idntfr_lgcy_txt, cnsmr_phn_nmbr_txt, record_date
                           ORDER BY cnsmr_phn_hst_id ASC NULLS FIRST, _row_id ASC NULLS FIRST) = 1"""

CTES["hard"] = """
SELECT cnsmr_idntfr_lgcy_txt AS h_legacy, cnsmr_phn_nmbr_txt AS h_phone,
       max(_file_date) AS last_seen_date,
       max(_file_date) < (SELECT max(_file_date) FROM nf_dedup) AS is_hard_deleted
FROM nf_dedup GROUP BY 1, 2"""

CTES["sf_latest"] = f"""
SELECT * FROM (SELECT *, {_date('record_date')} AS record_date_parsed FROM sf_dedup) x
QUALIFY row_number() OVER (PARTITION BY cnsmr_idntfr_lgcy_txt, cnsmr_phn_nmbr_txt
                           ORDER BY record_date_parsed DESC NULLS LAST,
                                    cnsmr_phn_hst_id DESC NULLS LAST, _row_id DESC NULLS LAST) = 1"""

CTES["soft"] = """
SELECT cnsmr_idntfr_lgcy_txt AS s_legacy, cnsmr_phn_nmbr_txt AS s_phone,
       cnsmr_phn_sft_dlt_flg AS soft_delete_flag,
       cnsmr_phn_sft_dlt_flg = 'Y' AS is_soft_deleted,
       record_date_parsed AS soft_deleted_at
FROM sf_latest"""

CTES["nf_latest"] = """
SELECT * FROM nf_dedup
QUALIFY row_number() OVER (PARTITION BY cnsmr_idntfr_lgcy_txt, cnsmr_phn_nmbr_txt
                           ORDER BY _file_date DESC NULLS LAST, _source_file DESC NULLS LAST,
                                    _row_id DESC NULLS LAST) = 1"""

CTES["merged"] = f"""
SELECT * FROM (
  SELECT cnsmr_idntfr_lgcy_txt AS legacy_identifier, cnsmr_phn_nmbr_txt AS phone_number,
         cnsmr_phn_id AS phone_id, cnsmr_phn_typ_val_txt AS phone_type,
         cnsmr_phn_stts_val_txt AS phone_status, cnsmr_phn_src_val_txt AS phone_source,
         cnsmr_phn_tchnlgy_typ_val_txt AS phone_technology,
         cnsmr_phn_qlty_score_nmbr AS quality_score, cnsmr_phn_cnsnt_flg AS consent_flag,
         {_date('cnsmr_phn_cnsnt_dt')} AS consent_date, _file_date AS event_date,
         CAST(NULL AS VARCHAR) AS soft_delete_flag, 'NON-FIN' AS record_source, _source_file
  FROM nf_latest
  UNION ALL BY NAME
  SELECT cnsmr_idntfr_lgcy_txt AS legacy_identifier, cnsmr_phn_nmbr_txt AS phone_number,
         CAST(NULL AS VARCHAR) AS phone_id, cnsmr_phn_typ_val_txt AS phone_type,
         cnsmr_phn_stts_val_txt AS phone_status, cnsmr_phn_src_val_txt AS phone_source,
         cnsmr_phn_tchnlgy_typ_val_txt AS phone_technology,
         cnsmr_phn_qlty_score_nmbr AS quality_score, cnsmr_phn_cnsnt_flg AS consent_flag,
         {_date('cnsmr_phn_cnsnt_dt')} AS consent_date, record_date_parsed AS event_date,
         cnsmr_phn_sft_dlt_flg AS soft_delete_flag, 'SUPPLFWD' AS record_source, _source_file
  FROM sf_latest) u
QUALIFY row_number() OVER (PARTITION BY legacy_identifier, phone_number
                           ORDER BY event_date DESC NULLS LAST,
                                    CASE WHEN record_source = 'SUPPLFWD' THEN 0 ELSE 1 END) = 1"""

CTES["enrl_latest"] = f"""
SELECT consumer_legacy_identifier AS legacy_identifier, phone_number,
       CAST(NULL AS VARCHAR) AS phone_id, phone_type, phone_status, phone_source,
       phone_technology, quality_score, CAST(NULL AS VARCHAR) AS consent_flag,
       CAST(NULL AS DATE) AS consent_date, {_date('enrollment_date')} AS event_date,
       CAST(NULL AS VARCHAR) AS soft_delete_flag, 'ENRLMT' AS record_source, _source_file
FROM enrollment
QUALIFY row_number() OVER (PARTITION BY consumer_legacy_identifier, phone_number
                           ORDER BY {_date('enrollment_date')} DESC NULLS LAST,
                                    _source_file DESC NULLS LAST, _row_id DESC NULLS LAST) = 1"""

CTES["state_rows"] = """
SELECT * FROM merged
UNION ALL BY NAME
SELECT * FROM enrl_latest e
WHERE NOT EXISTS (SELECT 1 FROM merged m
                  WHERE m.legacy_identifier = e.legacy_identifier
                    AND m.phone_number = e.phone_number)"""

CTES["silver_flags"] = """
SELECT r.*, h.is_hard_deleted,
       CASE WHEN h.is_hard_deleted THEN h.last_seen_date END AS hard_deleted_at,
       s.is_soft_deleted, s.soft_deleted_at,
       CASE WHEN s.is_soft_deleted AND r.record_source = 'NON-FIN'
                 AND r.event_date > s.soft_deleted_at THEN false
            ELSE COALESCE(s.is_soft_deleted, false) END AS soft_final
FROM state_rows r
LEFT JOIN hard h ON r.legacy_identifier = h.h_legacy AND r.phone_number = h.h_phone
LEFT JOIN soft s ON r.legacy_identifier = s.s_legacy AND r.phone_number = s.s_phone"""

CTES["silver"] = """
SELECT substr(legacy_identifier, 1, length(legacy_identifier) - 1) AS account_number,
       legacy_identifier, phone_number, phone_id, phone_type, phone_status, phone_source,
       phone_technology, quality_score, consent_flag, consent_date,
       COALESCE(is_hard_deleted, false) OR soft_final AS is_deleted,
       CASE WHEN is_hard_deleted THEN 'hard_delete' WHEN soft_final THEN 'soft_delete' END
         AS delete_type,
       CASE WHEN is_hard_deleted THEN hard_deleted_at WHEN soft_final THEN soft_deleted_at END
         AS deleted_at,
       record_source, event_date, _source_file
FROM silver_flags"""

CTES["gold"] = """
SELECT account_number, '+1' || phone_number AS phone_number, phone_source,
       CASE WHEN consent_flag = 'Y' THEN true WHEN consent_flag = 'N' THEN false END
         AS has_sms_consent,
       consent_date AS sms_consent_updated_at, is_deleted, delete_type, deleted_at, _source_file
FROM silver"""

CTES["decisions"] = """
SELECT account_number, phone_number,
       bool_and(COALESCE(phone_source = 'CLIENT', false) AND COALESCE(NOT is_deleted, false)
                AND COALESCE(has_sms_consent, true)) AS can_send_sms
FROM gold GROUP BY account_number, phone_number"""

_ORDER = list(CTES)
_FEEDS = ("nonfin", "supplfwd", "enrollment")

# Deliveries split at one date: an earlier run and a later incremental batch.
SPLIT_DATE = "2000-01-01"
VARIANTS = {
    "_early": f"_file_date < DATE '{SPLIT_DATE}'",
    "_late": f"_file_date >= DATE '{SPLIT_DATE}'",
}


def _variant(suffix: str, feed_filter: str) -> list[tuple[str, str]]:
    """The whole CTE chain again, over feeds restricted by ``feed_filter``."""
    out = []
    for name in _ORDER:
        body = CTES[name]
        for other in _ORDER:
            body = re.sub(rf"\b{other}\b", other + suffix, body)
        if name in _FEEDS:
            body = f"SELECT * FROM ({body}\n) f WHERE {feed_filter}"
        out.append((name + suffix, body))
    return out


def with_ctes(body: str) -> str:
    """Prefix ``body`` with every CTE it needs (DuckDB drops unused ones)."""
    items = [(n, CTES[n]) for n in _ORDER]
    for suffix, flt in VARIANTS.items():
        items += _variant(suffix, flt)
    parts = ",\n".join(f"{name} AS ({text}\n)" for name, text in items)
    body = body.strip()
    if body.startswith("WITH "):    # a body with CTEs of its own
        body = f"SELECT * FROM ({body}) body"
    return f"WITH {parts}\n{body}"
