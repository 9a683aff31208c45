"""Raw delivery file layouts.

Fixed values of the data contract (column names and order of the three pipe-
delimited delivery families, the file-name markers and the value domains).
Every raw column is a string; typing happens after ingest.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# --- fixed values: column order of each delivery family -------------------
ENROLLMENT_COLUMNS = [
    "account_number", "consumer_legacy_identifier", "agency_id", "ssn",
    "first_name", "last_name", "phone_number", "phone_type", "phone_technology",
    "phone_status", "phone_source", "quality_score", "enrollment_date",
]
SNAPSHOT_COLUMNS = [
    "cnsmr_phn_id", "cnsmr_idntfr_lgcy_txt", "cnsmr_idntfr_agncy_id",
    "cnsmr_idntfr_ssn_txt", "cnsmr_nm_frst_txt", "cnsmr_nm_lst_txt",
    "cnsmr_phn_nmbr_txt", "cnsmr_phn_typ_val_txt", "cnsmr_phn_stts_val_txt",
    "cnsmr_phn_src_val_txt", "cnsmr_phn_tchnlgy_typ_val_txt",
    "cnsmr_phn_qlty_score_nmbr", "cnsmr_phn_cnsnt_flg", "cnsmr_phn_cnsnt_dt",
]
CHANGE_COLUMNS = (
    ["cnsmr_phn_hst_id"] + SNAPSHOT_COLUMNS[1:] + ["cnsmr_phn_sft_dlt_flg", "record_date"]
)
# metadata appended at ingest, in this order
LINEAGE_COLUMNS = ["_source_file", "_file_date"]

# --- fixed values: file-name markers under the delivery root --------------
ENROLLMENT_GLOB = "ENROLLMENT/*ENRLMT*.csv.gz"
SNAPSHOT_GLOB = "MAINTENANCE/*NON-FIN-BDL*.csv.gz"
CHANGE_GLOB = "MAINTENANCE/*SUPPLFWD*.csv.gz"

# --- fixed values: record_source tags and domains -------------------------
SRC_SNAPSHOT = "NON-FIN"
SRC_CHANGE = "SUPPLFWD"
SRC_ENROLLMENT = "ENRLMT"
PHONE_SOURCES = ("CLIENT", "CONSUMER", "THIRD_PARTY", "OTHER")
PHONE_TYPES = ("CELL", "HOME", "WORK", "OTHER")
PHONE_STATUSES = ("ACTIVE", "INACTIVE", "DISCONNECTED")
PHONE_TECHNOLOGIES = ("WIRELESS", "LANDLINE", "VOIP")
DELETE_TYPES = ("hard_delete", "soft_delete")
HARD_DELETE = "hard_delete"
SOFT_DELETE = "soft_delete"

# --- fixed values: column order of the state and the consent table ---------
STATE_COLUMNS = [
    "account_number", "legacy_identifier", "phone_number", "phone_id", "phone_type",
    "phone_status", "phone_source", "phone_technology", "quality_score",
    "consent_flag", "consent_date", "is_deleted", "delete_type", "deleted_at",
    "record_source", "event_date", "_source_file",
]
CONSENT_COLUMNS = [
    "account_number", "phone_number", "phone_source", "has_sms_consent",
    "sms_consent_updated_at", "is_deleted", "delete_type", "deleted_at", "_source_file",
]


def string_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


ENROLLMENT_SCHEMA = string_schema(ENROLLMENT_COLUMNS)
SNAPSHOT_SCHEMA = string_schema(SNAPSHOT_COLUMNS)
CHANGE_SCHEMA = string_schema(CHANGE_COLUMNS)
