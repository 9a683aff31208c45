"""Stand-in delivery feeds derived from the shared test tables.

The test tables (``orders``, ``events``, ``customer``) carry no phone feeds, so
each feed is a deterministic projection of one table.  Every feed is lazy: a
scan + one projection that Catalyst prunes to the columns it needs, and its
size grows with the table.  Projections are written as Spark SQL expressions
(one ``selectExpr`` call each) and the scanned columns are declared up front,
so building a feed costs no schema-inference job.

snapshot   ``orders``; one full snapshot per year
change     ``events``; weekly change files
enrollment ``customer``; one enrollment per customer
requests   every ``orders`` row as an (account, phone) permission question

No row of a table is left out.  Keys that do not meet across the feeds are made by
mapping: customers with ``custkey % 10 = 9`` appear in the snapshots under account
keys of their own, so permission requests for them hit unknown keys (or
enrollment/change-only keys), and odd events name accounts of their own, so the
change feed's keys only partly overlap the snapshots'.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values of the stand-in definition.
CHANGE_EPOCH = "1998-01-01"       # record dates: epoch + event_id % 1462 days
CHANGE_SPAN_DAYS = 1462
ENROLLMENT_EPOCH = "1995-01-01"   # enrollment dates: epoch + custkey % 365 days
ENROLLMENT_SPAN_DAYS = 365
SNAPSHOT_OTHER_REMAINDER = 9          # customers with custkey % 10 = 9 have other keys in snapshots:
SNAPSHOT_OTHER_OFFSET = 1_000_000_000  # custkey plus this
CHANGE_OTHER_OFFSET = 500_000_000      # accounts of odd events: the usual key plus this
TYPES = ("CELL", "HOME", "WORK", "OTHER")
STATUSES = ("ACTIVE", "INACTIVE", "DISCONNECTED")
TECHNOLOGIES = ("WIRELESS", "LANDLINE", "VOIP")

# columns read from each test table (declared: no inference job per read)
TABLE_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "events": "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE",
    "customer": "c_custkey BIGINT, c_nationkey INT",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pad(x: str, n: int) -> str:
    return f"lpad(CAST({x} AS STRING), {n}, '0')"


def _pick(index: str, values: tuple[str, ...]) -> str:
    return f"element_at(array({', '.join(repr(v) for v in values)}), CAST({index} AS INT) + 1)"


def _identity(x: str) -> list[str]:
    """Agency, SSN and name columns of a synthetic person ``x``."""
    return [f"concat('AGN', {_pad(f'{x} % 1000000', 6)})",
            _pad(f"{x} * 7919 % 1000000000", 9),
            f"concat('F', CAST({x} AS STRING))",
            f"concat('L', CAST({x} AS STRING))"]


def _yyyymmdd(day: str) -> str:
    # a date's ISO text without dashes (cheaper than timestamp formatting)
    return f"replace(CAST({day} AS STRING), '-', '')"


def _delivery(folder: str, prefix: str, day: str, marker: str) -> str:
    return (f"concat('{folder}/{prefix}-', {_yyyymmdd(day)}, "
            f"'000000000-{marker}_000.csv.gz')")


def snapshot_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full snapshots (here: one per order year)."""
    day = "make_date(year(o_orderdate), 1, 1)"
    flag = "CASE o_orderstatus WHEN 'F' THEN 'Y' WHEN 'O' THEN 'N' END"
    # expressions repeat this text; the optimizer evaluates it once per row
    key = (f"(o_custkey + IF(o_custkey % 10 = {SNAPSHOT_OTHER_REMAINDER}, "
           f"CAST({SNAPSHOT_OTHER_OFFSET} AS BIGINT), 0L))")
    agn, ssn, first, last = _identity(key)
    return (_table(spark, sf_dir, "orders")
            .selectExpr(
                f"CAST({key} * 4 + o_orderkey % 4 AS STRING) AS cnsmr_phn_id",
                f"concat({_pad(key, 16)}, 'P') AS cnsmr_idntfr_lgcy_txt",
                f"{agn} AS cnsmr_idntfr_agncy_id",
                f"{ssn} AS cnsmr_idntfr_ssn_txt",
                f"{first} AS cnsmr_nm_frst_txt",
                f"{last} AS cnsmr_nm_lst_txt",
                f"{_pad('o_custkey % 50 * 4 + o_orderkey % 4', 10)} AS cnsmr_phn_nmbr_txt",
                f"{_pick('o_orderkey % 4', TYPES)} AS cnsmr_phn_typ_val_txt",
                f"{_pick('o_orderkey % 3', STATUSES)} AS cnsmr_phn_stts_val_txt",
                "CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'CLIENT' WHEN '2' THEN 'CLIENT' "
                "WHEN '3' THEN 'CONSUMER' WHEN '4' THEN 'THIRD_PARTY' WHEN '5' THEN 'OTHER' END "
                "AS cnsmr_phn_src_val_txt",
                f"{_pick('o_custkey % 3', TECHNOLOGIES)} AS cnsmr_phn_tchnlgy_typ_val_txt",
                "CAST(o_orderkey % 100 AS STRING) AS cnsmr_phn_qlty_score_nmbr",
                f"{flag} AS cnsmr_phn_cnsnt_flg",
                f"CASE WHEN {flag} IS NOT NULL THEN CAST(CAST(o_orderdate AS DATE) AS STRING) END "
                "AS cnsmr_phn_cnsnt_dt",
                f"{_delivery('MAINTENANCE', 'MAINTFEED', day, 'NON-FIN-BDL_EXPORT')} "
                "AS _source_file",
                f"{day} AS _file_date",
                f"concat('s', {_pad('o_orderkey', 10)}) AS _row_id",
            ))


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly change records with a soft-delete flag and their own record date."""
    off = f"CAST(event_id % {CHANGE_SPAN_DAYS} AS INT)"
    record_day = f"date_add(DATE'{CHANGE_EPOCH}', {off})"
    file_day = f"date_add(DATE'{CHANGE_EPOCH}', {off} - {off} % 7 + 7)"
    c = (f"(user_id * 10 + event_id % 3 * 3 + IF(event_id % 2 = 1, "
         f"CAST({CHANGE_OTHER_OFFSET} AS BIGINT), 0L))")
    flag = "CASE event_type WHEN 'signup' THEN 'Y' WHEN 'click' THEN 'N' END"
    agn, ssn, first, last = _identity(c)
    return (_table(spark, sf_dir, "events")
            .selectExpr(
                f"concat('h', {_pad('event_id', 10)}) AS cnsmr_phn_hst_id",
                f"concat({_pad(c, 16)}, 'P') AS cnsmr_idntfr_lgcy_txt",
                f"{agn} AS cnsmr_idntfr_agncy_id",
                f"{ssn} AS cnsmr_idntfr_ssn_txt",
                f"{first} AS cnsmr_nm_frst_txt",
                f"{last} AS cnsmr_nm_lst_txt",
                f"{_pad(f'{c} % 50 * 4 + event_id % 4', 10)} AS cnsmr_phn_nmbr_txt",
                f"{_pick('event_id % 4', TYPES)} AS cnsmr_phn_typ_val_txt",
                f"{_pick('event_id % 3', STATUSES)} AS cnsmr_phn_stts_val_txt",
                "CASE WHEN value < 5 THEN 'CLIENT' ELSE 'CONSUMER' END AS cnsmr_phn_src_val_txt",
                f"{_pick(f'{c} % 3', TECHNOLOGIES)} AS cnsmr_phn_tchnlgy_typ_val_txt",
                "CAST(event_id % 100 AS STRING) AS cnsmr_phn_qlty_score_nmbr",
                f"{flag} AS cnsmr_phn_cnsnt_flg",
                f"CASE WHEN {flag} IS NOT NULL THEN CAST({record_day} AS STRING) END "
                "AS cnsmr_phn_cnsnt_dt",
                "CASE WHEN event_type = 'error' THEN 'Y' ELSE 'N' END AS cnsmr_phn_sft_dlt_flg",
                f"CAST({record_day} AS STRING) AS record_date",
                f"{_delivery('MAINTENANCE', 'MAINTFEED', file_day, 'SUPPLFWD-BDL_EXPORT')} "
                "AS _source_file",
                f"{file_day} AS _file_date",
                f"concat('h', {_pad('event_id', 10)}) AS _row_id",
            ))


def enrollment_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First association of a phone with an account (lowest precedence)."""
    day = f"date_add(DATE'{ENROLLMENT_EPOCH}', CAST(c_custkey % {ENROLLMENT_SPAN_DAYS} AS INT))"
    file_day = f"make_date(year({day}), month({day}), 1)"
    agn, ssn, first, last = _identity("c_custkey")
    return _table(spark, sf_dir, "customer").selectExpr(
        f"{_pad('c_custkey', 16)} AS account_number",
        f"concat({_pad('c_custkey', 16)}, 'P') AS consumer_legacy_identifier",
        f"{agn} AS agency_id",
        f"{ssn} AS ssn",
        f"{first} AS first_name",
        f"{last} AS last_name",
        f"{_pad('c_custkey % 50 * 4 + c_custkey % 4', 10)} AS phone_number",
        f"{_pick('c_custkey % 4', TYPES)} AS phone_type",
        f"{_pick('c_custkey % 3', TECHNOLOGIES)} AS phone_technology",
        f"{_pick('c_custkey % 3', STATUSES)} AS phone_status",
        "CASE WHEN c_nationkey % 2 = 0 THEN 'CLIENT' ELSE 'OTHER' END AS phone_source",
        "CAST(c_custkey % 100 AS STRING) AS quality_score",
        f"CAST({day} AS STRING) AS enrollment_date",
        f"{_delivery('ENROLLMENT', 'ENROLLFEED', file_day, 'ENRLMT-EXPORT')} AS _source_file",
        f"{file_day} AS _file_date",
        f"concat('e', {_pad('c_custkey', 10)}) AS _row_id",
    )


def permission_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk permission questions: one per order, by the snapshot key rules but
    without the snapshot's mapping of some customers, so unknown keys occur."""
    return _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS request_id",
        f"{_pad('o_custkey', 16)} AS account_number",
        f"{_pad('o_custkey % 50 * 4 + o_orderkey % 4', 10)} AS phone_number",
    )


def feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (snapshot_feed(spark, sf_dir), change_feed(spark, sf_dir),
            enrollment_feed(spark, sf_dir))
