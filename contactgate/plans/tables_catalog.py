"""Registered queries for delivered files and versioned tables.

These builders write through Spark (delivery files, table versions) into a
fresh folder under the shared checkpoint directory and read the result back,
so the work grows with the input tables.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from contactgate.operators.merge import diff, upsert
from contactgate.plans.catalog import Layers, register
from contactgate.plans.oracle import SPLIT_DATE
from contactgate.session import fresh_path as _fresh
from contactgate.sources import schemas as S
from contactgate.sources.delivery import (
    DELIVERY_DIR, deliver, delivery_stem, good_rows, ingest_change, ingest_enrollment, ingest_lines, ingest_snapshot, reject_share_check, rejects,
)
from contactgate.sources.tables import DeliveryTable, KeyedTable, RunTable

KEYS = ["account_number", "phone_number"]


def _delivered(spark, sf):
    """Stand-in feeds written as gzip delivery files, read back by ingest."""
    L = Layers(spark, sf)
    root = _fresh(spark, "deliveries")
    deliver(L.nonfin, root, "MAINTENANCE", S.SNAPSHOT_COLUMNS)
    deliver(L.supplfwd, root, "MAINTENANCE", S.CHANGE_COLUMNS)
    deliver(L.enrollment, root, "ENROLLMENT", S.ENROLLMENT_COLUMNS)
    return root


@register("ingest_snapshot", "SELECT * EXCLUDE (_source_file, _row_id) FROM nonfin", "B1 B2 B3 B5")
def q_ingest_snapshot(spark, sf):
    root = _delivered(spark, sf)
    return ingest_snapshot(spark, root, layout="directory").drop("_source_file")


@register("ingest_change", "SELECT * EXCLUDE (_source_file, _row_id) FROM supplfwd", "B1 B2 B3 B6")
def q_ingest_change(spark, sf):
    root = _delivered(spark, sf)
    return ingest_change(spark, root, layout="directory").drop("_source_file")


@register("ingest_enrollment", "SELECT * EXCLUDE (_source_file, _row_id) FROM enrollment",
          "B1 B2 B3 B4")
def q_ingest_enrollment(spark, sf):
    root = _delivered(spark, sf)
    return ingest_enrollment(spark, root, layout="directory").drop("_source_file")


_LINE_SQL = " || '|' || ".join(f"coalesce({c}, '')" for c in S.CHANGE_COLUMNS)
_SHORT_SQL = " || '|' || ".join(f"coalesce({c}, '')" for c in S.CHANGE_COLUMNS[:10])
_LINE_NO_SQL = "CAST(substr(cnsmr_phn_hst_id, 2) AS BIGINT) % 50"


def _damaged_lines(spark, sf):
    """Change files as delivered, some lines cut short, some with fields too many."""
    feed = Layers(spark, sf).supplfwd
    number = F.expr(_LINE_NO_SQL)
    joined = lambda columns: F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in columns])
    line = (F.when(number == 0, joined(S.CHANGE_COLUMNS[:10]))
            .when(number == 1, F.concat(joined(S.CHANGE_COLUMNS), F.lit("|one|more"))).otherwise(joined(S.CHANGE_COLUMNS)))
    root = _fresh(spark, "damaged")
    stem = delivery_stem("_source_file")
    # one column of whole lines, named by the header
    (feed.select(line.alias("|".join(S.CHANGE_COLUMNS)), stem.alias(DELIVERY_DIR)).sortWithinPartitions(DELIVERY_DIR)
     .write.partitionBy(DELIVERY_DIR).option("sep", "\x01").option("header", "true").option("compression", "gzip")
     .csv(f"{root}/MAINTENANCE"))
    return ingest_lines(spark, root, S.CHANGE_GLOB, S.CHANGE_SCHEMA, layout="directory")


@register("ingest_good_rows", f"""
SELECT * EXCLUDE (_source_file, _row_id) FROM supplfwd WHERE {_LINE_NO_SQL} > 1""", "B1 B6")
def q_ingest_good_rows(spark, sf):
    return good_rows(_damaged_lines(spark, sf)).drop("_source_file")


@register("ingest_rejects", f"""
SELECT _file_date, CASE WHEN {_LINE_NO_SQL} = 0 THEN 'short' ELSE 'long' END AS _reject_reason,
       CASE WHEN {_LINE_NO_SQL} = 0 THEN {_SHORT_SQL} ELSE {_LINE_SQL} || '|one|more' END AS _raw
FROM supplfwd WHERE {_LINE_NO_SQL} <= 1""", "B1 B2")
def q_ingest_rejects(spark, sf):
    return rejects(_damaged_lines(spark, sf)).drop("_source_file")


@register("quality_reject_share", f"""
SELECT 'reject_share' AS name, bad <= n * 0.05 AS passed, bad AS observed, 'share<=0.05' AS expected
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {_LINE_NO_SQL} <= 1) AS bad FROM supplfwd) x""", "B1 Q1 Q4")
def q_quality_reject_share(spark, sf):
    return reject_share_check(_damaged_lines(spark, sf), 0.05)


@register("ingest_file_layout", """
SELECT * EXCLUDE (_source_file, _row_id), 'snapshot' AS feed FROM nonfin""", "B1 B2 B3 B5")
def q_ingest_file_layout(spark, sf):
    """The same files in the original layout, ``<folder>/<name>.csv.gz``, found by name
    alone.  Spark names what it writes, so each name here is a folder holding its parts;
    the reader's glob and the date in the name work on it as on a file."""
    L = Layers(spark, sf)
    root = _fresh(spark, "files")
    deliver(L.nonfin, root, "MAINTENANCE", S.SNAPSHOT_COLUMNS, layout="file")
    return ingest_snapshot(spark, root, layout="file").drop("_source_file").withColumn("feed", F.lit("snapshot"))


@register("lineage_columns", """
SELECT regexp_extract(_source_file, '([^/]+)\\.csv\\.gz$', 1) AS delivery, count(*) AS row_count,
       min(_file_date) AS file_date
FROM (SELECT _source_file, _file_date FROM nonfin UNION ALL SELECT _source_file, _file_date FROM supplfwd
      UNION ALL SELECT _source_file, _file_date FROM enrollment) f
GROUP BY 1""", "B2 I5")
def q_lineage_columns(spark, sf):
    """Rows per delivery, traced from the ingested file path back to the
    delivery name, with the delivery date parsed at ingest."""
    root = _delivered(spark, sf)
    frames = [ingest_snapshot(spark, root, layout="directory"),
              ingest_change(spark, root, layout="directory"),
              ingest_enrollment(spark, root, layout="directory")]
    files = None
    for f in frames:
        part = f.select("_source_file", "_file_date")
        files = part if files is None else files.unionByName(part)
    parent = F.substring_index(F.substring_index("_source_file", "/", -2), "/", 1)      # delivery=<name>
    delivery = F.substring_index(parent, f"{DELIVERY_DIR}=", -1)
    return files.groupBy(delivery.alias("delivery")).agg(
        F.count(F.lit(1)).alias("row_count"), F.min("_file_date").alias("file_date"))


@register("table_roundtrip", "SELECT * FROM gold", "B7 B8")
def q_table_roundtrip(spark, sf):
    t = RunTable(spark, _fresh(spark, "consent"))
    t.write(Layers(spark, sf).consent, run=1, sort_by=KEYS)
    return t.read(1)


@register("sql_on_path", """
SELECT phone_source, count(*) AS cnt, count(*) FILTER (WHERE is_deleted) AS deleted
FROM gold GROUP BY phone_source""", "B9")
def q_sql_on_path(spark, sf):
    t = RunTable(spark, _fresh(spark, "consent"))
    t.write(Layers(spark, sf).consent, run=1)
    return spark.sql(
        f"SELECT phone_source, count(*) AS cnt, count_if(is_deleted) AS deleted "
        f"FROM parquet.`{t.path}` WHERE run = 1 GROUP BY phone_source")


def _early_late(spark, sf):
    early = Layers(spark, sf, where=F.col("_file_date") < F.lit(SPLIT_DATE).cast("date"))
    late = Layers(spark, sf, where=F.col("_file_date") >= F.lit(SPLIT_DATE).cast("date"))
    return early.consent, late.consent


def _after_late(spark, sf):
    """The consent table once the late deliveries are in: both batches folded into one
    state.  (A state of the late batch alone would leave keys live that the newer
    snapshots no longer list.)"""
    from contactgate.plans.incremental import IncrementalState
    from contactgate.plans.phone_state import build_consent
    split = F.lit(SPLIT_DATE).cast("date")
    inc = IncrementalState(spark, _fresh(spark, "incremental"))
    for cond in (F.col("_file_date") < split, F.col("_file_date") >= split):
        L = Layers(spark, sf, where=cond)
        inc.apply(L.nonfin, L.supplfwd, L.enrollment)
    return build_consent(inc.state())


_UPSERT_SQL = """
SELECT * FROM gold_early e
WHERE NOT EXISTS (SELECT 1 FROM gold_late l WHERE l.account_number = e.account_number
                  AND l.phone_number = e.phone_number)
UNION ALL
SELECT * FROM gold_late"""


# the full state lists every key of the earlier run, so the merge replaces all of them
@register("upsert_merge", "SELECT * FROM gold", "I1 I2 J9")
def q_upsert_merge(spark, sf):
    """An earlier run's table, then a later delivery batch merged into it."""
    early, _ = _early_late(spark, sf)
    t = RunTable(spark, _fresh(spark, "consent"))
    t.upsert(early, KEYS, run=1, base=None)
    t.upsert(_after_late(spark, sf), KEYS, run=2, base=1)
    return t.read(2)


@register("upsert_merge_plain", _UPSERT_SQL, "I1 J9")
def q_upsert_merge_plain(spark, sf):
    early, late = _early_late(spark, sf)
    return upsert(early, late, KEYS)


@register("upsert_touched_buckets", _UPSERT_SQL, "I1 J9")
def q_upsert_touched_buckets(spark, sf):
    """The later batch merged into a table in key buckets: the buckets it has keys of are
    replaced, all other files stay."""
    early, late = _early_late(spark, sf)
    t = KeyedTable(spark, _fresh(spark, "consent-keyed"), KEYS, buckets=8)
    t.merge(early, run=1)
    t.merge(late, run=2)
    return t.read()


_VALUES = ["phone_source", "has_sms_consent", "sms_consent_updated_at", "is_deleted",
           "delete_type", "deleted_at", "_source_file"]


def _change_feed_sql(old: str, new: str) -> str:
    cols = ", ".join(_VALUES)
    o_cols = ", ".join(f"o.{c}" for c in _VALUES)
    n_cols = ", ".join(f"n.{c}" for c in _VALUES)
    distinct = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in _VALUES)
    return f"""
SELECT account_number, phone_number, {cols}, 'insert' AS _change_type FROM {new} n
WHERE NOT EXISTS (SELECT 1 FROM {old} o WHERE o.account_number = n.account_number
                  AND o.phone_number = n.phone_number)
UNION ALL
SELECT account_number, phone_number, {cols}, 'delete' FROM {old} o
WHERE NOT EXISTS (SELECT 1 FROM {new} n WHERE o.account_number = n.account_number
                  AND o.phone_number = n.phone_number)
UNION ALL
SELECT o.account_number, o.phone_number, {o_cols}, 'update_preimage'
FROM {old} o JOIN {new} n USING (account_number, phone_number) WHERE {distinct}
UNION ALL
SELECT n.account_number, n.phone_number, {n_cols}, 'update_postimage'
FROM {old} o JOIN {new} n USING (account_number, phone_number) WHERE {distinct}"""


@register("change_feed", _change_feed_sql("gold_early", "gold"), "I3")
def q_change_feed(spark, sf):
    early, _ = _early_late(spark, sf)
    t = RunTable(spark, _fresh(spark, "consent"))
    t.upsert(early, KEYS, run=1, base=None)
    t.upsert(_after_late(spark, sf), KEYS, run=2, base=1)
    return t.changes(1, 2, KEYS)


@register("change_feed_layers", _change_feed_sql("gold_early", "gold"), "I3")
def q_change_feed_layers(spark, sf):
    """What a full rebuild changes relative to the earlier run."""
    early, _ = _early_late(spark, sf)
    return diff(early, Layers(spark, sf).consent, KEYS)


@register("version_as_of", "SELECT * FROM gold_early", "I4")
def q_version_as_of(spark, sf):
    early, _ = _early_late(spark, sf)
    t = RunTable(spark, _fresh(spark, "consent"))
    t.upsert(early, KEYS, run=1, base=None)
    t.upsert(_after_late(spark, sf), KEYS, run=2, base=1)
    return t.read(1)


@register("schema_per_run", """
SELECT account_number, phone_number, CAST(has_sms_consent AS VARCHAR) AS has_sms_consent,
       NULL AS delete_type, phone_source, 1 AS run FROM gold_early
UNION ALL
SELECT account_number, phone_number, CASE WHEN has_sms_consent THEN 'yes' ELSE 'no' END, delete_type, NULL, 2 FROM gold""",
          "B8 I4")
def q_schema_per_run(spark, sf):
    """Two runs of one table: the second has a column more, one less, and another type for
    a third; each reads back as written, the history aligns them by name."""
    early, _ = _early_late(spark, sf)
    t = RunTable(spark, _fresh(spark, "schema"))
    t.write(early.select(*KEYS, "has_sms_consent", "phone_source"), run=1)
    said = F.when(F.col("has_sms_consent"), "yes").otherwise("no").alias("has_sms_consent")
    t.write(Layers(spark, sf).consent.select(*KEYS, said, "delete_type"), run=2)
    if t.read(1).columns != [*KEYS, "has_sms_consent", "phone_source"] or t.read(2).columns != [*KEYS, "has_sms_consent", "delete_type"]:
        raise AssertionError("a run came back with another schema")
    return t.history()


_RECORDS_SQL = """
SELECT substr(legacy, 1, length(legacy) - 1) AS account_number, '+1' || phone AS phone_number,
       CASE WHEN flag = 'Y' THEN true WHEN flag = 'N' THEN false END AS has_sms_consent,
       phone_source, record_source, event_date, class, prio, t0, t1
FROM (SELECT cnsmr_idntfr_lgcy_txt AS legacy, cnsmr_phn_nmbr_txt AS phone, cnsmr_phn_cnsnt_flg AS flag,
             cnsmr_phn_src_val_txt AS phone_source, 'NON-FIN' AS record_source, _file_date AS event_date,
             1 AS class, 0 AS prio, _source_file AS t0, _row_id AS t1 FROM nf_dedup
      UNION ALL
      SELECT cnsmr_idntfr_lgcy_txt, cnsmr_phn_nmbr_txt, cnsmr_phn_cnsnt_flg, cnsmr_phn_src_val_txt, 'SUPPLFWD',
             CAST(try_strptime(record_date, '%Y-%m-%d') AS DATE), 1, 1, cnsmr_phn_hst_id, _row_id FROM sf_dedup
      UNION ALL
      SELECT consumer_legacy_identifier, phone_number, NULL, phone_source, 'ENRLMT',
             CAST(try_strptime(enrollment_date, '%Y-%m-%d') AS DATE), 0, 0, _source_file, _row_id FROM enrollment) u
WHERE event_date IS NOT NULL"""


@register("consent_as_of", f"""
SELECT r.request_id, r.account_number, '+1' || r.phone_number AS phone_number, r.asked_on,
       h.has_sms_consent, h.phone_source, h.record_source, h.event_date
FROM (SELECT *, DATE '1992-01-01' + CAST(request_id % 3652 AS INTEGER) AS asked_on FROM requests) r
LEFT JOIN ({_RECORDS_SQL}) h
  ON h.account_number = r.account_number AND h.phone_number = '+1' || r.phone_number AND h.event_date <= r.asked_on
QUALIFY row_number() OVER (PARTITION BY r.request_id ORDER BY class DESC, event_date DESC, prio DESC,
                           t0 DESC NULLS LAST, t1 DESC NULLS LAST) = 1""", "I6")
def q_consent_as_of(spark, sf):
    """Every request with a day: which record held for its key on that day?"""
    from contactgate.plans.phone_state import consent_as_of
    from contactgate.sources.standin import permission_requests
    L = Layers(spark, sf)
    asked = permission_requests(spark, sf).withColumn(
        "asked_on", F.expr("date_add(DATE'1992-01-01', CAST(request_id % 3652 AS INT))"))
    return consent_as_of(asked, L.nonfin, L.supplfwd, L.enrollment)


_LINEAGE_RECORDS_SQL = """
SELECT cnsmr_idntfr_lgcy_txt AS legacy_identifier, cnsmr_phn_nmbr_txt AS phone_number, cnsmr_phn_typ_val_txt AS phone_type,
       cnsmr_phn_stts_val_txt AS phone_status, cnsmr_phn_src_val_txt AS phone_source, cnsmr_phn_tchnlgy_typ_val_txt AS phone_technology,
       cnsmr_phn_qlty_score_nmbr AS quality_score, cnsmr_phn_cnsnt_flg AS consent_flag, 'NON-FIN' AS record_source,
       _source_file, _file_date AS event_date, 1 AS class, 0 AS prio, _source_file AS t0, _row_id AS t1 FROM nf_dedup
UNION ALL
SELECT cnsmr_idntfr_lgcy_txt, cnsmr_phn_nmbr_txt, cnsmr_phn_typ_val_txt, cnsmr_phn_stts_val_txt, cnsmr_phn_src_val_txt,
       cnsmr_phn_tchnlgy_typ_val_txt, cnsmr_phn_qlty_score_nmbr, cnsmr_phn_cnsnt_flg, 'SUPPLFWD', _source_file,
       CAST(try_strptime(record_date, '%Y-%m-%d') AS DATE), 1, 1, cnsmr_phn_hst_id, _row_id FROM sf_dedup
UNION ALL
SELECT consumer_legacy_identifier, phone_number, phone_type, phone_status, phone_source, phone_technology, quality_score, NULL,
       'ENRLMT', _source_file, CAST(try_strptime(enrollment_date, '%Y-%m-%d') AS DATE), 0, 0, _source_file, _row_id FROM enrollment"""


def _lineage_sql() -> str:
    from contactgate.plans.phone_state import LINEAGE_OF
    rank = "class DESC, event_date DESC NULLS LAST, prio DESC, t0 DESC NULLS LAST, t1 DESC NULLS LAST"
    key = "PARTITION BY legacy_identifier, phone_number"
    each = [f"""
SELECT legacy_identifier, phone_number, '{c}' AS column_name, {c} AS value, event_date, record_source, _source_file,
       first_value({c}) OVER ({key} ORDER BY {rank}) AS current_value
FROM ({_LINEAGE_RECORDS_SQL}) r
QUALIFY row_number() OVER ({key} ORDER BY coalesce({c}, '') <> '' DESC, {rank}) = 1""" for c in LINEAGE_OF]
    return "SELECT * FROM (" + "\nUNION ALL".join(each) + ") l WHERE coalesce(value, '') <> ''"


@register("column_lineage", _lineage_sql(), "I5")
def q_column_lineage(spark, sf):
    """Which record and file supplied each attribute of every key."""
    from contactgate.plans.phone_state import column_lineage
    L = Layers(spark, sf)
    return column_lineage(L.nonfin, L.supplfwd, L.enrollment)


@register("presence_intervals", """
SELECT cnsmr_idntfr_lgcy_txt, cnsmr_phn_nmbr_txt, listed_from, listed_to,
       (SELECT min(c) FROM (SELECT unnest(cal) AS c) u WHERE c > listed_to) AS gone_at,
       lead(listed_from) OVER (PARTITION BY cnsmr_idntfr_lgcy_txt, cnsmr_phn_nmbr_txt ORDER BY listed_from) AS back_at
FROM (SELECT cnsmr_idntfr_lgcy_txt, cnsmr_phn_nmbr_txt, island, any_value(cal) AS cal, min(d) AS listed_from, max(d) AS listed_to
      FROM (SELECT *, count(*) FILTER (opens) OVER (PARTITION BY cnsmr_idntfr_lgcy_txt, cnsmr_phn_nmbr_txt ORDER BY d) AS island
            FROM (SELECT p.*, cal, prev IS NULL OR len(list_filter(cal, lambda x: x > prev AND x < d)) > 0 AS opens
                  FROM (SELECT *, lag(d) OVER (PARTITION BY cnsmr_idntfr_lgcy_txt, cnsmr_phn_nmbr_txt ORDER BY d) AS prev
                        FROM (SELECT DISTINCT cnsmr_idntfr_lgcy_txt, cnsmr_phn_nmbr_txt, _file_date AS d FROM nf_dedup) a) p,
                       (SELECT list(d) AS cal FROM (SELECT _file_date AS d, count(*) AS n, coalesce(max(count(*)) OVER (
                          ORDER BY _file_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS most
                        FROM nf_dedup GROUP BY _file_date) c WHERE n >= most * 0.5) k) o) i
      GROUP BY cnsmr_idntfr_lgcy_txt, cnsmr_phn_nmbr_txt, island) s""", "A3 D6 W7")
def q_presence_intervals(spark, sf):
    """When each key was listed, when it was gone and when it came back."""
    from contactgate.operators.deletes import presence
    return presence(Layers(spark, sf).nonfin_dedup, ["cnsmr_idntfr_lgcy_txt", "cnsmr_phn_nmbr_txt"])


@register("consent_validity", f"""
SELECT account_number, phone_number, has_sms_consent, phone_source, record_source, event_date,
       event_date AS valid_from, lead(event_date) OVER (PARTITION BY account_number, phone_number ORDER BY event_date) AS valid_to
FROM (SELECT *, max(r) OVER (PARTITION BY account_number, phone_number ORDER BY event_date
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
      FROM (SELECT *, row_number() OVER (PARTITION BY account_number, phone_number
                        ORDER BY class, event_date, prio, t0 NULLS FIRST, t1 NULLS FIRST) AS r
            FROM ({_RECORDS_SQL}) h
            QUALIFY row_number() OVER (PARTITION BY account_number, phone_number, event_date
                        ORDER BY class DESC, prio DESC, t0 DESC NULLS LAST, t1 DESC NULLS LAST) = 1) d) e
WHERE before IS NULL OR before < r""", "I6")
def q_consent_validity(spark, sf):
    from contactgate.plans.phone_state import consent_validity
    L = Layers(spark, sf)
    return consent_validity(L.nonfin, L.supplfwd, L.enrollment)


@register("stream_served_state", """
SELECT * EXCLUDE (_source_file, _row_id) FROM sf_latest""", "X1 I1")
def q_stream_served_state(spark, sf):
    """Change deliveries merged by the stream into a served table, those of two months once more;
    read as it stands."""
    from contactgate.streaming.served import serve_changes, served_changes
    L = Layers(spark, sf)
    root, table, ckpt = (_fresh(spark, x) for x in ("deliveries", "served", "stream-ckpt"))
    deliver(L.supplfwd, root, "MAINTENANCE", S.CHANGE_COLUMNS)
    serve_changes(spark, root, table, ckpt, layout="directory", max_files_per_trigger=120, buckets=8)
    again = L.supplfwd.where(F.col("_file_date") < F.lit("1998-03-01").cast("date")).withColumn(
        "_source_file", F.regexp_replace("_source_file", r"_000\.csv\.gz$", "_001.csv.gz"))
    deliver(again, root, "MAINTENANCE", S.CHANGE_COLUMNS)
    serve_changes(spark, root, table, ckpt, layout="directory", buckets=8)
    return served_changes(spark, table, buckets=8).drop("_source_file")


@register("stream_change_apply", """
SELECT * EXCLUDE (_source_file, _row_id) FROM sf_latest""", "X1")
def q_stream_change_apply(spark, sf):
    """Change deliveries applied by an availableNow file stream, several files
    per micro-batch, then read back as the newest record per key."""
    from contactgate.streaming.change_stream import current_changes, run_change_stream
    L = Layers(spark, sf)
    root = _fresh(spark, "deliveries")
    deliver(L.supplfwd, root, "MAINTENANCE", S.CHANGE_COLUMNS)
    state = _fresh(spark, "change-state")
    run_change_stream(spark, root, state, _fresh(spark, "stream-ckpt"), layout="directory",
                      max_files_per_trigger=50)
    return current_changes(spark, state).drop("_source_file")


@register("incremental_state", "SELECT * FROM silver", "C4 I1 A3")
def q_incremental_state(spark, sf):
    """The state folded from two delivery batches (before / from the split
    date) through stored reductions; equals the batch state."""
    from contactgate.plans.incremental import IncrementalState
    split = F.lit(SPLIT_DATE).cast("date")
    inc = IncrementalState(spark, _fresh(spark, "incremental"))
    for cond in (F.col("_file_date") < split, F.col("_file_date") >= split):
        L = Layers(spark, sf, where=cond)
        inc.apply(L.nonfin, L.supplfwd, L.enrollment)
    return inc.state()


@register("incremental_partial_feeds", "SELECT * FROM silver", "C4 I1 B1")
def q_incremental_partial_feeds(spark, sf):
    """Folds as deliveries come in an ordinary week: change files alone, enrollments
    alone, nothing at all, a snapshot date in two files on two days; equals the batch state."""
    from contactgate.plans.incremental import IncrementalState
    split = F.lit(SPLIT_DATE).cast("date")
    early, late = (Layers(spark, sf, where=c) for c in (F.col("_file_date") < split, F.col("_file_date") >= split))
    second = F.crc32("_row_id") % 2 == 1
    none = [f.limit(0) for f in (late.nonfin, late.supplfwd, late.enrollment)]
    newest = late.nonfin.select("_file_date").distinct().count()
    inc = IncrementalState(spark, _fresh(spark, "incremental"), open_dates=max(1, newest))
    inc.apply(early.nonfin, early.supplfwd.where(~second), early.enrollment)
    inc.apply(none[0], early.supplfwd.where(second), none[2])
    inc.apply(none[0], none[1], late.enrollment)
    inc.apply(*none)
    inc.apply(late.nonfin.where(second), none[1], none[2])
    inc.apply(late.nonfin.where(~second), late.supplfwd, none[2])
    return inc.state()


from contactgate.plans.catalog import LOOKUP_ACCOUNT, LOOKUP_PHONE  # noqa: E402

LOOKUP_SQL = f"""
SELECT '{LOOKUP_ACCOUNT}' AS account_number, '+1{LOOKUP_PHONE}' AS phone_number,
       COALESCE((SELECT can_send_sms FROM decisions
                 WHERE account_number = '{LOOKUP_ACCOUNT}'
                   AND phone_number = '+1{LOOKUP_PHONE}'), false) AS can_send_sms"""


def publish(spark, sf) -> RunTable:
    """Write the consent table as run 1, range-sorted on the key."""
    t = RunTable(spark, _fresh(spark, "consent"))
    t.write(Layers(spark, sf).consent, run=1, sort_by=KEYS)
    return t


@register("published_lookup", LOOKUP_SQL, "P6 C6 B7")
def q_published_lookup(spark, sf):
    """Point lookup against the published (written, key-sorted) table."""
    from contactgate.operators.decide import lookup
    from contactgate.plans.catalog import LOOKUP_ACCOUNT, LOOKUP_PHONE
    return lookup(spark, publish(spark, sf).read(1), LOOKUP_ACCOUNT, LOOKUP_PHONE)


@register("bronze_since", f"""
SELECT * EXCLUDE (_source_file, _row_id) FROM nonfin WHERE _file_date >= DATE '{SPLIT_DATE}'""",
          "B5 B7 B8 I4")
def q_bronze_since(spark, sf):
    """Snapshot deliveries ingested from files into a date-partitioned bronze
    table, then read back from the split date on (partition-pruned)."""
    root = _fresh(spark, "deliveries")
    deliver(Layers(spark, sf).nonfin, root, "MAINTENANCE", S.SNAPSHOT_COLUMNS)
    bronze = DeliveryTable(spark, _fresh(spark, "bronze-nonfin"))
    bronze.append(ingest_snapshot(spark, root, layout="directory"))
    return bronze.read(since=SPLIT_DATE).drop("_source_file")


@register("two_deliveries_of_a_date", """
SELECT * EXCLUDE (_source_file, _row_id) FROM supplfwd""", "B6 B8")
def q_two_deliveries_of_a_date(spark, sf):
    """Change records delivered in two files for every date, appended one after the
    other (and the first once more): both stay, neither twice."""
    feed = Layers(spark, sf).supplfwd.drop("_row_id")
    second = F.crc32("cnsmr_phn_hst_id") % 2 == 1
    other = F.regexp_replace("_source_file", r"_000\.csv\.gz$", "_001.csv.gz")
    bronze = DeliveryTable(spark, _fresh(spark, "bronze-supplfwd"))
    bronze.append(feed.where(~second))
    bronze.append(feed.where(second).withColumn("_source_file", other))
    bronze.append(feed.where(~second))
    return bronze.read().drop("_source_file")


@register("gated_publish", """
SELECT *, 'published' AS outcome FROM gold
UNION ALL BY NAME SELECT 'blocked' AS outcome, 'empty feed' AS account_number
UNION ALL BY NAME SELECT 'blocked' AS outcome, 'partial snapshot' AS account_number""", "Q4 D8 I1 I2")
def q_gated_publish(spark, sf):
    """Three runs through the gates: all feeds (published), an empty change feed and
    a partial newest snapshot (both blocked before anything is published)."""
    from contactgate.plans.phone_state import gated_run
    L = Layers(spark, sf)
    root = _fresh(spark, "gated")
    newest = L.nonfin.agg(F.max("_file_date")).scalar()
    partial = L.nonfin.where((F.col("_file_date") < newest) | (F.crc32("cnsmr_phn_id") % 5 == 0))
    runs = [("empty feed", gated_run(L.nonfin, L.supplfwd.limit(0), L.enrollment, root, run=1, on_fail="block")),
            ("partial snapshot", gated_run(partial, L.supplfwd, L.enrollment, root, run=2, on_fail="block"))]
    done = gated_run(L.nonfin, L.supplfwd, L.enrollment, root, run=3)
    published = RunTable(spark, f"{root}/consent").read(done).withColumn("outcome", F.lit("published"))
    blocked = spark.createDataFrame([(why, "blocked") for why, run in runs if run is None], "account_number string, outcome string")
    return published.unionByName(blocked, allowMissingColumns=True)


@register("incremental_catch_up", "SELECT * FROM silver", "C4 B7 I4")
def q_incremental_catch_up(spark, sf):
    """Deliveries land in date-partitioned bronze tables; the state is caught
    up in two folds that each read only their partitions."""
    from contactgate.plans.incremental import IncrementalState
    L = Layers(spark, sf)
    tables = []
    for name, feed in (("nonfin", L.nonfin), ("supplfwd", L.supplfwd), ("enrollment", L.enrollment)):
        t = DeliveryTable(spark, _fresh(spark, f"bronze-{name}"))
        t.append(feed)
        tables.append(t)
    inc = IncrementalState(spark, _fresh(spark, "incremental"))
    inc.apply_deliveries(*tables, until=SPLIT_DATE)
    inc.apply_deliveries(*tables, since=SPLIT_DATE)
    return inc.state()


def _history_sql() -> str:
    from contactgate.plans.reports import _GOLD_Q, _SILVER_Q, _quality_sql
    full = _quality_sql(_SILVER_Q + _GOLD_Q)
    early = full
    for name in ("silver", "gold"):
        early = re.sub(rf"\b{name}\b", f"{name}_early", early)
    return (f"SELECT name, passed, observed, expected, 1::BIGINT AS run FROM ({early}) e\n"
            f"UNION ALL\nSELECT name, passed, observed, expected, 2::BIGINT AS run FROM ({full}) f")


@register("quality_history", _history_sql(), "Q4 I4")
def q_quality_history(spark, sf):
    """Check results persisted per run: the earlier run's and the current
    run's results as two runs of one history table, read back whole."""
    from contactgate.plans.reports import published_quality
    early, _ = _early_late(spark, sf)
    t = RunTable(spark, _fresh(spark, "quality-history"))
    t.write(published_quality(early), run=1)
    t.write(published_quality(Layers(spark, sf).consent), run=2)
    return t.history()
