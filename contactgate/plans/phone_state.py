"""The phone-consent configuration of the generic operators.

Bronze feeds (raw strings + ``_source_file``/``_file_date``) → state (one row
per legacy identifier and phone, with delete status) → consent (published,
one row per account and phone) → decisions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactgate.functions.columns import (
    PHONE_PREFIX, account_from_legacy_sql, normalize_phone_input, normalize_phone_sql, parse_date_sql, tri_state_sql,
)
from contactgate.operators.deletes import absent_from_latest, flag_deletes
from contactgate.operators.latest import dedup_by, latest_by
from contactgate.operators.reconcile import (
    CHANGE, SNAPSHOT, ReconcileConfig, SourceSpec, delete_status, reconcile,
)
from contactgate.sources import schemas as S

KEYS = ["legacy_identifier", "phone_number"]
EVENT_COLUMNS = [
    "legacy_identifier", "phone_number", "phone_id", "phone_type", "phone_status",
    "phone_source", "phone_technology", "quality_score", "consent_flag", "consent_date",
    "event_date", "soft_delete_flag", "record_source", "_source_file",
]
EVENT_TYPES = {"consent_date": "date", "event_date": "date"}
# raw column -> event column, shared by the snapshot and change layouts
_PHONE_ATTRS = {
    "legacy_identifier": "cnsmr_idntfr_lgcy_txt",
    "phone_number": "cnsmr_phn_nmbr_txt",
    "phone_type": "cnsmr_phn_typ_val_txt",
    "phone_status": "cnsmr_phn_stts_val_txt",
    "phone_source": "cnsmr_phn_src_val_txt",
    "phone_technology": "cnsmr_phn_tchnlgy_typ_val_txt",
    "quality_score": "cnsmr_phn_qlty_score_nmbr",
    "consent_flag": "cnsmr_phn_cnsnt_flg",
}


# raw columns the state actually uses (identity data -- SSN, names, agency -- is
# pruned before the first shuffle, so it never reaches an aggregation buffer)
SNAPSHOT_USED = ["cnsmr_phn_id", *_PHONE_ATTRS.values(), "cnsmr_phn_cnsnt_dt"]
CHANGE_USED = ["cnsmr_phn_hst_id", *_PHONE_ATTRS.values(), "cnsmr_phn_cnsnt_dt",
               "cnsmr_phn_sft_dlt_flg", "record_date"]
ENROLLMENT_USED = ["consumer_legacy_identifier", "phone_number", "phone_type", "phone_status",
                   "phone_source", "phone_technology", "quality_score", "enrollment_date"]


def prune(df: DataFrame, used: list[str]) -> DataFrame:
    """Keep the used raw columns plus lineage and an optional ``_row_id``."""
    extra = [c for c in ("_source_file", "_file_date", "_row_id") if c in df.columns]
    return df.select(*used, *extra)


def row_key(df: DataFrame, raw_columns: list[str]) -> str:
    """Deterministic in-file tiebreak: a provided ``_row_id``, or else the text
    of the used fields (NULL is told from the empty text).  Rows equal on every used field are
    interchangeable downstream, so ordering by them is a total order for all
    that matters."""
    if "_row_id" in df.columns:
        return "_row_id"
    present = [c for c in raw_columns if c in df.columns]
    return "concat_ws('|', " + ", ".join(f"coalesce({c}, char(0))" for c in present) + ")"


CHANGE_DATE = parse_date_sql("record_date")
CONSENT_DATE = parse_date_sql("cnsmr_phn_cnsnt_dt")
ENROLLMENT_DATE = parse_date_sql("enrollment_date")


def change_date(df: DataFrame) -> Column:
    return F.expr(CHANGE_DATE)


# --- per-feed building blocks ---------------------------------------------

# Both forms reduce map-side: ``row_number() = 1`` plans a partial
# WindowGroupLimit before the exchange (top-1 per key per map task), the
# aggregate a partial max_by.  The window form stays in codegen'd sorts and
# measured faster for the wide dedup payloads; the reconcile itself must be an
# aggregate (three results per key in one pass).
DEDUP_METHOD = "window"

def dedup_snapshot(nonfin: DataFrame) -> DataFrame:
    """One row per (phone id, snapshot date): the first by file, then record."""
    return dedup_by(nonfin, ["cnsmr_phn_id", "_file_date"],
                    ["_source_file", row_key(nonfin, S.SNAPSHOT_COLUMNS)], method=DEDUP_METHOD)


def dedup_change(supplfwd: DataFrame) -> DataFrame:
    """One row per (legacy id, phone, raw record date): the lowest history id."""
    return dedup_by(supplfwd, ["cnsmr_idntfr_lgcy_txt", "cnsmr_phn_nmbr_txt", "record_date"],
                    ["cnsmr_phn_hst_id", row_key(supplfwd, S.CHANGE_COLUMNS)], method=DEDUP_METHOD)


def latest_snapshot_state(nonfin_dedup: DataFrame) -> DataFrame:
    """Newest snapshot row per (legacy id, phone)."""
    return latest_by(nonfin_dedup, ["cnsmr_idntfr_lgcy_txt", "cnsmr_phn_nmbr_txt"],
                     ["_file_date", "_source_file", row_key(nonfin_dedup, S.SNAPSHOT_COLUMNS)])


def latest_change_state(supplfwd_dedup: DataFrame) -> DataFrame:
    """Newest change row per (legacy id, phone) by parsed date, then history id."""
    df = supplfwd_dedup.withColumn("record_date_parsed", change_date(supplfwd_dedup))
    return latest_by(df, ["cnsmr_idntfr_lgcy_txt", "cnsmr_phn_nmbr_txt"],
                     ["record_date_parsed", "cnsmr_phn_hst_id", row_key(df, S.CHANGE_COLUMNS)])


def hard_deletes(nonfin_dedup: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """``raw``: the feed before dedup (which never removes a whole delivery), for a
    newest date that costs a pruned scan and not a second dedup."""
    return absent_from_latest(nonfin_dedup, ["cnsmr_idntfr_lgcy_txt", "cnsmr_phn_nmbr_txt"], dates=raw)


def soft_deletes(supplfwd_dedup: DataFrame) -> DataFrame:
    out = flag_deletes(supplfwd_dedup, ["cnsmr_idntfr_lgcy_txt", "cnsmr_phn_nmbr_txt"],
                       change_date(supplfwd_dedup), "cnsmr_phn_sft_dlt_flg",
                       order=["cnsmr_phn_hst_id", row_key(supplfwd_dedup, S.CHANGE_COLUMNS)])
    return out.withColumnRenamed("cnsmr_idntfr_lgcy_txt", "legacy_identifier") \
              .withColumnRenamed("cnsmr_phn_nmbr_txt", "phone_number")


# --- source specs ------------------------------------------------------------

def snapshot_source(nonfin_dedup: DataFrame, raw: DataFrame | None = None) -> SourceSpec:
    cols = dict(_PHONE_ATTRS)
    cols.update({
        "phone_id": "cnsmr_phn_id",
        "consent_date": CONSENT_DATE,
        "event_date": "_file_date",
        "_source_file": "_source_file",
    })
    return SourceSpec(nonfin_dedup, cols, S.SRC_SNAPSHOT, priority=0,
                      tiebreak=["_source_file", row_key(nonfin_dedup, S.SNAPSHOT_COLUMNS)],
                      role=SNAPSHOT, snapshot_date="_file_date",
                      snapshot_dates=raw.select("_file_date") if raw is not None else None)


def change_source(supplfwd_dedup: DataFrame) -> SourceSpec:
    cols = dict(_PHONE_ATTRS)
    cols.update({
        "consent_date": CONSENT_DATE,
        "event_date": CHANGE_DATE,
        "soft_delete_flag": "cnsmr_phn_sft_dlt_flg",
        "_source_file": "_source_file",
    })
    return SourceSpec(supplfwd_dedup, cols, S.SRC_CHANGE, priority=1,
                      tiebreak=["cnsmr_phn_hst_id", row_key(supplfwd_dedup, S.CHANGE_COLUMNS)],
                      role=CHANGE)


def enrollment_source(enrollment: DataFrame) -> SourceSpec:
    cols = {
        "legacy_identifier": "consumer_legacy_identifier",
        "phone_number": "phone_number",
        "phone_type": "phone_type",
        "phone_status": "phone_status",
        "phone_source": "phone_source",
        "phone_technology": "phone_technology",
        "quality_score": "quality_score",
        "event_date": ENROLLMENT_DATE,
        "_source_file": "_source_file",
    }
    return SourceSpec(enrollment, cols, S.SRC_ENROLLMENT, priority=0, fallback=True,
                      tiebreak=["_source_file", row_key(enrollment, S.ENROLLMENT_COLUMNS)])


def aligned_events(nonfin: DataFrame, supplfwd: DataFrame, enrollment: DataFrame,
                   ordered: bool = False) -> DataFrame:
    """The three deduplicated feeds on the common event schema, tagged; ``ordered`` keeps
    the columns that records are ordered by."""
    from contactgate.operators.reconcile import align, tiebreak_width
    cfg = _config()
    specs = [snapshot_source(dedup_snapshot(prune(nonfin, SNAPSHOT_USED))),
             change_source(dedup_change(prune(supplfwd, CHANGE_USED))),
             enrollment_source(prune(enrollment, ENROLLMENT_USED))]
    out = None
    more = ["__class", "__prio", "__tb"] if ordered else []
    for s in specs:
        a = align(s, EVENT_COLUMNS, cfg, tiebreak_width(specs)).select(*EVENT_COLUMNS, *more)
        out = a if out is None else out.unionByName(a)
    return out


def _config() -> ReconcileConfig:
    return ReconcileConfig(keys=KEYS, types=EVENT_TYPES)


# --- layers ------------------------------------------------------------------

def reconciled(nonfin: DataFrame, supplfwd: DataFrame, enrollment: DataFrame,
               extra: dict | None = None) -> DataFrame:
    """Winner per key with raw hard/soft delete inputs (before precedence)."""
    specs = [snapshot_source(dedup_snapshot(prune(nonfin, SNAPSHOT_USED)), raw=nonfin),
             change_source(dedup_change(prune(supplfwd, CHANGE_USED))),
             enrollment_source(prune(enrollment, ENROLLMENT_USED))]
    return reconcile(specs, _config(), EVENT_COLUMNS, extra)


def build_state(nonfin: DataFrame, supplfwd: DataFrame, enrollment: DataFrame) -> DataFrame:
    """Silver: one row per (legacy id, phone), 17 columns."""
    df = delete_status(reconciled(nonfin, supplfwd, enrollment))
    return df.selectExpr(
        f"{account_from_legacy_sql('legacy_identifier')} AS account_number",
        *[c for c in S.STATE_COLUMNS if c != "account_number"])


def build_consent(state: DataFrame) -> DataFrame:
    """Gold: published phone number, tri-state consent, delete status."""
    return state.selectExpr(
        "account_number",
        f"{normalize_phone_sql('phone_number')} AS phone_number",
        "phone_source",
        f"{tri_state_sql('consent_flag')} AS has_sms_consent",
        "consent_date AS sms_consent_updated_at",
        "is_deleted", "delete_type", "deleted_at", "_source_file",
    )


def consent_history(nonfin: DataFrame, supplfwd: DataFrame, enrollment: DataFrame) -> DataFrame:
    """Consent transitions per (legacy id, phone), from the whole record
    history, in the same single aggregate as the reconcile:

    ``withdrawn``  current consent is N and an earlier record said Y
    ``erased``     current record carries no consent, but an earlier record
                   said N (a newer row without consent undoes a withdrawal)
    Other keys are not reported.  Dates: newest Y, newest N, current event.
    """
    extra = {
        "last_yes_date": "max(CASE WHEN consent_flag = 'Y' THEN event_date END)",
        "last_no_date": "max(CASE WHEN consent_flag = 'N' THEN event_date END)",
    }
    r = reconciled(nonfin, supplfwd, enrollment, extra)
    current = F.col("consent_flag")
    status = (F.when((current == "N") & F.col("last_yes_date").isNotNull(), F.lit("withdrawn"))
              .when((current.isNull() | (current == "")) & F.col("last_no_date").isNotNull(),
                    F.lit("erased")))
    return (r.withColumn("consent_change", status)
             .where(F.col("consent_change").isNotNull())
             .select("legacy_identifier", "phone_number", "consent_flag", "consent_date",
                     "last_yes_date", "last_no_date", "event_date", "record_source",
                     "consent_change"))


def consent_transitions(nonfin: DataFrame, supplfwd: DataFrame, enrollment: DataFrame) -> DataFrame:
    """Every withdrawal in a key's history: a record that says N directly after one that
    said Y, in the order of the records (records without a consent value are passed
    over).  One row per withdrawal: ``legacy_identifier, phone_number, given_at,
    withdrawn_at, record_source``.

    The window runs along the records of one (legacy id, phone); such a history is
    bounded by the deliveries there have been.  Only records with a consent value enter it."""
    from pyspark.sql import Window
    records = aligned_events(nonfin, supplfwd, enrollment, ordered=True).where("consent_flag IN ('Y', 'N')")
    order = Window.partitionBy(*KEYS).orderBy("__class", "event_date", "__prio", "__tb")
    before = F.lag(F.struct("consent_flag", "event_date")).over(order)
    return (records.withColumn("__before", before)
            .where((F.col("consent_flag") == "N") & (F.col("__before.consent_flag") == "Y"))
            .select(*KEYS, F.col("__before.event_date").alias("given_at"),
                    F.col("event_date").alias("withdrawn_at"), "record_source"))


CONSENT_VALUES = ["has_sms_consent", "phone_source", "record_source", "event_date"]


def consent_records(nonfin: DataFrame, supplfwd: DataFrame, enrollment: DataFrame) -> DataFrame:
    """Every record of the feeds by published key, with what it says and its ``rank``: the
    precedence by which the reconcile picks a key's current record."""
    return aligned_events(nonfin, supplfwd, enrollment, ordered=True).selectExpr(
        f"{account_from_legacy_sql('legacy_identifier')} AS account_number",
        f"{normalize_phone_sql('phone_number')} AS phone_number",
        f"{tri_state_sql('consent_flag')} AS has_sms_consent", "phone_source", "record_source", "event_date",
        "struct(__class, event_date, __prio, __tb) AS rank")


def consent_as_of(requests: DataFrame, nonfin: DataFrame, supplfwd: DataFrame, enrollment: DataFrame,
                  at: str = "asked_on") -> DataFrame:
    """What the records said about each request's key on the request's day ``at``: consent,
    source and date of the record that held then (all NULL if there was none)."""
    from contactgate.operators.asof import as_of
    asked = requests.withColumn("phone_number", normalize_phone_input("phone_number"))
    return as_of(asked, consent_records(nonfin, supplfwd, enrollment), ["account_number", "phone_number"], at,
                 "event_date", F.col("rank"), CONSENT_VALUES)


def consent_validity(nonfin: DataFrame, supplfwd: DataFrame, enrollment: DataFrame) -> DataFrame:
    """The intervals in which each record held for its key (:func:`asof.validity`)."""
    from contactgate.operators.asof import validity
    return validity(consent_records(nonfin, supplfwd, enrollment), ["account_number", "phone_number"],
                    "event_date", F.col("rank"), CONSENT_VALUES)


LINEAGE_OF = ["phone_type", "phone_status", "phone_source", "phone_technology", "quality_score", "consent_flag"]


def column_lineage(nonfin: DataFrame, supplfwd: DataFrame, enrollment: DataFrame) -> DataFrame:
    """Which record supplied each attribute of a key: ``legacy_identifier, phone_number,
    column_name, value, event_date, record_source, _source_file, current_value``.

    Per attribute the record of highest precedence that has a value for it (not NULL or
    empty), with its date, feed and file, beside what the key's winning record says
    (``current_value``: NULL or empty where the newest record dropped it).  Attributes that
    no record supplied have no row.  All of it is one aggregate over the aligned records, so one
    shuffle after the feeds' dedup, reduced before it."""
    records = aligned_events(nonfin, supplfwd, enrollment, ordered=True).withColumn(
        "__rank", F.expr("struct(__class, event_date, __prio, __tb)"))
    from_ = ["event_date", "record_source", "_source_file"]
    supplied = [F.max_by(F.struct(F.col(c).alias("value"), *from_),
                         F.when(F.coalesce(F.col(c) != "", F.lit(False)), F.col("__rank"))).alias(f"__{c}") for c in LINEAGE_OF]
    reduced = records.groupBy(*KEYS).agg(*supplied, F.max_by(F.struct(*LINEAGE_OF), "__rank").alias("__now"))
    each = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"__{c}").alias("s"), F.col(f"__now.{c}").alias("current_value"))
                     for c in LINEAGE_OF])
    return (reduced.select(*KEYS, F.explode(each).alias("e")).where(F.col("e.s").isNotNull())
            .select(*KEYS, "e.column_name", "e.s.value", *[f"e.s.{c}" for c in from_], "e.current_value"))


class LayerGateError(RuntimeError):
    """A layer's checks failed; nothing further was built."""


def gated_run(nonfin: DataFrame, supplfwd: DataFrame, enrollment: DataFrame, tables: str, run: int,
              base: int | None = None, on_fail: str = "raise") -> int | None:
    """Feeds -> state -> consent with a gate after each layer.

    Every layer is written once under ``tables`` as ``run`` and checked: what can be counted
    row by row while it is written, unique keys in one scan of what was written.  Feeds
    (rows, dates, share of keys kept from the snapshot before), state, consent (with its
    consistency against the state).  The results of all checks are stored as a run of
    ``<tables>/quality`` before the verdict is acted on.  A failed gate stops the run
    (``raise``), or ends it returning None (``block``), or is warned of (``warn``); the
    consent table is merged into ``<tables>/consent`` from run ``base`` only behind all gates."""
    from contactgate.operators.quality import check_mode, evaluate_while_writing, gate, row_count_positive
    from contactgate.plans import reports as R
    from contactgate.sources.tables import RunTable
    check_mode(on_fail)
    spark = nonfin.sparkSession
    root = tables.rstrip("/")
    results = RunTable(spark, f"{root}/quality")

    def passed(layer: int, found: DataFrame) -> bool:
        # runs of the results table: three layers to a run
        results.write(found, run * 3 + layer)
        return gate(results.read(run * 3 + layer), on_fail) or on_fail == "warn"

    if not passed(0, R.feed_quality(nonfin, supplfwd, enrollment)):
        return None
    state = RunTable(spark, f"{root}/state")
    rows = evaluate_while_writing(build_state(nonfin, supplfwd, enrollment), [row_count_positive("state_rows")],
                                  lambda df: state.write(df, run)).first()["observed"]
    if not passed(1, R.state_gate(state.read(run))):
        return None
    consent = RunTable(spark, f"{root}/consent_candidate")
    seen = evaluate_while_writing(build_consent(state.read(run)), R.consent_row_checks(rows), lambda df: consent.write(df, run))
    if not passed(2, R.consent_gate(consent.read(run), seen=seen)):
        return None
    keys = ["account_number", "phone_number"]
    return RunTable(spark, f"{root}/consent").upsert(consent.read(run), keys, run, base, sort_by=keys)


def publish_consent(consent: DataFrame, table, run: int, base: int | None = None, on_fail: str = "raise",
                    keys: tuple[str, ...] = ("account_number", "phone_number")) -> int | None:
    """Check, then publish: write ``consent`` once beside the table, evaluate its checks in
    one pass there, and merge it into the :class:`RunTable` ``table`` as ``run`` only when
    they pass (or ``on_fail='warn'``).  An empty table does not pass.  Returns the run, or
    None when blocked (``on_fail='block'``)."""
    from contactgate.operators.quality import check_mode, evaluate_while_writing, gate
    from contactgate.plans.reports import consent_gate, consent_row_checks
    from contactgate.sources.tables import RunTable
    check_mode(on_fail)
    staged = RunTable(consent.sparkSession, f"{table.path}_candidate")
    seen = evaluate_while_writing(consent, consent_row_checks(), lambda df: staged.write(df, run))
    rows = staged.read(run)
    if not gate(consent_gate(rows, seen=seen), on_fail) and on_fail != "warn":
        return None
    return table.upsert(rows, list(keys), run, base, sort_by=list(keys))


# Up to so many requested keys (and phone ids of their rows) are put into the plan as
# literals, which reach the scans; beyond that they are joined.
MAX_LITERAL_KEYS = 200
MAX_LITERAL_IDS = 2000


def _few(df: DataFrame, limit: int) -> list | None:
    """The rows of ``df`` if there are no more than ``limit``, else None."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def state_for_keys(nonfin: DataFrame, supplfwd: DataFrame, enrollment: DataFrame,
                   requests: DataFrame) -> DataFrame:
    """The state rows of the requested (account_number, phone_number) keys only, without
    reconciling every key.  Phones may be given bare or with the country prefix.

    Change and enrollment rows are filtered to the requested keys before any shuffle.
    Snapshot dedup runs per (phone id, delivery date), so every snapshot row that
    shares a phone id with a requested key's rows takes part (rows without a phone id share
    that); everything else is dropped before the shuffle.  Few keys and ids are filters of
    the scan, many are semi joins.  The newest snapshot date comes from the whole feed."""
    keys = requests.select(
        F.col("account_number").alias("__acct"), normalize_phone_input("phone_number").alias("__phone")).distinct()
    literal = _few(keys, MAX_LITERAL_KEYS)

    def of_keys(df: DataFrame, legacy: str, phone: str) -> DataFrame:
        account, published = account_from_legacy_sql(legacy), normalize_phone_sql(phone)
        if literal is not None:
            known = [(a, p) for a, p in literal if a is not None and p is not None]
            raw = sorted({p.removeprefix(PHONE_PREFIX) for _, p in known if p.startswith(PHONE_PREFIX)})
            pairs = [(F.expr(account) == a) & (F.expr(published) == p) for a, p in known]
            return df.where(F.col(phone).isin(raw)).where(reduce(lambda x, y: x | y, pairs, F.lit(False)))
        k = df.selectExpr("*", f"{account} AS __acct", f"{published} AS __phone")
        return k.join(keys, ["__acct", "__phone"], "left_semi").drop("__acct", "__phone")

    nf = prune(nonfin, SNAPSHOT_USED)
    key_rows = of_keys(nf, "cnsmr_idntfr_lgcy_txt", "cnsmr_phn_nmbr_txt")
    ids = key_rows.select("cnsmr_phn_id").distinct()
    few_ids = _few(ids, MAX_LITERAL_IDS) if literal is not None else None
    if few_ids is not None:
        found = [r[0] for r in few_ids]
        same = F.col("cnsmr_phn_id").isin([i for i in found if i is not None])
        nf_relevant = nf.where(same | F.col("cnsmr_phn_id").isNull() if None in found else same)
    else:
        wanted = ids.select(F.col("cnsmr_phn_id").alias("__id"))
        nf_relevant = nf.join(wanted, nf["cnsmr_phn_id"].eqNullSafe(wanted["__id"]), "left_semi")
    nf_dedup = of_keys(dedup_snapshot(nf_relevant), "cnsmr_idntfr_lgcy_txt", "cnsmr_phn_nmbr_txt")
    ch = of_keys(prune(supplfwd, CHANGE_USED), "cnsmr_idntfr_lgcy_txt", "cnsmr_phn_nmbr_txt")
    en = of_keys(prune(enrollment, ENROLLMENT_USED), "consumer_legacy_identifier", "phone_number")
    specs = [snapshot_source(nf_dedup, raw=nonfin), change_source(dedup_change(ch)),
             enrollment_source(en)]
    df = delete_status(reconcile(specs, _config(), EVENT_COLUMNS))
    return df.selectExpr(
        f"{account_from_legacy_sql('legacy_identifier')} AS account_number",
        *[c for c in S.STATE_COLUMNS if c != "account_number"])
