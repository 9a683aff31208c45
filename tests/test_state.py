import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from conftest import ACCOUNTS, N_STATE, OUTCOMES, PHONES
from contactgate.operators.latest import latest_by
from contactgate.plans import phone_state as P
from contactgate.sources import schemas as S


def one(df, **eq):
    for k, v in eq.items():
        df = df.where(F.col(k) == v)
    rows = df.collect()
    assert len(rows) == 1, (eq, rows)
    return rows[0].asDict()


def test_account_from_legacy(spark):
    from contactgate.functions.columns import account_from_legacy
    df = spark.createDataFrame([("1234P",), ("ABCX",), ("Z",)], ["l"])
    assert [r[0] for r in df.select(account_from_legacy("l")).collect()] == ["1234", "ABC", ""]


def test_dedup_snapshot(scenario):
    nf = scenario[0]
    d = P.dedup_snapshot(nf)
    assert d.count() == nf.count() - 2      # a second row of an id, a second row without id
    may = d.where("_file_date = DATE'2023-05-01'")
    assert one(may, cnsmr_phn_id="id-21")["cnsmr_phn_src_val_txt"] == "CLIENT"
    assert [r["cnsmr_idntfr_lgcy_txt"] for r in may.where("cnsmr_phn_id IS NULL").collect()] == [ACCOUNTS["nameless"] + "P"]


def test_dedup_change_keeps_lowest_history_id(scenario):
    d = P.dedup_change(scenario[1])
    assert d.count() == scenario[1].count() - 1
    kept = {r["cnsmr_phn_hst_id"] for r in d.where(F.col("cnsmr_phn_nmbr_txt") == PHONES["writer"]).collect()}
    assert kept == {"g-02", "g-03"}


def test_hard_deletes(scenario):
    dedup = P.dedup_snapshot(scenario[0])
    for h in (P.hard_deletes(dedup), P.hard_deletes(dedup, raw=scenario[0])):
        moved = one(h, cnsmr_phn_nmbr_txt=PHONES["moved"])
        assert moved["is_hard_deleted"] is True and moved["hard_deleted_at"] == dt.date(2023, 8, 1)
        assert one(h, cnsmr_phn_nmbr_txt=PHONES["stayed"])["is_hard_deleted"] is False
        twin = {r["cnsmr_idntfr_lgcy_txt"][-1]: r["is_hard_deleted"] for r in h.where(F.col("cnsmr_phn_nmbr_txt") == PHONES["twin"]).collect()}
        assert twin == {"P": False, "S": True}


def test_soft_deletes(scenario):
    s = P.soft_deletes(P.dedup_change(scenario[1]))
    flagged = one(s, phone_number=PHONES["flagged"])
    assert flagged["is_soft_deleted"] is True and flagged["soft_deleted_at"] == dt.date(2023, 12, 1)
    assert one(s, phone_number=PHONES["writer"])["is_soft_deleted"] is False


def test_state_scenario(scenario):
    st = P.build_state(*scenario)
    assert st.columns == S.STATE_COLUMNS
    assert st.count() == N_STATE
    for who, (record, source, kind, day, _) in OUTCOMES.items():
        r = one(st, legacy_identifier=ACCOUNTS[who] + "P", phone_number=PHONES[who])
        assert (r["record_source"], r["phone_source"], r["delete_type"], r["is_deleted"]) == (record, source, kind, kind is not None), who
        assert r["deleted_at"] == (dt.date.fromisoformat(day) if day else None) and r["account_number"] == ACCOUNTS[who]
    other = one(st, legacy_identifier=ACCOUNTS["twin"] + "S")
    assert (other["delete_type"], other["deleted_at"]) == ("hard_delete", dt.date(2023, 5, 1))
    stayed = one(st, phone_number=PHONES["stayed"])
    assert (stayed["consent_flag"], stayed["consent_date"]) == ("N", dt.date(2023, 10, 15))
    assert one(st, phone_number=PHONES["writer"])["consent_flag"] == "Y"


def test_state_for_keys_is_the_state_of_those_keys(spark, scenario, monkeypatch):
    whole = P.build_state(*scenario)
    for limits in ((200, 2000), (200, 1), (2, 2)):      # literals; ids joined; all joined
        monkeypatch.setattr(P, "MAX_LITERAL_KEYS", limits[0])
        monkeypatch.setattr(P, "MAX_LITERAL_IDS", limits[1])
        for prefix in ("", "+1"):
            for names in (["shadow"], ["nameless", "shadow", "back"], list(ACCOUNTS)):
                asked = spark.createDataFrame([(ACCOUNTS[k], prefix + PHONES[k]) for k in names] + [("0", "4155500000"), (None, None)],
                                              "account_number string, phone_number string")
                got = P.state_for_keys(*scenario, asked)
                keys = [ACCOUNTS[k] + PHONES[k] for k in names]
                want = whole.where(F.concat("account_number", "phone_number").isin(keys))
                assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_a_row_without_phone_id_cannot_permit(spark):
    """The snapshot row of another source must not be lost for want of a phone id."""
    nf = _snap(spark, [_row(None, "7P", "4155500001", src="OTHER")], "2023-01-01")
    en = _empty_enrollment(spark).drop("_file_date")
    en = spark.createDataFrame([("7", "7P", "A", "S", "F", "L", "4155500001", "CELL", "WIRELESS", "ACTIVE", "CLIENT", "1", "2022-01-01", "e.csv.gz")],
                               en.schema).withColumn("_file_date", F.lit("2022-01-01").cast("date"))
    asked = spark.createDataFrame([("7", "+14155500001")], "account_number string, phone_number string")
    got = P.state_for_keys(nf, _empty_change(spark), en, asked)
    assert one(got, account_number="7")["phone_source"] == "OTHER"


def _spec(spark, rows, tag, **more):
    from contactgate.operators.reconcile import SourceSpec
    df = spark.createDataFrame(rows, "k string, v string, d string, a string, b string, c string")
    return SourceSpec(df, {"k": "k", "v": "v", "event_date": "CAST(d AS DATE)"}, tag, tiebreak=["a", "b", "c"], **more)


def test_every_tiebreak_field_counts(spark):
    from contactgate.operators.reconcile import ReconcileConfig, reconcile
    rows = [("k", "lo", "2023-01-01", "1", "1", "1"), ("k", "hi", "2023-01-01", "1", "1", "2")]
    cfg = ReconcileConfig(keys=["k"], types={"event_date": "date"})
    for order in (rows, rows[::-1]):
        got = reconcile([_spec(spark, order, "s")], cfg, ["k", "v", "event_date", "record_source"])
        assert got.first()["v"] == "hi"


def test_two_snapshot_feeds_and_no_flag_column(spark):
    from contactgate.operators.reconcile import SNAPSHOT, ReconcileConfig, delete_status, reconcile
    cfg = ReconcileConfig(keys=["k"], types={"event_date": "date"})
    t = ("1", "1", "1")
    a = _spec(spark, [("both", "x", "2023-01-01", *t), ("gone", "x", "2023-01-01", *t), ("one", "x", "2023-01-01", *t), ("one", "x", "2023-02-01", *t)], "A", role=SNAPSHOT)
    b = _spec(spark, [("both", "x", "2022-05-01", *t), ("gone", "x", "2022-04-01", *t), ("both", "x", "2022-04-01", *t), ("new", "x", "2022-05-01", *t)], "B", role=SNAPSHOT)
    got = delete_status(reconcile([a, b], cfg, ["k", "v", "event_date", "record_source"]))
    found = {r["k"]: (r["is_deleted"], r["last_seen_date"]) for r in got.collect()}
    assert found == {"both": (False, dt.date(2023, 1, 1)), "gone": (True, dt.date(2023, 1, 1)),
                     "one": (False, dt.date(2023, 2, 1)), "new": (False, dt.date(2022, 5, 1))}


def test_consent_transitions(spark):
    for flags, days in (("YNY", [2]), ("YNYNN", [2, 4]), ("NY", []), ("", []), ("Y-N", [3])):
        nf = None
        for i, f in enumerate(flags, start=1):
            part = _snap(spark, [_row("id", "7P", "4155500001", flag=None if f == "-" else f)], f"2023-01-{i:02d}")
            nf = part if nf is None else nf.unionByName(part)
        nf = nf if nf is not None else _snap(spark, [], "2023-01-01")
        got = P.consent_transitions(nf, _empty_change(spark), _empty_enrollment(spark))
        assert sorted(r["withdrawn_at"].day for r in got.collect()) == days


def test_feed_order_does_not_matter(scenario):
    nf, ch, en = scenario
    a = P.build_state(nf, ch, en)
    b = P.build_state(nf.orderBy(F.rand(7)).repartition(5), ch.orderBy(F.rand(3)), en.repartition(3))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


_RAW = StructType([StructField(c, StringType()) for c in S.SNAPSHOT_COLUMNS + ["_source_file"]])


def _snap(spark, rows, fdate):
    df = spark.createDataFrame(rows, _RAW)
    return df.withColumn("_file_date", F.lit(fdate).cast("date"))


def _row(pid, legacy, phone, src="CLIENT", flag=None, fdate=None):
    return (pid, legacy, "A", "S", "F", "L", phone, "CELL", "ACTIVE", src, "WIRELESS", "1", flag,
            fdate, "f.csv.gz")


def _empty_change(spark):
    return spark.createDataFrame([], StructType(
        [StructField(c, StringType()) for c in S.CHANGE_COLUMNS + ["_source_file"]])
    ).withColumn("_file_date", F.lit(None).cast("date"))


def _empty_enrollment(spark):
    return spark.createDataFrame([], StructType(
        [StructField(c, StringType()) for c in S.ENROLLMENT_COLUMNS + ["_source_file"]])
    ).withColumn("_file_date", F.lit(None).cast("date"))


def test_null_keys_are_kept_and_never_deleted(spark):
    s1 = _snap(spark, [_row("1", None, "2025550100"), _row("2", "7P", "2025550101")], "2020-01-01")
    s2 = _snap(spark, [_row("2", "7P", "2025550101")], "2020-02-01")
    st = P.build_state(s1.unionByName(s2), _empty_change(spark), _empty_enrollment(spark))
    null_key = one(st, phone_number="2025550100")
    assert null_key["legacy_identifier"] is None and null_key["is_deleted"] is False


def test_unparseable_consent_date_is_null(spark):
    s1 = _snap(spark, [_row("1", "7P", "2025550100", flag="Y", fdate="2020-13-45")], "2020-01-01")
    st = P.build_state(s1, _empty_change(spark), _empty_enrollment(spark))
    r = st.first()
    assert r["consent_flag"] == "Y" and r["consent_date"] is None


def test_empty_consent_is_not_consent(spark):
    s1 = _snap(spark, [_row("1", "7P", "2025550100", flag="")], "2020-01-01")
    st = P.build_state(s1, _empty_change(spark), _empty_enrollment(spark))
    g = P.build_consent(st).first()
    assert g["has_sms_consent"] is None


def test_two_suffixes_of_one_account_give_two_rows(spark):
    s1 = _snap(spark, [_row("1", "77P", "2025550100"), _row("2", "77Q", "2025550100", src="OTHER")],
               "2020-01-01")
    st = P.build_state(s1, _empty_change(spark), _empty_enrollment(spark))
    assert st.where(F.col("account_number") == "77").count() == 2


def test_partial_last_snapshot_marks_absent_keys(spark):
    s1 = _snap(spark, [_row("1", "7P", "2025550100"), _row("2", "8P", "2025550101")], "2020-01-01")
    s2 = _snap(spark, [_row("1", "7P", "2025550100")], "2020-02-01")
    st = P.build_state(s1.unionByName(s2), _empty_change(spark), _empty_enrollment(spark))
    assert one(st, legacy_identifier="8P")["delete_type"] == "hard_delete"


def test_phone_id_reassigned_to_another_key(spark):
    # W1 deduplicates on (phone id, snapshot date): the second key's row is dropped
    s1 = _snap(spark, [_row("1", "7P", "2025550100"), _row("1", "8P", "2025550101")], "2020-01-01")
    st = P.build_state(s1, _empty_change(spark), _empty_enrollment(spark))
    assert st.count() == 1


def test_latest_by_null_order_is_smallest(spark):
    df = spark.createDataFrame([("k", None, "a"), ("k", "2020-01-01", "b")], "k string, d string, v string")
    assert latest_by(df, ["k"], ["d"]).first()["v"] == "b"
    assert latest_by(df, ["k"], ["d"], newest=False).first()["v"] == "a"
    assert latest_by(df, ["k"], ["d"], method="window").first()["v"] == "b"
    assert latest_by(df, ["k"], ["d"], newest=False, method="window").first()["v"] == "a"


def test_state_for_keys_equals_full_state(spark):
    from conftest import SF_SMALL
    from contactgate.plans.catalog import Layers
    L = Layers(spark, SF_SMALL)
    full = L.state
    req = full.select("account_number", "phone_number").orderBy("account_number", "phone_number").limit(40)
    want = full.join(req, ["account_number", "phone_number"], "left_semi").select(*full.columns)
    got = P.state_for_keys(L.nonfin, L.supplfwd, L.enrollment, req)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.count() == want.count() > 0


def test_state_for_keys_keeps_phone_id_competitors(spark):
    # the other key's row wins the (phone id, date) dedup, so the requested key
    # has no snapshot row that day -- exactly as in the full state
    s1 = _snap(spark, [_row("1", "7P", "2025550100"), _row("1", "8P", "2025550101")], "2020-01-01")
    req = spark.createDataFrame([("8", "2025550101")], "account_number string, phone_number string")
    got = P.state_for_keys(s1, _empty_change(spark), _empty_enrollment(spark), req)
    full = P.build_state(s1, _empty_change(spark), _empty_enrollment(spark))
    assert got.count() == full.where("account_number = '8'").count() == 0
