"""One test per semantic decision that the scenario does not pin down."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from contactgate.operators.merge import repeated_keys
from contactgate.operators.quality import (
    QualityGateError, bad_rows, evaluate, gate, row_count_positive,
)
from contactgate.plans import phone_state as P
from contactgate.sources import schemas as S


def _frame(spark, cols, rows, fdate):
    df = spark.createDataFrame(rows, StructType([StructField(c, StringType()) for c in cols + ["_source_file"]]))
    return df.withColumn("_file_date", F.lit(fdate).cast("date"))


def snap(spark, rows, fdate):
    full = [(pid, leg, "A", "S", "F", "L", ph, "CELL", "ACTIVE", src, "VOIP", "1", flag, cdt, "f")
            for pid, leg, ph, src, flag, cdt in rows]
    return _frame(spark, S.SNAPSHOT_COLUMNS, full, fdate)


def chg(spark, rows, fdate="2020-06-01"):
    full = [(hid, leg, "A", "S", "F", "L", ph, "CELL", "ACTIVE", "CLIENT", "VOIP", "1", flag, None, dele, rdate, "c")
            for hid, leg, ph, flag, dele, rdate in rows]
    return _frame(spark, S.CHANGE_COLUMNS, full, fdate)


def no_enrollment(spark):
    return _frame(spark, S.ENROLLMENT_COLUMNS, [], "2020-01-01")


def test_absence_beats_flag_for_label_and_date(spark):
    s1 = snap(spark, [("1", "7P", "2025550100", "CLIENT", None, None),
                      ("2", "8P", "2025550101", "CLIENT", None, None)], "2020-01-01")
    s2 = snap(spark, [("2", "8P", "2025550101", "CLIENT", None, None)], "2020-03-01")
    c = chg(spark, [("h1", "7P", "2025550100", None, "Y", "2020-02-01")])
    st = P.build_state(s1.unionByName(s2), c, no_enrollment(spark))
    r = st.where("legacy_identifier = '7P'").first()
    assert (r["delete_type"], r["deleted_at"]) == ("hard_delete", dt.date(2020, 1, 1))


def test_newer_change_without_flag_does_not_revive(spark):
    s1 = snap(spark, [("1", "7P", "2025550100", "CLIENT", None, None),
                      ("2", "8P", "2025550101", "CLIENT", None, None)], "2020-01-01")
    s2 = snap(spark, [("2", "8P", "2025550101", "CLIENT", None, None)], "2020-03-01")
    c = chg(spark, [("h1", "7P", "2025550100", None, "N", "2020-05-01")])
    r = P.build_state(s1.unionByName(s2), c, no_enrollment(spark)).where("legacy_identifier = '7P'").first()
    assert (r["record_source"], r["delete_type"]) == ("SUPPLFWD", "hard_delete")


def test_unparseable_change_date_keeps_flag_delete(spark):
    # winner is the snapshot row (a NULL change date sorts last), but the flag
    # cannot be proven older than it, so the flag delete stands, undated
    s1 = snap(spark, [("1", "7P", "2025550100", "CLIENT", None, None)], "2020-01-01")
    c = chg(spark, [("h1", "7P", "2025550100", None, "Y", "not-a-date")])
    r = P.build_state(s1, c, no_enrollment(spark)).first()
    assert (r["record_source"], r["delete_type"], r["deleted_at"]) == ("NON-FIN", "soft_delete", None)


def test_consent_erased_by_newer_blank_record(spark):
    s1 = snap(spark, [("1", "7P", "2025550100", "CLIENT", "N", "2020-01-01")], "2020-01-01")
    s2 = snap(spark, [("1", "7P", "2025550100", "CLIENT", None, None)], "2020-02-01")
    nf = s1.unionByName(s2)
    h = P.consent_history(nf, chg(spark, []), no_enrollment(spark)).first()
    assert (h["consent_change"], h["last_no_date"]) == ("erased", dt.date(2020, 1, 1))
    g = P.build_consent(P.build_state(nf, chg(spark, []), no_enrollment(spark))).first()
    assert g["has_sms_consent"] is None


def test_same_day_change_records_keep_lowest_history_id(spark):
    c = chg(spark, [("h2", "7P", "2025550100", "N", "N", "2020-01-01"),
                    ("h1", "7P", "2025550100", "Y", "N", "2020-01-01")])
    r = P.build_state(snap(spark, [], "2020-01-01"), c, no_enrollment(spark)).first()
    assert r["consent_flag"] == "Y"


def test_null_phone_fails_format_check(spark):
    df = spark.createDataFrame([("+12025550100",), (None,)], "phone_number string")
    res = evaluate(df, [bad_rows("normalized", F.coalesce(
        ~F.col("phone_number").rlike(r"^\+1\d{10}$"), F.lit(True)))]).first()
    assert (res["observed"], res["passed"]) == (1, False)


def test_gate_raises_and_warns(spark):
    df = spark.createDataFrame([(None,)], "x string")
    res = evaluate(df, [row_count_positive("rows"), bad_rows("no_null_x", F.col("x").isNull())])
    with pytest.raises(QualityGateError, match="no_null_x"):
        gate(res, on_fail="raise")
    with pytest.warns(UserWarning):
        assert gate(res, on_fail="warn") is False
    ok = evaluate(spark.createDataFrame([("a",)], "x string"), [bad_rows("no_null_x", F.col("x").isNull())])
    assert gate(ok) is True


def test_duplicate_source_keys_are_reported(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    assert [r["k"] for r in repeated_keys(df, ["k"]).collect()] == ["a"]


def test_publish_is_blocked_by_failed_checks(spark, tmp_path):
    from contactgate.plans.phone_state import publish_consent
    from contactgate.sources.tables import RunTable
    bad = spark.createDataFrame(
        [("1", "2025550100", "CLIENT", None, None, False, None, None, "f")],
        "account_number string, phone_number string, phone_source string, has_sms_consent boolean, "
        "sms_consent_updated_at date, is_deleted boolean, delete_type string, deleted_at date, _source_file string")
    t = RunTable(spark, str(tmp_path / "c"))
    with pytest.raises(QualityGateError):
        publish_consent(bad, t, run=1)
    assert publish_consent(bad, t, run=1, on_fail="block") is None
    with pytest.raises(QualityGateError):       # an empty table does not pass
        publish_consent(bad.limit(0), t, run=1)
    with pytest.raises(ValueError):
        publish_consent(bad, t, run=1, on_fail="maybe")
    assert not t.exists()
    good = bad.withColumn("phone_number", F.lit("+12025550100"))
    assert publish_consent(good, t, run=1) == 1 and t.read(1).count() == 1


def test_partial_last_snapshot_fails_drop_check(spark):
    from contactgate.plans.reports import snapshot_drop_check
    full = snap(spark, [(str(i), f"{i}P", "2025550100", "CLIENT", None, None) for i in range(10)], "2020-01-01")
    partial = snap(spark, [("1", "1P", "2025550100", "CLIENT", None, None)], "2020-02-01")
    r = snapshot_drop_check(full.unionByName(partial)).first()
    assert (r["passed"], r["observed"]) == (False, 10)
    r = snapshot_drop_check(full).first()
    assert (r["passed"], r["observed"]) == (True, 100)


def test_every_layer_is_gated_and_results_are_kept(spark, tmp_path, scenario):
    from contactgate.plans.phone_state import gated_run
    from contactgate.sources.tables import RunTable
    nf, ch, en = scenario
    root = str(tmp_path / "g")
    with pytest.raises(QualityGateError, match="supplfwd_row_count_positive"):
        gated_run(nf, ch.limit(0), en, root, run=1)
    # the twin's two suffixes repeat a key: the state's gate stops the run before anything is published
    with pytest.raises(QualityGateError, match="silver_no_duplicate"):
        gated_run(nf, ch, en, root, run=2)
    assert not RunTable(spark, f"{root}/consent").exists()
    one_suffix = nf.where("cnsmr_idntfr_lgcy_txt NOT LIKE '%S'")
    assert gated_run(one_suffix, ch, en, root, run=3) == 3
    assert RunTable(spark, f"{root}/consent").read(3).count() == 10
    kept = RunTable(spark, f"{root}/quality").history()
    assert sorted(r["run"] for r in kept.select("run").distinct().collect()) == [3, 6, 7, 9, 10, 11]
    assert kept.where("NOT passed").select("name").distinct().count() == 2


def test_checks_counted_while_writing_equal_those_of_a_scan(spark, tmp_path, scenario):
    from contactgate.operators.quality import Check, evaluate, evaluate_while_writing
    from contactgate.plans import reports as R
    from contactgate.sources.tables import RunTable
    good = P.build_consent(P.build_state(*scenario))
    bad = good.withColumn("delete_type", F.when(F.col("is_deleted"), F.lit(None)).otherwise(F.lit("soft_delete")))
    for n, (df, rows) in enumerate(((good, good.count()), (bad, 3), (good.limit(0), 0))):
        t = RunTable(spark, str(tmp_path / "t"))
        checks = [*R.consent_row_checks(rows), Check("phones", F.sum(F.length("phone_number")), "gt0")]
        seen = evaluate_while_writing(df.repartition(5), checks, lambda d: t.write(d, n))
        assert sorted(map(tuple, seen.collect())) == sorted(map(tuple, evaluate(t.read(n), checks).collect()))
        assert sorted(map(tuple, R.consent_gate(t.read(n), seen=seen.where("name <> 'phones'")).collect())) == sorted(
            map(tuple, R.consent_gate(t.read(n), df if n != 1 else df.limit(3)).collect()))


def test_a_layer_is_scanned_once_for_its_gate(spark, tmp_path, scenario):
    from contactgate.operators.quality import evaluate_while_writing
    from contactgate.plans import reports as R
    from contactgate.sources.tables import RunTable
    t = RunTable(spark, str(tmp_path / "t"))
    df = P.build_consent(P.build_state(*scenario))
    seen = evaluate_while_writing(df, R.consent_row_checks(), lambda d: t.write(d, 1))
    plan = R.consent_gate(t.read(1), seen=seen)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_null_and_the_empty_text_differ_in_the_last_order(spark):
    rows = spark.createDataFrame([("h", "l", "p", None, "1"), ("h", "l", "p", "", "2")],
                                 "cnsmr_phn_hst_id string, cnsmr_idntfr_lgcy_txt string, cnsmr_phn_nmbr_txt string, cnsmr_phn_typ_val_txt string, n string")
    key = F.expr(P.row_key(rows, ["cnsmr_phn_hst_id", "cnsmr_phn_typ_val_txt"]))
    assert rows.select(key.alias("k")).distinct().count() == 2
