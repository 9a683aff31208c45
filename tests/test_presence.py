import datetime as dt
import random

from pyspark.sql import functions as F

from contactgate.operators.deletes import absent_from_latest, complete_dates, presence

SCHEMA = "k string, _file_date date"


def _d(n):
    return dt.date(2023, 1, 1) + dt.timedelta(7 * n)


def _plain(listed, complete):
    """(key, from, to, gone, back) by walking the calendar."""
    out = []
    for k, days in listed.items():
        days = sorted(days)
        spans = [[days[0], days[0]]]
        for a, b in zip(days, days[1:]):
            if any(a < c < b for c in complete):
                spans.append([b, b])
            else:
                spans[-1][1] = b
        for i, (a, b) in enumerate(spans):
            out.append((k, a, b, min((c for c in complete if c > b), default=None), spans[i + 1][0] if i + 1 < len(spans) else None))
    return sorted(out, key=str)


def _found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_as_by_walking_the_calendar(spark):
    rng = random.Random(2)
    listed = {f"k{i}": {_d(n) for n in range(12) if rng.random() < 0.6} for i in range(60)}
    listed = {k: v for k, v in listed.items() if v}
    rows = [(k, d) for k, days in listed.items() for d in days] * 2     # repeated rows change nothing
    df = spark.createDataFrame(rows, SCHEMA)
    for complete in ({_d(n) for n in range(12)}, {_d(n) for n in (0, 1, 4, 5, 8, 11)}, set()):
        dates = spark.createDataFrame([(d,) for d in complete], "_file_date date")
        assert _found(presence(df, ["k"], complete=dates)) == _plain(listed, complete)


def test_a_partial_snapshot_opens_no_gap(spark):
    full = [(f"k{i}", _d(n)) for n in (0, 1, 3) for i in range(10)]
    partial = [(f"k{i}", _d(2)) for i in range(3)]      # 3 of 10 keys
    df = spark.createDataFrame(full + partial, SCHEMA)
    assert sorted(r[0] for r in complete_dates(df).collect()) == [_d(0), _d(1), _d(3)]
    got = _found(presence(df, ["k"]))
    assert got == sorted(((f"k{i}", _d(0), _d(3), None, None) for i in range(10)), key=str)
    # where it is the newest one it tells nobody gone either
    last = df.where(F.col("_file_date") < F.lit(_d(3)))
    assert all(r[3] is None for r in _found(presence(last, ["k"])))


def test_gone_agrees_with_absence_from_the_newest_snapshot(spark):
    rng = random.Random(5)
    rows = [(f"k{i}", _d(n)) for n in range(6) for i in range(40) if rng.random() < 0.8]
    df = spark.createDataFrame(rows, SCHEMA)
    gone = {r["k"] for r in presence(df, ["k"]).where("back_at IS NULL AND gone_at IS NOT NULL").collect()}
    assert gone == {r["k"] for r in absent_from_latest(df, ["k"]).where("is_hard_deleted").collect()}


def test_a_key_with_a_third_of_all_rows_is_reduced_before_the_shuffle(spark):
    df = spark.createDataFrame([("hot", _d(n % 5)) for n in range(3000)] + [(f"k{n}", _d(n % 5)) for n in range(6000)], SCHEMA)
    got = presence(df, ["k"], complete=spark.createDataFrame([(_d(n),) for n in range(5)], "_file_date date"))
    assert [tuple(r) for r in got.where("k = 'hot'").collect()] == [("hot", _d(0), _d(4), None, None)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_collect_set" in plan and plan.count("hashpartitioning(k") == 1


def test_nulls_and_nothing(spark):
    df = spark.createDataFrame([(None, _d(0)), (None, _d(2)), ("a", None), ("a", _d(1))], SCHEMA)
    got = _found(presence(df, ["k"], complete=spark.createDataFrame([(_d(n),) for n in range(3)], "_file_date date")))
    assert got == sorted([(None, _d(0), _d(0), _d(1), _d(2)), (None, _d(2), _d(2), None, None), ("a", _d(1), _d(1), _d(2), None)], key=str)
    assert presence(df.limit(0), ["k"]).count() == 0


def test_column_lineage_of_the_scenario(spark, scenario):
    from conftest import PHONES
    from contactgate.plans.phone_state import build_state, column_lineage
    got = {(r["phone_number"], r["legacy_identifier"][-1], r["column_name"]): r for r in column_lineage(*scenario).collect()}
    sameday = got[PHONES["sameday"], "P", "consent_flag"]
    assert (sameday["value"], sameday["record_source"], sameday["current_value"]) == ("N", "SUPPLFWD", "N")
    flagged = got[PHONES["flagged"], "P", "phone_source"]
    assert flagged["record_source"] == "SUPPLFWD" and "20231205" in flagged["_source_file"]
    # what the winning record says is what the state has
    state = {(r["phone_number"], r["legacy_identifier"][-1]): r for r in build_state(*scenario).collect()}
    for (phone, suffix, column), r in got.items():
        assert r["current_value"] == state[phone, suffix][column] and r["value"]
    older = [r for r in got.values() if r["value"] != r["current_value"]]
    assert all(not r["current_value"] for r in older)       # else the winner itself supplied it
