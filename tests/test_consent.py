import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from conftest import ACCOUNTS, N_STATE, OUTCOMES, PHONES
from contactgate.functions.columns import normalize_phone, tri_state
from contactgate.operators.decide import can_send_sms, decide, denial_reason
from contactgate.plans import phone_state as P
from contactgate.sources import schemas as S


def test_normalize_phone(spark):
    df = spark.createDataFrame([("2025550100",), (None,)], "p string")
    assert [r[0] for r in df.select(normalize_phone("p")).collect()] == ["+12025550100", None]
    assert df.select(normalize_phone("p")).schema[0].dataType == StringType()


@pytest.mark.parametrize("flag,expected", [("Y", True), ("N", False), (None, None), ("", None), ("x", None)])
def test_tri_state(spark, flag, expected):
    df = spark.createDataFrame([(flag,)], StructType([StructField("f", StringType())]))
    out = df.select(tri_state("f").alias("c"))
    assert out.schema[0].dataType == BooleanType()
    assert out.first()[0] is expected


@pytest.fixture()
def consent(scenario):
    return P.build_consent(P.build_state(*scenario))


def test_consent_columns(consent):
    assert consent.columns == S.CONSENT_COLUMNS
    assert consent.count() == N_STATE
    assert consent.where(~F.col("phone_number").startswith("+1")).count() == 0


@pytest.mark.parametrize("who", list(OUTCOMES))
def test_can_send_sms(spark, consent, who):
    expected = OUTCOMES[who][-1]
    assert can_send_sms(spark, consent, ACCOUNTS[who], "+1" + PHONES[who]) is expected
    assert can_send_sms(spark, consent, ACCOUNTS[who], PHONES[who]) is expected  # bare 10 digits


def test_unknown_key_is_denied(spark, consent):
    assert can_send_sms(spark, consent, "9999999999999999", "+12025559999") is False


def test_bulk_decide_matches_single(spark, consent):
    req = spark.createDataFrame(
        [(i, ACCOUNTS[k], PHONES[k]) for i, k in enumerate(PHONES)] + [(99, "0", "2025550000")],
        "request_id long, account_number string, phone_number string")
    out = {r["request_id"]: r["can_send_sms"] for r in decide(req, consent).collect()}
    assert out[99] is False
    for i, k in enumerate(PHONES):
        assert out[i] is can_send_sms(spark, consent, ACCOUNTS[k], PHONES[k])


def test_decide_runs_nothing_while_it_is_planned(spark, consent):
    from pathlib import Path

    from contactgate.operators.decide import decision_table
    from contactgate.session import scratch_path
    req = spark.createDataFrame([(ACCOUNTS[k], PHONES[k]) for k in PHONES], "account_number string, phone_number string")
    folder = Path(scratch_path(spark, "contactgate").removeprefix("file:"))
    before = set(folder.glob("decisions-*"))
    planned = decide(req, consent)
    assert set(folder.glob("decisions-*")) == before
    written = decide(req, consent, decisions=decision_table(consent))
    assert sorted(planned.collect()) == sorted(written.collect())
    assert len(set(folder.glob("decisions-*")) - before) == 1


def test_decide_is_most_restrictive_on_duplicate_keys(spark):
    c = spark.createDataFrame(
        [("1", "+12025550100", "CLIENT", None, False), ("1", "+12025550100", "OTHER", None, False)],
        "account_number string, phone_number string, phone_source string, has_sms_consent boolean, is_deleted boolean")
    req = spark.createDataFrame([("1", "+12025550100")], "account_number string, phone_number string")
    assert decide(req, c).first()["can_send_sms"] is False


def test_never_true_for_deleted_or_non_client(consent, spark):
    req = consent.select("account_number", "phone_number")
    d = decide(req, consent).join(consent, ["account_number", "phone_number"])
    assert d.where(F.col("can_send_sms") & (F.col("is_deleted") | (F.col("phone_source") != "CLIENT"))).count() == 0


def test_denial_reason(consent):
    found = denial_reason(consent).groupBy("reason").count().collect()
    assert {r["reason"]: r["count"] for r in found} == {"deleted": 3, "consent_withdrawn": 2, "can_send": 6}
    other = denial_reason(consent.limit(1).withColumn("phone_source", F.lit("OTHER"))).first()
    assert other["reason"] == "not_client_source"
