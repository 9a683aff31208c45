"""Invariants on the full stand-in data (the end-to-end tier): layer
contracts, delete consistency, publish checks, decision rule."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, StringType

import __spark_entry__ as E
from conftest import SF_MID
from contactgate.operators.decide import decide
from contactgate.plans.catalog import Layers
from contactgate.sources import schemas as S


@pytest.fixture(scope="module")
def layers(spark):
    return Layers(spark, SF_MID)


def _one(spark, name):
    return E.queries()[name](spark, SF_MID).first().asDict()


def test_layer_contracts(layers):
    st, co = layers.state, layers.consent
    assert st.columns == S.STATE_COLUMNS and co.columns == S.CONSENT_COLUMNS
    types = {f.name: f.dataType for f in st.schema.fields}
    for c in ("consent_date", "deleted_at", "event_date"):
        assert types[c] == DateType()
    assert types["is_deleted"] == BooleanType() and types["quality_score"] == StringType()
    assert {f.name: f.dataType for f in co.schema.fields}["has_sms_consent"] == BooleanType()


def test_class_counts(layers):
    got = {(r[0], r[1]): r[2] for r in
           layers.state.groupBy("record_source", "delete_type").count().collect()}
    assert got == {("ENRLMT", None): 241, ("NON-FIN", None): 1036, ("NON-FIN", "hard_delete"): 3679,
                   ("SUPPLFWD", None): 877, ("SUPPLFWD", "hard_delete"): 632,
                   ("SUPPLFWD", "soft_delete"): 228}


def test_delete_consistency(spark):
    assert set(_one(spark, "delete_consistency").values()) == {0}
    assert set(_one(spark, "consent_delete_consistency").values()) == {0}


def test_publish_checks_pass(spark):
    assert _one(spark, "quality_verdict") == {"all_passed": True, "failed": 0}
    assert _one(spark, "hard_deleted_in_latest")["hard_deleted_in_latest"] == 0
    assert _one(spark, "duplicate_keys_state")["duplicates"] == 0
    assert _one(spark, "idempotency_diff")["only_in_first"] == 0


def test_decisions_follow_rule(spark, layers):
    co = layers.consent
    d = decide(co.select("account_number", "phone_number"), co).join(co, ["account_number", "phone_number"])
    rule = ((F.col("phone_source") == "CLIENT") & ~F.col("is_deleted")
            & F.coalesce(F.col("has_sms_consent"), F.lit(True)))
    assert d.where(F.col("can_send_sms") != rule).count() == 0
    assert d.where("can_send_sms").count() == 453


def test_hot_request_key(spark, layers):
    """A third of all requests on one key: answered whole and correctly."""
    req = E.queries()["bulk_permission"](spark, SF_MID).select("request_id", "account_number", "phone_number")
    hot = req.first()
    n = req.count()
    extra = spark.range(n // 2).select(
        (F.col("id") + 10_000_000).alias("request_id"),
        F.lit(hot["account_number"]).alias("account_number"),
        F.lit(hot["phone_number"]).alias("phone_number"))
    out = decide(req.unionByName(extra), layers.consent)
    assert out.count() == n + n // 2
    assert out.where(F.col("phone_number") == hot["phone_number"]) \
        .where(F.col("account_number") == hot["account_number"]) \
        .select("can_send_sms").distinct().count() == 1
