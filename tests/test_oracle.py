"""Every registered query against its DuckDB twin on the smallest tables."""

import pytest

import __spark_entry__ as E
from compare import compare, duck
from conftest import SF_SMALL

NAMES = sorted(E.queries())
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    if name not in ORACLE:
        assert df.count() >= 0
        return
    assert compare(df, con, ORACLE[name]) == []


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["request_id", "account_number", "phone_number", "can_send_sms"]
    assert df.count() > 0
