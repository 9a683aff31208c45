import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from contactgate.operators.asof import as_of, validity

HISTORY = "k string, j int, day date, prio int, id string, v string"
DAY0 = dt.date(2020, 1, 1)


def _plain_as_of(history, k, j, at):
    held = [(p, d, i, v) for hk, hj, d, p, i, v in history if (hk, hj) == (k, j) and d is not None and d <= at]
    return max(held, key=lambda r: (r[0], r[1], r[2]), default=(None, None, None, None))


@pytest.fixture(scope="module")
def history():
    rng = random.Random(8)
    rows = []
    for n in range(900):
        k = "hot" if n % 3 == 0 else f"k{rng.randrange(25)}"    # one key has a third of all records
        rows.append((k, rng.randrange(2), DAY0 + dt.timedelta(rng.randrange(700)), rng.choice([1, 1, 1, 0]), f"i{n:04}", rng.choice("abc")))
    return rows + [("k1", 0, None, 1, "z", "undated"), (None, 0, DAY0, 1, "n", "null key"), (None, 0, DAY0 + dt.timedelta(40), 1, "n", "null key")]


def rank():
    return F.struct("prio", "day", "id")


@pytest.mark.parametrize("period", ["month", "year"])
def test_as_of_as_by_a_range_join(spark, history, period):
    rng = random.Random(9)
    asked = [(n, "hot" if n % 3 == 0 else f"k{rng.randrange(27)}", rng.randrange(2), DAY0 + dt.timedelta(rng.randrange(-30, 760)))
             for n in range(500)]
    asked += [(900, None, 0, DAY0), (901, "k1", 0, None), (902, "k1", 0, DAY0), (902, "k1", 0, DAY0)]
    got = as_of(spark.createDataFrame(asked, "r int, k string, j int, at date"), spark.createDataFrame(history, HISTORY),
                ["k", "j"], "at", "day", rank(), ["v", "id", "day"], period).collect()
    assert len(got) == len(asked)
    for r in got:
        if r["k"] is None or r["at"] is None:
            assert (r["v"], r["id"], r["day"]) == (None, None, None)
        else:
            p, d, i, v = _plain_as_of(history, r["k"], r["j"], r["at"])
            assert (r["v"], r["id"], r["day"]) == (v, i, d)


def test_intervals_answer_every_day(spark, history):
    got = validity(spark.createDataFrame(history, HISTORY), ["k", "j"], "day", rank(), ["v", "id"]).collect()
    by_key = {}
    for r in got:
        by_key.setdefault((r["k"], r["j"]), []).append((r["valid_from"], r["valid_to"], r["v"], r["id"]))
    for (k, j), spans in by_key.items():
        spans.sort(key=lambda s: s[0])
        assert [s[1] for s in spans] == [s[0] for s in spans[1:]] + [None]      # they follow each other
        for a, b, v, i in spans:
            for at in {a, (b or a + dt.timedelta(30)) - dt.timedelta(1)}:
                assert _plain_as_of(history, k, j, at)[2:] == (i, v)
    assert set(by_key) == {(h[0], h[1]) for h in history if h[2] is not None}


def test_no_window_runs_along_a_whole_history(spark, history):
    plan = as_of(spark.createDataFrame([(1, "k1", 0, DAY0)], "r int, k string, j int, at date"), spark.createDataFrame(history, HISTORY),
                 ["k", "j"], "at", "day", rank(), ["v"])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("__period" in w for w in windows)


def test_nothing_in_it(spark):
    none = spark.createDataFrame([], HISTORY)
    asked = spark.createDataFrame([("k1", 0, DAY0)], "k string, j int, at date")
    assert [tuple(r) for r in as_of(asked, none, ["k", "j"], "at", "day", rank(), ["v"]).collect()] == [("k1", 0, DAY0, None)]
    assert as_of(asked.limit(0), none, ["k", "j"], "at", "day", rank(), ["v"]).count() == 0
    assert validity(none, ["k", "j"], "day", rank(), ["v"]).count() == 0


def test_consent_of_the_scenario_on_some_days(spark, scenario):
    from conftest import ACCOUNTS, PHONES
    from contactgate.plans.phone_state import consent_as_of
    days = [("writer", "2023-06-09"), ("writer", "2023-06-10"), ("signer", "2022-11-21"), ("signer", "2022-11-22"), ("signer", "2024-01-01"),
            ("sameday", "2023-10-31"), ("sameday", "2023-11-01")]
    asked = spark.createDataFrame([(n, ACCOUNTS[w], PHONES[w], dt.date.fromisoformat(d)) for n, (w, d) in enumerate(days)],
                                  "n int, account_number string, phone_number string, asked_on date")
    got = {r["n"]: (r["has_sms_consent"], r["record_source"]) for r in consent_as_of(asked, *scenario).collect()}
    assert got[1] == (True, "SUPPLFWD") and got[2] == (None, None) and got[3] == (None, "ENRLMT") == got[4]
    assert got[6] == (False, "SUPPLFWD")
