"""A key holding a third of all rows: results stay whole and exact, and the
plan reduces the hot key before the shuffle."""

import pandas as pd
from pyspark.sql import functions as F

from contactgate.operators.latest import latest_by


def _hot_frame(spark, n=30000):
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("k"),
        (F.col("id") * 7919 % 10007).alias("d"),
        F.col("id").cast("string").alias("v"))
    return df.repartition(8)


def test_latest_by_hot_key_matches_brute_force(spark):
    df = _hot_frame(spark)
    pdf = df.toPandas()
    exp = (pdf.sort_values(["k", "d", "v"]).groupby("k").tail(1)
           .set_index("k")["v"].to_dict())
    for method in ("aggregate", "window"):
        got = {r["k"]: r["v"] for r in latest_by(df, ["k"], ["d", "v"], method=method).collect()}
        assert got == exp, method
    assert len(exp) == 998


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_reduced_before_exchange(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        agg = _plan(latest_by(_hot_frame(spark), ["k"], ["d", "v"]))
        win = _plan(latest_by(_hot_frame(spark), ["k"], ["d", "v"], method="window"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # partial aggregate / partial group limit sit below the key exchange
    assert agg.index("partial_max_by") > agg.index("Exchange hashpartitioning(k")
    partial = [i for i, line in enumerate(win.splitlines())
               if "WindowGroupLimit" in line and line.rstrip().endswith("Partial")]
    exchange = [i for i, line in enumerate(win.splitlines()) if "Exchange hashpartitioning(k" in line]
    assert partial and exchange and partial[0] > exchange[0]


def test_hot_key_state_is_whole(spark):
    """Every row of the hot key is considered: the winner is the global max."""
    df = _hot_frame(spark)
    best = df.where("k = 'hot'").agg(F.max(F.struct("d", "v")).alias("m")).first()["m"]
    got = latest_by(df, ["k"], ["d", "v"]).where("k = 'hot'").first()
    assert (got["d"], got["v"]) == (best["d"], best["v"])


def test_salted_decide_equals_plain(spark):
    from conftest import SF_SMALL
    from contactgate.operators.decide import decide, hot_keys
    from contactgate.plans.catalog import Layers
    from contactgate.sources.standin import permission_requests
    consent = Layers(spark, SF_SMALL).consent
    req = permission_requests(spark, SF_SMALL)
    hot = req.first()
    extra = spark.range(3000).select(
        (F.col("id") + 10_000_000).alias("request_id"),
        F.lit(hot["account_number"]).alias("account_number"),
        F.lit(hot["phone_number"]).alias("phone_number"))
    req = req.unionByName(extra)
    assert hot_keys(req, ["account_number", "phone_number"], 0.3).count() == 1
    plain = decide(req, consent)
    salted = decide(req, consent, hot_key_share=0.3, salt_buckets=8)
    assert salted.count() == plain.count() == req.count()
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_salt_does_not_depend_on_the_request_columns(spark):
    """Requests that are nothing but one key are spread all the same; the share is checked."""
    import pytest
    from conftest import SF_SMALL
    from contactgate.operators.decide import decide, hot_keys
    from contactgate.plans.catalog import LOOKUP_ACCOUNT, LOOKUP_PHONE, Layers
    consent = Layers(spark, SF_SMALL).consent
    req = spark.range(2000).select(F.lit(LOOKUP_ACCOUNT).alias("account_number"), F.lit(LOOKUP_PHONE).alias("phone_number"))
    salted = decide(req, consent, hot_key_share=0.5, salt_buckets=8)
    assert salted.count() == 2000 and salted.distinct().count() == 1
    for share in (0, -1, 1.5):
        with pytest.raises(ValueError):
            hot_keys(req, ["account_number", "phone_number"], share)
