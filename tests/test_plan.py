"""Plan-shape checks: the reconcile is a few hash exchanges, no Python, and
lookups push their filters into the scan."""

from conftest import SF_SMALL
from contactgate.plans.catalog import Layers, q_permission_lookup


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_reconcile_exchanges_and_no_python(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(Layers(spark, SF_SMALL).state)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") <= 3, plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "WindowGroupLimit" in plan           # top-1 dedup reduces before the shuffle


def test_lookup_filter_reaches_scan(spark):
    plan = q_permission_lookup(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "0000000000000001" in plan


def test_scan_prunes_identity_columns(spark):
    plan = _plan(Layers(spark, SF_SMALL).state)
    assert "o_totalprice" not in plan


def test_published_lookup_pushes_key_into_scan(spark, tmp_path):
    from contactgate.operators.decide import lookup
    from contactgate.sources.tables import RunTable
    t = RunTable(spark, str(tmp_path / "consent"))
    t.write(Layers(spark, SF_SMALL).consent, run=1, sort_by=["account_number", "phone_number"])
    plan = _plan(lookup(spark, t.read(1), "0000000000000001", "0000000005"))
    assert "PushedFilters: [IsNotNull(account_number), IsNotNull(phone_number), " \
           "EqualTo(account_number,0000000000000001)" in plan


def test_bronze_read_prunes_partitions(spark, tmp_path):
    from contactgate.sources.standin import snapshot_feed
    from contactgate.sources.tables import DeliveryTable
    b = DeliveryTable(spark, str(tmp_path / "bronze"))
    b.append(snapshot_feed(spark, SF_SMALL))
    df = b.read(since="2000-01-01")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_file_date" in plan
    assert df.select("_file_date").distinct().count() == 2


def _static(spark, make):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return _plan(make())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_lookup_from_raw_feeds_shuffles_little(spark):
    plan = _static(spark, lambda: q_permission_lookup(spark, SF_SMALL))
    assert plan.count("Exchange hashpartitioning") <= 4 and "Join" not in plan, plan


def test_hard_deletes_plan(spark):
    from contactgate.plans.catalog import q_detect_hard_deletes
    plan = _static(spark, lambda: q_detect_hard_deletes(spark, SF_SMALL))
    assert plan.count("Exchange hashpartitioning") <= 2, plan


def test_winner_profile_plans_the_state_once(spark):
    from contactgate.plans.reports import q_winner_source_profile
    plan = _static(spark, lambda: q_winner_source_profile(spark, SF_SMALL))
    assert plan.count("max_by") <= 4 and "SortMergeJoin" not in plan, plan


def test_a_hot_request_key_is_split(spark):
    """A third of the requests ask for one key: the final plan reads it in parts."""
    from contactgate.operators.decide import decide
    from contactgate.sources.standin import permission_requests
    from pyspark.sql import functions as F
    consent = Layers(spark, SF_SMALL).consent
    hot = F.col("id") % 3 == 0
    req = spark.range(0, 300_000, 1, 8).select(
        F.when(hot, F.lit("0000000000000001")).otherwise(F.lpad(F.col("id").cast("string"), 16, "0")).alias("account_number"),
        F.lit("0000000005").alias("phone_number"))
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = decide(req, consent)
        assert df.count() == 300_000
        df.write.format("noop").mode("overwrite").save()
        run = decide(req, consent).groupBy("can_send_sms").count()
        run.collect()
        assert "skew=true" in _plan(run)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_reports_keep_their_order(spark):
    from contactgate.plans import reports as R
    for make in (R.q_record_source_share, R.q_phone_source_share, R.q_winner_source_profile):
        counts = [r["cnt"] for r in make(spark, SF_SMALL).collect()]
        assert counts == sorted(counts, reverse=True)
