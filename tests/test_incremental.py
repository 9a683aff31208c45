from pyspark.sql import functions as F

from conftest import SF_SMALL
from contactgate.plans import phone_state as P
from contactgate.plans.catalog import Layers
from contactgate.plans.incremental import IncrementalState


def _same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fold_in_any_order_equals_batch(spark, tmp_path):
    full = Layers(spark, SF_SMALL)
    expected = full.state
    bounds = ["1997-01-01", "2000-01-01"]
    d = [F.lit(b).cast("date") for b in bounds]
    parts = [F.col("_file_date") < d[0],
             (F.col("_file_date") >= d[0]) & (F.col("_file_date") < d[1]),
             F.col("_file_date") >= d[1]]
    for order, name in ((parts, "fwd"), (parts[::-1], "rev")):
        inc = IncrementalState(spark, str(tmp_path / name))
        for cond in order:
            L = Layers(spark, SF_SMALL, where=cond)
            inc.apply(L.nonfin, L.supplfwd, L.enrollment)
        assert inc.last_run() == 2
        _same(inc.state(), expected)


def test_fold_of_scenario(spark, tmp_path, scenario):
    nf, ch, en = scenario
    inc = IncrementalState(spark, str(tmp_path / "s"))
    early = F.col("_file_date") < F.lit("2023-08-01").cast("date")
    inc.apply(nf.where(early), ch.where(early), en.where(early))
    inc.apply(nf.where(~early), ch.where(~early), en.where(~early))
    _same(inc.state(), P.build_state(nf, ch, en))


def test_a_split_snapshot_date_is_refused(spark, tmp_path, scenario):
    import pytest
    from contactgate.plans.incremental import SplitDeliveryError
    nf, ch, en = scenario
    inc = IncrementalState(spark, str(tmp_path / "s"))
    first = F.col("_source_file").contains("_000.csv")
    inc.apply(nf.where(first), ch, en)
    with pytest.raises(SplitDeliveryError):
        inc.apply(nf.where(~first), ch.limit(0), en.limit(0))
    assert inc.last_run() == 0


def _empty(*frames):
    return [f.limit(0) for f in frames]


def test_folds_of_single_feeds_and_of_nothing(spark, tmp_path, scenario):
    """The ordinary weeks: a fold without snapshot rows is a fold like any other."""
    nf, ch, en = scenario
    none = _empty(nf, ch, en)
    steps = [(none[0], ch.where("cnsmr_phn_hst_id < 'g-03'"), none[2]), (none[0], none[1], en), none,
             (none[0], ch.where("cnsmr_phn_hst_id >= 'g-03'"), none[2]), (nf, none[1], none[2]), none]
    inc = IncrementalState(spark, str(tmp_path / "s"))
    assert [inc.apply(*s) for s in steps] == [0, 1, 2, 3, 4, 5] and inc.last_run() == 5
    _same(inc.state(), P.build_state(nf, ch, en))


def test_a_fold_is_not_overwritten_by_the_next(spark, tmp_path, scenario):
    nf, ch, en = scenario
    none = _empty(nf, ch, en)
    inc = IncrementalState(spark, str(tmp_path / "s"))
    inc.apply(nf, none[1], en)
    inc.apply(none[0], ch.where("cnsmr_phn_hst_id < 'g-03'"), none[2])
    first = inc.state().collect()
    inc.apply(none[0], ch.where("cnsmr_phn_hst_id >= 'g-03'"), none[2])
    assert inc.survivors.history().count() == ch.count()
    assert sorted(map(str, inc.state().collect())) != sorted(map(str, first))
    _same(inc.state(), P.build_state(nf, ch, en))


def test_fold_numbers_of_the_caller(spark, tmp_path, scenario):
    import pytest
    nf, ch, en = scenario
    none = _empty(nf, ch, en)
    inc = IncrementalState(spark, str(tmp_path / "s"))
    assert inc.apply(nf, none[1], en, run=20230901) == 20230901
    assert inc.apply(none[0], ch, none[2], run=20230908) == 20230908
    assert inc.apply(none[0], ch, none[2], run=20230908) == 20230908      # retried: nothing changes
    with pytest.raises(ValueError):
        inc.apply(*none, run=20230905)
    _same(inc.state(), P.build_state(nf, ch, en))


def test_a_late_second_file_of_an_open_date_is_merged(spark, tmp_path, scenario):
    import pytest
    from contactgate.plans.incremental import SplitDeliveryError
    nf, ch, en = scenario
    none = _empty(nf, ch, en)
    days = sorted(r[0] for r in nf.select("_file_date").distinct().collect())
    # both files of a date hold rows of one phone id, so the dedup spans the two folds
    twin = nf.withColumn("_source_file", F.regexp_replace("_source_file", "_000", "_009")).withColumn(
        "cnsmr_phn_cnsnt_flg", F.lit("N"))
    both = nf.unionByName(twin)
    expected = P.build_state(both, ch, en)
    for late, early in ((nf, twin), (twin, nf)):
        inc = IncrementalState(spark, str(tmp_path / str(late is nf)), open_dates=2)
        for day in days:
            inc.apply(early.where(F.col("_file_date") == F.lit(day)), none[1], none[2])
            inc.apply(late.where(F.col("_file_date") == F.lit(day)), none[1], none[2])
        inc.apply(none[0], ch, en)
        _same(inc.state(), expected)
        if len(days) > 2:
            with pytest.raises(SplitDeliveryError):
                inc.apply(nf.where(F.col("_file_date") == F.lit(days[0])), none[1], none[2])
