
from contactgate.operators.merge import diff, gap_fill, upsert
from contactgate.sources.tables import RunTable


def _df(spark, rows):
    return spark.createDataFrame(rows, "k string, v string")


def test_runs_upsert_and_as_of_reads(spark, tmp_path):
    t = RunTable(spark, str(tmp_path / "t"))
    assert not t.exists()
    t.upsert(_df(spark, [("a", "1"), ("b", "1")]), ["k"], run=20230101, base=None)
    t.upsert(_df(spark, [("b", "2"), ("c", "2")]), ["k"], run=20230201, base=20230101)
    assert sorted(map(tuple, t.read(20230201).collect())) == [("a", "1"), ("b", "2"), ("c", "2")]
    assert sorted(map(tuple, t.read(20230101).collect())) == [("a", "1"), ("b", "1")]
    assert t.history().select("run").distinct().count() == 2
    plan = t.read(20230101)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run" in plan


def test_a_retried_run_replaces_itself_alone(spark, tmp_path):
    t = RunTable(spark, str(tmp_path / "t"))
    t.write(_df(spark, [("a", "1")]), run=1)
    t.write(_df(spark, [("a", "2"), ("b", "2")]), run=2)
    t.write(_df(spark, [("a", "3")]), run=2)
    assert t.read(1).first()["v"] == "1" and [r["v"] for r in t.read(2).collect()] == ["3"]
    t.write(_df(spark, []), run=2)
    assert t.read(2).count() == 0 and t.read(1).count() == 1


def test_repeated_source_keys_are_refused(spark, tmp_path):
    import pytest
    from contactgate.operators.merge import RepeatedKeyError
    t = RunTable(spark, str(tmp_path / "t"))
    with pytest.raises(RepeatedKeyError):
        t.upsert(_df(spark, [("a", "1"), ("a", "2")]), ["k"], run=1, base=None)
    with pytest.raises(ValueError):
        t.upsert(_df(spark, [("a", "1")]), ["k"], run=1, base=1)
    assert not t.exists()


def test_deliveries_of_one_date_and_undated_ones_stay(spark, tmp_path):
    from contactgate.sources.tables import DeliveryTable
    from pyspark.sql import functions as F
    rows = lambda day, name, *vs: spark.createDataFrame([(v, name) for v in vs], "v string, _source_file string") \
        .withColumn("_file_date", F.lit(day).cast("date"))
    b = DeliveryTable(spark, str(tmp_path / "b"))
    b.append(rows("2023-01-01", "d/x-1.csv.gz", "1"))
    b.append(rows("2023-01-01", "d/x-2.csv.gz", "2"))
    b.append(rows(None, "d/u-1.csv.gz", "3"))
    b.append(rows(None, "d/u-2.csv.gz", "4"))
    b.append(rows("2023-01-01", "d/x-1.csv.gz", "1b"))
    assert sorted(r["v"] for r in b.read().collect()) == ["1b", "2", "3", "4"]
    assert sorted(r["v"] for r in b.read(since="2023-01-01").collect()) == ["1b", "2"]


def test_diff_meets_null_keys(spark):
    old, new = _df(spark, [(None, "1"), ("a", "1")]), _df(spark, [(None, "1"), ("a", "2")])
    assert sorted(r["_change_type"] for r in diff(old, new, ["k"]).collect()) == ["update_postimage", "update_preimage"]


def test_change_feed(spark, tmp_path):
    old = _df(spark, [("a", "1"), ("b", "1"), ("d", None)])
    new = _df(spark, [("b", "2"), ("c", "2"), ("d", None)])
    out = {(r["k"], r["_change_type"]): r["v"] for r in diff(old, new, ["k"]).collect()}
    assert out == {("a", "delete"): "1", ("b", "update_preimage"): "1",
                   ("b", "update_postimage"): "2", ("c", "insert"): "2"}


def test_upsert_keeps_unmatched_target_rows(spark):
    out = upsert(_df(spark, [("a", "1"), ("b", "1")]), _df(spark, [("b", "9")]), ["k"])
    assert sorted(map(tuple, out.collect())) == [("a", "1"), ("b", "9")]
    out = upsert(_df(spark, [("a", "1")]), _df(spark, [("b", "9")]), ["k"], delete_missing=True)
    assert out.collect()[0]["k"] == "b"


def test_gap_fill_keeps_null_key_fallback(spark):
    prim = spark.createDataFrame([("a", "p"), (None, "p")], "k string, v string")
    fb = spark.createDataFrame([("a", "f"), ("b", "f"), (None, "f")], "k string, v string")
    out = sorted((r["k"] or "", r["v"]) for r in gap_fill(prim, fb, ["k"]).collect())
    assert out == [("", "f"), ("", "p"), ("a", "p"), ("b", "f")]


def test_each_run_keeps_its_schema(spark, tmp_path):
    t = RunTable(spark, str(tmp_path / "t"))
    t.write(spark.createDataFrame([(1, "a")], "id int, x string"), run=1)
    t.write(spark.createDataFrame([(2, "b", 2.5)], "id int, x string, y double"), run=2)    # added
    assert t.read(1).columns == ["id", "x"] and t.read(2).columns == ["id", "x", "y"]
    rows = lambda: sorted(((r["run"], r["id"], r["x"], r["y"]) for r in t.history().collect()), key=str)
    assert rows() == [(1, 1, "a", None), (2, 2, "b", 2.5)]
    t.write(spark.createDataFrame([(3, 7.5)], "id long, y double"), run=3)                  # dropped, wider
    assert t.read(3).dtypes == [("id", "bigint"), ("y", "double")]
    assert rows() == [(1, 1, "a", None), (2, 2, "b", 2.5), (3, 3, None, 7.5)]
    t.write(spark.createDataFrame([("four", "d", 1.0)], "id string, x string, y double"), run=4)    # retyped
    assert [r["id"] for r in t.read(4).collect()] == ["four"] and [r["id"] for r in t.read(1).collect()] == [1]
    assert rows() == [(1, "1", "a", None), (2, "2", "b", 2.5), (3, "3", None, 7.5), (4, "four", "d", 1.0)]
    t.write(spark.createDataFrame([], "other date"), run=5)                                 # empty, all new
    assert t.read(5).columns == ["other"] and len(t.history().collect()) == 4 and "other" in t.history().columns


def test_empty_and_missing_runs_are_told_apart(spark, tmp_path):
    import pytest
    from contactgate.sources.tables import MissingRunError
    t = RunTable(spark, str(tmp_path / "t"))
    assert t.runs() == [] and t.last_run() is None
    t.write(_df(spark, [("a", "1")]), run=2)
    t.write(_df(spark, []), run=10)
    assert t.runs() == [2, 10] and t.last_run() == 10 and t.read(10).count() == 0
    for run in (1, 77):
        with pytest.raises(MissingRunError):
            t.read(run)
    with pytest.raises(MissingRunError):
        t.upsert(_df(spark, [("b", "1")]), ["k"], run=11, base=9)
    with pytest.raises(MissingRunError):
        t.changes(2, 3, ["k"])
    (tmp_path / "t" / "run=12").mkdir()     # a write that did not end
    assert t.last_run() == 10


def test_deliveries_of_two_roots_and_without_a_file(spark, tmp_path):
    import pytest
    from contactgate.sources.tables import DeliveryTable
    from pyspark.sql import functions as F
    rows = lambda name, v: spark.createDataFrame([(v, name)], "v string, _source_file string") \
        .withColumn("_file_date", F.lit("2023-01-01").cast("date"))
    b = DeliveryTable(spark, str(tmp_path / "b"))
    b.append(rows("north/x.csv.gz", "1"))
    b.append(rows("south/x.csv.gz", "2"))
    b.append(rows("north/delivery=x/part-0.csv.gz", "3"))
    b.append(rows("south/delivery=x/part-0.csv.gz", "4"))
    b.append(rows("south/delivery=x/part-1.csv.gz", "4b"))      # the folder is the delivery
    assert sorted(r["v"] for r in b.read().collect()) == ["1", "2", "3", "4b"]
    with pytest.raises(Exception, match="has no _source_file"):
        b.append(rows(None, "5"))
    assert b.read().count() == 4


def _files(path):
    return {str(f): f.stat().st_mtime_ns for f in path.rglob("part-*")}


def test_a_merge_replaces_touched_buckets_only(spark, tmp_path):
    from contactgate.sources.tables import KeyedTable
    from pyspark.sql import functions as F
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=64)
    rows = spark.range(2000).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.lit("old").alias("v"))
    assert len(t.merge(rows, run=1)) == 64
    before = _files(tmp_path / "t")
    touched = t.merge(_df(spark, [("k7", "new")]), run=2)
    after = _files(tmp_path / "t")
    assert len(touched) == 1
    own = f"{t.bucket_col}={touched[0]}/"
    assert {f: x for f, x in after.items() if own not in f} == {f: x for f, x in before.items() if own not in f}
    assert not {f for f in after if own in f} & {f for f in before if own in f}
    assert t.read().count() == 2000 and [r["k"] for r in t.read().where("v = 'new'").collect()] == ["k7"]
    scanned = t.rows_of(touched)
    assert "PartitionFilters: [" + t.bucket_col in scanned._jdf.queryExecution().executedPlan().toString().replace("isnotnull(", "") \
        or t.bucket_col in scanned._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("]")[0]
    assert scanned.count() < 200


def test_merge_as_by_merge_semantics(spark, tmp_path):
    import pytest
    from contactgate.operators.merge import RepeatedKeyError
    from contactgate.sources.tables import KeyedTable
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    with pytest.raises(FileNotFoundError):
        t.read()
    assert t.merge(_df(spark, []), run=1) == []
    t.merge(_df(spark, [("a", "1"), ("b", "1"), (None, "1")]), run=2)
    for _ in range(3):      # a retried run changes nothing, null keys included
        t.merge(_df(spark, [("b", "2"), ("c", "2"), (None, "2")]), run=3)
    got = sorted((r["k"] or "", r["v"]) for r in t.read().collect())
    assert got == [("", "1"), ("", "2"), ("a", "1"), ("b", "2"), ("c", "2")]
    with pytest.raises(RepeatedKeyError):
        t.merge(_df(spark, [("a", "1"), ("a", "2")]), run=4)
    with pytest.raises(ValueError):
        t.merge(_df(spark, [("a", "0")]), run=2)
    with pytest.raises(ValueError):
        KeyedTable(spark, t.path, ["k"], buckets=8).read()
    assert sorted((r["k"] or "", r["v"]) for r in t.read().collect()) == got


def test_a_merge_that_crashed_while_replacing_is_finished_by_its_retry(spark, tmp_path):
    import shutil

    from contactgate.sources.tables import KeyedTable
    from pyspark.sql import functions as F
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    t.merge(spark.range(40).select(F.col("id").cast("string").alias("k"), F.lit("1").alias("v")), run=1)
    source = spark.range(20, 60).select(F.col("id").cast("string").alias("k"), F.lit("2").alias("v"))
    t.merge(source, run=2)
    want = sorted(map(tuple, t.read().collect()))
    shutil.rmtree(next((tmp_path / "t").glob(f"{t.bucket_col}=*")))     # a bucket was removed and not yet put back
    t.merge(source, run=2)
    assert sorted(map(tuple, t.read().collect())) == want and len(want) == 60


def test_changes_join_only_buckets_that_differ(spark, tmp_path, monkeypatch):
    from contactgate.sources import tables
    from pyspark.sql import functions as F
    base = spark.range(500).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("v"))
    base = base.union(spark.createDataFrame([], "k string, v long"))
    t = RunTable(spark, str(tmp_path / "t"))
    t.write(base, run=1)
    t.write(base.repartition(3), run=2)
    t.write(base.withColumn("v", F.when(F.col("k") == "40", F.lit(None)).otherwise(F.col("v"))), run=3)
    t.write(base.where("k <> '41'").union(spark.createDataFrame([(None, 5)], base.schema)), run=4)
    joined = []
    monkeypatch.setattr(tables, "diff", lambda a, b, keys: joined.append((a.count(), b.count())) or diff(a, b, keys))
    assert t.changes(1, 2, ["k"]).count() == 0 and joined[-1] == (0, 0)
    one = sorted(map(tuple, t.changes(1, 3, ["k"]).collect()), key=str)
    assert one == sorted(map(tuple, diff(t.read(1), t.read(3), ["k"]).collect()), key=str) and len(one) == 2
    assert 0 < joined[-1][0] < 20
    for a, b in ((1, 4), (4, 3), (3, 4)):
        assert sorted(map(tuple, t.changes(a, b, ["k"]).collect()), key=str) == \
            sorted(map(tuple, diff(t.read(a), t.read(b), ["k"]).collect()), key=str)


def test_bags_are_compared_by_digest(spark, monkeypatch):
    from contactgate.operators.merge import bag_difference
    from pyspark.sql import DataFrame
    rows = [("a", "1"), ("a", "1"), (None, "1"), ("1", None), ("c", "3")]
    told = lambda a, b: tuple(bag_difference(_df(spark, a), _df(spark, b)).first())
    compared = []
    exact = DataFrame.exceptAll
    monkeypatch.setattr(DataFrame, "exceptAll", lambda a, b: compared.append(1) or exact(a, b))
    assert told(rows, rows[::-1]) == (0, 0, 5) and not compared     # equal bags cost one pass a side
    assert told(rows, rows[1:]) == (1, 0, 5)                        # a duplicate less
    assert told(rows, [*rows, rows[0]]) == (0, 1, 5)
    assert told(rows, [*rows[:4], ("c", "4")]) == (1, 1, 5)         # changed
    assert told([("x", None)], [(None, "x")]) == (1, 1, 1)          # a value moved to the other column
    assert told([], []) == (0, 0, 0)


def test_compat_reads_an_empty_overwrite_as_empty(spark, tmp_path):
    from contactgate import compat
    path = str(tmp_path / "t")
    compat.write_delta(_df(spark, [("a", "1")]), path)
    compat.write_delta(_df(spark, []), path)
    assert compat.read_delta(spark, path).count() == 0
    compat.write_delta(_df(spark, [("b", "1")]), path, mode="append")
    compat.merge_delta(spark, _df(spark, [("b", "2"), ("c", "2")]), path, ["k"])
    assert sorted(map(tuple, compat.read_delta(spark, path).collect())) == [("b", "2"), ("c", "2")]


def test_no_results_do_not_pass(spark):
    import pytest
    from contactgate.operators.quality import QualityGateError, gate, verdict
    none = spark.createDataFrame([], "name string, passed boolean, observed long, expected string")
    assert tuple(verdict(none).first()) == (False, 0)
    with pytest.raises(QualityGateError):
        gate(none)
