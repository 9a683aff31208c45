from conftest import SF_SMALL
from contactgate.plans import phone_state as P
from contactgate.sources import schemas as S
from contactgate.sources.delivery import deliver
from contactgate.sources.standin import change_feed
from contactgate.streaming.change_stream import current_changes, run_change_stream


def test_available_now_equals_batch(spark, tmp_path):
    feed = change_feed(spark, SF_SMALL)
    deliver(feed, str(tmp_path / "in"), "MAINTENANCE", S.CHANGE_COLUMNS)
    run_change_stream(spark, str(tmp_path / "in"), str(tmp_path / "state"),
                      str(tmp_path / "ckpt"), layout="directory", max_files_per_trigger=7)
    streamed = current_changes(spark, str(tmp_path / "state")).drop("_source_file")
    batch = P.latest_change_state(P.dedup_change(feed)).drop("_source_file", "_row_id")
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_restart_is_idempotent(spark, tmp_path, scenario_dir):
    state, ckpt = str(tmp_path / "state"), str(tmp_path / "ckpt")
    run_change_stream(spark, str(scenario_dir), state, ckpt, max_files_per_trigger=1)
    first = current_changes(spark, state).collect()
    run_change_stream(spark, str(scenario_dir), state, ckpt, max_files_per_trigger=1)
    assert sorted(map(tuple, current_changes(spark, state).collect())) == sorted(map(tuple, first))
    assert len(first) == 4      # keys with change records


def test_second_wave_of_files_is_picked_up(spark, tmp_path):
    from pyspark.sql import functions as F
    feed = change_feed(spark, SF_SMALL)
    split = F.lit("2000-01-01").cast("date")
    root, state, ckpt = str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "ckpt")
    deliver(feed.where(F.col("_file_date") < split), root, "MAINTENANCE", S.CHANGE_COLUMNS)
    run_change_stream(spark, root, state, ckpt, layout="directory")
    first_batches = len(list((tmp_path / "state" / "batches").glob("batch=*")))
    deliver(feed.where(F.col("_file_date") >= split), root, "MAINTENANCE", S.CHANGE_COLUMNS)
    run_change_stream(spark, root, state, ckpt, layout="directory")
    assert len(list((tmp_path / "state" / "batches").glob("batch=*"))) > first_batches
    streamed = current_changes(spark, state).drop("_source_file")
    batch = P.latest_change_state(P.dedup_change(feed)).drop("_source_file", "_row_id")
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0
    assert batch.count() == streamed.count()


def test_compaction_between_waves(spark, tmp_path):
    from pyspark.sql import functions as F
    from contactgate.streaming.change_stream import compact
    feed = change_feed(spark, SF_SMALL)
    split = F.lit("2000-01-01").cast("date")
    root, state, ckpt = str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "ckpt")
    deliver(feed.where(F.col("_file_date") < split), root, "MAINTENANCE", S.CHANGE_COLUMNS)
    run_change_stream(spark, root, state, ckpt, layout="directory")
    done = compact(spark, state)
    assert done is not None and compact(spark, state) is None      # nothing new to fold
    deliver(feed.where(F.col("_file_date") >= split), root, "MAINTENANCE", S.CHANGE_COLUMNS)
    run_change_stream(spark, root, state, ckpt, layout="directory")
    streamed = current_changes(spark, state).drop("_source_file")
    batch = P.latest_change_state(P.dedup_change(feed)).drop("_source_file", "_row_id")
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0
    assert batch.count() == streamed.count()
    assert compact(spark, state) > done
    again = current_changes(spark, state).drop("_source_file")
    assert again.exceptAll(streamed).count() == 0 and streamed.exceptAll(again).count() == 0


def test_reading_before_the_first_batch_and_after_an_empty_one(spark, tmp_path):
    from contactgate.streaming.change_stream import BATCHES, compact
    state = str(tmp_path / "state")
    assert current_changes(spark, state).count() == 0 and compact(spark, state) is None
    feed = change_feed(spark, SF_SMALL).drop("_row_id")
    rows = P.dedup_change(feed)
    rows.limit(0).write.parquet(f"{state}/{BATCHES}/batch=0")
    rows.limit(1).write.parquet(f"{state}/{BATCHES}/batch=1")
    rows.limit(0).write.parquet(f"{state}/{BATCHES}/batch=2")
    compact(spark, state)
    rows.write.parquet(f"{state}/{BATCHES}/batch=3")
    assert current_changes(spark, state).count() == P.latest_change_state(rows).count()


def test_compacting_nothing_but_empty_batches_loses_nothing(spark, tmp_path):
    from contactgate.streaming.change_stream import BATCHES, compact
    state = str(tmp_path / "state")
    rows = P.dedup_change(change_feed(spark, SF_SMALL).drop("_row_id"))
    rows.limit(0).write.parquet(f"{state}/{BATCHES}/batch=0")
    compact(spark, state)
    rows.limit(3).write.parquet(f"{state}/{BATCHES}/batch=1")
    assert current_changes(spark, state).count() > 0
