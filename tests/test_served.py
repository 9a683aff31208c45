import random

import pytest
from pyspark.sql import functions as F

from conftest import CHG_HDR, SF_SMALL, write_gz
from contactgate.plans import phone_state as P
from contactgate.sources import schemas as S
from contactgate.sources.delivery import deliver, ingest_change
from contactgate.sources.standin import change_feed
from contactgate.streaming.served import reduce_changes, serve_changes, served_changes, served_table

COLUMNS = [*S.CHANGE_COLUMNS, "record_date_parsed"]


def _rows(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def _batch(feed):
    return P.latest_change_state(P.dedup_change(feed))


def _record(hid, key, day, flag="Y"):
    return f"{hid}|{key}P|AGY|9|F|L|4155550{key}|HOME|ACTIVE|CLIENT|VOIP|5|{flag}|{day}|N|{day}"


def test_served_table_equals_the_batch_state(spark, tmp_path):
    feed = change_feed(spark, SF_SMALL).drop("_row_id")
    root, table, ckpt = (str(tmp_path / x) for x in ("in", "served", "ckpt"))
    split = F.lit("2000-01-01").cast("date")
    deliver(feed.where(F.col("_file_date") >= split), root, "MAINTENANCE", S.CHANGE_COLUMNS)    # the newer files first
    serve_changes(spark, root, table, ckpt, layout="directory", max_files_per_trigger=60, buckets=4)
    deliver(feed.where(F.col("_file_date") < split), root, "MAINTENANCE", S.CHANGE_COLUMNS)     # late
    twice = feed.withColumn("_source_file", F.regexp_replace("_source_file", "_000", "_001"))
    deliver(twice.where("crc32(cnsmr_phn_hst_id) % 3 = 0"), root, "MAINTENANCE", S.CHANGE_COLUMNS)
    serve_changes(spark, root, table, ckpt, layout="directory", max_files_per_trigger=90, buckets=4)
    got = served_changes(spark, table, buckets=4)
    assert _rows(got) == _rows(_batch(feed)) and got.count() > 0
    before = _rows(got)
    serve_changes(spark, root, table, ckpt, layout="directory", buckets=4)      # nothing new
    assert _rows(served_changes(spark, table, buckets=4)) == before


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_order_of_files(spark, tmp_path, seed):
    """Several spellings of a date, several ids of a date text, dates that are none, null keys."""
    rng = random.Random(seed)
    days = ["2023-05-01", "2023-05-1", "2023-05-02", "not a date", "2023-13-40", ""]
    files = [[_record(f"h{rng.randrange(40):02}", rng.randrange(1, 5), rng.choice(days), rng.choice("YN")) for _ in range(8)] for _ in range(5)]
    files.append([r.replace(r.split("|")[1], "", 1) for r in files[0][:3]])     # no legacy id
    for n, rows in enumerate(files):
        write_gz(tmp_path / "all" / f"MAINTENANCE/FEED-2023060{n + 1}070000005-SUPPLFWD-BDL_EXPORT_000.csv.gz", CHG_HDR, rows)
    want = _rows(_batch(ingest_change(spark, str(tmp_path / "all"))))
    table = served_table(spark, str(tmp_path / "served"), buckets=3)
    from contactgate.streaming.served import fold_changes
    parts = [ingest_change(spark, str(tmp_path / "all")).where(F.col("_source_file").contains(f"FEED-2023060{n + 1}")) for n in range(6)]
    order = list(range(6)) + [rng.randrange(6)]
    rng.shuffle(order)
    for epoch, n in enumerate(order):
        table.merge(reduce_changes(parts[n]), epoch, fold_changes)
    got = table.read()
    assert _rows(got) == want
    table.merge(reduce_changes(parts[order[-1]]), len(order) - 1, fold_changes)     # a replayed epoch
    assert _rows(table.read()) == want


def test_an_epoch_without_rows(spark, tmp_path):
    write_gz(tmp_path / "in" / "MAINTENANCE/FEED-20230601070000005-SUPPLFWD-BDL_EXPORT_000.csv.gz", CHG_HDR, [])
    serve_changes(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c"))
    with pytest.raises(FileNotFoundError):
        served_changes(spark, str(tmp_path / "t"))
