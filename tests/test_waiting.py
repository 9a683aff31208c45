"""Micro-batches wait until they are as many rows as the served table."""

import pytest

from contactgate.plans import phone_state as P
from contactgate.sources import schemas as S
from contactgate.sources.tables import RunTable
from contactgate.streaming.served import apply_changes, served_changes

SCHEMA = ", ".join(f"{c} string" for c in S.CHANGE_COLUMNS) + ", _source_file string, _file_date date"


def _record(hid, key, day):
    return (f"h{hid:03}", f"{key}P", "A", "9", "F", "L", f"4155550{key}", "HOME", "ACTIVE", "CLIENT", "VOIP", "5", "Y", day, "N", day, "f", None)


def _rows(df):
    return sorted(tuple(r) for r in df.select("cnsmr_idntfr_lgcy_txt", "cnsmr_phn_hst_id").collect())


def test_merges_grow_with_the_rows_and_readers_see_what_waits(spark, tmp_path):
    path = str(tmp_path / "served")
    batches = [[_record(10 * e, 100 + e, "2023-05-01"), _record(10 * e + 1, 200 + e, "2023-05-02")] for e in range(6)]
    batches[4].append(_record(99, 200, "2023-06-01"))      # a newer record of a merged key
    seen = []
    for epoch, rows in enumerate(batches):
        apply_changes(spark, path, spark.createDataFrame(rows, SCHEMA), epoch, buckets=2)
        seen += rows
    want = _rows(P.latest_change_state(P.dedup_change(spark.createDataFrame(seen, SCHEMA))))
    assert RunTable(spark, f"{path}_merged").runs() == [0, 1, 3]
    assert _rows(served_changes(spark, path, buckets=2)) == want
    apply_changes(spark, path, spark.createDataFrame(batches[5], SCHEMA), 5, buckets=2)      # replayed
    assert _rows(served_changes(spark, path, buckets=2)) == want
    with pytest.raises(ValueError):
        apply_changes(spark, path, spark.createDataFrame(batches[4], SCHEMA), 4, buckets=2)
