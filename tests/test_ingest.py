import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType

from conftest import DELIVERIES, ENR_HDR, write_gz
from contactgate.sources import schemas as S
from contactgate.sources.delivery import (
    deliver, ingest_enrollment, ingest_snapshot,
)


def test_column_order_and_lineage_last(scenario):
    nf, ch, en = scenario
    assert nf.columns == S.SNAPSHOT_COLUMNS + ["_source_file", "_file_date"]
    assert ch.columns == S.CHANGE_COLUMNS + ["_source_file", "_file_date"]
    assert en.columns == S.ENROLLMENT_COLUMNS + ["_source_file", "_file_date"]


def test_all_raw_columns_are_strings(scenario):
    for df in scenario:
        for f in df.schema.fields:
            if f.name == "_file_date":
                assert f.dataType == DateType()
            else:
                assert f.dataType == StringType(), f.name


def _rows(kind):
    return sum(len(rows) for name, (_, rows) in DELIVERIES.items() if kind in name)


def test_row_counts(scenario):
    assert [df.count() for df in scenario] == [_rows("NON-FIN"), _rows("SUPPLFWD"), _rows("ENRLMT")]


def test_file_dates_from_names(scenario):
    for df, days in zip(scenario, ([(5, 1), (8, 1), (11, 1)], [(6, 15), (12, 5)], None)):
        found = sorted(r[0] for r in df.select("_file_date").distinct().collect())
        assert found == ([dt.date(2023, m, d) for m, d in days] if days else [dt.date(2022, 12, 1), dt.date(2023, 9, 1)])


def test_source_file_is_full_path(scenario, scenario_dir):
    names = {r[0] for r in scenario[0].select("_source_file").distinct().collect()}
    assert {n.rsplit("/", 1)[1] for n in names} == {n.rsplit("/", 1)[1] for n in DELIVERIES if "NON-FIN" in n}
    assert all(str(scenario_dir) in n for n in names)


def test_empty_fields_are_null(scenario):
    row = scenario[0].where(F.col("cnsmr_phn_id") == "id-24").first()
    assert row["cnsmr_phn_cnsnt_flg"] is None and row["cnsmr_phn_cnsnt_dt"] is None
    assert scenario[0].where("cnsmr_phn_id IS NULL").count() == 2


def test_trailing_slash_in_root(spark, scenario_dir):
    assert ingest_snapshot(spark, str(scenario_dir) + "/").count() == _rows("NON-FIN")


def test_unstamped_file_name_gives_null_date(spark, tmp_path):
    write_gz(tmp_path / "ENROLLMENT" / "no-stamp-ENRLMT-EXPORT.csv.gz", ENR_HDR,
             ["1|1P|A|S|F|L|2025550100|CELL|WIRELESS|ACTIVE|CLIENT|1|2020-01-01"])
    df = ingest_enrollment(spark, str(tmp_path))
    assert df.where(F.col("_file_date").isNull()).count() == 1


def test_header_mismatch_fails(spark, tmp_path):
    bad = ENR_HDR.replace("phone_number", "phone_nmbr")
    write_gz(tmp_path / "ENROLLMENT" / "X-20200101000000000-ENRLMT-EXPORT_000.csv.gz", bad,
             ["1|1P|A|S|F|L|2025550100|CELL|WIRELESS|ACTIVE|CLIENT|1|2020-01-01"])
    with pytest.raises(Exception):
        ingest_enrollment(spark, str(tmp_path)).collect()


def test_deliver_roundtrip_directory_layout(spark, tmp_path):
    from contactgate.sources.standin import snapshot_feed
    from conftest import SF_SMALL
    feed = snapshot_feed(spark, SF_SMALL)
    deliver(feed, str(tmp_path), "MAINTENANCE", S.SNAPSHOT_COLUMNS)
    back = ingest_snapshot(spark, str(tmp_path), layout="directory")
    assert back.columns == S.SNAPSHOT_COLUMNS + S.LINEAGE_COLUMNS
    cols = S.SNAPSHOT_COLUMNS + ["_file_date"]
    assert back.select(*cols).exceptAll(feed.select(*cols)).count() == 0
    assert feed.select(*cols).exceptAll(back.select(*cols)).count() == 0


def test_short_row_is_null_padded(spark, tmp_path):
    write_gz(tmp_path / "ENROLLMENT" / "X-20200101000000000-ENRLMT-EXPORT_000.csv.gz", ENR_HDR,
             ["1|1P|A|S|F|L|2025550100|CELL"])
    r = ingest_enrollment(spark, str(tmp_path)).first()
    assert r["phone_type"] == "CELL" and r["enrollment_date"] is None
