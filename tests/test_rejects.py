import gzip

import pytest
from pyspark.sql import functions as F

from conftest import CHG_HDR
from contactgate.sources import schemas as S
from contactgate.sources.delivery import good_rows, ingest_change, ingest_lines, reject_share_check, rejects

FILE = "MAINTENANCE/FEED-20230615070000005-SUPPLFWD-BDL_EXPORT_000.csv.gz"
GOOD = "g-1|A1P|AGY|9|F|L|4155550001|HOME|ACTIVE|CLIENT|VOIP|5|Y|2023-06-01|N|2023-06-01"


def _written(folder, lines: list[bytes], name=FILE):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wb") as f:
        f.write(b"\n".join([CHG_HDR.encode(), *lines, b""]))


def _lines(spark, folder):
    return ingest_lines(spark, str(folder), S.CHANGE_GLOB, S.CHANGE_SCHEMA)


def test_every_line_is_a_good_row_or_a_reject(spark, tmp_path):
    short, long = "|".join(GOOD.split("|")[:9]), GOOD + "|x|y"
    lines = [GOOD.encode(), short.encode(), long.encode(), GOOD.replace("|F|", "|Fran\u00e7ois|").encode("latin-1"),
             GOOD.replace("|F|", "|Fran\u00e7ois|").encode(), b"", GOOD.replace("|CLIENT|", "||").encode(), b"g-9"]
    _written(tmp_path, lines)
    _written(tmp_path, [GOOD.encode()], FILE.replace("0615", "0622"))
    found = _lines(spark, tmp_path)
    assert found.count() == 8       # all lines but the blank one
    bad = {r["_raw"]: (r["_reject_reason"], str(r["_file_date"]), r["_source_file"].rsplit("/", 1)[1]) for r in rejects(found).collect()}
    at = ("2023-06-15", FILE.split("/")[1])
    assert bad[short] == ("short", *at) and bad[long] == ("long", *at) and bad["g-9"] == ("short", *at)
    assert [v for k, v in bad.items() if "\ufffd" in k] == [("undecodable", *at)] and len(bad) == 4
    good = good_rows(found)
    assert good.count() == 4 and good.columns == ingest_change(spark, str(tmp_path)).columns
    assert {r["cnsmr_nm_frst_txt"] for r in good.collect()} == {"F", "Fran\u00e7ois"}
    assert good.where("cnsmr_phn_src_val_txt IS NULL").count() == 1


def test_good_files_have_no_rejects(spark, scenario_dir):
    found = _lines(spark, scenario_dir)
    assert rejects(found).count() == 0
    same = ingest_change(spark, str(scenario_dir))
    assert good_rows(found).exceptAll(same).count() == 0 and found.count() == same.count() > 0


def test_a_renamed_header_still_fails(spark, tmp_path):
    path = tmp_path / FILE
    path.parent.mkdir(parents=True)
    with gzip.open(path, "wt") as f:
        f.write(CHG_HDR.replace("record_date", "recorded") + "\n" + GOOD + "\n")
    with pytest.raises(Exception, match="CSV header"):
        _lines(spark, tmp_path).collect()


def test_the_gate_on_their_share(spark, tmp_path):
    from contactgate.operators.quality import QualityGateError, gate
    _written(tmp_path, [GOOD.encode()] * 9 + [b"g-9|short"])
    found = _lines(spark, tmp_path)
    assert gate(reject_share_check(found, 0.1))
    assert tuple(reject_share_check(found, 0.1).first()) == ("reject_share", True, 1, "share<=0.1")
    with pytest.raises(QualityGateError):
        gate(reject_share_check(found, 0.05))
    assert reject_share_check(found.limit(0), 0).first()["passed"]
    with pytest.raises(ValueError):
        reject_share_check(found, 2)
