"""Names and dates of deliveries, without patterns searched in every row."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from contactgate.functions.columns import file_date_from_name
from contactgate.plans.tables_catalog import q_lineage_columns
from contactgate.sources.delivery import delivery_stem, ingest_snapshot
from contactgate.sources.tables import DeliveryTable


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lineage_searches_no_path_for_its_folder(spark, scenario_dir):
    assert "/[^/]+$" not in _plan(ingest_snapshot(spark, str(scenario_dir)))


def test_a_name_without_a_stamp_is_not_parsed(spark):
    names = spark.createDataFrame([("part-0001.csv.gz",), ("X-20190101000000863-Y.csv",), ("X-20191301000000863-Y.csv",), (None,)], "name string")
    dated = names.select(file_date_from_name("name").alias("d"))
    assert [str(r["d"]) for r in dated.collect()] == ["None", "2019-01-01", "None", "None"]
    assert "CASE WHEN" in _plan(dated)


def test_delivery_stem_is_the_name_without_its_ending(spark):
    paths = ["M/F-1_000.csv.gz", "F.csv.gz", "M/.csv.gz", "M/F.csv", "", "M/", "a.csv.gz/b", "a/b.csv.gz.csv.gz", None]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = df.select(delivery_stem("p").alias("a"), F.regexp_extract("p", r"([^/]+)\.csv\.gz$", 1).alias("b")).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got]


def test_lineage_columns_searches_no_path_for_its_delivery(spark):
    assert "/[^/]+$" not in _plan(q_lineage_columns(spark, SF_SMALL))


def test_delivery_names_as_by_the_patterns(spark):
    paths = ["M/F_000.csv.gz", "r/M/delivery=F/part-0.csv.gz", "r/M/delivery=/part", "delivery=a/delivery=b/c", "r/delivery=", "x-delivery=y",
             "r/delivery=y", "r/", "", "plain"]
    df = spark.createDataFrame([(p,) for p in paths], "_source_file string")
    folder = F.regexp_extract("_source_file", r"^(.*delivery=[^/]+)/", 1)
    whole = F.when(folder != "", folder).otherwise(F.col("_source_file"))
    want = F.concat_ws("-", F.regexp_extract(whole, r"(?:delivery=)?([^/]+)$", 1), F.lower(F.hex(F.xxhash64(whole))))
    named = df.select(DeliveryTable.delivery_of().alias("a"), want.alias("b"))
    assert all(r["a"] == r["b"] for r in named.collect())
    assert "(?:delivery=)?" not in _plan(df.select(DeliveryTable.delivery_of()))
