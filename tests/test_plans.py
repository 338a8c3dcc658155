"""What the physical plans of the queries look like."""

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tidewell import ScanRequest, TimeRange
from tidewell.operators import number_rows, slice_by_tags, top_per_table

from . import meters

SF = "/root/testdata/sf0.001"


def plan(df):
    session = df.sparkSession
    session.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        session.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture
def table(lake, spark):
    table = lake.create_table("power", meters.spec(buckets=4))
    table.append(meters.frame(spark))
    return table


@pytest.mark.parametrize("key", ["time_slices", "tag_slices", "per_table_topn", "collapse_key", "sum_by_table"])
def test_one_scan(spark, key):
    assert plan(registry.queries()[key](spark, SF)).count("FileScan") == 1


def test_a_time_range_reaches_the_scan(spark):
    text = plan(registry.queries()["time_slices"](spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,props:string>" in text


def test_unused_columns_are_not_read(spark):
    text = plan(registry.queries()["ts_millis"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_tag_predicates_reach_the_scan(table):
    text = plan(slice_by_tags(table.spark.read.parquet(f"{table.path}/log"), ["groupid = 1", "groupid = 7"]))
    assert re.search(r"PushedFilters: \[Or\(EqualTo\(groupid,1\),EqualTo\(groupid,7\)\)", text)


def test_a_small_limit_cuts_groups_before_the_shuffle(spark, table):
    text = plan(top_per_table(table.read(), 5, ["ts"]))
    assert re.search(r"WindowGroupLimit.*Partial", text)


def test_restricted_reads_leave_out_folders(table):
    text = plan(table.read(datetime(2024, 12, 19, 18), datetime(2024, 12, 19, 20), ["d1001"]))
    folders = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text).group(1)
    assert "period" in folders and "bucket" in folders
    assert "GreaterThanOrEqual(ts,2024-12-19 18:00:00.0)" in text
    assert "EqualTo(tbname,d1001)" in text or "In(tbname" in text


def test_sliced_scans_of_stored_tables_leave_out_folders(lake, table):
    hours = TimeRange.of_millis(1734631200000, 1734638400000, "ts", timedelta(hours=1))
    by_time = lake.scan("power", ScanRequest(table="meters", time=hours))
    by_table = lake.scan("power", ScanRequest(table="meters", tables=("d1001",)))
    for df, name in ((by_time, "period"), (by_table, "bucket")):
        assert name in re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan(df)).group(1)
    assert by_time.count() == 12 and by_table.count() == 9
    # a limit comes before the range, which then must not narrow what is read
    first = lake.scan("power", ScanRequest(table="meters", order_by=("ts",), limit=7, time=hours))
    assert first.count() == 1


def test_key_conditions_above_a_table_reach_the_scan(table):
    text = plan(table.read().where("tbname = 'd1001' and ts >= '2024-12-19 18:00:00'"))
    assert "EqualTo(tbname,d1001)" in text and "GreaterThanOrEqual(ts,2024-12-19 18:00:00.0)" in text


def test_periods_of_one_batch_are_read_without_a_shuffle(table, spark):
    assert "Exchange" not in plan(table.read())
    later = meters.frame(spark).withColumn("ts", F.col("ts") + F.expr("interval 2 days"))
    table.append(later)
    assert "Exchange" not in plan(table.read()) and table.read().count() == 36
    table.append(later.withColumn("voltage", F.lit(1)))
    text = plan(table.read())
    collapsed = text[text.index("Exchange") :]
    assert text.count("FileScan") == 2 and collapsed.count("FileScan") == 1
    assert table.read().where("voltage = 1").count() == 18 and table.read().count() == 36


def test_a_compacted_table_is_read_without_a_shuffle(table):
    table.compact()
    text = plan(table.read())
    assert "Exchange" not in text and "Aggregate" not in text


@pytest.mark.parametrize("piece_rows", [5, 1_000_000])
def test_numbered_rows_are_shuffled_once(spark, piece_rows):
    rows = registry._meters(spark, SF).select("event_id", "ts", "tbname")
    text = plan(number_rows(rows, ["tbname"], ["ts", "event_id"], piece_rows=piece_rows))
    # from the numbering down to the scan of the rows
    path = text[: text.index("FileScan")]
    assert "Window [row_number()" in path and path.count("Exchange hashpartitioning") == 1


def test_costly_columns_are_computed_once_for_rejects(spark):
    for key in ("coerce_rows", "coerce_rejects"):
        assert plan(registry.queries()[key](spark, SF)).count("get_json_object") == 1


def test_streams_stay_out_of_python(spark):
    text = registry._meters_stream(spark, SF)._jdf.queryExecution().analyzed().toString()
    assert "Python" not in text and "MapInArrow" not in text
