"""What Spark's JDBC source and sink are asked for. No database runs here: the session and the
frame are stand-ins that record the calls."""

import re
from collections import Counter
from unittest.mock import MagicMock, patch

import pytest

from tidewell import ScanRequest, TimeRange, open_sink, open_table
from tidewell.sinks import write_jdbc
from tidewell.sources import read_jdbc, scan_jdbc

URL = "jdbc:some://host:6041/power"


def test_one_query_is_one_slice():
    spark = MagicMock()
    read_jdbc(spark, URL, "select 1", options={"user": "u"})
    reader = spark.read.format.return_value.option.return_value.options.return_value.option.return_value
    reader.option.assert_called_once_with("query", "select 1")


def test_each_predicate_is_a_partition():
    spark = MagicMock()
    request = ScanRequest(sql="select * from meters", time=TimeRange(0, 25, "ts", 10))
    read_jdbc(spark, URL, request.sql_text(), request.predicates(), {"user": "u"})
    (url, table), named = spark.read.jdbc.call_args
    assert (url, table) == (URL, "(select * from meters) q")
    assert named["predicates"] == ["ts >= 0 and ts < 10", "ts >= 10 and ts < 20", "ts >= 20 and ts < 25"]
    assert named["properties"]["user"] == "u"


def test_no_slices_read_nothing():
    spark = MagicMock()
    read_jdbc(spark, URL, "select * from meters", [])
    reader = spark.read.format.return_value.option.return_value.options.return_value.option.return_value
    reader.option.assert_called_once_with("query", "select * from (select * from meters) q where 1 = 0")


def test_options_open_a_database():
    spark = MagicMock()
    options = {"td.jdbc.mode": "source", "td.jdbc.url": URL, "scan.query": "select 1", "user": "u", "timezone": "UTC-8"}
    open_table(spark, options)
    spark.read.format.assert_called_once_with("jdbc")
    spark.read.format.return_value.option.return_value.options.assert_called_once_with(user="u", timezone="UTC-8")


@pytest.mark.parametrize("size, sent", [(500, "500"), (0, "1"), (-3, "1")])
def test_rows_per_round_trip(size, sent):
    df = MagicMock()
    write_jdbc(df, URL, "power.meters", size)
    writer = df.write.format.return_value
    writer.option.return_value.option.return_value.option.assert_called_once_with("batchsize", sent)


def test_a_database_target_binds_by_position():
    rows = MagicMock(columns=["a", "b"])
    options = {
        "td.jdbc.url": URL, "sink.db.name": "power", "sink.table.name": "t", "sink.batch.size": "20",
        "sink.parallelism": "3",
    }
    open_sink(MagicMock(), options, ["ts", "`Aateat`"]).insert(rows)
    rows.toDF.assert_called_once_with("ts", "Aateat")
    rows.toDF.return_value.select.assert_called_once_with("`ts`", "`Aateat`")
    rows.toDF.return_value.select.return_value.repartition.assert_called_once_with(3)
    with pytest.raises(ValueError, match="2 fields, but 1 columns"):
        open_sink(MagicMock(), options, ["ts"]).insert(rows)


def test_sub_tables_are_slices_of_a_database():
    spark = MagicMock()
    request = ScanRequest(select="ts, voltage", table="meters", where="voltage > 3", tables=("d1", "o'k"))
    scan_jdbc(spark, URL, request, {"user": "u"})
    (_, table), named = spark.read.jdbc.call_args
    assert table == "(select tbname, ts, voltage from meters where voltage > 3) q"
    assert named["predicates"] == ["tbname = 'd1'", "tbname = 'o''k'"]


def test_tag_predicates_are_slices_of_a_database():
    spark = MagicMock()
    scan_jdbc(spark, URL, ScanRequest(sql="select * from meters", tags=("groupid = 1", "groupid = 2")))
    assert spark.read.jdbc.call_args.kwargs["predicates"] == ["groupid = 1", "groupid = 2"]


def test_ten_thousand_windows_in_16_partitions():
    spark = MagicMock()
    time = TimeRange(0, 100_000, "ts", 10)
    assert len(time.windows()) == 10_000
    scan_jdbc(spark, URL, ScanRequest(sql="select * from meters", time=time), partitions=16)
    predicates = spark.read.jdbc.call_args.kwargs["predicates"]
    assert len(predicates) == 16
    bounds = [tuple(int(n) for n in re.findall(r"\d+", p)) for p in predicates]
    assert bounds[0][0] == 0 and bounds[-1][1] == 100_000
    assert all(a[1] == b[0] and a[0] < a[1] for a, b in zip(bounds, bounds[1:]))


def test_many_sub_tables_are_read_as_lists():
    spark = MagicMock()
    names = [f"d{i}" for i in range(1000)] + ["d7", "o'k", "d7"]
    scan_jdbc(spark, URL, ScanRequest(table="meters", tables=tuple(names)), partitions=8)
    predicates = spark.read.jdbc.call_args.kwargs["predicates"]
    read = [n for p in predicates for n in re.findall(r"'((?:[^']|'')*)'", p)]
    assert Counter(read) == Counter(n.replace("'", "''") for n in names)
    # a name listed again is in another condition, since one condition reads it once
    assert len(predicates) == 8 + 1 + 1 and all(len(set(ns)) == len(ns) for ns in (re.findall(r"'(\w+)'", p) for p in predicates))


def test_many_tag_predicates_keep_their_overlaps():
    spark = MagicMock()
    tags = tuple(f"groupid > {i}" for i in range(10))
    with patch("tidewell.sources.jdbc.reduce", lambda union, frames: frames):
        parts = scan_jdbc(spark, URL, ScanRequest(sql="select * from meters", tags=tags), partitions=3)
    reader = spark.read.format.return_value.option.return_value.options.return_value.option.return_value
    queries = [call.args[1] for call in reader.option.call_args_list]
    assert len(parts) == len(queries) == 3
    asked = [tag for query in queries for tag in re.findall(r"where (groupid > \d+)", query)]
    assert sorted(asked) == sorted(tags) and all("union all" in query for query in queries)


def test_options_slice_a_database():
    spark = MagicMock()
    options = {
        "td.jdbc.mode": "source", "td.jdbc.url": URL, "scan.query": "select * from meters", "scan.time.column": "ts",
        "scan.time.start": "1000", "scan.time.end": "1970-01-01 00:00:05", "scan.time.interval": "1", "scan.partitions": "4",
    }
    open_table(spark, options)
    predicates = spark.read.jdbc.call_args.kwargs["predicates"]
    assert predicates[0] == "ts >= 1000 and ts < 2000" and predicates[-1].endswith("ts < 5000") and len(predicates) == 4
    with pytest.raises(ValueError, match="one way"):
        open_table(spark, {**options, "scan.tags": "a = 1"})
