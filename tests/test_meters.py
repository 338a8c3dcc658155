"""The sums the small meters fixture is known for."""

from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewell import ScanRequest, TableSpec, TimeRange, column_field, open_sink, open_table, scan
from tidewell.operators import collapse_rows, map_records, pack_rows, unpack_rows
from tidewell.sinks import copy_slices

from . import meters

RANGE = TimeRange.of_text(
    "2024-12-19 16:30:00.000", "2024-12-19 19:30:00.000", "ts", timedelta(hours=1), zone="UTC"
)


@pytest.fixture
def source(lake, spark):
    table = lake.create_table("power", meters.spec())
    table.append(meters.frame(spark, copies=True))
    return table


def read(lake, query, **more):
    options = {"td.jdbc.mode": "source", "td.jdbc.url": f"{lake.root}/power", "scan.query": query}
    return open_table(lake.spark, {**options, **more})


def test_24_written_rows_collapse_to_18(source):
    assert source.read().count() == 18
    assert meters.total(source.read()) == 1221 * 3


def test_the_largest_order_wins(spark):
    latest = collapse_rows(meters.frame(spark, copies=True), ["tbname", "ts"], ["phase"])
    copied = latest.where(F.col("ts") == F.lit(meters.moment(19, 45)))
    assert sorted(round(r["phase"], 5) for r in copied.collect()) == [3.11003, 3.15003]


def test_filter_above_a_scan(source, lake):
    rows = read(lake, "SELECT ts, `current`, voltage, phase, tbname FROM `meters`")
    assert meters.total(rows.where("`current` > 90")) == 203 * 3


def test_time_slices(source, spark):
    sliced = scan(spark, ScanRequest(sql="select * from meters", time=RANGE), {"meters": source.read()})
    assert sliced.groupBy("slice").count().orderBy("slice").collect() == [(0, 6), (1, 6), (2, 6)]
    assert meters.total(sliced) == 1221 * 3


def test_tag_slices(source, spark):
    request = ScanRequest(
        sql="select tbname, groupid, voltage, upper(location) as place from meters",
        tags=("place like '%FRANCISCO' and groupid < 2", "groupid between 2 and 5"),
    )
    assert meters.total(scan(spark, request, {"meters": source.read()})) == 1221 * 3


def test_tag_slices_repeat_overlaps_and_leave_gaps(source, spark):
    tables = {"meters": source.read()}
    twice = ScanRequest(sql="select * from meters", tags=("groupid >= 1", "groupid > 1", "groupid > 2"))
    counts = scan(spark, twice, tables).groupBy("slice").count().orderBy("slice").collect()
    assert counts == [(0, 18), (1, 9)]
    assert scan(spark, ScanRequest(sql="select * from meters", tags=()), tables).count() == 0


def test_table_slices(source, spark):
    request = ScanRequest(
        select="voltage, tbname, phase * 2 as doubled",
        table="meters",
        order_by=("voltage desc",),
        limit=9,
        tables=("d1002", "d1001"),
    )
    rows = scan(spark, request, {"meters": source.read()})
    assert rows.columns == ["voltage", "tbname", "doubled"]
    assert meters.total(rows) == 1221 * 3


def test_a_table_listed_twice_is_read_twice(source, spark):
    request = ScanRequest(table="meters", tables=("d1001", "d1002", "d1001"), where="voltage > 202")
    counts = scan(spark, request, {"meters": source.read()}).groupBy("tbname").count().orderBy("tbname").collect()
    assert counts == [("d1001", 6), ("d1002", 9)]


def test_a_limit_holds_for_each_sub_table(source, spark):
    request = ScanRequest(table="meters", tables=("d1001", "d1002"), order_by=("ts desc",), limit=2)
    rows = scan(spark, request, {"meters": source.read()})
    assert sorted(r["voltage"] for r in rows.collect()) == [202, 203, 205, 206]


def test_no_listed_table_reads_nothing(source, spark):
    assert scan(spark, ScanRequest(table="meters", tables=()), {"meters": source.read()}).count() == 0


def test_structured_text():
    request = ScanRequest(
        select="tbname, `phase`", table="meters", where="phase < 0.3", order_by=("tbname", "`phase` desc"), limit=3
    )
    assert request.sql_text() == (
        "select tbname, `phase` from `meters` where phase < 0.3 order by tbname, `phase` desc limit 3"
    )
    assert ScanRequest(table="meters").sql_text() == "select * from `meters`"
    assert ScanRequest(sql="select 1", table="meters", where="x").sql_text() == "select 1"
    with pytest.raises(ValueError):
        ScanRequest()
    with pytest.raises(ValueError):
        ScanRequest(table="meters", tags=("a",), tables=("b",))


def test_batches_of_rows(source, lake):
    rows = read(
        lake, "select ts, voltage, tbname from meters", **{"td.batch.mode": "true", "batch.size": "4"}
    )
    assert rows.columns == ["rows"]
    assert max(rows.select(F.size("rows")).toPandas().iloc[:, 0]) <= 4
    assert meters.total(unpack_rows(rows)) == 1221 * 3


@pytest.mark.parametrize("size", [1, 2, 7, 18, 100])
def test_batches_keep_every_row(spark, size):
    df = meters.frame(spark).coalesce(1)
    packed = pack_rows(df, size)
    sizes = [r[0] for r in packed.select(F.size("rows")).collect()]
    assert sum(sizes) == 18 and all(s == size for s in sizes[:-1])
    assert unpack_rows(packed).collect() == df.collect()


def test_batches_across_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        packed = pack_rows(spark.range(0, 50, 1, 1), 10)
        assert [[r["id"] for r in e["rows"]] for e in packed.collect()] == [
            list(range(s, s + 10)) for s in range(0, 50, 10)
        ]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_copy_that_breaks_off_and_runs_again(source, lake, spark):
    target = lake.create_table("power_sink", meters.spec("sink_meters"))
    late = F.col("ts") > F.lit(meters.moment(18, 46))
    broken = source.read().withColumn(
        "voltage", F.when(late, F.raise_error(F.lit("broken")).cast("int")).otherwise(F.col("voltage"))
    )
    with pytest.raises(Exception, match="broken"):
        copy_slices(broken, RANGE, target, "copy")
    assert meters.total(target.read()) == 1221
    copied = copy_slices(source.read(), RANGE, target, "copy")
    assert copied == RANGE.windows()[1:]
    assert meters.total(target.read()) == 1221 * 3
    assert copy_slices(source.read(), RANGE, target, "copy") == []


def test_a_copy_from_a_stored_table(source, lake):
    target = lake.create_table("power_sink", meters.spec("sink_meters"))
    assert copy_slices(source, RANGE, target, "copy") == RANGE.windows()
    assert sorted(target.read().collect()) == sorted(source.read().collect())


def test_requests_by_text_over_stored_tables(source, lake):
    assert meters.total(lake.scan("power", ScanRequest(sql="select * from meters where groupid = 1"))) == 606 * 3


@pytest.mark.parametrize("name", ["meters", "`meters`", "power.meters", "`power`.`meters`", "power . meters"])
def test_tables_by_plain_and_qualified_names(source, lake, name):
    assert lake.sql("power", f"SELECT sum(voltage) FROM {name}").first()[0] == 1221 * 3
    longer = lake.create_table("power", meters.spec("meters_old"))
    assert longer.read().count() == 0
    assert lake.sql("power", f"SELECT sum(voltage) s FROM {name} UNION ALL SELECT count(*) FROM power.meters_old").count() == 2
    assert meters.total(read(lake, f"SELECT * FROM {name} WHERE groupid = 2")) == 615 * 3


def test_a_copy_of_one_sub_table_into_a_normal_table(source, lake, spark):
    target = lake.create_table("power_sink", TableSpec.normal("sink_normal", meters.COLUMNS[:4], key=["ts"]))
    rows = source.read(tables=["d1001"]).select("ts", "current", "voltage", "phase")
    copy_slices(rows, RANGE, target, "copy")
    assert meters.total(target.read()) == 606 * 3


def sink(lake, table, fields, kind="sink.supertable.name"):
    options = {
        "td.jdbc.mode": "cdc",  # the mode does not matter to a target
        "td.jdbc.url": f"{lake.root}/power_sink?user=someone",
        "sink.db.name": "power_sink",
        kind: table,
    }
    return open_sink(lake.spark, options, fields)


def test_insert_select(source, lake, spark):
    lake.create_table("power_sink", meters.spec("sink_meters"))
    target = sink(lake, "sink_meters", meters.NAMES)
    target.insert(read(lake, "SELECT ts, `current`, voltage, phase, location, groupid, tbname FROM `meters`"))
    assert meters.total(target.store.read()) == 1221 * 3
    tags = target.store.tags().orderBy("tbname").collect()
    assert tags == [("d1001", "California.SanFrancisco", 1), ("d1002", "Alabama.Montgomery", 2)]


def test_insert_values_into_a_normal_table(lake, spark):
    lake.create_table("power_sink", TableSpec.normal("sink_normal", meters.COLUMNS[:4], key=["ts"]))
    target = sink(lake, "sink_normal", ["ts", "current", "voltage", "phase"], "sink.table.name")
    target.insert(spark.sql("SELECT * FROM VALUES (CAST('2025-01-19 23:00:03' AS TIMESTAMP), 12.34, 220, 1.56)"))
    row = target.store.read().first()
    assert (row["voltage"], round(row["current"], 2)) == (220, 12.34)
    assert row["ts"] == datetime(2025, 1, 19, 23, 0, 3)


def test_insert_values_into_a_super_table(lake, spark):
    lake.create_table("power_sink", meters.spec("sink_meters"))
    target = sink(lake, "sink_meters", meters.NAMES)
    values = ", ".join(
        f"(CAST('2024-12-19 19:12:4{5 + step}' AS TIMESTAMP), {c}, {v}, {p}, '{location}', {group}, '{name}')"
        for name, (location, group, readings) in meters.SUB_TABLES.items()
        for step, (c, v, p) in enumerate(readings)
    )
    target.insert(spark.sql(f"SELECT * FROM VALUES {values}"))
    assert meters.total(target.store.read()) == 1221


def test_insert_rows_from_a_list(lake, spark):
    lake.create_table("power_sink", meters.spec("sink_meters"))
    start = datetime(2025, 1, 1)
    rows = [
        (start + timedelta(seconds=i), 1.5 * i, 301 + i, 0.1, "California.SanFrancisco", 1, "d001") for i in range(50)
    ]
    target = sink(lake, "sink_meters", meters.NAMES)
    target.insert(spark.createDataFrame(rows, meters.spec().schema))
    assert meters.total(target.store.read()) == 16275


def test_a_mixed_case_column(lake, spark):
    columns = [*meters.COLUMNS[:4], column_field("Aateat", "INT"), *meters.COLUMNS[4:]]
    lake.create_table("power_sink", TableSpec.super("sink_meters", columns))
    fields = ["ts", "current", "voltage", "phase", "`Aateat`", "location", "groupid", "tbname"]
    start = datetime(2025, 1, 1)
    rows = [(start + timedelta(seconds=i), 1.0, 301 + i, 0.1, i * i, f"location_{i}", i, f"d0{i}") for i in range(10)]
    schema = "a timestamp, b float, c int, d float, e int, f string, g int, h string"
    target = sink(lake, "sink_meters", fields)
    target.insert(spark.createDataFrame(rows, schema))
    back = target.store.read()
    assert meters.total(back) == 3055
    assert back.agg(F.sum("Aateat")).first()[0] == sum(i * i for i in range(10))
    assert back.select("tbname").distinct().count() == 10


def test_rows_from_json(lake, spark):
    lines = [(f'{{"vin":{i % 10}}}', i) for i in range(20)]
    vin = F.get_json_object("line", "$.vin").cast("int")
    rows = spark.createDataFrame(lines, "line string, n int").select(
        F.timestamp_seconds(F.col("n") + 1735689600).alias("ts"),
        F.lit(1.0).alias("current"),
        (vin + 300).alias("voltage"),
        F.lit(0.5).alias("phase"),
        F.concat(F.lit("location_"), vin).alias("location"),
        vin.alias("groupid"),
        F.concat(F.lit("d0"), vin).alias("tbname"),
    )
    lake.create_table("power_sink", meters.spec("sink_meters"))
    target = sink(lake, "sink_meters", meters.NAMES)
    target.insert(rows, by="name")
    assert meters.total(target.store.read()) == 6090


def test_user_records_both_ways(source, lake, spark):
    def decode(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"name": batch["tbname"] + "/" + batch["location"], "volts": batch["voltage"]})

    records = map_records(source.read(), decode, "volts int, name string")
    assert records.columns == ["volts", "name"]
    assert records.agg(F.sum("volts")).first()[0] == 1221 * 3

    def encode(batch: pd.DataFrame) -> pd.DataFrame:
        parts = batch["name"].str.split("/", expand=True)
        return batch.assign(tbname=parts[0], location=parts[1], voltage=batch["volts"])

    back = map_records(records, encode, "tbname string, location string, voltage int")
    assert back.groupBy("tbname").agg(F.sum("voltage")).orderBy("tbname").collect() == [
        ("d1001", 606 * 3), ("d1002", 615 * 3),
    ]
