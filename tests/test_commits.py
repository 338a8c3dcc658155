"""Commits, copies in one pass, checked writes, layouts and statements."""

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewell import Lake, ScanRequest, Statements, TableSpec, TableStore, TimeRange, column_field, fs, open_table, scan
from tidewell.sinks import copy_slices
from tidewell.sinks.copy import window_rows

from . import meters
from .test_plans import plan

HOURS = TimeRange.of_text("2024-12-19 16:30:00.000", "2024-12-19 19:30:00.000", "ts", timedelta(hours=1), zone="UTC")


@pytest.fixture
def table(lake):
    return lake.create_table("power", meters.spec(order_by=("phase",), buckets=4))


def counted(df):
    """The rows and how many of them tasks have read so far."""
    read = df.sparkSession.sparkContext.accumulator(0)

    @F.udf("boolean")
    def seen(_):
        read.add(1)
        return True

    return df.where(seen.asNondeterministic()("ts")), read


@pytest.mark.parametrize("step", ["publish_json", "move"])
def test_a_replacement_that_breaks_off_loses_nothing(table, spark, monkeypatch, step):
    table.append(meters.frame(spark), batch="one")
    before = sorted(table.read().collect())
    higher = meters.frame(spark).withColumn("voltage", F.col("voltage") + 1000)

    def broken(*_):
        raise OSError("injected")

    with monkeypatch.context() as patch:
        patch.setattr(fs, step, broken)
        with pytest.raises(OSError, match="injected"):
            table.append(higher, batch="one")
    again = TableStore.open(spark, table.path)
    if step == "publish_json":  # it never counted
        assert sorted(again.read().collect()) == before
    else:  # it counts from the commit on; whoever comes next completes it
        assert meters.total(again.read()) == 1221 * 3 + 18_000
        assert fs.glob(spark, f"{table.path}/staged/*") == []
    table.append(meters.frame(spark), batch="one")
    assert sorted(again.read().collect()) == before
    assert again.batches() == ["one"]
    again.vacuum()
    assert len(fs.glob(spark, f"{table.path}/log/_commit=*/_batch=*")) == 1
    assert sorted(table.read().collect()) == before


def test_two_writers_take_different_numbers(table, spark, monkeypatch):
    other = TableStore.open(spark, table.path)
    taken = []
    publish = fs.publish_json

    def overtaken(session, path, value):
        if not taken:
            taken.append(path)
            other.append(meters.frame(spark).where("tbname = 'd1001'"), batch="other")
        return publish(session, path, value)

    with monkeypatch.context() as patch:
        patch.setattr(fs, "publish_json", overtaken)
        table.append(meters.frame(spark).where("tbname = 'd1002'"), batch="one")
    assert table.last_commit() == 2 and table.batches() == ["one", "other"]
    assert meters.total(table.read()) == 1221 * 3


def test_commits_are_found_in_a_few_looks(table, spark, monkeypatch):
    for number in range(1, 38):
        fs.write_json(spark, table._commit_file(number), {"staged": "x", "live": {}, "ends": {}})
    looks = []
    exists = fs.exists
    monkeypatch.setattr(fs, "exists", lambda s, path: looks.append(path) or exists(s, path))
    assert TableStore.open(spark, table.path).last_commit() == 37
    assert len(looks) < 20


def test_a_copy_reads_its_source_once(table, lake, spark):
    table.append(meters.frame(spark))
    target = lake.create_table("copy", meters.spec(order_by=("phase",)))
    source, read = counted(table.read())
    narrow = TimeRange(HOURS.start_ms, HOURS.end_ms, "ts", 60_000)
    assert len(narrow.windows()) == 180
    assert plan(window_rows(table, narrow, narrow.windows())).count("FileScan") == 1
    assert copy_slices(source, narrow, target, "copy") == narrow.windows()
    assert read.value == 18
    assert target.last_commit() == 1 and len(target.batches()) == 180
    assert sorted(target.read().collect()) == sorted(table.read().collect())
    assert copy_slices(source, narrow, target, "copy") == [] and read.value == 18


def test_a_copy_in_steps_and_one_that_breaks_off(table, lake, spark):
    table.append(meters.frame(spark))
    target = lake.create_table("copy", meters.spec(order_by=("phase",)))
    late = F.col("ts") > F.lit(meters.moment(18, 46))
    broken = table.read().withColumn(
        "voltage", F.when(late, F.raise_error(F.lit("broken")).cast("int")).otherwise(F.col("voltage"))
    )
    with pytest.raises(Exception, match="broken"):
        copy_slices(broken, HOURS, target, "copy")
    assert meters.total(target.read()) == 1221
    source, read = counted(table.read())
    assert copy_slices(source, HOURS, target, "copy", windows_at_once=1) == HOURS.windows()[1:]
    assert read.value == 2 * 18 and target.last_commit() == 3  # a step reads the source once
    # a window in the middle that is missing is the only one written
    other = lake.create_table("other", meters.spec(order_by=("phase",)))
    for start, end in (HOURS.windows()[0], HOURS.windows()[2]):
        other.append(meters.frame(spark).where("false"), batch=f"copy-{start}-{end}")
    assert copy_slices(table, HOURS, other, "copy") == [HOURS.windows()[1]]
    assert meters.total(other.read()) == 1221


def test_rejects_and_rows_in_one_job(table, spark, tmp_path):
    rows = meters.frame(spark).withColumn(
        "voltage", F.when(F.col("groupid") == 2, F.lit("n/a")).otherwise(F.col("voltage").cast("string"))
    ).withColumn("phase", F.when(F.col("voltage") == "201", F.lit(1e300)).otherwise(F.col("phase").cast("double")))
    source, read = counted(rows)
    folder = f"file://{tmp_path}/rejects"
    for _ in range(2):
        assert table.append_checked(source, folder, batch="one") == {"written": 6, "rejected": 12}
    assert read.value == 2 * 18
    assert sorted(r["voltage"] for r in table.read().collect()) == [202] * 3 + [203] * 3
    rejects = table.read_rejects(folder, rows.schema).collect()
    assert sorted((r["voltage"], ",".join(r["rejected"])) for r in rejects) == [("201", "phase")] * 3 + [("n/a", "voltage")] * 9
    assert rejects[0].__fields__ == [*rows.columns, "rejected"]
    nothing = table.append_checked(rows.where("false"), folder, batch="two")
    assert nothing == {"written": 0, "rejected": 0} and table.batches() == ["one", "two"]


def test_a_normal_table_is_laid_out_by_its_time(lake, spark):
    spec = TableSpec.normal("n", meters.COLUMNS[:4], key=["ts"], order_by=("voltage",))
    assert list(spec.layout) == ["period"]
    assert TableSpec.normal("k", meters.COLUMNS[:4], key=["voltage"]).layout == {}
    assert TableSpec.normal("x", [column_field("x", "INT")]).layout == {}
    table = lake.create_table("power", spec)
    rows = meters.frame(spark).select("ts", "current", "voltage", "phase")
    for day in range(4):
        table.append(rows.withColumn("ts", F.col("ts") + F.expr(f"interval {day} days")))
    some = table.read(datetime(2024, 12, 20), datetime(2024, 12, 21, 18))
    assert "period" in re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan(some)).group(1)
    assert {re.search(r"period=([\d-]+)", f).group(1) for f in some.inputFiles()} <= {f"2024-12-{d}" for d in (19, 20, 21, 22)}
    assert some.count() == 9 + 3
    table.compact()
    assert table.read().count() == 36 and meters.total(table.read(datetime(2024, 12, 22))) == 615 * 3


def test_listed_sub_tables_read_few_bytes(lake, spark):
    """10 of 10,000 sub-tables: conditions on their names reach the row groups."""
    spec = TableSpec.super("many", [column_field("ts", "TIMESTAMP"), column_field("v", "DOUBLE")], buckets=64, period="year")
    table = lake.create_table("power", spec)
    rows = spark.range(0, 200_000, 1, 4).select(
        F.timestamp_seconds(F.col("id") % 20 * 3600 + 1_700_000_000).alias("ts"),
        F.rand(3).alias("v"),
        F.format_string("d%05d", F.floor(F.col("id") / 20)).alias("tbname"),
    )
    table.append(rows)
    names = [f"d{i * 997:05d}" for i in range(10)]

    def output(df):
        """Rows that leave the scan, before the filter."""
        df.collect()
        node = df._jdf.queryExecution().executedPlan()
        node = node.executedPlan() if node.nodeName() == "AdaptiveSparkPlan" else node
        while node.children().size():
            node = node.children().apply(0)
        return node.metrics().apply("numOutputRows").value()

    few = table.read(tables=names)
    assert few.count() == 200
    assert output(few) < 200_000 / 5
    listed = spark.createDataFrame([(n,) for n in names], "tbname string")
    jobs, rows = spark.sparkContext.statusTracker(), table.read()
    spark.sparkContext.setJobGroup("listed", "")
    try:
        from tidewell.operators import read_tables

        frame = read_tables(rows, listed)
        assert list(jobs.getJobIdsForGroup("listed")) == []  # built without a job
    finally:
        spark.sparkContext.setJobGroup("none", "")
    assert sorted(frame.collect()) == sorted(few.collect())


def test_tag_predicates_read_matching_buckets(lake, spark):
    """Also over a base and the log; a predicate on other columns reads everything."""
    spec = TableSpec.super("tagged", meters.COLUMNS, order_by=("phase",), buckets=64, fixed_tags=True)
    table = lake.create_table("power", spec)
    many = spark.range(400).select(
        F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("ts"),
        F.lit(1.0).cast("float").alias("current"),
        F.col("id").cast("int").alias("voltage"),
        F.lit(0.5).cast("float").alias("phase"),
        F.concat(F.lit("place"), F.col("id") % 100).alias("location"),
        (F.col("id") % 100).cast("int").alias("groupid"),
        F.concat(F.lit("t"), F.col("id") % 100).alias("tbname"),
    )
    table.append(many.where("voltage < 300"))
    table.compact()
    table.append(many.where("voltage >= 300"))
    request = ScanRequest(table="tagged", tags=("groupid = 7", "location = 'place8'", "groupid = 7"))
    rows = lake.scan("power", request)
    assert sorted((r["slice"], r["tbname"]) for r in rows.collect()) == [(0, "t7")] * 4 + [(1, "t8")] * 4 + [(2, "t7")] * 4
    filters = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan(rows))
    assert filters and all("bucket" in f for f in filters)
    read = table.read(tags=["groupid = 7"])
    assert len({r["bucket"] for r in spark.read.parquet(f"{table.path}/log").select("bucket").distinct().collect()}) > 30
    assert read.select("tbname").distinct().count() < 10 and read.where("groupid = 7").count() == 4
    assert table.read(tags=["voltage = 3"]).count() == 400 and table.read(tags=[]).count() == 0
    assert table.tags().count() == 100 and table.tags().where("groupid = 9").first()["location"] == "place9"
    topic = lake.create_topic("tagged", table)
    stream = topic.read(topic.group("g"), "earliest").writeStream.format("memory").queryName("tagged_rows")
    stream.trigger(availableNow=True).start().awaitTermination()
    assert spark.table("tagged_rows").count() == 400  # lists of sub-tables are not rows
    table.vacuum()
    assert table.tags().count() == 100 and table.read().count() == 400


def test_sub_table_lists_of_rows_with_maps(spark):
    from tidewell.operators import read_tables

    rows = spark.range(6).selectExpr("concat('d', id % 3) AS tbname", "map('k', id) AS m")
    listed = spark.createDataFrame([("d1",), ("d1",)], "tbname string")
    assert read_tables(rows, listed).count() == 4


def test_aggregates_of_windows(table, spark):
    table.append(meters.frame(spark))
    day = TimeRange.of_text("2024-12-19 15:30:00.000", "2024-12-19 19:30:00.000", "ts", timedelta(hours=1), zone="UTC")
    frames = {"meters": table.read()}
    request = ScanRequest(select="sum(voltage) AS s, count(*) AS n, max(tbname) AS m", table="meters", time=day)
    found = sorted(map(tuple, scan(spark, request, frames).select("slice", "s", "n", "m").collect()))
    assert found == [(0, None, 0, None)] + [(k, 1221, 6, "d1002") for k in (1, 2, 3)]
    assert scan(spark, ScanRequest(select="count(*) AS n", table="meters", time=TimeRange(5, 5, "ts")), frames).count() == 0
    plain = ScanRequest(select="voltage", table="meters", order_by=("`current` desc",), time=day)
    assert sorted(r["slice"] for r in scan(spark, plain, frames).collect()) == [1] * 6 + [2] * 6 + [3] * 6
    limited = ScanRequest(select="voltage", table="meters", order_by=("ts",), limit=7, time=day)
    rows = scan(spark, limited, frames)
    assert rows.columns == ["voltage", "slice"] and sorted(r["slice"] for r in rows.collect()) == [1] * 6 + [2]
    assert plan(scan(spark, plain, frames)).count("FileScan") == 1
    with pytest.raises(ValueError, match="no column"):
        scan(spark, ScanRequest(table="meters", time=TimeRange(0, 9, "missing")), frames)


def test_limits_by_a_time_of_another_name(table, lake, spark):
    table.append(meters.frame(spark))
    frame = table.read().withColumnRenamed("ts", "at")
    request = ScanRequest(table="meters", tables=("d1001", "d1002"), limit=2)
    rows = scan(spark, request, {"meters": frame}).collect()
    assert sorted((r["tbname"], r["voltage"]) for r in rows) == [("d1001", 201), ("d1001", 202), ("d1002", 204), ("d1002", 205)]
    spec = TableSpec.super("own", [column_field("at", "TIMESTAMP"), *meters.COLUMNS[1:]], time="at")
    own = lake.create_table("power", spec)
    own.append(frame)
    assert sorted(r["voltage"] for r in lake.scan("power", ScanRequest(table="own", tables=("d1001",), limit=2)).collect()) == [201, 202]


@pytest.mark.parametrize("alias", ["it's", 'a "b', "x -- y", "/* z", "power.meters"])
def test_names_in_backticks_may_hold_anything(table, lake, spark, alias):
    table.append(meters.frame(spark))
    rows = lake.sql("power", f"select `current` as `{alias}` from `power`.`meters` where location <> 'x' and tbname = 'd1001'")
    assert rows.columns == [alias] and rows.count() == 9


def test_slices_by_options(table, lake, spark):
    table.append(meters.frame(spark))
    options = {"td.jdbc.mode": "source", "td.jdbc.url": f"{lake.root}/power", "scan.query": "select * from meters"}

    def total(**more):
        return meters.total(open_table(spark, {**options, **{f"scan.{k.replace('_', '.')}": v for k, v in more.items()}}))

    times = {"time_column": "ts", "time_start": "2024-12-19 17:30:00", "time_end": "2024-12-19 19:00:00"}
    assert total(**times, time_interval="600000") == 1221
    assert total(**{**times, "time_zone": "Asia/Tokyo"}) is None
    assert total(tags="groupid = 1; groupid > 0") == 606 * 3 + 1221 * 3
    assert total(tables="d1002, d1002, none") == 2 * 615 * 3
    for wrong in ({"tags": "a", "tables": "b"}, {"time_column": "ts"}, {"partitions": "0"}):
        with pytest.raises(ValueError):
            total(**wrong)


def test_statements(lake, spark):
    source = lake.create_table("power", meters.spec(order_by=("phase",)))
    source.append(meters.frame(spark))
    for name in ("copy", "part"):
        lake.create_table("sinks", meters.spec(name, order_by=("phase",)))
    lake.create_topic("topic_meters", source, meters.NAMES)
    sql = Statements(spark)
    columns = "ts TIMESTAMP, `current` FLOAT, voltage INT, phase FLOAT, location VARCHAR(64), groupid INT, tbname STRING"
    sink = f"'td.jdbc.url' '{lake.root}', 'sink.db.name' 'sinks', 'sink.supertable.name'"
    sql.run(
        f"""CREATE TABLE IF NOT EXISTS st_source ({columns}) USING tidewell
            OPTIONS ('td.jdbc.mode' = 'source', 'td.jdbc.url' = '{lake.root}/power', 'scan.query' = 'select * from meters');"""
    )
    sql.run(f"CREATE TABLE st_copy ({columns}) USING tidewell OPTIONS ({sink} 'copy')")
    sql.run(f"CREATE TABLE st_part USING tidewell OPTIONS ({sink} 'part')")
    assert spark.sql("SELECT sum(voltage) FROM st_source").first()[0] == 1221 * 3
    assert "FileScan parquet" in plan(sql.run("SELECT * FROM st_source WHERE voltage > 203"))
    sql.run("INSERT INTO st_copy SELECT * FROM st_source WHERE groupid = 1")
    sql.run("INSERT INTO st_copy (tbname, ts, voltage) VALUES ('d9', TIMESTAMP '2025-01-01 00:00:00', 7)")
    copied = lake.table("sinks", "copy").read()
    assert meters.total(copied) == 606 * 3 + 7
    assert copied.where("tbname = 'd9'").first()["phase"] is None
    sql.run(
        f"""CREATE TABLE st_stream ({columns}) USING tidewell OPTIONS ('td.jdbc.mode' 'cdc', 'url' '{lake.root}',
            'topic' 'topic_meters', 'group.id' 'g', 'auto.offset.reset' 'earliest')"""
    )
    sql.run("INSERT INTO st_part SELECT * FROM st_stream WHERE voltage > 203").awaitTermination()
    assert meters.total(lake.table("sinks", "part").read()) == 615 * 3
    with pytest.raises(ValueError, match="declared already"):
        sql.run(f"CREATE TABLE st_copy ({columns}) USING tidewell OPTIONS ({sink} 'copy')")
    with pytest.raises(ValueError, match="OVERWRITE"):
        sql.run("INSERT OVERWRITE st_copy SELECT * FROM st_source")
    with pytest.raises(ValueError, match="unknown table options"):
        sql.run("CREATE TABLE st_bad USING tidewell OPTIONS ('colour' 'red')")
    with pytest.raises(ValueError, match="2 fields, but 7"):
        sql.run("INSERT INTO st_copy SELECT ts, voltage FROM st_source")
    with pytest.raises(ValueError, match="no column type"):
        sql.run(f"CREATE TABLE st_odd (d DECIMAL(9, 2)) USING tidewell OPTIONS ({sink} 'copy')")
