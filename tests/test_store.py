from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewell import TableSpec, column_field
from tidewell.model import layout_for

from . import meters


@pytest.fixture
def table(lake):
    return lake.create_table("power", meters.spec(order_by=("phase",), buckets=4))


def test_an_empty_table(table):
    assert table.read().count() == 0
    assert table.read().columns == meters.NAMES
    table.compact()
    table.append(meters.frame(table.spark).where("false"), batch="nothing")
    assert table.read().count() == 0


def test_a_batch_written_again_is_replaced(table, spark):
    table.append(meters.frame(spark), batch="one")
    table.append(meters.frame(spark).where("voltage = 201"), batch="one")
    assert table.read().count() == 3
    assert table.batches() == ["one"]


def test_a_write_that_breaks_off_does_not_count(table, spark):
    table.append(meters.frame(spark).where("groupid = 1"), batch="one")
    bad = F.when(F.col("voltage") == 205, F.raise_error(F.lit("broken")).cast("int")).otherwise(F.col("voltage"))
    with pytest.raises(Exception, match="broken"):
        table.append(meters.frame(spark).withColumn("voltage", bad), batch="two")
    assert table.batches() == ["one"]
    assert table.read().count() == 9
    assert not table.committed("two")


@pytest.mark.parametrize("batch", ["a/b", "a b", "a*", "{x}"])
def test_batch_ids_are_plain(table, spark, batch):
    with pytest.raises(ValueError, match="batch id"):
        table.append(meters.frame(spark), batch=batch)


def test_compaction_keeps_the_rows(table, spark):
    table.append(meters.frame(spark, copies=True), batch="one")
    before = sorted(table.read().collect())
    table.compact()
    assert sorted(table.read().collect()) == before
    assert table.committed("one")
    table.vacuum()
    assert table.batches() == []
    assert table.committed("one")
    assert sorted(table.read().collect()) == before


def test_writes_after_compaction_replace_older_rows(table, spark):
    rows = meters.frame(spark)
    table.append(rows, batch="one")
    table.compact()
    higher = rows.withColumn("phase", F.col("phase") + 10).withColumn("voltage", F.col("voltage") + 1000)
    table.append(higher.where("tbname = 'd1001'"), batch="two")
    lower = rows.withColumn("phase", F.col("phase") - 10).withColumn("voltage", F.col("voltage") + 5000)
    table.append(lower.where("tbname = 'd1002'"), batch="three")
    for _ in range(2):
        totals = table.read().groupBy("tbname").agg(F.sum("voltage")).orderBy("tbname").collect()
        assert totals == [("d1001", 606 * 3 + 9000), ("d1002", 615 * 3)]
        table.compact()
        table.vacuum()


def test_only_touched_days_are_written_anew(table, spark):
    rows = meters.frame(spark)
    table.append(rows, batch="one")
    table.append(rows.withColumn("ts", F.col("ts") + F.expr("interval 1 day")), batch="two")
    table.compact()
    table.append(rows.where("voltage = 201").withColumn("phase", F.col("phase") + 1), batch="three")
    table.compact()
    generations = dict(table._generations())
    assert generations[0]["periods"] == ["2024-12-19", "2024-12-20"]
    assert generations[1] == {"batches": ["three"], "periods": ["2024-12-19"]}
    assert table.read().count() == 36
    assert table.read().where("phase > 1").count() == 3


def test_a_compaction_that_breaks_off_changes_nothing(table, spark):
    table.append(meters.frame(spark), batch="one")
    # data files without the closing description
    table._write(meters.frame(spark).withColumn("voltage", F.lit(0)), f"{table.path}/base/gen=0")
    assert meters.total(table.read()) == 1221 * 3
    table.compact()
    assert meters.total(table.read()) == 1221 * 3


def test_reads_restricted_by_time_and_table(table, spark):
    table.append(meters.frame(spark))
    start, end = datetime(2024, 12, 19, 18, 12, 45, 642000), datetime(2024, 12, 19, 19, 12, 45, 642000)
    assert table.read(start, end).count() == 6
    assert table.read(start).count() == 12
    assert table.read(end=end, tables=["d1002", "d1002", "none"]).count() == 6


def test_rows_without_a_time_or_name_are_kept(table, spark):
    rows = [(None, 1.0, 1, 1.0, "l", 1, "d1"), (meters.moment(1, 1), 1.0, 2, 1.0, "l", 1, None)]
    table.append(spark.createDataFrame(rows, table.spec.schema))
    assert meters.total(table.read()) == 3
    table.compact()
    assert meters.total(table.read()) == 3


def test_normal_tables_with_and_without_a_key(lake, spark):
    columns = meters.COLUMNS[:4]
    rows = meters.frame(spark, copies=True).select("ts", "current", "voltage", "phase")
    plain = lake.create_table("power", TableSpec.normal("plain", columns))
    plain.append(rows, writers=3)
    assert plain.read().count() == 24
    plain.compact()
    plain.append(rows.limit(1))
    assert plain.read().count() == 25
    keyed = lake.create_table("power", TableSpec.normal("keyed", columns, key=["ts"], order_by=("voltage",)))
    keyed.append(rows)
    keyed.compact()
    keyed.append(rows)
    assert keyed.read().count() == 9
    assert meters.total(keyed.read()) == 615 * 3
    keyed.compact()
    assert meters.total(keyed.read()) == 615 * 3


def test_the_day_of_a_row_does_not_depend_on_the_session(table, spark):
    table.append(meters.frame(spark))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        table.append(meters.frame(spark), batch="again")
        assert table._periods_of(table.batches()) == ["2024-12-19"]
        assert table.read(datetime(2024, 12, 19, 17), datetime(2024, 12, 19, 18)).count() == 6
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_writers(table, spark):
    table.append(meters.frame(spark), writers=2)
    assert table.read().count() == 18
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        table.append(meters.frame(spark), batch="plain", writers=2)
        assert table.read().count() == 18
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_the_layout_follows_the_size():
    assert layout_for(50 << 10) == {"period": "year", "buckets": 1}
    assert layout_for(10 << 20) == {"period": "month", "buckets": 1}
    assert layout_for(100 << 30) == {"period": "day", "buckets": 25}
    assert layout_for(100 << 40) == {"period": "day", "buckets": 512}


@pytest.mark.parametrize("period, folder", [("day", "2024-12-19"), ("month", "2024-12-01"), ("year", "2024-01-01")])
def test_periods(lake, spark, period, folder):
    table = lake.create_table("power", meters.spec(period, period=period, buckets=2))
    table.append(meters.frame(spark), batch="one")
    assert table._periods_of(["one"]) == [folder]
    assert table.read(datetime(2024, 12, 19, 18), datetime(2024, 12, 19, 19)).count() == 6
    table.compact()
    table.append(meters.frame(spark).withColumn("ts", F.col("ts") + F.expr("interval 2 years")), batch="two")
    assert table.read(datetime(2024, 12, 19, 18)).count() == 12 + 18
    assert table.read().count() == 36
    with pytest.raises(ValueError, match="period"):
        meters.spec(period="week")


def test_promises_make_the_collapse_hash(lake, spark):
    columns = [column_field("n", "BIGINT"), *meters.COLUMNS]
    rows = meters.frame(spark, copies=True).withColumn("n", F.monotonically_increasing_id())
    results = []
    for name, promised in (("plain", False), ("promised", True)):
        spec = TableSpec.super(name, columns, order_by=("n",), fixed_tags=promised, distinct_order=promised)
        table = lake.create_table("power", spec)
        assert lake.table("power", name).spec == spec
        table.append(rows)
        plan = table.read()._jdf.queryExecution().executedPlan().toString()
        assert ("SortAggregate" in plan) is not promised
        results.append(sorted(table.read().collect()))
    assert results[0] == results[1] and len(results[0]) == 18


def test_a_table_is_created_once(lake):
    lake.create_table("power", meters.spec("once"))
    with pytest.raises(ValueError, match="already"):
        lake.create_table("power", meters.spec("once"))


def test_tables_of_a_database(lake):
    lake.create_table("power", meters.spec("a"))
    lake.create_table("power", TableSpec.normal("b", [column_field("x", "INT")]))
    assert list(lake.tables("power")) == ["a", "b"]
