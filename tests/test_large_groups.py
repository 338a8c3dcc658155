"""Results and task sizes when one sub-table holds a third of all rows."""

import pytest
from pyspark.sql import functions as F

from tidewell import TableSpec, column_field
from tidewell.operators import collapse_rows, number_rows, numbering, read_tables, slices, top_per_table

ROWS = 30_000


@pytest.fixture(scope="module")
def rows(spark):
    """One sub-table with a third of the rows, with bursts; 500 others; repeated and NULL times."""
    name = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("d"), F.pmod(F.xxhash64("id"), F.lit(500))))
    seconds = F.when(F.col("id") % 2 == 0, F.col("id") % 97).otherwise(F.col("id"))
    df = spark.range(0, ROWS, 1, 8).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 1000 == 7, F.lit(None)).otherwise(F.timestamp_seconds(seconds)).alias("ts"),
        F.when(F.col("id") % 501 == 0, F.lit(None)).otherwise(name).alias("tbname"),
        (F.col("id") % 100).cast("int").alias("voltage"),
    )
    return df.cache()


def expected_numbers(rows, descending):
    """event_id -> row number, with NULL times first upwards and last downwards."""
    groups = {}
    for r in rows.collect():
        groups.setdefault(r["tbname"], []).append(r)
    numbers = {}
    for members in groups.values():
        def key(r):
            return (r["ts"] is not None, r["ts"].timestamp() if r["ts"] else 0, r["event_id"])

        for n, r in enumerate(sorted(members, key=key, reverse=descending), 1):
            numbers[r["event_id"]] = n
    return numbers


@pytest.mark.parametrize("piece_rows", [100, 1_000_000])
@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("sent", [True, False])
def test_numbers_match_a_plain_sort(spark, rows, piece_rows, descending, sent):
    order = ["ts desc", "event_id desc"] if descending else ["ts", "event_id"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB" if sent else "-1")
    try:
        numbered = number_rows(rows, ["tbname"], order, "n", piece_rows=piece_rows).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r["event_id"]: r["n"] for r in numbered} == expected_numbers(rows, descending)
    assert len(numbered) == ROWS


def test_a_large_limit(spark, rows):
    numbers = expected_numbers(rows, False)
    kept = number_rows(rows, ["tbname"], ["ts", "event_id"], "n", up_to=1500, piece_rows=500)
    assert {r["event_id"]: r["n"] for r in kept.collect()} == {e: n for e, n in numbers.items() if n <= 1500}
    top = top_per_table(rows, 1500, ["ts", "event_id"])
    assert {r["event_id"] for r in top.collect()} == {e for e, n in numbers.items() if n <= 1500}
    few = top_per_table(rows, 3, ["ts", "event_id"])
    assert {r["event_id"] for r in few.collect()} == {e for e, n in numbers.items() if n <= 3}


def largest_part(df):
    counts = df.groupBy(F.spark_partition_id().alias("part")).count()
    return counts.agg(F.max("count")).first()[0]


def test_the_large_group_is_spread_when_numbered(spark, rows):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = number_rows(rows, ["tbname"], ["ts", "event_id"], "n", piece_rows=300)
        hot = numbered.where("tbname = 'hot' and ts > timestamp_seconds(97)")
        assert largest_part(hot) < hot.count() / 3
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_pieces_do_not_depend_on_how_the_rows_are_spread(spark):
    """One wrong clock, a burst, and more pieces than are looked up at a time."""
    at = F.when(F.col("id") == 0, F.lit(0)).when(F.col("id") < 15_000, F.lit(10**9)).otherwise(F.col("id") + 10**9)
    df = spark.range(0, 20_000, 1, 4).select(F.lit("a").alias("g"), at.alias("at"), "id")
    for piece_rows, most in ((1000, 2000), (20, 20)):
        bounds = numbering._bounds(df, ["g"], numbering._place(["at", "id"]), piece_rows)
        sizes = [r["count"] for r in numbering._cut(df, ["g"], bounds, ["at", "id"]).groupBy("_piece").count().collect()]
        assert sum(sizes) == 20_000 and max(sizes) <= most
    numbered = number_rows(df, ["g"], ["at", "id"], "n", piece_rows=20)
    assert numbered.where("n <> id + 1").isEmpty() and numbered.count() == 20_000


@pytest.mark.parametrize("order", [["s"], ["`s` desc", "id"], ["id desc"]])
def test_any_order_on_both_sides_of_the_limit(spark, order):
    df = spark.range(0, 3000, 1, 4).select(
        F.lit("a").alias("tbname"), F.concat(F.lit("s"), F.lpad((F.col("id") * 7 % 3000).cast("string"), 5, "0")).alias("s"), "id"
    )
    for limit in (1000, 1001):
        top = {r["id"] for r in top_per_table(df, limit, order).collect()}
        words = order[0].replace("`", "").split()
        expected = sorted(df.collect(), key=lambda r: r[words[0]], reverse="desc" in words)[:limit]
        assert top == {r["id"] for r in expected}
        pieces = number_rows(df, ["tbname"], order, "n", up_to=limit, piece_rows=200)
        assert {r["id"] for r in pieces.collect()} == top


@pytest.mark.parametrize("bound", [100_000, 0])
def test_a_list_that_is_data(spark, rows, monkeypatch, bound):
    monkeypatch.setattr(slices, "LISTED_NAMES", bound)
    listed = spark.createDataFrame([("hot",), ("d1",), ("hot",), ("none",), (None,)], "tbname string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB" if bound else "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        read = read_tables(rows, listed)
        counts = {r[0]: r[1] for r in read.groupBy("tbname").count().collect()}
        if not bound:
            assert largest_part(read) < read.count() / 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    plain = {r[0]: r[1] for r in rows.groupBy("tbname").count().collect()}
    assert counts == {"hot": 2 * plain["hot"], "d1": plain["d1"]}
    assert read.columns == rows.columns


@pytest.mark.parametrize("in_list, listed", [(1_000, 100_000), (0, 100_000), (0, 0)])
def test_lists_of_any_length_read_the_same(spark, rows, monkeypatch, in_list, listed):
    monkeypatch.setattr(slices, "IN_LIST_NAMES", in_list)
    monkeypatch.setattr(slices, "LISTED_NAMES", listed)
    names = ["hot", "d1", "d2", "d1"]
    plain = {r[0]: r[1] for r in rows.groupBy("tbname").count().collect()}
    counts = {r[0]: r[1] for r in read_tables(rows, names).groupBy("tbname").count().collect()}
    assert counts == {"hot": plain["hot"], "d1": 2 * plain["d1"], "d2": plain["d2"]}


def test_copies_of_one_key_shuffle_as_one_row_per_task(spark, rows):
    copies = rows.withColumn("ts", F.when(F.col("tbname") == "hot", F.timestamp_seconds(F.lit(0))).otherwise(F.col("ts")))
    latest = collapse_rows(copies, ["tbname", "ts"], ["event_id"], distinct_order=True)
    again = collapse_rows(copies, ["tbname", "ts"], ["event_id"])
    assert sorted(latest.collect(), key=repr) == sorted(again.collect(), key=repr)
    hot = latest.where("tbname = 'hot'").collect()
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert len(hot) == 1 and hot[0]["event_id"] == rows.where("tbname = 'hot'").agg(F.max("event_id")).first()[0]
    assert "partial_max_by" in plan and "SortAggregate" not in plan


def test_a_tie_in_the_order_is_broken_the_same_way(spark):
    tied = [("a", 1, 5, "x"), ("a", 1, 5, "y"), ("a", 1, 4, "z"), ("a", None, None, "q"), ("a", None, None, None)]
    for turned in (tied, tied[::-1]):
        df = spark.createDataFrame(turned, "tbname string, ts int, o int, v string")
        out = collapse_rows(df, ["tbname", "ts"], ["o"]).orderBy("ts").collect()
        assert out == [("a", None, None, "q"), ("a", 1, 5, "y")]


def test_rows_without_an_order_value_survive(spark):
    df = spark.createDataFrame([("a", 1, None, 7), ("b", 1, 3, 8), ("b", 1, None, 9)], "k string, t int, o long, v int")
    out = collapse_rows(df, ["k", "t"], ["o"], distinct_order=True).orderBy("k").collect()
    assert out == [("a", 1, None, 7), ("b", 1, 3, 8)]


def test_a_large_sub_table_in_a_stored_table(lake, rows):
    spec = TableSpec.super(
        "skewed",
        [column_field("event_id", "BIGINT"), column_field("ts", "TIMESTAMP"), column_field("voltage", "INT")],
        order_by=("event_id",),
        buckets=8,
    )
    table = lake.create_table("power", spec)
    table.append(rows)
    expected = sorted(collapse_rows(rows, ["tbname", "ts"], ["event_id"]).select(*spec.schema.names).collect(), key=repr)
    assert sorted(table.read().collect(), key=repr) == expected
    table.compact()
    assert sorted(table.read().collect(), key=repr) == expected
