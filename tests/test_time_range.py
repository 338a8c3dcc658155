from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewell import TimeRange
from tidewell.operators import slice_by_time

HOUR = 3_600_000


@pytest.mark.parametrize(
    "start, end, interval, expected",
    [
        (0, 3 * HOUR, HOUR, [(0, HOUR), (HOUR, 2 * HOUR), (2 * HOUR, 3 * HOUR)]),
        (0, 3 * HOUR + 5, HOUR, [(0, HOUR), (HOUR, 2 * HOUR), (2 * HOUR, 3 * HOUR), (3 * HOUR, 3 * HOUR + 5)]),
        (0, 10, 0, [(0, 10)]),
        (0, 10, -5, [(0, 10)]),
        (0, 10, 11, [(0, 10)]),
        (0, 10, 10, [(0, 10)]),
        (10, 10, 5, []),
        (10, 5, 5, []),
    ],
)
def test_windows(start, end, interval, expected):
    assert TimeRange(start, end, "ts", interval).windows() == expected


def test_without_a_column_there_is_no_window():
    assert TimeRange(0, 10, "", 5).windows() == []


def test_bounds_of_local_times_millis_and_texts():
    start, end = datetime(2023, 3, 5, 21, 30), datetime(2023, 3, 6, 1, 45)
    local = TimeRange.of_local(start, end, "at", timedelta(minutes=90), "America/Lima")
    text = TimeRange.of_text("05.03.2023 21:30", "06.03.2023 01:45", "at", timedelta(minutes=90), "%d.%m.%Y %H:%M", "America/Lima")
    first = 1678069800000  # 2023-03-06 02:30 UTC
    assert local == text == TimeRange.of_millis(first, first + 255 * 60_000, "at", timedelta(minutes=90))
    assert [e - s for s, e in local.windows()] == [90 * 60_000, 90 * 60_000, 75 * 60_000]
    here = TimeRange.of_local(start, end, "at", timedelta(hours=1))
    assert here.start_ms == round(start.timestamp() * 1000)


def test_an_offset_in_the_text_decides():
    read = TimeRange.of_text(
        "2023-03-05 21:30 -0130", "2023-03-05 23:30 -0130", "at", timedelta(0), "%Y-%m-%d %H:%M %z", "America/Lima"
    )
    assert read.start_ms == 1678057200000 and read.end_ms - read.start_ms == 2 * HOUR


def test_predicates_for_a_database():
    assert TimeRange(0, 25, "ts", 10).predicates() == [
        "ts >= 0 and ts < 10", "ts >= 10 and ts < 20", "ts >= 20 and ts < 25",
    ]


@pytest.mark.parametrize("kind", ["long", "timestamp", "timestamp_ntz"])
def test_rows_fall_into_half_open_windows(spark, kind):
    instants = [-1, 0, 9_999, 10_000, 19_999, 20_000, 24_999, 25_000, None]
    df = spark.createDataFrame([(i,) for i in instants], "at long")
    if kind != "long":
        df = df.select(F.timestamp_millis("at").cast(kind).alias("at"))
    sliced = slice_by_time(df, TimeRange(0, 25_000, "at", 10_000))
    assert [r["slice"] for r in sliced.orderBy("at").collect()] == [0, 0, 1, 1, 2, 2]


def test_microseconds_below_a_bound_stay_in_the_earlier_window(spark):
    df = spark.sql("select timestamp_micros(9999999L) at union all select timestamp_micros(10000000L)")
    sliced = slice_by_time(df, TimeRange(0, 20_000, "at", 10_000))
    assert [r["slice"] for r in sliced.orderBy("at").collect()] == [0, 1]


@pytest.mark.parametrize("empty", [TimeRange(5, 5, "at"), TimeRange(9, 5, "at"), TimeRange(0, 9, "")])
def test_an_empty_range_reads_nothing(spark, empty):
    df = spark.range(10).withColumnRenamed("id", "at")
    assert slice_by_time(df, empty).count() == 0


def test_a_limit_in_the_query_applies_before_the_slices(spark):
    df = spark.range(100).withColumnRenamed("id", "at").orderBy("at").limit(10)
    assert slice_by_time(df, TimeRange(5, 50, "at", 10)).count() == 5
