"""The small meters fixture: two sub-tables, 18 distinct rows, 24 with copies of two keys."""

from datetime import datetime, timezone

from tidewell import TableSpec, column_field

COLUMNS = [
    column_field("ts", "TIMESTAMP"),
    column_field("current", "FLOAT"),
    column_field("voltage", "INT"),
    column_field("phase", "FLOAT"),
    column_field("location", "BINARY(64)", tag=True),
    column_field("groupid", "INT", tag=True),
]
NAMES = ["ts", "current", "voltage", "phase", "location", "groupid", "tbname"]
# The sub-tables, their tags and voltages, and the number of rows and copies, which the sums
# that are asserted come from. Currents and phases are our own; one sub-table has one current above 90.
SUB_TABLES = {
    "d1001": ("California.SanFrancisco", 1, [(41.5, 201, 0.11), (77.0, 202, 0.22), (95.5, 203, 0.44)]),
    "d1002": ("Alabama.Montgomery", 2, [(44.25, 204, 0.15), (61.75, 205, 0.35), (70.5, 206, 0.55)]),
}


def spec(name="meters", **settings):
    return TableSpec.super(name, COLUMNS, **settings)


def moment(hour, second):
    return datetime(2024, 12, 19, hour, 12, second, 642000, tzinfo=timezone.utc)


def rows(copies=False):
    made = []
    for name, (location, group, readings) in SUB_TABLES.items():
        for hour in (17, 18, 19):
            for step, (current, voltage, phase) in enumerate(readings):
                made.append((moment(hour, 45 + step), current, voltage, phase, location, group, name))
        if copies:
            first = readings[0]
            for extra in (1.00001, 2.00002, 3.00003):
                made.append((moment(19, 45), first[0], first[1], first[2] + extra, location, group, name))
    return made


def frame(spark, copies=False):
    return spark.createDataFrame(rows(copies), spec().schema)


def total(df):
    return df.agg({"voltage": "sum"}).first()[0]
