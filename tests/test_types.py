"""Every column type as metric and as tag, with a row of values and a row of NULLs."""

from datetime import datetime, timezone

import pytest

from tidewell import TableSpec, column_field, open_table

TYPES = {
    "int": "INT", "long": "BIGINT", "double": "DOUBLE", "bool": "BOOL", "binary": "BINARY(100)",
    "nchar": "NCHAR(100)", "varbinary": "VARBINARY(100)", "geometry": "GEOMETRY(100)", "tinyint": "TINYINT",
    "smallint": "SMALLINT",
}
POINT = bytes.fromhex("010100000000000000000059400000000000005940")
VALUES = (1, 1_000_000_000_000, 1.1, True, "binary_value", "nchar_value", bytes([0x98, 0xF4, 0x6E]), POINT, 9, 13)
MOMENT = datetime(2025, 1, 19, 23, 0, 3, tzinfo=timezone.utc)

SPEC = TableSpec.super(
    "stb1",
    [column_field("ts", "TIMESTAMP")]
    + [column_field(f"{n}_col", t) for n, t in TYPES.items()]
    + [column_field(f"{n}_tag", t, tag=True) for n, t in TYPES.items()],
)


@pytest.fixture
def rows(spark):
    values = (MOMENT, *VALUES, *VALUES, "ntb")
    nulls = (MOMENT, *[None] * 20, "w3")
    return spark.createDataFrame([values, nulls], SPEC.schema)


def check(df):
    first, second = df.orderBy("tbname").collect()
    assert len(SPEC.schema) == 22
    assert (first["tbname"], second["tbname"]) == ("ntb", "w3")
    assert first["ts"] == second["ts"] == MOMENT.replace(tzinfo=None)
    for kind in ("col", "tag"):
        assert tuple(first[f"{n}_{kind}"] for n in TYPES) == VALUES
        assert tuple(second[f"{n}_{kind}"] for n in TYPES) == (None,) * 10


def test_round_trip(lake, rows):
    table = lake.create_table("power", SPEC)
    table.append(rows)
    check(table.read())
    table.compact()
    check(table.read())
    assert [f.dataType for f in table.read().schema] == [f.dataType for f in SPEC.schema]
    assert len(table.spec.tags) == 10


def test_opened_by_options(lake, rows):
    lake.create_table("power", SPEC).append(rows)
    options = {"td.jdbc.mode": "source", "td.jdbc.url": f"{lake.root}/power", "scan.query": "select * from stb1"}
    check(open_table(lake.spark, options, SPEC.schema))


def test_a_description_survives_storage(lake):
    lake.create_table("power", SPEC)
    assert lake.table("power", "stb1").spec == SPEC


def test_no_table_there(lake):
    with pytest.raises(ValueError, match="there is no table"):
        lake.table("power", "nothing")
