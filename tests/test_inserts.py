from datetime import datetime, timezone

import pytest

from tidewell import TableSpec, column_field
from tidewell.functions import row_tuple
from tidewell.sinks import insert_statements, write_statements

from . import meters


def packed(df, limit, spec=None):
    return [tuple(r) for r in insert_statements(df, spec or meters.spec(), "power", limit).collect()]


def test_literals_of_every_type(spark):
    spec = TableSpec.normal(
        "t",
        [
            column_field("ts", "TIMESTAMP"), column_field("a", "BOOL"), column_field("b", "TINYINT"),
            column_field("c", "BIGINT"), column_field("d", "FLOAT"), column_field("e", "DOUBLE"),
            column_field("f", "VARCHAR"), column_field("g", "NCHAR"), column_field("h", "JSON"),
            column_field("i", "VARBINARY"), column_field("j", "GEOMETRY"),
        ],
    )
    moment = datetime(2024, 1, 1, 0, 0, 0, 999_999, tzinfo=timezone.utc)
    row = (moment, True, 9, 10**12, 50.3, 1e-5, "it's", "Zürich", '{"k": 1}', b"\x98\xf4", None)
    df = spark.createDataFrame([row, (None,) * 11], spec.schema)
    texts = [r[0] for r in df.select(row_tuple(df.schema)).collect()]
    assert texts[0] == (
        "(1704067200999,true,9,1000000000000,50.3,1.0E-5,'it''s','Zürich','{\"k\": 1}','\\x98F4',NULL)"
    )
    assert texts[1] == "(" + ",".join(["NULL"] * 11) + ")"


@pytest.mark.parametrize("limit", [1, 150, 200, 400, 1_000, 1_000_000])
@pytest.mark.parametrize("arrow_rows", ["3", "10000"])
def test_statements_hold_all_tuples_below_the_limit(spark, limit, arrow_rows):
    df = meters.frame(spark).coalesce(1)
    tuples = [r[0] for r in df.select(row_tuple(df.schema)).collect()]
    prefix = "INSERT INTO `power`.`meters` (`ts`,`current`,`voltage`,`phase`,`location`,`groupid`,`tbname`) VALUES "
    expected, text, count = [], prefix, 0
    for one in tuples:
        if count and len(text) + len(one) >= limit:
            expected.append((text, count))
            text, count = prefix, 0
        text, count = text + one, count + 1
    expected.append((text, count))

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", arrow_rows)
    try:
        assert packed(df, limit) == expected
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_no_rows_make_no_statement(spark):
    assert packed(meters.frame(spark).where("false"), 1000) == []


def test_text_files(spark, tmp_path):
    statements = insert_statements(meters.frame(spark), meters.spec(), "power", 300)
    write_statements(statements, f"file://{tmp_path}/out")
    back = spark.read.option("lineSep", ";\n").text(f"file://{tmp_path}/out")
    assert sorted(r[0] for r in back.collect()) == sorted(r[0] for r in statements.collect())
