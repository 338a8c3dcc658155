from datetime import datetime

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import types as T

from tidewell import TableSpec, column_field
from tidewell.functions import trim_backticks
from tidewell.functions.decode import decode_rows
from tidewell.model import type_name_of
from tidewell.operators import bind_rows, split_rejects, unpack_rows
from tidewell.operators.binding import resolve_fields

from . import meters

ONE_INT = TableSpec.normal("t", [column_field("col1", "INT")])


@pytest.mark.parametrize(
    "written, bare", [(None, None), ("SSAA", "SSAA"), ("", ""), ("``", ""), ("```", "`"), ("`a b`", "a b"), ("a`", "a`")]
)
def test_backticks(written, bare):
    assert trim_backticks(written) == bare


@pytest.mark.parametrize("written", ["`", "`sss"])
def test_an_open_backtick_is_an_error(written):
    with pytest.raises(ValueError, match="backtick"):
        trim_backticks(written)


def test_field_lists():
    spec = TableSpec.super("m", [*meters.COLUMNS, column_field("Aateat", "INT")])
    names = [f.name for f in resolve_fields(spec, ["ts", "`Aateat`", "tbname"])]
    assert names == ["ts", "Aateat", "tbname"]
    with pytest.raises(ValueError, match="no column 'aateat'"):
        resolve_fields(spec, ["ts", "aateat"])
    with pytest.raises(ValueError, match="more than once"):
        resolve_fields(spec, ["ts", "`ts`"])


def test_a_normal_table_has_no_tbname():
    with pytest.raises(ValueError, match="tbname"):
        resolve_fields(ONE_INT, ["col1", "tbname"])


def test_arity_is_checked_before_any_row_moves(spark):
    df = spark.sql("select 10 a, raise_error('moved') b")
    with pytest.raises(ValueError, match="2 fields, but 1 columns"):
        bind_rows(df, ONE_INT, by="position")


def test_a_value_of_the_wrong_type_names_index_type_and_column(spark):
    df = spark.createDataFrame([("not_a_int",)], "col1 string")
    with pytest.raises(SparkRuntimeException) as error:
        bind_rows(df, ONE_INT).collect()
    for part in ("field 0", "INT", "col1", "not_a_int"):
        assert part in str(error.value)


def test_a_number_out_of_range_is_an_error(spark):
    spec = TableSpec.normal("t", [column_field("small", "TINYINT")])
    with pytest.raises(SparkRuntimeException, match="small"):
        bind_rows(spark.range(300, 301).withColumnRenamed("id", "small"), spec).collect()


@pytest.mark.parametrize(
    "value, type_name, ok",
    [
        ("1.0D", "INT", True), ("1.5D", "INT", False), ("cast(3e9 as double)", "INT", False), ("1", "BOOL", True),
        ("5", "BOOL", False), ("true", "INT", True), ("cast(50.3 as decimal(4,1))", "FLOAT", True),
        ("0.1D", "FLOAT", True), ("'7'", "SMALLINT", True), ("'7.5'", "SMALLINT", False), ("7", "VARCHAR", True),
        ("128", "TINYINT", False), ("127", "TINYINT", True), ("-128L", "TINYINT", True), ("-129L", "TINYINT", False),
        ("cast('NaN' as double)", "BIGINT", False), ("cast('Infinity' as double)", "BIGINT", False),
        ("9.223372036854775807E18D", "BIGINT", False), ("-9.223372036854775808E18D", "BIGINT", True),
        ("cast(7 as decimal(38,0))", "BIGINT", True), ("cast(7.5 as decimal(10,1))", "BIGINT", False),
        ("99999999999999999999", "BIGINT", False), ("cast(null as boolean)", "INT", True), ("cast(null as string)", "INT", True), ("cast(null as double)", "INT", True), ("null", "GEOMETRY", True),
        ("timestamp_ntz'2024-01-01'", "TIMESTAMP", True), ("'2024-01-01 00:00:00'", "TIMESTAMP", True),
        ("'soon'", "TIMESTAMP", False),
    ],
)
def test_values_convert_without_loss_or_not_at_all(spark, value, type_name, ok):
    spec = TableSpec.normal("t", [column_field("a", type_name)])
    df = spark.sql(f"select {value} a")
    if ok:
        assert bind_rows(df, spec).count() == 1 and bind_rows(df, spec).collect()
    else:
        with pytest.raises(SparkRuntimeException, match="field 0"):
            bind_rows(df, spec).collect()
    good, bad = split_rejects(df, spec.schema.fields)
    assert (len(good.collect()), len(bad.collect())) == ((1, 0) if ok else (0, 1))


@pytest.mark.parametrize(
    "value, type_name", [("1L", "TIMESTAMP"), ("timestamp'2024-01-01'", "BIGINT"), ("'a'", "GEOMETRY"), ("X'00'", "INT")]
)
def test_types_that_never_fit_fail_before_any_row_moves(spark, value, type_name):
    spec = TableSpec.normal("t", [column_field("a", type_name)])
    with pytest.raises(ValueError, match="field 0 .*column a.* does not take"):
        bind_rows(spark.sql(f"select {value} a"), spec)


def test_null_stays_null_and_unbound_columns_are_null(spark):
    df = spark.createDataFrame([("d1", None, None)], "tbname string, ts timestamp, voltage string")
    row = bind_rows(df, meters.spec(), ["tbname", "ts", "voltage"])
    assert row.columns == meters.NAMES
    assert row.first().asDict() == dict.fromkeys(meters.NAMES) | {"tbname": "d1"}


def test_the_key_must_be_bound(spark):
    df = spark.createDataFrame([("d1", 1)], "tbname string, voltage int")
    with pytest.raises(ValueError, match="key column 'ts'"):
        bind_rows(df, meters.spec(), ["tbname", "voltage"])


def test_columns_are_bound_by_name_in_any_order(spark):
    df = meters.frame(spark)
    turned = df.select(*reversed(df.columns))
    assert bind_rows(turned, meters.spec()).collect() == df.collect()


def test_missing_source_columns_are_an_error(spark):
    with pytest.raises(ValueError, match="no column 'phase'"):
        bind_rows(meters.frame(spark).drop("phase"), meters.spec())


def test_rejects_keep_their_raw_values(spark):
    df = spark.createDataFrame([(1, "5"), (2, "x"), (3, None), (4, "700")], "id int, v string")
    good, bad = split_rejects(df, [column_field("v", "TINYINT")])
    assert good.orderBy("id").collect() == [(1, 5), (3, None)]
    assert bad.orderBy("id").collect() == [(2, "x", ["v"]), (4, "700", ["v"])]


def test_unknown_types_fail_early(spark):
    with pytest.raises(ValueError, match="unknown column type"):
        column_field("a", "DECIMAL(10,2)")
    with pytest.raises(ValueError, match="which no column type"):
        type_name_of(T.StructField("a", T.ArrayType(T.IntegerType())))


def test_decode_texts_in_a_charset(spark):
    df = spark.sql("select encode('Zürich', 'ISO-8859-1') city, X'98F46E' raw, cast(null as binary) none")
    schema = T.StructType(
        [column_field("raw", "VARBINARY"), column_field("city", "NCHAR"), column_field("none", "VARCHAR")]
    )
    assert decode_rows(df, schema, "ISO-8859-1").first() == (bytearray.fromhex("98f46e"), "Zürich", None)


def test_decode_epoch_milliseconds(spark):
    schema = T.StructType([column_field("ts", "TIMESTAMP")])
    row = decode_rows(spark.sql("select 1734624768123L ts"), schema).first()
    assert row["ts"] == datetime(2024, 12, 19, 16, 12, 48, 123000)


@pytest.mark.parametrize("batch", ["cast(null as array<struct<a:int>>)", "cast(array() as array<struct<a:int>>)"])
def test_a_null_or_empty_batch_is_an_error(spark, batch):
    with pytest.raises(SparkRuntimeException, match="NULL or empty"):
        unpack_rows(spark.sql(f"select {batch} rows")).collect()

