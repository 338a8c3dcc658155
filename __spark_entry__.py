"""

The ``events`` table is read as a super table of meters: sub-table ``d<user_id>``, tags
``location`` and ``groupid``, metrics ``current``, ``voltage`` and ``phase``.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracles import ORACLES  # noqa: E402
from tidewell import (  # noqa: E402
    Lake,
    ScanRequest,
    Statements,
    TableSpec,
    TableStore,
    TimeRange,
    column_field,
    consumer_group,
    open_sink,
    open_table,
    scan,
    shared_folder,
)
from tidewell.functions import (  # noqa: E402
    decode_rows,
    json_field,
    local_to_utc,
    millis,
    row_tuple,
    to_millis_precision,
)
from tidewell.model import input_bytes, layout_for  # noqa: E402
from tidewell.operators import (  # noqa: E402
    bind_rows,
    collapse_rows,
    map_records,
    number_rows,
    pack_rows,
    read_tables,
    slice_by_tags,
    slice_by_time,
    split_rejects,
    top_per_table,
    unpack_rows,
)
from tidewell.sinks import copy_slices, insert_statements, write_statements  # noqa: E402
from tidewell.sources import run_sql  # noqa: E402
from tidewell.streaming import run_into_table  # noqa: E402

# The operators on training text may be left out as a whole, with their pipeline and what they import.
try:
    import corpus_pipeline  # noqa: E402
    from tidewell.llm import queries as llm_queries  # noqa: E402
except ImportError:
    corpus_pipeline = llm_queries = None

METERS = ["event_id", "ts", "current", "voltage", "phase", "location", "groupid", "tbname"]
TAGGED = ["ts", "current", "voltage", "phase", "location", "groupid", "tbname"]

# -- inputs -------------------------------------------------------------------------------


def _as_meters(events: DataFrame, *kept: str) -> DataFrame:
    groupid = F.col("user_id") % 10
    return events.select(
        *kept,
        "event_id",
        "ts",
        F.col("value").alias("current"),
        json_field(F.col("props"), "$.k", "int").alias("voltage"),
        ((F.col("event_id") % 100).cast("double") / 100).alias("phase"),
        F.concat(F.lit("loc_"), groupid.cast("string")).alias("location"),
        groupid.cast("int").alias("groupid"),
        F.concat(F.lit("d"), F.col("user_id").cast("string")).alias("tbname"),
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Stored tables and streams hold instants; the local times of the files are in UTC.
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_meters(_events(spark, sf_dir))


def _meters_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As a glob the path may be one file or a folder of files.
    schema = _events(spark, sf_dir).schema
    return _as_meters(spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]"))


def _local(df: DataFrame) -> DataFrame:
    """Instants of a stored table as the local times the files hold."""
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# -- stored tables ------------------------------------------------------------------------

DAYS = 30  # the events cover one month


def _layout(spark: SparkSession, sf_dir: str) -> dict:
    return layout_for(input_bytes(_events(spark, sf_dir)) / DAYS)


def _meters_spec(spark: SparkSession, sf_dir: str, name: str = "meters") -> TableSpec:
    return TableSpec.super(
        name,
        [
            column_field("event_id", "BIGINT"),
            column_field("ts", "TIMESTAMP"),
            column_field("current", "DOUBLE"),
            column_field("voltage", "INT"),
            column_field("phase", "DOUBLE"),
            column_field("location", "VARCHAR(64)", tag=True),
            column_field("groupid", "INT", tag=True),
        ],
        order_by=("event_id",),
        # by construction: the tags are functions of the user, event ids are unique
        fixed_tags=True,
        distinct_order=True,
        **_layout(spark, sf_dir),
    )


def _lake(spark: SparkSession, label: str) -> Lake:
    return Lake(spark, shared_folder(spark, label))


def _new_table(spark: SparkSession, sf_dir: str, label: str) -> TableStore:
    return _lake(spark, label).create_table("power", _meters_spec(spark, sf_dir))


def _filled_lake(spark: SparkSession, sf_dir: str, label: str) -> tuple[Lake, TableStore]:
    lake = _lake(spark, label)
    table = lake.create_table("power", _meters_spec(spark, sf_dir))
    table.append(_meters(spark, sf_dir), batch="first")
    return lake, table


# -- bounded scans ------------------------------------------------------------------------


def supertable_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _meters(spark, sf_dir).select(*TAGGED)


def scan_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    request = ScanRequest(sql=f"SELECT {', '.join(TAGGED)} FROM meters")
    return scan(spark, request, {"meters": _meters(spark, sf_dir)})


def scan_structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    request = ScanRequest(
        select="ts, `current`, tbname", table="meters", where="voltage > 50", order_by=("ts desc",)
    )
    return scan(spark, request, {"meters": _meters(spark, sf_dir)})


def filter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _meters(spark, sf_dir).where("current > 90").select(*TAGGED)


def sum_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _meters(spark, sf_dir).agg(
        F.sum("voltage").alias("sum_voltage"), F.count(F.lit(1)).alias("row_count")
    )


def sum_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _meters(spark, sf_dir).groupBy("tbname").agg(
        F.sum("voltage").alias("sum_voltage"), F.count(F.lit(1)).alias("row_count")
    )


def dec_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    exact = F.sum(F.col("current").cast("decimal(18,2)")).cast("double")
    return _meters(spark, sf_dir).groupBy("tbname").agg(exact.alias("sum_current"))


def order_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    request = ScanRequest(
        select="event_id, ts, `current`, tbname", table="meters", order_by=("ts desc", "event_id"), limit=100
    )
    return scan(spark, request, {"meters": _meters(spark, sf_dir)})


def _sliced(spark: SparkSession, sf_dir: str, interval: timedelta) -> DataFrame:
    bounds = TimeRange.of_local(datetime(2024, 1, 1), datetime(2024, 1, 29, 5), "ts", interval, "UTC")
    rows = slice_by_time(_meters(spark, sf_dir), bounds)
    return rows.groupBy("slice").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("voltage").alias("sum_voltage")
    )


def time_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sliced(spark, sf_dir, timedelta(hours=6))


def time_slice_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sliced(spark, sf_dir, timedelta(days=365))


def time_slices_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregate for each window, as a query of its own would yield it: also for windows without rows."""
    bounds = TimeRange.of_local(datetime(2023, 12, 31), datetime(2024, 1, 29, 5), "ts", timedelta(hours=8), "UTC")
    request = ScanRequest(
        select="sum(voltage) AS sum_voltage, count(*) AS row_count", table="meters", where="voltage > 50", time=bounds
    )
    return scan(spark, request, {"meters": _meters(spark, sf_dir)})


def time_slices_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows below a query that orders its rows and leaves the time out."""
    bounds = TimeRange.of_local(datetime(2024, 1, 10), datetime(2024, 1, 20), "ts", timedelta(days=3), "UTC")
    request = ScanRequest(select="event_id, voltage", table="meters", order_by=("current",), time=bounds)
    return scan(spark, request, {"meters": _meters(spark, sf_dir)})


def tag_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    request = ScanRequest(
        sql="SELECT event_id, groupid FROM meters",
        tags=("groupid < 6", "groupid > 3 and groupid < 8"),
    )
    return scan(spark, request, {"meters": _meters(spark, sf_dir)}).withColumnRenamed("slice", "tag_slice")


def table_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The list itself is data: every sub-table seen with a purchase, those of error events again.
    events = _events(spark, sf_dir)
    name = F.concat(F.lit("d"), F.col("user_id").cast("string")).alias("tbname")
    bought = events.where("event_type = 'purchase'").select(name).distinct()
    failed = events.where("event_type = 'error'").select(name).distinct()
    return read_tables(_as_meters(events), bought.union(failed)).select(*METERS)


def per_table_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_per_table(_meters(spark, sf_dir), 5, ["ts", "event_id"]).select(*METERS)


def per_table_limit_own_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of listed sub-tables by the table's own time, which is not called ts."""
    rows = _meters(spark, sf_dir).withColumnRenamed("ts", "at")
    request = ScanRequest(select="tbname, at", table="meters", tables=("d1", "d2", "d3", "d5", "d8", "d13"), limit=4)
    return scan(spark, request, {"meters": rows})


def per_table_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The path for large limits, with pieces small enough that sub-tables are split."""
    rows = _meters(spark, sf_dir).select("event_id", "ts", "tbname")
    piece_rows = 500
    numbered = number_rows(
        rows, ["tbname"], ["ts desc", "event_id desc"], "position", up_to=40, piece_rows=piece_rows
    )
    return numbered.select("event_id", "tbname", "position")


def bounds_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    utc = local_to_utc(F.col("ts"), "Asia/Shanghai").cast("timestamp_ntz")
    return _events(spark, sf_dir).select("event_id", utc.alias("utc_ts"))


def row_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _meters(spark, sf_dir).select("tbname", "ts", "event_id")
    numbered = number_rows(rows, ["tbname"], ["ts", "event_id"])
    batch = F.call_function("div", F.col("row_number") - 1, F.lit(20))
    return numbered.groupBy("tbname", batch.alias("batch")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("event_id").alias("first_id"),
        F.max("event_id").alias("last_id"),
    )


def unpack_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unpack_rows(pack_rows(_meters(spark, sf_dir), 2000))


# -- decoding -----------------------------------------------------------------------------


def ts_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return _events(spark, sf_dir).select(
        "event_id", millis(ts).alias("ms"), to_millis_precision(ts).cast("timestamp_ntz").alias("ts_ms")
    )


def types_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _meters(spark, sf_dir).select(
        "event_id",
        "current",
        "voltage",
        "groupid",
        (F.col("voltage") % 2).alias("odd"),
        F.col("event_id").cast("string").alias("id_text"),
    )
    declared = T.StructType(
        [
            column_field("event_id", "BIGINT"),
            column_field("current", "FLOAT"),
            column_field("voltage", "SMALLINT"),
            column_field("groupid", "TINYINT"),
            column_field("odd", "BOOL"),
            column_field("id_text", "INT"),
        ]
    )
    return decode_rows(raw, declared)


def utf8_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _meters(spark, sf_dir).select("event_id", F.encode("location", "UTF-8").alias("location"))
    text = decode_rows(raw, T.StructType([column_field("event_id", "BIGINT"), column_field("location", "NCHAR(64)")]))
    return text.select("event_id", "location", F.hex(F.encode("location", "UTF-8")).alias("location_hex"))


def record_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    shuffled = _meters(spark, sf_dir).select("tbname", "phase", "voltage", "groupid", "current", "location", "event_id")
    record = T.StructType(
        [
            column_field("event_id", "BIGINT"),
            column_field("current", "DOUBLE"),
            column_field("voltage", "INT"),
            column_field("phase", "DOUBLE"),
            column_field("location", "VARCHAR"),
            column_field("groupid", "INT"),
            column_field("tbname", "VARCHAR"),
        ]
    )
    return decode_rows(shuffled, record)


def record_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    def convert(batch):
        return batch.assign(label=batch["tbname"] + "@" + batch["location"], voltage=batch["voltage"] * 2)

    rows = _meters(spark, sf_dir).select("event_id", "tbname", "location", "voltage")
    return map_records(rows, convert, "event_id bigint, label string, voltage int")


def map_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _meters(spark, sf_dir).select(
        "event_id",
        F.concat_ws("|", F.col("tbname"), F.col("location"), F.col("voltage").cast("string")).alias("line"),
    )


def json_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = F.from_json("props", "k INT").alias("record")
    vin = F.col("record.k")
    return _events(spark, sf_dir).select("event_id", "ts", record).select(
        "event_id",
        "ts",
        (vin + 300).alias("voltage"),
        F.concat(F.lit("location_"), vin.cast("string")).alias("location"),
        vin.alias("groupid"),
        F.concat(F.lit("d0"), vin.cast("string")).alias("tbname"),
    )


def collapse_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _meters(spark, sf_dir).select(
        "tbname", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "event_id", "voltage"
    )
    return collapse_rows(rows, ["tbname", "hour"], ["event_id"], distinct_order=True)


def collapse_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _meters(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return collapse_rows(rows, ["tbname", "hour"], ["voltage"])


# -- sinks --------------------------------------------------------------------------------


def sink_supertable(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, table = _filled_lake(spark, sf_dir, "sink-supertable")
    return _local(table.read())


def sink_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, table = _filled_lake(spark, sf_dir, "sink-tags")
    return table.tags()


def sink_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping writes, compaction, and a later correction of part of the rows."""
    table = _new_table(spark, sf_dir, "sink-compacted")
    rows = _meters(spark, sf_dir)
    table.append(rows.where("ts < timestamp_ntz'2024-01-20'"), batch="early")
    table.append(rows.where("ts >= timestamp_ntz'2024-01-10'"), batch="late")
    table.compact()
    corrected = rows.where("ts >= timestamp_ntz'2024-01-25'")
    table.append(corrected.withColumn("event_id", F.col("event_id") + 1_000_000_000), batch="corrected")
    return _local(table.read())


def table_read_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, table = _filled_lake(spark, sf_dir, "table-read")
    return _local(table.read(datetime(2024, 1, 5, 6), datetime(2024, 1, 20, 18, 30)))


def lake_time_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time slices of a stored table; folders outside the range are left out."""
    lake, _ = _filled_lake(spark, sf_dir, "lake-slices")
    bounds = TimeRange.of_text(
        "2024-01-05 00:00:00.000", "2024-01-20 12:30:00.000", "ts", timedelta(days=1), zone="Asia/Shanghai"
    )
    rows = lake.scan("power", ScanRequest(select="ts, voltage", table="meters", time=bounds))
    return rows.groupBy("slice").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("voltage").alias("sum_voltage")
    )


def lake_tag_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag predicates on a stored table become buckets by the sub-tables it lists at each write."""
    lake = _lake(spark, "lake-tags")
    table = lake.create_table("power", replace(_meters_spec(spark, sf_dir), buckets=16))
    rows = _meters(spark, sf_dir)
    table.append(rows.where("event_id % 2 = 0"), batch="even")
    table.compact()
    table.append(rows.where("event_id % 2 = 1"), batch="odd")
    tags = ("tbname in ('d3', 'd14', 'd15')", "groupid = 4 and tbname like 'd1%'")
    request = ScanRequest(select="event_id, groupid, tbname", table="meters", tags=tags)
    return lake.scan("power", request).withColumnRenamed("slice", "tag_slice")


def sink_normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    spec = TableSpec.normal(
        "orders",
        [
            column_field("o_orderkey", "BIGINT"),
            column_field("o_custkey", "BIGINT"),
            column_field("o_orderstatus", "VARCHAR(8)"),
            column_field("o_totalprice", "DOUBLE"),
        ],
    )
    table = _lake(spark, "sink-normal").create_table("power", spec)
    table.append(orders, batch="first")
    return table.read()


def sink_normal_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A normal table is laid out by its time, so that a range of it opens the files of its days only."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    spec = TableSpec.normal(
        "orders",
        [column_field("o_orderkey", "BIGINT"), column_field("o_orderdate", "TIMESTAMP"), column_field("o_totalprice", "DOUBLE")],
        time="o_orderdate",
        period="year",
    )
    table = _lake(spark, "sink-normal-range").create_table("power", spec)
    table.append(orders, batch="first")
    rows = table.read(datetime(1996, 3, 1), datetime(1998, 6, 15))
    return rows.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


def sink_parallelism(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, "sink-parallelism")
    table = lake.create_table("power", _meters_spec(spark, sf_dir))
    options = {
        "td.jdbc.url": lake.root,
        "sink.db.name": "power",
        "sink.supertable.name": "meters",
        "sink.parallelism": "3",
    }
    open_sink(spark, options).insert(_meters(spark, sf_dir), by="name")
    return _local(table.read())


def sink_bind(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _meters_spec(spark, sf_dir)
    fields = ["tbname", "`groupid`", "location", "`phase`", "voltage", "current", "`ts`", "event_id"]
    return _local(bind_rows(_meters(spark, sf_dir), spec, fields))


def insert_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, "insert-select")
    table = lake.create_table("power", _meters_spec(spark, sf_dir))
    sink = open_sink(
        spark,
        {
            "td.jdbc.mode": "sink",
            "td.jdbc.url": lake.root,
            "sink.db.name": "power",
            "sink.supertable.name": "meters",
        },
        METERS,
    )
    sink.insert(run_sql(spark, f"SELECT {', '.join(METERS)} FROM source", {"source": _meters(spark, sf_dir)}))
    return _local(table.read())


def values_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows given as VALUES join a table that holds the meters."""
    _, table = _filled_lake(spark, sf_dir, "values-insert")
    values = spark.sql(
        """
        SELECT * FROM VALUES
          (CAST('2023-05-02 06:00:00' AS TIMESTAMP), 11.5, 118, 0.75, 'loc_6', 6, 'd9006'),
          (CAST('2023-05-02 06:20:00' AS TIMESTAMP), 12.25, 121, 0.5, 'loc_6', 6, 'd9006'),
          (CAST('2023-05-02 06:40:00' AS TIMESTAMP), 13.0, 117, 0.25, 'loc_6', 6, 'd9006'),
          (CAST('2023-05-03 21:15:30' AS TIMESTAMP), 7.75, 233, 1.5, 'loc_8', 8, 'd9018')
        """
    )
    table.append(values, batch="values", fields=TAGGED, by="position")
    return _local(table.read())


def _coerced(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    raw = _meters(spark, sf_dir).select(
        "event_id",
        (F.col("voltage") * 3).alias("reading"),
        F.when(F.col("voltage") % 7 == 0, F.lit("n/a")).otherwise(F.col("voltage").cast("string")).alias("code"),
    )
    return split_rejects(raw, [column_field("reading", "TINYINT"), column_field("code", "INT")])


def coerce_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coerced(spark, sf_dir)[0]


def coerce_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = _coerced(spark, sf_dir)[1]
    return rejects.select("event_id", "reading", "code", F.concat_ws(",", "rejected").alias("columns"))


def _checked_spec(spark: SparkSession, sf_dir: str) -> TableSpec:
    return TableSpec.super(
        "checked",
        [
            column_field("ts", "TIMESTAMP"),
            column_field("event_id", "BIGINT"),
            column_field("reading", "TINYINT"),
            column_field("code", "INT"),
        ],
        order_by=("event_id",),
        **_layout(spark, sf_dir),
    )


def _unchecked(rows: DataFrame) -> DataFrame:
    return rows.select(
        "ts",
        "tbname",
        "event_id",
        (F.col("voltage") * 3).alias("reading"),
        F.when(F.col("voltage") % 7 == 0, F.lit("n/a")).otherwise(F.col("voltage").cast("string")).alias("code"),
    )


def _good_and_bad(table: TableStore, folder: str, schema: T.StructType) -> DataFrame:
    """Rows of both outputs of a checked write."""
    good = table.read().select("event_id", F.col("reading").cast("int"), F.col("code").cast("string"), F.lit("").alias("columns"))
    bad = table.read_rejects(folder, schema)
    return good.union(bad.select("event_id", "reading", "code", F.concat_ws(",", "rejected")))


def coerce_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that convert go into a table, the others to a folder, in one job over the input."""
    table = _lake(spark, "coerce-write").create_table("power", _checked_spec(spark, sf_dir))
    rows = _unchecked(_meters(spark, sf_dir))
    folder = f"{table.path}-rejects"
    table.append_checked(rows, folder, batch="first")
    return _good_and_bad(table, folder, rows.schema)


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``coerce_write``, micro-batch by micro-batch."""
    table = _lake(spark, "stream-rejects").create_table("power", _checked_spec(spark, sf_dir))
    rows = _unchecked(_meters_stream(spark, sf_dir))
    folder = f"{table.path}-rejects"
    run_into_table(rows, table, f"{table.path}-checkpoint", rejects=folder)
    return _good_and_bad(table, folder, rows.schema)


TYPE_COLUMNS = {
    "int_col": "INT",
    "long_col": "BIGINT",
    "double_col": "DOUBLE",
    "bool_col": "BOOL",
    "binary_col": "BINARY(100)",
    "nchar_col": "NCHAR(100)",
    "varbinary_col": "VARBINARY(100)",
    "geometry_col": "GEOMETRY(100)",
    "tinyint_col": "TINYINT",
    "smallint_col": "SMALLINT",
}


def types_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every type written and read back; the rows of error events hold NULL only."""
    spec = TableSpec.super(
        "all_types",
        [column_field("ts", "TIMESTAMP"), *[column_field(n, t) for n, t in TYPE_COLUMNS.items()]],
        **_layout(spark, sf_dir),
    )
    values = {
        "int_col": F.col("voltage"),
        "long_col": F.col("event_id") + F.lit(1_000_000_000_000),
        "double_col": F.col("current"),
        "bool_col": F.col("voltage") % 2 == 0,
        "binary_col": F.col("location"),
        "nchar_col": F.concat(F.lit("n_"), F.col("location")),
        "varbinary_col": F.encode("location", "UTF-8"),
        "geometry_col": F.unhex(F.lpad(F.hex("event_id"), 12, "0")),
        "tinyint_col": F.col("groupid").cast("tinyint"),
        "smallint_col": F.col("voltage").cast("smallint"),
    }
    rows = _as_meters(_events(spark, sf_dir), "event_type")
    filled = F.col("event_type") != "error"
    rows = rows.select("ts", "tbname", *[F.when(filled, v).alias(n) for n, v in values.items()])
    table = _lake(spark, "types-roundtrip").create_table("power", spec)
    table.append(rows, batch="first")
    back = _local(table.read())
    return back.withColumns({n: F.hex(n) for n in ("varbinary_col", "geometry_col")})


def insert_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _meters(spark, sf_dir).select(
        "event_id", "ts", "voltage", F.concat(F.col("location"), F.lit("'s")).alias("location"), "tbname"
    )
    return rows.select("event_id", row_tuple(rows.schema).alias("tuple"))


def insert_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows as INSERT statements in text files, read back and measured."""
    rows = _meters(spark, sf_dir).select("ts", "voltage", "location", "groupid", "tbname")
    spec = _meters_spec(spark, sf_dir)
    statements = insert_statements(rows, spec, "power", limit=20_000)
    folder = shared_folder(spark, "insert-text")
    write_statements(statements, folder)
    lines = spark.read.option("lineSep", ";\n").text(folder)
    prefix = "INSERT INTO `power`.`meters` (`ts`,`voltage`,`location`,`groupid`,`tbname`) VALUES "
    tuples = F.expr(f"substring(value, {len(prefix) + 1})")
    return lines.agg(
        F.sum(F.regexp_count("value", F.lit(r"\(\d+,"))).alias("tuples"),
        F.sum(F.length(tuples)).alias("tuple_chars"),
        F.max((F.length("value") >= 20_000).cast("int")).alias("too_long"),
        F.min(F.col("value").startswith(prefix).cast("int")).alias("prefixed"),
    )


def copy_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy that breaks off in its third window and is run again."""
    table = _new_table(spark, sf_dir, "copy-resume")
    bounds = TimeRange.of_local(datetime(2024, 1, 3), datetime(2024, 1, 28, 5), "ts", timedelta(days=7), "UTC")
    source = _meters(spark, sf_dir)
    third = bounds.window(*bounds.windows()[2])
    inside = third.contains(source.schema["ts"].dataType)
    broken = source.withColumn(
        "voltage",
        F.when(inside & (F.col("event_id") % 2 == 1), F.raise_error(F.lit("injected failure")).cast("int"))
        .otherwise(F.col("voltage")),
    )
    try:
        copy_slices(broken, bounds, table, "copy")
    except Exception as error:  # the injected failure only
        if "injected failure" not in str(error):
            raise
    else:
        raise RuntimeError("the copy was to break off")
    copy_slices(source, bounds, table, "copy")
    return _local(table.read())


# -- streams ------------------------------------------------------------------------------


def stream_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic's rows as a native stream: no Python per row, no shuffle."""
    folder = shared_folder(spark, "stream-scan")
    stream = _meters_stream(spark, sf_dir).select(*METERS)
    (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/rows")
        .awaitTermination()
    )
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements are batches of rows; the sink unpacks them."""
    table = _new_table(spark, sf_dir, "stream-batches")
    packed = pack_rows(_meters_stream(spark, sf_dir), 2000)
    run_into_table(packed, table, f"{table.path}-checkpoint", packed="rows")
    return _local(table.read())


def stream_to_supertable(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _new_table(spark, sf_dir, "stream-table")
    run_into_table(_meters_stream(spark, sf_dir), table, f"{table.path}-checkpoint")
    return _local(table.read())


def stream_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = TableSpec.super(
        "hourly",
        [column_field("ts", "TIMESTAMP"), column_field("event_id", "BIGINT"), column_field("voltage", "INT")],
        order_by=("event_id",),
        distinct_order=True,
        **_layout(spark, sf_dir),
    )
    table = _lake(spark, "stream-collapse").create_table("power", spec)
    hourly = _meters_stream(spark, sf_dir).select(
        F.date_trunc("hour", "ts").alias("ts"), "event_id", "voltage", "tbname"
    )
    run_into_table(hourly, table, f"{table.path}-checkpoint")
    return _local(table.read()).withColumnRenamed("ts", "hour")


def stream_from_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group that starts at the latest position sees only what is written afterwards."""
    lake = _lake(spark, "stream-position")
    source = lake.create_table("power", _meters_spec(spark, sf_dir))
    rows = _meters(spark, sf_dir)
    source.append(rows.where("ts < timestamp_ntz'2024-01-12'"), batch="history")
    topic = lake.create_topic("topic_meters", source)
    group = topic.group("group_1")
    topic.read(group, "latest")
    source.append(rows.where("ts >= timestamp_ntz'2024-01-12'"), batch="news")
    target = lake.create_table("copy", _meters_spec(spark, sf_dir))
    run_into_table(topic.read(group, "latest"), target, group.checkpoint)
    return _local(target.read())


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that crashes after a write and is started again from its checkpoint."""
    lake, source = _filled_lake(spark, sf_dir, "stream-resume")
    topic = lake.create_topic("topic_meters", source)
    group = topic.group("group_1")
    target = lake.create_table("copy", _meters_spec(spark, sf_dir))

    def crash(number: int) -> None:
        raise RuntimeError("injected failure")

    try:
        run_into_table(topic.read(group, "earliest"), target, group.checkpoint, after_write=crash)
    except Exception as error:  # the injected failure only
        if "injected failure" not in str(error):
            raise
    else:
        raise RuntimeError("the stream was to crash")
    run_into_table(topic.read(group, "earliest"), target, group.checkpoint)
    return _local(target.read())


def vgroup_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writes, and the second one again, read through a topic: a sub-table stays in one vgroup, and
    the positions of a vgroup count all rows written to it without a gap, later writes behind earlier ones."""
    spec = replace(_meters_spec(spark, sf_dir), buckets=5, numbered=True)
    lake = _lake(spark, "vgroups")
    source = lake.create_table("power", spec)
    rows = _meters(spark, sf_dir)
    source.append(rows.where("ts < timestamp_ntz'2024-01-12'"), batch="history")
    for _ in range(2):
        source.append(rows.where("ts >= timestamp_ntz'2024-01-12'"), batch="news")
    topic = lake.create_topic("topic_meters", source)
    group = topic.group("group_1")
    stream = topic.read(group, "earliest", with_positions=True)
    folder = f"{group.folder}/rows"
    (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", group.checkpoint)
        .trigger(availableNow=True)
        .start(folder)
        .awaitTermination()
    )
    read = spark.read.schema(stream.schema).parquet(folder)
    history = F.col("ts") < F.lit(datetime(2024, 1, 12, tzinfo=timezone.utc))
    ends = read.groupBy("vgroup").agg(
        F.coalesce(F.max(F.when(history, F.col("position"))), F.lit(-1)).alias("history_end"),
        (
            (F.min("position") == 0)
            & (F.max("position") == F.count(F.lit(1)) - 1)
            & (F.count_distinct("position") == F.count(F.lit(1)))
        ).alias("dense"),
    )
    return (
        read.join(ends, "vgroup")
        .groupBy("tbname")
        .agg(
            F.count_distinct("vgroup").alias("vgroups"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(F.col("position") > F.col("history_end")).alias("news"),
            F.bool_and("dense").alias("dense"),
        )
    )


def stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream table with a declared schema: bytes in its charset become text, numbers the declared types."""
    lake = _lake(spark, "stream-decode")
    spec = TableSpec.super(
        "raw",
        [
            column_field("ts", "TIMESTAMP"),
            column_field("event_id", "BIGINT"),
            column_field("voltage", "INT"),
            column_field("place", "VARBINARY(64)"),
        ],
        **_layout(spark, sf_dir),
    )
    source = lake.create_table("power", spec)
    place = F.encode(F.concat("location", F.lit(" é日")), "UTF-16BE")
    source.append(_meters(spark, sf_dir).withColumn("place", place), batch="first")
    lake.create_topic("topic_raw", source)
    declared = [column_field("ts", "TIMESTAMP"), column_field("event_id", "VARCHAR"), column_field("voltage", "SMALLINT")]
    declared += [column_field("place", "NCHAR(64)"), column_field("tbname", "VARCHAR")]
    options = {
        "td.jdbc.mode": "cdc",
        "url": lake.root,
        "topic": "topic_raw",
        "group.id": "group_1",
        "auto.offset.reset": "earliest",
        "value.deserializer.encoding": "UTF-16BE",
    }
    stream = open_table(spark, options, T.StructType(declared))
    group = consumer_group(spark, options)
    folder = f"{group.folder}/rows"
    writer = stream.writeStream.format("parquet").option("checkpointLocation", group.checkpoint)
    writer.trigger(availableNow=True).start(folder).awaitTermination()
    return _local(spark.read.schema(stream.schema).parquet(folder))


# -- tables by options --------------------------------------------------------------------


def _declared() -> T.StructType:
    return T.StructType(
        [
            column_field("ts", "TIMESTAMP"),
            column_field("current", "DOUBLE"),
            column_field("voltage", "INT"),
            column_field("phase", "DOUBLE"),
            column_field("location", "VARCHAR"),
            column_field("groupid", "INT"),
            column_field("tbname", "VARCHAR"),
        ]
    )


def open_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, _ = _filled_lake(spark, sf_dir, "open-table")
    options = {
        "td.jdbc.url": f"{lake.root}/power",
        "td.jdbc.mode": "source",
        "table.name": "meters",
        "scan.query": "SELECT ts, `current`, voltage, phase, location, groupid, tbname FROM `meters`",
    }
    open_table(spark, options, _declared(), view="meters_table")
    return _local(spark.sql("SELECT * FROM meters_table WHERE `current` > 90"))


def open_table_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, source = _filled_lake(spark, sf_dir, "open-stream")
    lake.create_topic("topic_meters", source, METERS)
    lake.create_table("power_sink", _meters_spec(spark, sf_dir, "sink_meters"))
    options = {
        "td.jdbc.mode": "cdc",
        "url": lake.root,
        "topic": "topic_meters",
        "group.id": "group_1",
        "auto.offset.reset": "earliest",
    }
    sink = open_sink(
        spark,
        {"td.jdbc.url": lake.root, "sink.db.name": "power_sink", "sink.supertable.name": "sink_meters"},
    )
    stream = open_table(spark, options)
    sink.insert_stream(stream, options).awaitTermination()
    return _local(sink.store.read())


def open_table_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table opened by options that slice it by tag predicates: rows of two of them come twice."""
    lake, _ = _filled_lake(spark, sf_dir, "open-slices")
    options = {
        "td.jdbc.url": f"{lake.root}/power",
        "td.jdbc.mode": "source",
        "scan.query": "SELECT event_id, voltage, groupid FROM meters",
        "scan.tags": "groupid < 6; groupid > 3 and groupid < 8",
    }
    return open_table(spark, options)


def ddl_insert_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source, stream and sink declared and joined in SQL."""
    lake, source = _filled_lake(spark, sf_dir, "ddl")
    lake.create_topic("topic_meters", source, METERS)
    lake.create_table("sinks", _meters_spec(spark, sf_dir, "cold"))
    lake.create_table("sinks", _meters_spec(spark, sf_dir, "warm"))
    view = f"declared_{uuid.uuid4().hex[:8]}"
    statements = Statements(spark)
    columns = "event_id BIGINT, ts TIMESTAMP, `current` DOUBLE, voltage INT, phase DOUBLE, location STRING, groupid INT, tbname STRING"
    sink = f"'td.jdbc.url' '{lake.root}', 'sink.db.name' 'sinks', 'sink.supertable.name'"
    stream = f"'td.jdbc.mode' 'cdc', 'url' '{lake.root}', 'topic' 'topic_meters', 'group.id' 'g', 'auto.offset.reset' 'earliest'"
    for text in (
        f"CREATE TABLE {view}_source ({columns}) USING tidewell OPTIONS ('td.jdbc.mode' 'source', "
        f"'td.jdbc.url' '{lake.root}/power', 'scan.query' 'SELECT * FROM meters')",
        f"CREATE TABLE {view}_stream ({columns}) USING tidewell OPTIONS ({stream})",
        f"CREATE TABLE {view}_cold ({columns}) USING tidewell OPTIONS ({sink} 'cold')",
        f"CREATE TABLE {view}_warm ({columns}) USING tidewell OPTIONS ({sink} 'warm')",
    ):
        statements.run(text)
    statements.run(f"INSERT INTO {view}_cold SELECT * FROM {view}_source WHERE `current` <= 40")
    statements.run(f"INSERT INTO {view}_warm SELECT * FROM {view}_stream WHERE `current` > 40").awaitTermination()
    parts = [lake.table("sinks", name).read().withColumn("part", F.lit(name)) for name in ("cold", "warm")]
    return _local(parts[0].union(parts[1]))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator; each reads the given tables as a whole."""
    listed = [
        supertable_scan,
        scan_sql,
        scan_structured,
        filter_rows,
        sum_global,
        sum_by_table,
        dec_sum,
        order_limit,
        time_slices,
        time_slice_single,
        time_slices_sum,
        time_slices_ordered,
        tag_slices,
        table_slices,
        per_table_topn,
        per_table_limit_own_time,
        per_table_latest,
        bounds_zone,
        row_batches,
        unpack_batches,
        ts_millis,
        types_decode,
        utf8_roundtrip,
        record_by_name,
        record_custom,
        map_rows,
        json_ingest,
        collapse_key,
        collapse_row,
        sink_supertable,
        sink_tags,
        sink_compacted,
        table_read_pruned,
        lake_time_slices,
        lake_tag_slices,
        sink_normal,
        sink_normal_range,
        sink_parallelism,
        sink_bind,
        insert_select,
        values_insert,
        coerce_rows,
        coerce_rejects,
        coerce_write,
        types_roundtrip,
        insert_literals,
        insert_text,
        copy_resume,
        stream_scan,
        stream_batches,
        stream_to_supertable,
        stream_collapse,
        stream_from_position,
        stream_resume,
        stream_rejects,
        stream_decode,
        vgroup_positions,
        open_table_query,
        open_table_stream,
        open_table_slices,
        ddl_insert_select,
    ]
    named = {query.__name__: query for query in listed}
    named["open_table"] = named.pop("open_table_query")
    named["insert_statements"] = named.pop("insert_text")
    if llm_queries:
        named |= llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return named


def entry(spark: SparkSession) -> DataFrame:
    """Rows and voltage per time window of the meters."""
    return time_slices(spark, "/root/testdata/sf0.001")


def oracle_sql() -> dict[str, str]:
    """For each key of ``queries()`` the SQL that yields the same rows."""
    return dict(ORACLES) | (llm_queries.ORACLES if llm_queries else {})
