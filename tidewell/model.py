"""The data model: column types, and the description of a super table or a normal table."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The column types of the time-series model and the Spark type that holds each.
COLUMN_TYPES: dict[str, T.DataType] = {
    "BOOL": T.BooleanType(),
    "TINYINT": T.ByteType(),
    "SMALLINT": T.ShortType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "VARCHAR": T.StringType(),
    "BINARY": T.StringType(),
    "NCHAR": T.StringType(),
    "JSON": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
    "VARBINARY": T.BinaryType(),
    "GEOMETRY": T.BinaryType(),
}

TBNAME = "tbname"
PERIODS = ("day", "month", "year")
TYPE_KEY = "column_type"


def column_field(name: str, type_name: str, tag: bool = False) -> T.StructField:
    """A column of the model, e.g. ``column_field("location", "VARCHAR(64)", tag=True)``."""
    bare = type_name.split("(")[0].strip().upper()
    if bare not in COLUMN_TYPES:
        raise ValueError(f"unknown column type {type_name!r} for column {name!r}")
    return T.StructField(name, COLUMN_TYPES[bare], True, {TYPE_KEY: bare, "tag": tag})


def type_name_of(struct_field: T.StructField) -> str:
    """The model's name for a column's type; a type outside the model is an error."""
    declared = (struct_field.metadata or {}).get(TYPE_KEY)
    if declared:
        return declared
    if isinstance(struct_field.dataType, T.TimestampNTZType):
        return "TIMESTAMP"
    for name, data_type in COLUMN_TYPES.items():
        if data_type == struct_field.dataType:
            return name
    raise ValueError(
        f"column {struct_field.name!r} has type {struct_field.dataType.simpleString()}, "
        "which no column type of the model holds"
    )


@dataclass(frozen=True)
class TableSpec:
    """What a stored table looks like.

    ``columns`` are the declared columns without ``tbname``. A *super table* holds the rows of
    many sub-tables, names the sub-table of each row in ``tbname`` and is keyed by
    (``tbname``, ``ts``). A *normal table* has neither tags nor ``tbname`` and is keyed only if
    ``key`` says so. Among rows with an equal key the one with the largest ``order_by`` wins;
    the remaining columns decide a tie, so the winner never depends on the run. The rows of a
    ``numbered`` table have positions in their bucket, which topics can tell.
    """

    name: str
    columns: tuple[T.StructField, ...]
    super_table: bool = True
    time: str = "ts"
    order_by: tuple[str, ...] = ()
    normal_key: tuple[str, ...] = ()
    buckets: int = 1
    period: str = "day"
    fixed_tags: bool = False
    distinct_order: bool = False
    numbered: bool = False

    def __post_init__(self):
        if self.period not in PERIODS:
            raise ValueError(f"a period is one of {', '.join(PERIODS)}, not {self.period!r}")

    @staticmethod
    def super(name: str, columns: Sequence[T.StructField], **settings) -> "TableSpec":
        return TableSpec(name, tuple(columns), True, **settings)

    @staticmethod
    def normal(name: str, columns: Sequence[T.StructField], key: Sequence[str] = (), **settings) -> "TableSpec":
        return TableSpec(name, tuple(columns), False, normal_key=tuple(key), **settings)

    @property
    def schema(self) -> T.StructType:
        fields = list(self.columns)
        if self.super_table:
            fields.append(column_field(TBNAME, "VARCHAR(192)"))
        return T.StructType(fields)

    @property
    def tags(self) -> list[str]:
        return [c.name for c in self.columns if (c.metadata or {}).get("tag")]

    @property
    def key(self) -> list[str]:
        return [TBNAME, self.time] if self.super_table else list(self.normal_key)

    @property
    def layout(self) -> dict[str, Column]:
        """Directory columns of the stored table, each a function of the row key."""
        if not self.timed:
            return {}
        period = {"period": period_of(F.col(self.time), self.period)}
        return period | {"bucket": bucket_of(F.col(TBNAME), self.buckets)} if self.super_table else period

    @property
    def timed(self) -> bool:
        """Whether rows are laid out by their time: it must not differ between rows with an equal key."""
        timed = any(c.name == self.time and c.dataType == T.TimestampType() for c in self.columns)
        return timed and (not self.key or self.time in self.key)

    @property
    def file_options(self) -> dict[str, str]:
        """Where a file has too many sub-tables for a dictionary, a Bloom filter of their names lets a
        list of them skip row groups; its size follows their number."""
        if not self.super_table:
            return {}
        return {f"parquet.bloom.filter.enabled#{TBNAME}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}

    def to_json(self) -> dict:
        return {
            "name": self.name,
            "columns": json.loads(T.StructType(list(self.columns)).json()),
            "super_table": self.super_table,
            "time": self.time,
            "order_by": list(self.order_by),
            "normal_key": list(self.normal_key),
            "buckets": self.buckets,
            "period": self.period,
            "fixed_tags": self.fixed_tags,
            "distinct_order": self.distinct_order,
            "numbered": self.numbered,
        }

    @staticmethod
    def from_json(value: dict) -> "TableSpec":
        return TableSpec(
            value["name"],
            tuple(T.StructType.fromJson(value["columns"]).fields),
            value["super_table"],
            value["time"],
            tuple(value["order_by"]),
            tuple(value["normal_key"]),
            value["buckets"],
            value["period"],
            value["fixed_tags"],
            value["distinct_order"],
            value["numbered"],
        )


def period_of(instant: Column, period: str) -> Column:
    """The first day of the UTC day, month or year of an instant, whatever zone the session has."""
    day = F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86_400).cast("int"))
    return day if period == "day" else F.trunc(day, period)


def bucket_of(name: Column, buckets: int) -> Column:
    """The bucket of a sub-table: all rows of one sub-table share it."""
    return F.pmod(F.xxhash64(name), F.lit(buckets)).cast("int")


def layout_for(bytes_per_day: float, leaf_bytes: int = 4 << 30, most: int = 512) -> dict:
    """``period`` and ``buckets`` of a super table, from how much a day holds.

    Days of several TB get hundreds of buckets, so a read of one sub-table touches a small
    share of each day. Days of a few MB share a folder with their month or year, so that files
    do not get tiny.
    """
    buckets = max(1, min(most, round(bytes_per_day / leaf_bytes)))
    period = "year" if bytes_per_day < 1 << 20 else "month" if bytes_per_day < 32 << 20 else "day"
    return {"period": period, "buckets": buckets}


def input_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a frame's size, from file sizes; runs no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
