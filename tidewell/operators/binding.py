"""Rows bound to the columns of a target table: names, arity and types."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.names import trim_backticks
from ..model import TableSpec, type_name_of


def resolve_fields(spec: TableSpec, fields: Sequence[str] | None = None) -> list[T.StructField]:
    """The target columns a field list names, in the list's order. Names are case-sensitive.

    ``tbname`` is a column of every super table. Without a list, all columns of the target.
    """
    target = {f.name: f for f in spec.schema.fields}
    if fields is None:
        return list(spec.schema.fields)
    names = [trim_backticks(f) for f in fields]
    unknown = [n for n in names if n not in target]
    if unknown:
        raise ValueError(f"table {spec.name!r} has no column {', '.join(map(repr, unknown))}")
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"column {', '.join(map(repr, repeated))} is bound more than once")
    return [target[n] for n in names]


def check_arity(df: DataFrame, fields: Sequence[T.StructField]) -> None:
    if len(df.columns) != len(fields):
        raise ValueError(f"rows have {len(df.columns)} fields, but {len(fields)} columns are bound")


_TEXT = (T.StringType, T.VarcharType, T.CharType)
_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_MOMENT = (T.TimestampType, T.TimestampNTZType, T.DateType)


def _convert(index: int, column: Column, source: T.DataType, target: T.StructField) -> tuple[Column, Column | None]:
    """The value in the target's type (NULL if it has none there), and the condition that it
    was lost. A condition of None means that every value converts.

    Numbers convert if nothing but floating-point precision is lost, texts are parsed, local
    times are read in the session's zone. A type that never fits is an error right away.
    """
    to = target.dataType
    if source == to or (isinstance(source, _TEXT) and isinstance(to, T.StringType)):
        return column, None
    if isinstance(source, T.NullType):
        return F.lit(None).cast(to), None
    numbers = (T.NumericType, T.BooleanType)
    if isinstance(source, numbers) and isinstance(to, numbers):
        lost = _lost_number(column, source, to)
        value = column.cast(to)
        return (value, None) if lost is None else (F.when(~lost, value), lost)
    if isinstance(source, _MOMENT) and isinstance(to, _MOMENT):
        return column.cast(to), None
    if isinstance(source, _TEXT) and not isinstance(to, T.BinaryType):
        value = column.try_cast(to)
        lost = column.isNotNull() & value.isNull()
        if isinstance(to, T.FractionalType) and not isinstance(to, T.DecimalType):
            # a number too large for the type becomes infinite; only the text "Infinity" means that
            lost = lost | (_infinite(value) & ~F.lower(column).contains("inf"))
        return F.when(~lost, value), lost
    if isinstance(to, T.StringType) and not isinstance(source, (T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
        return column.cast(to), None
    raise ValueError(f"{_place(index, target)} does not take {source.simpleString()} values")


def _lost_number(column: Column, source: T.DataType, to: T.DataType) -> Column | None:
    """Whether a number has no equal in the target's type; never NULL.

    Told by comparison: a cast that overflows costs an exception per row, even a tried one.
    """
    if isinstance(source, T.DoubleType) and isinstance(to, T.FloatType):
        return _infinite(column.cast(to)) & ~_infinite(column)
    if isinstance(source, T.BooleanType) or isinstance(to, T.FractionalType):
        return None
    if isinstance(to, T.BooleanType):
        return ~F.coalesce(column.isin(0, 1), F.lit(True))
    if isinstance(source, T.IntegralType):
        if _BITS[type(source)] <= _BITS[type(to)]:
            return None
        most = 2 ** (_BITS[type(to)] - 1)
        fits = column.between(-most, most - 1)
    else:
        most = Decimal(2 ** (_BITS[type(to)] - 1))
        fits = (column >= F.lit(-most)) & (column < F.lit(most)) & (column % 1 == 0)
    return ~F.coalesce(fits, F.lit(True))


def _infinite(column: Column) -> Column:
    return F.coalesce(F.abs(column) == F.lit(float("inf")), F.lit(False))


def _place(index: int, target: T.StructField) -> str:
    return f"field {index} (type {type_name_of(target)}, column {target.name})"


def _converted(index: int, column: Column, source: T.DataType, target: T.StructField) -> Column:
    """As ``_convert``, but a lost value stops the job and names the field."""
    value, lost = _convert(index, column, source, target)
    if lost is None:
        return value
    reason = F.concat(F.lit(f"{_place(index, target)} does not take the value "), column.cast("string"))
    return F.when(lost, F.raise_error(reason).cast(target.dataType)).otherwise(value)


def checked(column: Column, source: T.DataType, target: T.StructField) -> Column:
    """One value in the target's type; a value that would be lost stops the job."""
    return _converted(0, column, source, target)


def bind_rows(
    df: DataFrame,
    spec: TableSpec,
    fields: Sequence[str] | None = None,
    by: str = "name",
    kept: Sequence[str] = (),
) -> DataFrame:
    """Rows in the column order and the types of the target, ready to be written.

    ``fields`` lists the bound columns, the whole target if it is None. ``by="name"`` takes
    each from the source column of that name; ``by="position"`` takes the source columns as
    they come, as ``INSERT INTO ... SELECT`` does, and needs as many as are bound. Columns of
    the target that are not bound are NULL. Names and arity are checked before any row moves.
    Columns ``kept`` of rows bound by name stay behind the target's.
    """
    bound = resolve_fields(spec, fields)
    if by == "position":
        check_arity(df, bound)
        named = df.toDF(*[f.name for f in bound])
    elif by == "name":
        missing = [f.name for f in bound if f.name not in df.columns]
        if missing:
            raise ValueError(f"the rows have no column {', '.join(map(repr, missing))}")
        named = df.select(*[F.col(f"`{name}`") for name in [*[f.name for f in bound], *kept]])
    else:
        raise ValueError("rows are bound by 'name' or by 'position'")
    absent = [k for k in spec.key if k not in named.columns]
    if absent:
        raise ValueError(f"table {spec.name!r} needs its key column {', '.join(map(repr, absent))}")

    source = {f.name: (i, f.dataType) for i, f in enumerate(named.schema.fields)}
    columns = []
    for target in spec.schema.fields:
        if target.name in source:
            index, data_type = source[target.name]
            value = _converted(index, F.col(f"`{target.name}`"), data_type, target)
        else:
            value = F.lit(None).cast(target.dataType)
        columns.append(value.alias(target.name, metadata=target.metadata or {}))
    return named.select(*columns, *kept)


def _computed_once(df: DataFrame, listed: Sequence[str]) -> DataFrame:
    """Passing columns through a generator keeps the optimizer from copying the expressions they come
    from into each condition on them."""
    if not listed:
        return df
    others = [F.col(f"`{c}`") for c in df.columns if c not in listed]
    once = F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in listed])))
    return df.select(*others, once).select(*[F.col(f"`{c}`") for c in df.columns])


def _failures(failed: dict[str, Column]) -> tuple[Column, Column]:
    """Whether any condition holds, and the names of those that do."""
    any_failed = F.lit(False)
    for condition in failed.values():
        any_failed = any_failed | condition
    names = F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in failed.items()]))
    return any_failed, names.cast("array<string>")


RAW = "_raw"


def check_rows(df: DataFrame, spec: TableSpec, out: str = "rejected") -> DataFrame:
    """Rows bound by name and ready to be written, good and bad ones in one frame.

    The target's columns come first; a row with a value that does not convert has NULL there, the
    row as it came in ``_raw``, and the names of the columns at fault in ``out``. Both are NULL in good
    rows. Columns of the target that the rows do not have are NULL.
    """
    absent = [k for k in spec.key if k not in df.columns]
    if absent:
        raise ValueError(f"table {spec.name!r} needs its key column {', '.join(map(repr, absent))}")
    place = {f.name: (i, f.dataType) for i, f in enumerate(df.schema.fields)}
    df = _computed_once(df, [f.name for f in spec.schema.fields if f.name in place])
    columns, failed = [], {}
    for target in spec.schema.fields:
        value: Column = F.lit(None).cast(target.dataType)
        if target.name in place:
            index, data_type = place[target.name]
            value, lost = _convert(index, F.col(f"`{target.name}`"), data_type, target)
            if lost is not None:
                failed[target.name] = lost
        columns.append((target, value))
    any_failed, names = _failures(failed)
    raw = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(
        *[F.when(~any_failed, v).alias(t.name, metadata=t.metadata or {}) for t, v in columns],
        F.when(any_failed, raw).alias(RAW),
        F.when(any_failed, names).alias(out),
    )


def split_rejects(
    df: DataFrame, fields: Sequence[T.StructField], out: str = "rejected"
) -> tuple[DataFrame, DataFrame]:
    """The rows whose listed columns all convert, converted; and the other rows as they came,
    with the names of the columns that did not convert in ``out``.

    Both are lazy and read the input on their own; persist it first if it is costly.
    """
    target = {f.name: f for f in fields}
    df = _computed_once(df, [c for c in df.columns if c in target])
    good, failed = [], {}
    for index, source in enumerate(df.schema.fields):
        column = F.col(f"`{source.name}`")
        if source.name in target:
            column, lost = _convert(index, column, source.dataType, target[source.name])
            if lost is not None:
                failed[source.name] = lost
        good.append(column.alias(source.name))
    any_failed, names = _failures(failed)
    rejects = df.where(any_failed).withColumn(out, names)
    return df.where(~any_failed).select(*good), rejects
