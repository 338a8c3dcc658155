"""Row numbers inside groups that may be too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import shared_folder

# How many rows of a piece are sampled on average to find where it begins: pieces are then within
# about half of the size asked for.
SAMPLES = 32
# Bounds that are looked up at a time: a row carries no longer list of them through a join, except
# for groups of more than FAN * FAN pieces.
FAN = 128
# Into how many parts a large group falls in a shuffled join.
SALTS = 16


def _is_descending(item: str) -> bool:
    return item.strip().lower().endswith(" desc")


def _bare(item: str) -> str:
    words = item.strip().split()
    return " ".join(words[:-1]) if words[-1].lower() in ("asc", "desc") else item.strip()


def sort_columns(order_by: Sequence[str]) -> list[Column]:
    """``["ts desc", "event_id"]`` as sort columns."""
    return [F.col(_bare(i)).desc() if _is_descending(i) else F.col(_bare(i)).asc() for i in order_by]


def _place(order_by: Sequence[str]) -> Column:
    """The leading order columns of one direction, as one value that sorts like them."""
    same = [_is_descending(i) == _is_descending(order_by[0]) for i in order_by]
    leading = order_by[: same.index(False)] if False in same else order_by
    return F.struct(*[F.col(_bare(i)).alias(f"o{n}") for n, i in enumerate(leading)])


def number_rows(
    df: DataFrame,
    group: Sequence[str],
    order_by: Sequence[str],
    out: str = "row_number",
    up_to: int | None = None,
    piece_rows: int = 1_000_000,
) -> DataFrame:
    """``row_number`` per group in the given order, without sorting a large group in one task.

    A sample, drawn first by a job over the key and order columns, shows which groups have more
    than about ``piece_rows`` rows and cuts these into consecutive pieces of about that many, however
    their rows are spread; any other group is one piece. The pieces of large groups are counted, the
    counts are summed up along the group, and each row is then numbered within its piece. A large
    group costs one task only its sample and its list of pieces. The order columns may have any
    type that sorts. Rows that agree in all leading order columns of one direction stay together;
    for a super table with its time among them these are copies of one row key.

    The sample's cuts are written below the shared folder, so that tasks that run again cut alike;
    the numbers don't depend on them. ``up_to`` keeps the numbers up to that one and drops whole
    pieces beyond it early.
    """
    # A group is matched by its columns as texts and by which of them are NULL, so that NULLs
    # match and the join and the window below share one partitioning.
    columns = [F.col(g).cast("string") for g in group]
    keys = {f"_group{i}": F.coalesce(c, F.lit("")) for i, c in enumerate(columns)}
    if any(df.schema[g].nullable for g in group):
        keys["_nulls"] = F.concat(*[F.when(c.isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])
    rows = df.withColumns(keys)

    bounds = _bounds(rows, list(keys), _place(order_by), piece_rows)
    if bounds.isEmpty():
        numbered = rows.withColumn(out, _number(list(keys), order_by))
    else:
        pieces = _cut(rows, list(keys), bounds, order_by)
        numbered = _number_pieces(pieces, [*keys, "_piece"], order_by, out, up_to)
    if up_to is not None:
        numbered = numbered.where(F.col(out) <= up_to)
    return numbered.select(*df.columns, out)


def _number(keys: Sequence[str], order_by: Sequence[str]) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*sort_columns(order_by))).cast("long")


def _bounds(rows: DataFrame, keys: Sequence[str], place: Column, piece_rows: int) -> DataFrame:
    """Where the second and later pieces of the large groups begin, counted upwards from 1."""
    share = min(1.0, SAMPLES / piece_rows)
    sample = rows.select(*keys, place.alias("_bound"))
    if share < 1:
        sample = sample.where(F.rand(17) < share)
    stride = max(1, round(piece_rows * share))
    along = F.row_number().over(Window.partitionBy(*keys).orderBy("_bound"))
    cuts = sample.withColumn("_n", along).where(F.col("_n") % stride == 0)
    folder = shared_folder(rows.sparkSession, "bounds")
    cuts.withColumn("_n", (F.col("_n") / stride).cast("int")).write.parquet(folder)
    return rows.sparkSession.read.schema(cuts.schema).parquet(folder)


def _passed(bounds: str, place: Column, steps: int) -> Column:
    """How many of the sorted bounds, fewer than ``2 ** steps``, a row has reached; 0 without bounds."""
    return F.aggregate(
        F.array(*[F.lit(1 << step) for step in reversed(range(steps))]),
        F.lit(0),
        lambda found, step: F.when(F.get(F.col(bounds), found + step - 1) <= place, found + step).otherwise(found),
    )


def _cut(rows: DataFrame, keys: list[str], bounds: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """The rows with the number of their piece; NULL for a group that is not cut.

    Every ``FAN``-th bound is looked up first, then those between two of these. Both lists are
    joined with a salt, so that a large group spreads over many tasks where the join shuffles.
    """
    place = _place(order_by)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    listed = F.sort_array(F.collect_list("_bound"))
    far = bounds.where(F.col("_n") % FAN == 0).groupBy(*keys).agg(listed.alias("_far"))
    near = (
        bounds.where(F.col("_n") % FAN != 0)
        .groupBy(*keys, F.floor(F.col("_n") / FAN).cast("int").alias("_part"))
        .agg(listed.alias("_near"))
    )
    salt = F.pmod(F.xxhash64(place), F.lit(SALTS)).cast("int")
    placed = (
        rows.withColumn("_salt", salt)
        .join(far.withColumn("_salt", salts), [*keys, "_salt"], "left")
        .withColumn("_part", _passed("_far", place, 30))
        .join(near.withColumn("_salt", salts), [*keys, "_part", "_salt"], "left")
    )
    piece = F.col("_part").cast("long") * FAN + _passed("_near", place, FAN.bit_length() - 1)
    is_cut = F.col("_near").isNotNull() | (F.col("_part") > 0)
    return placed.withColumn("_piece", F.when(is_cut, piece)).drop("_salt", "_far", "_near", "_part")


def _number_pieces(
    pieces: DataFrame, keys: list[str], order_by: Sequence[str], out: str, up_to: int | None
) -> DataFrame:
    along = F.col("_piece").desc() if _is_descending(order_by[0]) else F.col("_piece").asc()
    earlier = Window.partitionBy(*keys[:-1]).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        pieces.where(F.col("_piece").isNotNull())
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*keys, F.sum("_rows").over(earlier).alias("_earlier"))
        .where(F.col("_earlier") > 0)
    )
    before = F.coalesce(F.col("_earlier"), F.lit(0))
    placed = pieces.join(starts, keys, "left")
    if up_to is not None:
        placed = placed.where(before < up_to)
    return placed.withColumn(out, before + _number(keys, order_by))
