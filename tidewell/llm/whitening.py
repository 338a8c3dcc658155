"""Embedding whitening: the scatter matrix is counted on bit planes, exactly.

Every entry becomes a whole number and is shifted by its dimension's least one. Each dimension is cut
into bit planes, and each plane of a block of rows is packed into 64-bit words. The bits two planes
share, weighed by the places of the two planes, add up to the exact cross products of two dimensions; a
plane of ones beside them yields the sums and the number of rows. The covariance is centred on these
whole numbers and divided only then, so ``eigh`` sees it to the last digit of a double.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ._common import finite_vectors

SCALE, SHIFT = 1024, 100_000
#: Scaled entries beyond this size count as this, so that every entry is a long.
LARGEST = 2.0**52
COMPONENTS = 8
#: Rows packed into words at a time: the planes of 64 dimensions then fit a core's cache.
BLOCK = 8192
#: Bits of the parts in which whole numbers of any size are summed up as longs.
LIMB = 31


def whole_entries(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id and ``x``, the entries as longs, of all rows with a vector of finite entries."""

    def whole(c: Column) -> Column:
        return F.floor(F.greatest(F.least(c * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))) + F.lit(SHIFT)

    rows = finite_vectors(vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("v")), "v")
    return rows.select("vec_id", F.transform("v", whole).alias("x"))


def bit_planes(x: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The planes of a block of rows as words, with each plane's dimension and place; in the order of
    the dimensions, and a plane of ones as the last dimension. ``x`` is not negative."""
    rows, dims = x.shape
    words, owners, places = [], [], []
    for place in range(int(bits.max(initial=0))):
        having = np.flatnonzero(bits > place)
        words.append(_words(((x[:, having] >> place) & 1).T))
        owners.append(having)
        places.append(np.full(len(having), place))
    words.append(_words(np.ones((1, rows), np.uint8)))
    owners.append(np.array([dims]))
    places.append(np.array([0]))
    owner, place = np.concatenate(owners), np.concatenate(places)
    order = np.lexsort((place, owner))
    return np.concatenate(words)[order], owner[order], place[order]


def _words(bits: np.ndarray) -> np.ndarray:
    packed = np.packbits(bits.astype(np.uint8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))).view(np.uint64)


def cross_products(x: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Exact sums of products of the columns of a block, with a column of ones as the last: its upper
    triangle, as objects."""
    planes, owner, place = bit_planes(x, bits)
    dims = x.shape[1] + 1
    # a weighed count is below 2 ** (2 * bits + 14), and a dimension adds up to four of the largest
    small = 2 * int(bits.max(initial=0)) + 16 <= 62
    weights = np.array([1 << int(p) for p in place], np.int64 if small else object)
    total = np.zeros((dims, dims), np.int64 if small else object)
    present = np.unique(owner)
    starts = np.searchsorted(owner, present)
    for plane in range(len(owner)):
        mine = int(np.searchsorted(present, owner[plane]))
        first = starts[mine]
        counts = np.bitwise_count(planes[first:] & planes[plane]).sum(axis=1, dtype=np.int64)
        weighed = np.add.reduceat(counts * weights[first:], starts[mine:] - first)
        total[owner[plane], present[mine:]] += weighed * weights[plane]
    return total.astype(object)


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _scatter(low: np.ndarray, bits: np.ndarray):
    dims = len(low)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims + 1), object)
        for batch in batches:
            x = _matrix(batch, dims) - low
            for at in range(0, len(x), BLOCK):
                total += cross_products(x[at : at + BLOCK], bits)
        places, limbs, amounts = [], [], []
        for i, j in zip(*np.triu_indices(dims + 1)):
            value, limb = int(total[i, j]), 0
            while value:
                places.append(int(i) * (dims + 1) + int(j))
                limbs.append(limb)
                amounts.append(value & ((1 << LIMB) - 1))
                value, limb = value >> LIMB, limb + 1
        yield pa.RecordBatch.from_pydict(
            {"place": pa.array(places, pa.int64()), "limb": pa.array(limbs, pa.int32()), "amount": pa.array(amounts, pa.int64())}
        )

    return run


@dataclass(frozen=True)
class Whitening:
    """What was learned: all of it is as large as the number of dimensions, squared at most."""

    n: int
    low: np.ndarray  # the least entry of each dimension
    high: np.ndarray
    sums: list[int]  # of the entries above the least ones
    values: np.ndarray  # eigenvalues of the kept components, falling; 0 where there is no spread
    vectors: np.ndarray  # their unit vectors as columns
    trace: float

    @property
    def dims(self) -> int:
        return len(self.low)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Learn from ``x`` of all rows; None without any. Vectors have the length that most have, of
    lengths that are equally frequent the greatest; others are not of this space."""
    ranges = (
        rows.select(F.size("x").alias("length"), F.posexplode("x").alias("place", "entry"))
        .groupBy("length", "place")
        .agg(F.min("entry").alias("low"), F.max("entry").alias("high"), F.count("*").alias("n"))
        .groupBy("length")
        .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("place", "low", "high"))).alias("ranges"))
    )
    best = ranges.orderBy(F.desc("n"), F.desc("length")).limit(1).collect()
    if not best:
        return None
    low = np.array([r.low for r in best[0].ranges], np.int64)
    high = np.array([r.high for r in best[0].ranges], np.int64)
    dims = len(low)
    bits = np.array([int(h - l).bit_length() for l, h in zip(low, high)])
    parts = rows.where(F.size("x") == dims).select("x").mapInArrow(_scatter(low, bits), "place long, limb int, amount long")
    total: dict[int, int] = {}
    for row in parts.groupBy("place", "limb").agg(F.sum("amount").alias("amount")).collect():
        total[row.place] = total.get(row.place, 0) + (int(row.amount) << (LIMB * row.limb))

    def product(i: int, j: int) -> int:
        return total.get(min(i, j) * (dims + 1) + max(i, j), 0)

    n, sums = product(dims, dims), [product(i, dims) for i in range(dims)]
    covariance = np.empty((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            covariance[i, j] = covariance[j, i] = (n * product(i, j) - sums[i] * sums[j]) / (n * n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    spread = values > values[0] * dims * np.finfo(float).eps
    return Whitening(n, low, high, sums, np.where(spread, values, 0.0), vectors, float(np.trace(covariance)))


def _apply(model: Whitening):
    n, low, dims = model.n, model.low, model.dims
    reach, most = int((model.high - low).max()), max(model.sums)
    sums = np.array(model.sums, object)
    square, unit = sum(s * s for s in model.sums), np.where(model.values > 0, model.values, 1.0)
    basis = model.vectors / np.sqrt(unit)
    empty = model.values == 0

    def fitting(x: np.ndarray, largest: int) -> np.ndarray:
        return x if largest < 1 << 62 else x.astype(object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, dims) - low
            wide = fitting(x, n * (reach + 1) + most)
            centred = (wide * n - sums.astype(wide.dtype)).astype(np.float64) / n
            white = centred @ basis
            # the sum of (n * x - S) ** 2, from two sums that stay small
            squares = fitting(x, dims * reach * reach)
            crossed = fitting(x, dims * reach * most)
            a = (squares * squares).sum(axis=1).tolist()
            b = (crossed * sums.astype(crossed.dtype)).sum(axis=1).tolist()
            deviation = [n * n * int(p) - 2 * n * int(q) + square for p, q in zip(a, b)]
            flat = pa.array(white.ravel(), mask=np.tile(empty, len(white)))
            offsets = np.arange(len(white) + 1, dtype=np.int32) * len(basis.T)
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch.column("vec_id"),
                    "deviation": pa.array(
                        [Decimal(v) if v < 10**38 else None for v in deviation], pa.decimal128(38, 0)
                    ),
                    "whitened": pa.ListArray.from_arrays(pa.array(offsets), flat),
                }
            )

    return run


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation and the whitened vector of all rows of the model's length."""
    kind = rows.schema["vec_id"].dataType.simpleString()
    chosen = rows.where(F.size("x") == model.dims)
    return chosen.mapInArrow(_apply(model), f"vec_id {kind}, deviation decimal(38,0), whitened array<double>")


def identity_error(whitened: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity, measured over
    all of them; components without spread don't count."""
    kept = [k for k, value in enumerate(model.values) if value > 0]
    pairs = [(i, j) for i in kept for j in kept if i <= j]
    if not pairs:
        return 0.0
    entry = [F.col("whitened")[k] for k in range(len(model.values))]
    measured = whitened.agg(*[F.covar_pop(entry[i], entry[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(measured[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds null or non-finite entries are left out, and so are vectors of
    another length than most have. Entries are ``floor(1024 * c) + 100000``; those beyond 2**52 before
    the shift count as 2**52. ``deviation`` is exact, a decimal(38,0), null beyond that. Repeated rows
    count and come out as often as they go in, and so do rows without an id. A component along which
    nothing varies has ``whitened`` null and ``explained`` 0. Other columns are not read; an empty table
    gives no rows. The table is read four times and nothing is shuffled but sums of a task.
    """
    rows = whole_entries(vectors, id_col, vec_col)
    model = fit(rows, components)
    spark = vectors.sparkSession
    if model is None:
        return _empty(spark, rows)
    white = transform(rows, model)
    error = identity_error(white, model)
    share = F.array(*[F.lit(float(v / model.trace) if model.trace else 0.0) for v in model.values])
    return white.select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened")).select(
        "vec_id",
        (F.col("k") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(share, F.col("k")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def _empty(spark: SparkSession, rows: DataFrame) -> DataFrame:
    kind = rows.schema["vec_id"].dataType.simpleString()
    return spark.createDataFrame(
        [],
        f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, "
        "identity_error double",
    )
