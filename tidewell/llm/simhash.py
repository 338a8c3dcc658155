"""SimHash near-dedup: fingerprints of word shingles, linked at a small Hamming distance.

Segment-popcount embedding: a fingerprint is mapped to the bit counts of its 32 segments of two bits.
The Manhattan distance of two such vectors is a lower bound of the Hamming distance. Fingerprints at a
distance of 4 or less therefore have a half (16 segments) whose vectors differ by at most 2, and then
some grid point lies within 1 of both. Every fingerprint is entered at the grid points within 1 of
its two half vectors; those that meet at a point are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ._common import partitions, rows_in_groups, stored, whole_text
from ._graph import components

WORDS = 4
DISTANCE = 4
#: Fixed value: the seed of Spark's own xxhash64.
SEED = 42
_FIELDS = np.uint64(0x5555555555555555)
#: Entries of a grid point from which on a pivot search replaces the comparison of all pairs.
DENSE = 64


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """SimHash of a text in UTF-8 as a signed 64-bit number.

    A-Z are lower-cased; a bit is set if it is set in over half of the XXH64 values of the shingles,
    repeats included. A text with fewer words has one shingle, a text without words none and 0.
    """
    parts = text.lower().split()  # of bytes: ASCII letters, ASCII white space
    if not parts:
        return 0
    if len(parts) <= words:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(parts), SEED)], np.uint64)
    else:
        joined = b" ".join(parts)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
        ends = np.cumsum(lengths)
        starts = (ends - lengths)[: len(parts) - words + 1].tolist()
        ends = (ends - 1)[words - 1 :].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends)], np.uint64)
    set_in = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        set_in += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * set_in > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(text.as_py(), words) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(values, pa.int64())], names=["doc_id", "fp"]
            )

    return run


def with_fingerprints(
    docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fp) of every document; null counts as empty."""
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).cast("binary").alias("text")
    )
    return texts.mapInArrow(_fingerprints(words), "doc_id long, fp long")


def segment_counts(fps: np.ndarray) -> np.ndarray:
    """Bit counts of the 32 two-bit segments, each in a field of two bits."""
    return (fps & _FIELDS) + ((fps >> np.uint64(1)) & _FIELDS)


def grid_points(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(point, fingerprint) for the grid points within 1 of both half vectors."""
    counts = segment_counts(fps)
    points, owners = [], []
    for half in (0, 1):
        vector = (counts >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        top = np.uint64(half << 32)
        points.append(vector | top)
        owners.append(fps)
        for field in range(16):
            shift = np.uint64(2 * field)
            value = (vector >> shift) & np.uint64(3)
            step = np.uint64(1) << shift
            for fits, moved in ((value < 2, vector + step), (value > 0, vector - step)):
                points.append(moved[fits] | top)
                owners.append(fps[fits])
    return np.concatenate(points), np.concatenate(owners)


def _enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column("fp").to_numpy().view(np.uint64)
        for at in range(0, len(fps), 2000):
            points, owners = grid_points(fps[at : at + 2000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(points.view(np.int64)), pa.array(owners.view(np.int64))], names=["point", "fp"]
            )


def _near(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= most


def links_at_point(fps: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect all near fingerprints of one point: a pivot takes what is near it out."""
    rest = fps
    waiting: list[np.ndarray] = []
    while len(rest) or waiting:
        if waiting:
            now = waiting.pop()
        else:
            now, rest = rest[:1], rest[1:]
        for pivot in now:
            if not len(rest):
                return
            near = _near(rest, pivot, most)
            if near.any():
                found, rest = rest[near], rest[~near]
                yield np.full(len(found), pivot, np.uint64), found
                waiting.append(found)


def _compare(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in rows_in_groups(batches, "point"):
            points = table.column("point").combine_chunks().to_numpy()
            fps = table.column("fp").combine_chunks().to_numpy().view(np.uint64)
            edges = np.flatnonzero(np.diff(points)) + 1
            begins = np.concatenate([[0], edges])
            sizes = np.diff(np.concatenate([begins, [len(points)]]))
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for k in np.flatnonzero(sizes > DENSE):
                found += links_at_point(fps[begins[k] : begins[k] + sizes[k]], most)
            left = np.repeat(sizes, sizes) - (np.arange(len(points)) - np.repeat(begins, sizes))
            first = np.flatnonzero((left > 1) & (np.repeat(sizes, sizes) <= DENSE))
            step = 1
            while len(first):
                near = _near(fps[first], fps[first + step], most)
                found.append((fps[first[near]], fps[first[near] + step]))
                step += 1
                first = first[left[first] > step]
            if found:
                a = np.concatenate([x for x, _ in found]).view(np.int64)
                b = np.concatenate([x for _, x in found]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def near_links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that connect all at ``distance`` or less.

    Not every pair is returned: at a crowded grid point a spanning set of the links is.
    """
    if not 0 <= distance <= 4:
        raise ValueError("the grid covers distances of 0 to 4")
    n = partitions(fps.sparkSession)
    return (
        fps.mapInArrow(_enter, "point long, fp long")
        .repartition(n, "point")
        .sortWithinPartitions("point")
        .mapInArrow(_compare(distance), "a long, b long")
        .distinct()
    )


def group_near(
    docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest id reachable).

    Documents link when their fingerprints differ in ``distance`` bits or fewer. Null and empty texts
    have the fingerprint zero and link like any other. Rows with a null id take part in the linking;
    component_id is null only if no linked row has an id. Repeated rows come out as often as they go
    in. Equal fingerprints are one node, so copies are never paired. Empty tables give no rows.
    """
    rows = stored(with_fingerprints(docs, words, id_col, text_col), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(near_links(nodes.select("fp"), distance))
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    placed = stored(placed, "placed")
    least = stored(placed.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    classes = stored(placed.join(least, "root").select("fp", "component_id"), "classes")
    return rows.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(
    docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents with one row of each component, all columns as they were.

    The row with the smallest id stays; of rows that repeat id and text, any one. Rows without an id
    stay as they are.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(whole_text(text_col)).alias("digest"),
    )
    keep = stored(group_near(docs, words, distance, id_col, text_col).select("component_id").distinct(), "keep")
    kept = rows.join(keep, rows["id"] == keep["component_id"], "left_semi").dropDuplicates(["id", "digest"])
    return kept.unionByName(rows.filter("id is null")).select("row.*")
