"""Connected components of a graph whose links are a table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ._common import stored


def forest(links: Iterator[tuple[int, int]]) -> dict[int, int]:
    """Each node of the links with the smallest node it reaches through them."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        top = node
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[node] != top:
            parent[node], node = top, parent[node]
        return top

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {node: root(node) for node in parent}


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a partition as stars around their smallest nodes."""
    links = ((a, b) for batch in batches for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist()))
    stars = [(a, b) for a, b in forest(links).items() if a != b]
    a, b = zip(*stars) if stars else ((), ())
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _with_least(links: DataFrame) -> DataFrame:
    """Links (u, v) with the least neighbour of u. The least ones are stored, so that a node with very
    many links is a skewed join that Spark splits."""
    least = stored(links.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
    return links.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest node it is connected to.

    Alternates between hanging larger neighbours and smaller neighbours of every node on its least
    one, after contracting what each partition holds; the rounds grow with the logarithm of the
    longest path. Each round is stored in the shared folder.
    """
    now = stored(links.mapInArrow(_contract, "a long, b long"), "links")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before == tuple(state):
            break
        before = tuple(state)
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            now.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large")
        small = _with_least(large).select(F.explode(F.array("u", "v")).alias("a"), F.col("m").alias("b"))
        now = stored(small.filter("a <> b").distinct(), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
