"""Hard-negative mining with cover trees.

Every candidate gets one more coordinate, which makes all of a block's vectors equally long; the largest
inner product with an anchor is then the smallest distance to it. A cover tree over a block of
candidates halves its covering radius from level to level, and the real radius of each node bounds the
inner products of everything below it from both sides. A search descends best bound first, skips
nodes that lie outside every window still open, and scores what is left exactly, in whole numbers.

Candidates are dealt to blocks of bounded size, anchors to packs of bounded size; each pair of a block
and a pack is a task's unit of work, and only the best few of a window leave it.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ._common import finite_vectors, stored

SCALE = 256
#: Scaled components beyond this size count as this, so that every score is a long.
LARGEST = 2**20
POSITIVES = NEGATIVES = 5
#: A negative scores from the first to the second per cent of its positive.
MARGIN = (80, 100)
BLOCK_ROWS = 2048
PACK_ROWS = 4096
#: A node of no more members is not cut further.
LEAF = 8
#: Hits of a block that are kept before the best are chosen.
HELD = 1 << 16
#: What rounding may add to a distance, as a share of the longest vectors.
SLACK = 1e-5
NEVER = 1 << 61

_TREE = (
    "block long, ids array<long>, labels array<long>, points array<int>, center array<int>, radius array<double>, "
    "first_leaf array<int>, last_leaf array<int>, first_child array<int>, last_child array<int>"
)
_HITS = "query long, part int, id long, score long"


@dataclass(frozen=True)
class CoverTree:
    """Nodes in the order of their levels. The leaves of a node, and its children, stand side by side."""

    ids: np.ndarray
    labels: np.ndarray
    points: np.ndarray  # whole numbers, in the order of the leaves
    center: np.ndarray  # of each node, a place in points
    radius: np.ndarray  # the largest distance from the center to anything below the node
    first_leaf: np.ndarray
    last_leaf: np.ndarray
    first_child: np.ndarray
    last_child: np.ndarray


def augmented_distances(points: np.ndarray) -> tuple[np.ndarray, float]:
    """Distances between all points of a block once they are made equally long, and that length squared."""
    norms = (points * points).sum(axis=1)
    longest = float(norms.max(initial=0.0))
    long = np.column_stack([points, np.sqrt(longest - norms)])
    return np.sqrt(np.maximum(0.0, 2 * longest - 2 * (long @ long.T))), longest


def cover_tree(ids: np.ndarray, labels: np.ndarray, points: np.ndarray) -> CoverTree:
    """The tree over a block. A node of radius r has children of radius 2**s at most, the largest power
    below r, whose centers are more than 2**s apart; the first has the node's own center."""
    distance, longest = augmented_distances(points.astype(np.float64))
    slack = SLACK * np.sqrt(longest)
    nodes: list[tuple] = []
    order: list[np.ndarray] = []
    placed = 0
    waiting = [(0, np.arange(len(points)))]
    for center, members in waiting:  # grows as it goes, level after level
        radius = float(distance[center, members].max())
        first_child = len(waiting)
        leaves = [members]
        if len(members) > LEAF and radius > slack:
            bound = 2.0 ** (np.ceil(np.log2(radius)) - 1)
            leaves, pivot, rest = [], center, members
            while len(rest):
                near = distance[pivot, rest] <= bound
                group, rest = rest[near], rest[~near]
                if len(group) > 1:
                    waiting.append((pivot, group))
                else:
                    leaves.append(group)
                pivot = rest[0] if len(rest) else pivot
        own = np.concatenate(leaves) if leaves else np.empty(0, np.int64)
        order.append(own)
        nodes.append((center, radius, placed, placed + len(own), first_child, len(waiting)))
        placed += len(own)
    leaf = np.concatenate(order)
    place = np.empty(len(leaf), np.int64)
    place[leaf] = np.arange(len(leaf))
    center, radius, first_leaf, last_leaf, first_child, last_child = map(np.array, zip(*nodes))
    return CoverTree(
        ids[leaf], labels[leaf], points[leaf], place[center], radius, first_leaf, last_leaf, first_child, last_child
    )


def search(
    tree: CoverTree,
    queries: np.ndarray,
    query_ids: np.ndarray,
    query_labels: np.ndarray,
    lows: np.ndarray,
    highs: np.ndarray,
    same: bool,
    most: int,
) -> tuple[np.ndarray, ...]:
    """For every window ``lows[i, p] <= score <= highs[i, p]`` of a query its ``most`` best candidates with
    the query's label (``same``) or another; higher scores first, then smaller ids. Returns the query's
    place, the window's place, the candidate's id and its score."""
    dims = tree.points.shape[1]
    reach = max(np.abs(tree.points).max(initial=0), np.abs(queries).max(initial=0))
    # products of doubles are exact below 2 ** 53; beyond, whole numbers are multiplied
    kind = np.float64 if dims * int(reach) ** 2 < 1 << 53 else np.int64
    points, anchors = tree.points.astype(kind), queries.astype(kind)
    norms = (anchors * anchors).sum(axis=1).astype(np.float64)
    longest = float((points * points).sum(axis=1).max(initial=0))
    slack = SLACK * (np.sqrt(longest) + np.sqrt(norms))
    need, highs = lows.astype(kind), highs.astype(kind)
    parts = lows.shape[1]
    best: list[np.ndarray] = []
    held = 0

    def keep_best() -> None:
        """Of the hits held, the best of each window; a full window asks for its last score from now on."""
        nonlocal best, held
        if not best:
            return
        slot, ids, scores = (np.concatenate(c) for c in zip(*best))
        order = np.lexsort((ids, -scores, slot))
        slot, ids, scores = slot[order], ids[order], scores[order]
        edges = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        rank = np.arange(len(slot)) - np.repeat(edges, np.diff(np.concatenate([edges, [len(slot)]])))
        last = rank == most - 1
        need.reshape(-1)[slot[last]] = scores[last]
        kept = rank < most
        best, held = [(slot[kept], ids[kept], scores[kept])], 0

    open_ended = np.full(len(anchors), np.inf)
    heap: list[tuple] = [(-np.inf, 0, open_ended, -open_ended)]
    while heap:
        _, node, upper, lower = heapq.heappop(heap)
        active = np.flatnonzero(((upper[:, None] >= need) & (lower[:, None] <= highs)).any(axis=1))
        if not len(active):
            continue
        leaves = slice(tree.first_leaf[node], tree.last_leaf[node])
        children = np.arange(tree.first_child[node], tree.last_child[node])
        if leaves.stop > leaves.start:
            scores = anchors[active] @ points[leaves].T
            fits = (scores >= need[active].min(axis=1)[:, None]) & (scores <= highs[active].max(axis=1)[:, None])
            fits &= (query_labels[active][:, None] == tree.labels[leaves]) == same
            row, column = np.nonzero(fits)
            other = query_ids[active][row] != tree.ids[leaves][column]
            row, column = row[other], column[other]
            found, query, ids = scores[row, column], active[row], tree.ids[leaves][column]
            for part in range(parts):
                inside = (found >= need[query, part]) & (found <= highs[query, part])
                if inside.any():
                    best.append((query[inside] * parts + part, ids[inside], found[inside]))
                    held += int(inside.sum())
            if held > HELD or len(best) > 64:
                keep_best()
        if len(children):
            scores = (anchors[active] @ points[tree.center[children]].T).astype(np.float64)
            square = (norms[active] + longest)[:, None]
            apart = np.sqrt(np.maximum(0.0, square - 2 * scores))
            reach = tree.radius[children][None, :] + slack[active][:, None]
            above = (square - np.maximum(0.0, apart - reach) ** 2) / 2
            below = (square - (apart + reach) ** 2) / 2
            for k, child in enumerate(children):
                upper, lower = np.full(len(anchors), -np.inf), np.full(len(anchors), np.inf)
                upper[active], lower[active] = above[:, k], below[:, k]
                heapq.heappush(heap, (-float(above[:, k].max()), int(child), upper, lower))
    keep_best()
    if not best:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    slot, ids, scores = best[0]
    return slot // parts, slot % parts, ids, scores.astype(np.int64)


def _lists(table: pa.Table, name: str, dims: int) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    return table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _build(key: tuple, table: pa.Table) -> pa.Table:
    points = _lists(table, "q", len(table.column("q")[0]))
    order = np.argsort(table.column("id").to_numpy())  # so that a block that is built again is the same
    tree = cover_tree(table.column("id").to_numpy()[order], table.column("label").to_numpy()[order], points[order])
    row = {"block": pa.array([key[0].as_py()], pa.int64())}
    for name, kind in (
        ("ids", pa.int64()), ("labels", pa.int64()), ("points", pa.int32()), ("center", pa.int32()),
        ("radius", pa.float64()), ("first_leaf", pa.int32()), ("last_leaf", pa.int32()),
        ("first_child", pa.int32()), ("last_child", pa.int32()),
    ):
        values = np.asarray(getattr(tree, name)).ravel()
        row[name] = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))
    return pa.table(row)


def _searched(same: bool, most: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        hits: list[tuple] = []
        if left.num_rows and right.num_rows:
            column = {n: left.column(n).combine_chunks().flatten().to_numpy(zero_copy_only=False) for n in left.column_names[2:]}
            column["points"] = column["points"].reshape(len(column["ids"]), -1)
            tree = CoverTree(**column)
            ids, labels = right.column("query").to_numpy(), right.column("label").to_numpy()
            queries = _lists(right, "q", tree.points.shape[1])
            parts = max(map(len, right.column("lows").to_pylist()))
            windows = [
                np.array([w + [missing] * (parts - len(w)) for w in right.column(name).to_pylist()], np.int64)
                for name, missing in (("lows", NEVER), ("highs", -NEVER))
            ]
            hits = [search(tree, queries, ids, labels, *windows, same, most)]
            hits = [(ids[q], part, found, score) for q, part, found, score in hits]
        query, part, found, score = hits[0] if hits else [np.empty(0, np.int64)] * 4
        return pa.table(
            {
                "query": pa.array(query, pa.int64()),
                "part": pa.array(part, pa.int32()),
                "id": pa.array(found, pa.int64()),
                "score": pa.array(score, pa.int64()),
            }
        )

    return run


@dataclass(frozen=True)
class Forest:
    """Cover trees over blocks of candidates, one row each, written below the shared folder."""

    trees: DataFrame
    blocks: int


def plant(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> Forest:
    """One cover tree per block of candidates (columns id, label, q). Ids are unique, so that the blocks
    a hash of them makes are of bounded size."""
    blocks = max(1, -(-rows.count() // block_rows))
    dealt = rows.select("id", "label", "q", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"))
    return Forest(stored(dealt.groupBy("block").applyInArrow(_build, _TREE), "cover_trees"), blocks)


def search_all(forest: Forest, queries: DataFrame, same: bool, most: int) -> DataFrame:
    """query, part, id, score, rank: for each window of every query its ``most`` best candidates.

    ``queries`` has query, label, q and the windows' bounds as arrays ``lows`` and ``highs``. Every pack of
    queries meets every block once, as a pair of its own, so no task holds more than one of each.
    """
    packs = max(1, -(-queries.count() // PACK_ROWS))

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    trees = forest.trees.select(each(packs).alias("pack"), *forest.trees.columns)
    asked = queries.withColumn("pack", F.pmod(F.xxhash64("query"), F.lit(packs))).select(
        "pack", each(forest.blocks).alias("block"), "query", "label", "q", "lows", "highs"
    )
    hits = (
        trees.groupBy("pack", "block").cogroup(asked.groupBy("pack", "block")).applyInArrow(_searched(same, most), _HITS)
    )
    place = F.row_number().over(Window.partitionBy("query", "part").orderBy(F.desc("score"), "id"))
    return hits.withColumn("rank", place).where(F.col("rank") <= most)


def whole_vectors(vectors: DataFrame, anchor: Column, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """id, label, q and is_anchor, one row per id, of the rows that take part."""

    def whole(c: Column) -> Column:
        return F.floor(F.greatest(F.least(c * SCALE, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))).cast("int")

    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("long").alias("label"),
        F.col(vec_col).alias("v"),
        F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
    )
    rows = finite_vectors(rows, "v").where("id is not null and label is not null and size(v) > 0")
    rows = rows.select("id", "label", F.transform("v", whole).alias("q"), "is_anchor")
    lengths = rows.groupBy(F.size("q").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).limit(1)
    length = next((r.length for r in lengths.collect()), 0)
    one = F.max(F.struct("label", "q", "is_anchor")).alias("one")
    return rows.where(F.size("q") == length).groupBy("id").agg(one).select("id", "one.*")


def mine(
    vectors: DataFrame,
    anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    margin: tuple[int, int] = MARGIN,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are inner products of the components ``floor(256 * c)``; higher ones come first, ties by the
    smaller id. The rows that ``anchor`` selects are the anchors; an anchor's positives are its first other
    rows of the same label, and each gets its first rows of another label with a score from ``margin[0]``
    to ``margin[1]`` per cent of its own. Fewer are returned where there are no more.

    Rows without an id or a label, with a null vector or a null or non-finite component, and with a
    vector of another length than most have (of equally frequent ones the greatest) take no part. Rows
    that share an id count once, as the one with the greatest label, then vector. Scaled components
    beyond 2**20 count as 2**20. Other columns are not read; an empty table gives no rows.
    """
    rows = stored(whole_vectors(vectors, anchor, id_col, vec_col, label_col), "vectors")
    forest = plant(rows)
    anchors = rows.where("is_anchor").select(F.col("id").alias("query"), "label", "q")
    every = anchors.withColumns({"lows": F.array(F.lit(-NEVER)), "highs": F.array(F.lit(NEVER))})
    first = search_all(forest, every, True, positives)
    listed = first.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("positives"))
    found = stored(anchors.join(listed, "query"), "positives")

    def least(p: Column) -> Column:  # the smallest whole score of the margin
        scaled = p["score"] * margin[0]
        return F.when(scaled > 0, scaled + 99).otherwise(scaled)

    lows = F.transform("positives", lambda p: _div(least(p), 100))
    highs = F.transform("positives", lambda p: _floor_div(p["score"] * margin[1], 100))
    windows = found.withColumns({"lows": lows, "highs": highs})
    hard = search_all(forest, windows, False, negatives)
    pairs = found.select("query", F.posexplode("positives").alias("part", "positive"))
    return hard.join(pairs, ["query", "part"]).select(
        F.col("query").alias("anchor_id"),
        F.col("positive.id").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        F.col("positive.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def _div(a: Column, b: int) -> Column:
    """Whole division towards zero."""
    return F.call_function("div", a, F.lit(b).cast("long"))


def _floor_div(a: Column, b: int) -> Column:
    return _div(a - F.pmod(a, F.lit(b).cast("long")), b)
