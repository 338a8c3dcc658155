"""Substring dedup by paragraphs: MinHash banding, exact Jaccard, components.

A paragraph is a line of a text. Paragraphs whose shingles of five words are alike are found by MinHash
bands, compared exactly and clustered by components; in a cluster the first paragraph stays. Paragraphs
are also cut at words that their neighbourhood determines, so that a passage falls into the same
parts wherever it stands; parts that repeat exactly are removed from paragraphs that stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ._common import partitions, rows_in_groups, stored, whole_text
from ._graph import components

#: Words of a shingle, similarity of a link, words of the shortest paragraph and of the shortest part.
SHINGLE, SIMILARITY, LEAST_WORDS, LEAST_PART = 5, 0.8, 20, 8
#: Bands and rows: a pair at the similarity of 0.8 meets in a band with a chance of 1 - (1 - 0.8^3)^8 = 0.997.
BANDS, ROWS = 8, 3
#: Paragraphs of a band that one task compares; larger bands are cut into blocks.
BLOCK = 2048
#: Words on either side that decide where a paragraph is cut.
REACH = 6
REMEMBERED = 400_000
#: Words that are looked at together.
WORDS_AT_ONCE = 200_000
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_RNG = np.random.default_rng(11)
_FACTORS = _RNG.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_TERMS = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values * _A
    values ^= values >> np.uint64(32)
    values *= _B
    return values ^ values >> np.uint64(29)


class Words:
    """Hashes of words, remembered up to a bound."""

    def __init__(self) -> None:
        self._known: dict[bytes, int] = {}

    def hashes(self, words: list[bytes]) -> list[int]:
        if len(self._known) > REMEMBERED:
            self._known.clear()
        known, out = self._known, []
        for word in words:
            value = known.get(word)
            if value is None:
                value = known[word] = xxhash.xxh64_intdigest(word)
            out.append(value)
        return out


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Hashes of the runs of five words; of all words where there are fewer."""
    if len(hashes) < SHINGLE:
        hashes = np.concatenate([hashes, np.zeros(SHINGLE - len(hashes), np.uint64)])
    n = len(hashes) - SHINGLE + 1
    value = hashes[:n].copy()
    for k in range(1, SHINGLE):
        value *= _A
        value += hashes[k : k + n]
    return _mixed(value)


def cuts(hashes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places at which paragraphs are cut: words whose pair hash is the least of their neighbourhood,
    the first of equals. The words of all paragraphs stand back to back."""
    n = len(hashes) - 1
    if n < 2 * REACH + 1:
        return np.empty(0, np.int64)
    pairs = _mixed(hashes[:-1] * np.uint64(3) + hashes[1:])
    least = pairs
    for width in (1, 2):  # the least of 4 words from each on, then of REACH
        least = np.minimum(least[:-width], least[width:])
    least = np.minimum(least[: n - REACH + 1], least[REACH - 4 :])
    middle = pairs[REACH : n - REACH]
    lowest = (middle < least[: len(middle)]) & (middle <= least[REACH + 1 :])
    at = np.flatnonzero(lowest) + REACH
    line = np.searchsorted(ends, at, side="right")
    return at[(at - REACH >= begins[line]) & (at + REACH <= ends[line] - 2)]


def bands(grams: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Band hashes of paragraphs whose shingles begin at ``begins``: one row each."""
    out = np.empty((len(begins), BANDS), np.uint64)
    for band in range(BANDS):
        value = np.full(len(begins), band, np.uint64)
        for row in range(band * ROWS, (band + 1) * ROWS):
            value = _mixed(value ^ np.minimum.reduceat(_mixed(grams * _FACTORS[row] + _TERMS[row]), begins))
        out[:, band] = value
    return out


_UNITS = "doc_id long, paragraph int, part int, n_words int, digest long, bands binary"


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paragraphs with their bands, and their parts."""
    words_of = Words()
    for batch in batches:
        lines: list[tuple] = []
        size = 0
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            for paragraph, line in enumerate(text.as_py().lower().split(b"\n")):
                words = line.split()
                if len(words) >= LEAST_WORDS:
                    lines.append((doc_id, paragraph, words))
                    size += len(words)
            if size > WORDS_AT_ONCE:
                yield _rows_of(lines, words_of)
                lines, size = [], 0
        if lines:
            yield _rows_of(lines, words_of)


def _rows_of(lines: list[tuple], words_of: Words) -> pa.RecordBatch:
    sizes = np.array([len(words) for _, _, words in lines])
    ends = np.cumsum(sizes)
    begins = ends - sizes
    hashes = np.array([h for _, _, words in lines for h in words_of.hashes(words)], np.uint64)
    # shingles that do not cross the end of a paragraph
    grams = shingles(hashes)
    inside = np.ones(len(hashes), bool)
    for back in range(1, SHINGLE):
        inside[ends - back] = False
    found = bands(grams[inside[: len(grams)]], np.cumsum(sizes - SHINGLE + 1) - (sizes - SHINGLE + 1))
    places = cuts(hashes, begins, ends)
    first = np.searchsorted(places, begins).tolist()
    after = np.searchsorted(places, ends).tolist()
    rows: list[tuple] = []
    for k, (doc_id, paragraph, words) in enumerate(lines):
        rows.append((doc_id, paragraph, -1, len(words), _digest(words), found[k].tobytes()))
        if first[k] < after[k]:
            at = [0, *(places[first[k] : after[k]] - begins[k]).tolist(), len(words)]
            for part, (a, b) in enumerate(zip(at, at[1:])):
                if b - a >= LEAST_PART:
                    rows.append((doc_id, paragraph, part, b - a, _digest(words[a:b]), None))
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
        names=["doc_id", "paragraph", "part", "n_words", "digest", "bands"],
    )


def _digest(words: list[bytes]) -> int:
    value = xxhash.xxh3_64_intdigest(b" ".join(words))
    return value - (1 << 64) if value >> 63 else value


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.int64)
        digests = np.repeat(batch.column("digest").to_numpy(), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(digests)], names=["band", "digest"])


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted distinct shingles of the wanted paragraphs, where the text has them at their place."""
    words_of = Words()
    for batch in batches:
        digests, sets = [], []
        for text, wanted in zip(batch.column("text"), batch.column("wanted").to_pylist()):
            lines = text.as_py().lower().split(b"\n")
            for item in wanted:
                words = lines[item["paragraph"]].split() if item["paragraph"] < len(lines) else []
                if words and _digest(words) == item["digest"]:
                    digests.append(item["digest"])
                    sets.append(np.unique(shingles(np.array(words_of.hashes(words), np.uint64))).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(digests, pa.int64()), pa.array(sets, pa.binary())], names=["digest", "shingles"]
        )


def alike(pivot: np.ndarray, others: list[np.ndarray], similarity: float) -> np.ndarray:
    """Whether the exact Jaccard similarity to the pivot reaches the threshold."""
    sizes = np.array([len(x) for x in others])
    every = np.concatenate(others)
    at = np.minimum(np.searchsorted(pivot, every), len(pivot) - 1)
    common = np.add.reduceat((pivot[at] == every).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
    return common >= similarity * (sizes + len(pivot) - common) - 1e-9


def _compare(similarity: float):
    """Links that connect all alike paragraphs of a band: a pivot takes what is alike out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in rows_in_groups(batches, "band", 1 << 12):
            keys = table.column("band").combine_chunks().to_numpy()
            digests = table.column("digest").combine_chunks().to_numpy()
            data = table.column("shingles").to_pylist()
            begins = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
            links: list[tuple[int, int]] = []
            for lo, hi in zip(begins[:-1], begins[1:]):
                if hi - lo < 2:
                    continue
                sets = [np.frombuffer(x, np.uint64) for x in data[lo:hi]]
                rest, waiting = list(range(hi - lo)), []
                while rest:
                    pivot = waiting.pop() if waiting else rest.pop()
                    if not rest:
                        break
                    near = alike(sets[pivot], [sets[i] for i in rest], similarity)
                    found = [i for i, hit in zip(rest, near) if hit]
                    rest = [i for i, hit in zip(rest, near) if not hit]
                    links += [(int(digests[lo + pivot]), int(digests[lo + i])) for i in found]
                    waiting += found
            a, b = zip(*links) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _compare_across(similarity: float):
    """Links between the rows of either side of a block pair that are not connected yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in rows_in_groups(batches, "band", 1 << 12):
            keys = table.column("band").combine_chunks().to_numpy()
            digests, roots = table.column("digest").to_pylist(), table.column("root").to_pylist()
            resting, data = table.column("resting").to_pylist(), table.column("shingles").to_pylist()
            begins = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
            links: list[tuple[int, int]] = []
            for lo, hi in zip(begins[:-1].tolist(), begins[1:].tolist()):
                sets = {k: np.frombuffer(data[k], np.uint64) for k in range(lo, hi)}
                others = [k for k in range(lo, hi) if not resting[k]]
                sizes = np.array([len(sets[k]) for k in others])
                names, component = np.unique([roots[k] for k in range(lo, hi)], return_inverse=True)
                component = dict(zip(range(lo, hi), component.tolist()))
                now = np.arange(len(names))
                of_others = np.array([component[k] for k in others], np.int64)
                for pivot in (k for k in range(lo, hi) if resting[k]):
                    if not others:
                        break
                    size, own = len(sets[pivot]), component[pivot]
                    fits = (sizes >= similarity * size - 1e-9) & (size >= similarity * sizes - 1e-9)
                    rest = np.flatnonzero(fits & (now[of_others] != now[own])).tolist()
                    if not rest:
                        continue
                    near = alike(sets[pivot], [sets[others[i]] for i in rest], similarity)
                    for i, hit in zip(rest, near):
                        there = now[of_others[i]]
                        if hit and there != now[own]:
                            links.append((digests[pivot], digests[others[i]]))
                            now[now == there] = now[own]
            a, b = zip(*links) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def in_blocks(met: DataFrame, crowded: DataFrame, turn: int) -> DataFrame:
    """(band, digest) of ``met`` with a band of its own for each block of a crowded band, dealt anew each turn."""
    block = F.pmod(F.xxhash64("digest", F.lit(turn)), F.col("blocks"))
    return met.join(crowded, "band", "left").select(
        F.when(F.col("blocks").isNull(), F.col("band")).otherwise(F.xxhash64("band", block)).alias("band"), "digest"
    )


def block_pairs(members: DataFrame) -> DataFrame:
    """Rows (band, digest, root, resting): a band of its own for each pair of a block of all members of a
    crowded band and a block of those outside its largest component. Any two members of different
    components meet; bands of one component have no rows. ``members`` has (band, digest, blocks, root)."""
    sizes = stored(members.groupBy("band", "root").count(), "sizes")
    largest = sizes.groupBy("band").agg(
        F.max(F.struct("count", "root")).alias("top"), F.sum("count").alias("all")
    ).select("band", F.col("top.root").alias("top"), (F.col("all") - F.col("top.count")).alias("n_resting"))
    largest = stored(largest.filter("n_resting > 0"), "largest")
    rows = members.join(largest, "band").select(
        "band", "digest", "root", "blocks", (F.col("root") != F.col("top")).alias("rests"),
        F.ceil(F.col("n_resting") / BLOCK).alias("pieces"),
    )
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)
    dealt = lambda n: F.pmod(F.xxhash64("digest", F.lit(-1)), n)
    every = rows.select(
        "band", "digest", "root", F.lit(False).alias("resting"), dealt(F.col("blocks")).alias("i"),
        F.explode(upto(F.col("pieces"))).alias("j"),
    )
    outside = rows.filter("rests").select(
        "band", "digest", "root", F.lit(True).alias("resting"), F.explode(upto(F.col("blocks"))).alias("i"),
        dealt(F.col("pieces")).alias("j"),
    )
    return every.unionByName(outside).select(F.xxhash64("band", "i", "j").alias("band"), "digest", "root", "resting")


def linked(met: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(node, root) of the paragraphs that are alike, from their bands and their shingles.

    No task compares more than about ``BLOCK`` paragraphs of a band. Crowded bands are cut into random
    blocks, anew while that connects most of what is not; then the members outside the largest component of
    their band are compared with all members of other components, in pairs of blocks, so that no link is lost.
    """
    n = partitions(met.sparkSession)
    crowded = met.groupBy("band").count().filter(F.col("count") > BLOCK)
    crowded = stored(crowded.select("band", F.ceil(F.col("count") / BLOCK).alias("blocks")), "crowded")

    def compared(rows: DataFrame, run) -> DataFrame:
        rows = rows.join(sets, "digest").repartition(n, "band").sortWithinPartitions("band")
        return rows.mapInArrow(run, "a long, b long").distinct()

    links = compared(in_blocks(met, crowded, 0).select("band", "digest"), _compare(similarity))
    if not crowded.count():
        return stored(components(links), "roots")
    links = stored(links, "links")
    crowds = stored(met.join(crowded, "band"), "crowds")
    turn, before = 0, None
    while True:
        roots = stored(components(links), "roots")
        members = crowds.join(roots, F.col("digest") == F.col("node"), "left").select(
            "band", "digest", "blocks", F.coalesce("root", "digest").alias("root")
        )
        members = stored(members, "members")
        of_band = members.groupBy("band", "root").count().groupBy("band")
        outside = of_band.agg((F.sum("count") - F.max("count")).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        if not outside:
            return roots
        if before is not None and 2 * outside > before:
            break
        turn, before = turn + 1, outside
        again = in_blocks(crowds.select("band", "digest"), crowded, turn)
        links = stored(links.unionByName(compared(again, _compare(similarity))).distinct(), "links")
    across = compared(block_pairs(members), _compare_across(similarity))
    return stored(components(links.unionByName(across)), "roots")


def repeated_paragraphs(
    docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per removed paragraph or part: doc_id, paragraph, part, n_words, keep_doc_id,
    keep_paragraph, keep_part, cluster_size.

    A paragraph is a \\n-split line of ``LEAST_WORDS`` words or more, A-Z lower-cased; shorter lines are
    left alone. Paragraphs link when the Jaccard similarity of their sets of five-word shingles reaches
    ``similarity``; of each component the paragraph of the smallest doc_id, then the first, stays. ``part``
    is -1 for a whole paragraph; other rows are parts (numbered from 0 in their paragraph) of
    paragraphs that stay, equal to a part that stays or lies in a paragraph before. Null and
    empty texts have no paragraphs. Null ids come before all others. Repeated rows: of two with the same id
    and text, all paragraphs are at the same place and none is removed for the other. Other columns
    are not read. Without repeats, or from an empty table, there are no rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).cast("binary").alias("text"))
    units = stored(texts.mapInArrow(_units, _UNITS), "units")
    place = F.struct("doc_id", "paragraph", "part")
    classes = stored(
        units.groupBy("digest", (F.col("part") < 0).alias("whole")).agg(
            F.min(place).alias("first"), F.count("*").alias("copies"), F.first("bands").alias("bands")
        ),
        "classes",
    )
    entered = classes.filter("whole").select("digest", "bands").mapInArrow(_spread, "band long, digest long")
    meeting = stored(
        entered.groupBy("band").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).filter("lo <> hi").select("band"),
        "meeting",
    )
    met = stored(entered.join(meeting, "band"), "met")
    wanted = (
        classes.filter("whole")
        .join(met.select("digest").distinct(), "digest")
        .groupBy(F.col("first.doc_id").alias("doc"))
        .agg(F.collect_list(F.struct(F.col("first.paragraph").alias("paragraph"), "digest")).alias("wanted"))
    )
    # an id that several rows have may not lead to the wanted paragraph in all of them: digests decide
    one_each = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("doc"))).select("text", "wanted")
    sets = stored(one_each.mapInArrow(_shingle_sets, "digest long, shingles binary").dropDuplicates(["digest"]), "sets")
    roots = linked(met, sets, similarity)
    whole = classes.filter("whole").join(roots, F.col("digest") == F.col("node"), "left").select(
        "digest", "first", "copies", F.coalesce("root", "digest").alias("root")
    )
    whole = stored(whole, "whole")
    kept = whole.groupBy("root").agg(F.min("first").alias("keep"), F.sum("copies").alias("cluster_size"))
    clusters = stored(
        whole.join(kept.filter("cluster_size > 1"), "root").select("digest", F.lit(True).alias("whole"), "keep", "cluster_size")
        .unionByName(
            classes.filter("not whole and copies > 1").select(
                "digest", "whole", F.col("first").alias("keep"), F.col("copies").alias("cluster_size")
            )
        ),
        "clusters",
    )
    found = stored(
        units.select("doc_id", "paragraph", "part", "n_words", "digest", (F.col("part") < 0).alias("whole"))
        .join(clusters, ["digest", "whole"])
        .filter(~place.eqNullSafe(F.col("keep")))
        .select(
            "doc_id", "paragraph", "part", "n_words", F.col("keep.doc_id").alias("keep_doc_id"),
            F.col("keep.paragraph").alias("keep_paragraph"), F.col("keep.part").alias("keep_part"), "cluster_size",
        ),
        "found",
    )
    gone = found.filter("part < 0").select(F.col("doc_id").alias("d"), F.col("paragraph").alias("p")).distinct()
    parts = found.filter("part >= 0").join(
        gone, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("paragraph") == F.col("p")), "left_anti"
    )
    return found.filter("part < 0").unionByName(parts)
