"""Mixing sources to target weights.

The documents of a source are put in a pseudo-random order and cut into blocks of a fixed number of
words; a source that is wanted several times is run through again. How many blocks of each source an
output shard gets comes from a splitting tree: a node splits its block counts between its two halves
of the shards by a multivariate hypergeometric draw, seeded by the node, so that any shard can find
its quotas alone. Shards then own disjoint runs of the permuted blocks and shuffle them locally.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ._common import SPACE, stored, whole_text, words_of

#: Weights of the sources in order, repeating; and how often a source may be used.
WEIGHTS, MOST_USES = (5, 2, 1), 3
#: Words of a block, and blocks of a shard.
BLOCK_WORDS, SHARD_BLOCKS = 4096, 4096
SEED = 7


def count_words(text: Column) -> Column:
    """Runs of other than ASCII white space, without building an array of them."""
    blank = lambda at: F.substring(text, at, 1).isin(" ", "\t", "\n", "\x0b", "\f", "\r").cast("int")
    return F.when(text == "", 0).otherwise(F.size(F.split(text, SPACE, -1)) - blank(1) - blank(-1)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, most_uses: int = MOST_USES) -> DataFrame:
    """(source, rank, words, target) from rows of (source, size).

    The sources by code point, null last, weigh ``weights`` in turn and share all words by weight. No
    target exceeds ``most_uses`` times its source; what is above is shared among the others by weight
    until none is above. That is the level L at which the targets min(L * weight, cap) use up all
    words; with the sources in order of cap / weight it is found in one pass over the sources.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("words"))
    ranked = per_source.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    ).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    )
    filled = Window.orderBy(F.col("words") / F.col("weight"), "rank")
    levels = ranked.select(
        "*",
        F.sum("words").over(Window.partitionBy()).alias("all_words"),
        F.coalesce(F.sum("words").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("weight").over(filled.rowsBetween(0, Window.unboundedFollowing)).alias("weight_left"),
    ).withColumn("level", (F.col("all_words") - most_uses * F.col("before")) / F.col("weight_left"))
    holds = F.col("level") * F.col("weight") <= most_uses * F.col("words")
    level = F.min_by(F.when(holds, F.col("level")), F.when(holds, F.col("words") / F.col("weight"))).over(
        Window.partitionBy()
    )
    cap = (most_uses * F.col("words")).cast("double")
    return levels.withColumn("shared", level).select(
        "source",
        "rank",
        "words",
        F.least(F.coalesce(F.col("shared") * F.col("weight"), cap), cap).alias("target"),
    )


def shard_quotas(blocks: np.ndarray, shards: int, begin: int, end: int, seed: int) -> np.ndarray:
    """Blocks per source that lie before and in each of the shards begin..end-1: (shard, 2, source).

    A node (low, high) of the tree holds the counts of its shards; its left half draws its share of
    blocks without replacement from the node's.
    """
    found = np.zeros((end - begin, 2, len(blocks)), np.int64)

    def split(low: int, high: int, counts: np.ndarray, before: np.ndarray) -> None:
        if high <= begin or low >= end:
            return
        if high - low == 1:
            found[low - begin] = before, counts
            return
        middle = (low + high) // 2
        total = int(counts.sum())
        left_total = total * (middle - low) // (high - low)
        rng = np.random.default_rng([seed, low, high])
        left = _draw(rng, counts, left_total)
        split(low, middle, left, before)
        split(middle, high, counts - left, before + left)

    split(0, shards, blocks.astype(np.int64), np.zeros(len(blocks), np.int64))
    return found


def _draw(rng: np.random.Generator, counts: np.ndarray, take: int) -> np.ndarray:
    """A multivariate hypergeometric draw, source by source."""
    left, drawn = int(counts.sum()), np.zeros_like(counts)
    for i, count in enumerate(counts.tolist()):
        if not take:
            break
        drawn[i] = _hypergeometric(rng, count, left - count, take)
        left -= count
        take -= int(drawn[i])
    return drawn


#: numpy's own bound on a population.
NUMPY_LARGEST = 10**9


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, take: int) -> int:
    """How many of ``take`` draws without replacement are good, for a population of any size.

    Beyond numpy's bound the distribution is summed up over twelve standard deviations around its mode,
    from the ratios of neighbouring terms, and inverted.
    """
    if good + bad < NUMPY_LARGEST:
        return int(rng.hypergeometric(good, bad, take))
    low, high = max(0, take - bad), min(good, take)
    total = good + bad
    mode = min(max((take + 1) * (good + 1) // (total + 2), low), high)
    spread = math.sqrt(take * (good / total) * (bad / total) * ((total - take) / (total - 1)))
    reach = int(12 * spread) + 50
    first, last = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(first, last, dtype=np.float64)
    steps = np.log(good - k) + np.log(take - k) - np.log(k + 1) - np.log(bad - take + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    shares = np.cumsum(np.exp(logs - logs.max()))
    return first + int(np.searchsorted(shares, rng.random() * shares[-1], side="right"))


def mix_documents(
    docs: DataFrame,
    weights: tuple = WEIGHTS,
    most_uses: int = MOST_USES,
    block_words: int = BLOCK_WORDS,
    shard_blocks: int = SHARD_BLOCKS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """The mix and the measured documents.

    The mix has rows (shard, place, row, copy, from_word, to_word): words from_word up to to_word of
    the document ``row`` stand in ``shard``, ordered by ``place``. A source yields its target to the
    word: the last document it gives is cut. The measured documents have (row, doc_id, source, size,
    nth, source_size, target), one per row of ``docs``; ``nth`` counts rows equal in the three before.

    A null text has no words, a null source is a source. Documents without words and empty tables are
    measured and give nothing to the mix. The order depends on ids and sizes only, so reruns agree;
    rows that repeat id, size and source stand in any order among themselves.
    """
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")).cast("binary"))
    measured = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            count_words(whole_text(text_col)).alias("size"),
        ).select(
            "*", key.alias("key"), F.substring(key, 1, 3).alias("range"),
            F.row_number().over(Window.partitionBy("doc_id", "source", "size").orderBy(key)).alias("nth"),
        ),
        "measured",
    )
    targets = stored(source_targets(measured, weights, most_uses), "targets")
    # where each key range of a source begins; then places within a range
    in_order = Window.partitionBy("rank").orderBy("range")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    sums = measured.groupBy("source", "range").agg(F.sum("size").alias("range_words"))
    ranges = stored(
        sums.join(targets, same(sums, targets))
        .drop(targets["source"])
        .withColumn("range_begin", F.sum("range_words").over(in_order) - F.col("range_words")),
        "ranges",
    )
    place = Window.partitionBy("rank", "range").orderBy("key", "doc_id", "size")
    rows = stored(
        measured.join(ranges, same(measured, ranges) & (measured["range"] == ranges["range"]))
        .drop(ranges["source"])
        .drop(ranges["range"])
        .select(
            "doc_id", "source", "rank", "size", "nth", "target", F.col("words").alias("source_size"),
            (F.col("range_begin") + F.sum("size").over(place.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
            .alias("start"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "rows",
    )
    # the words a source yields, as a run through its permuted documents, again from the front at the end
    run_words = F.round("target").cast("long")
    begin = F.col("copy") * F.col("source_size") + F.col("start")
    drawn = (
        rows.filter("size > 0")
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(most_uses - 1))).alias("copy"))
        .select("*", begin.alias("begin"), F.least(begin + F.col("size"), run_words).alias("end"))
        .filter("begin < end")
        .select(
            "*",
            F.explode(F.expr(f"sequence(begin div {block_words}, (end - 1) div {block_words})")).alias("block"),
        )
    )
    quotas = _quotas(targets, block_words, shard_blocks, seed)
    lo = F.greatest(F.col("begin"), F.col("block") * block_words)
    hi = F.least(F.col("end"), (F.col("block") + 1) * block_words)
    mix = drawn.join(quotas, ["rank", "block"]).select(
        "shard",
        F.xxhash64(F.lit(seed), "rank", "block", "begin").alias("place"),
        "row",
        "copy",
        (lo - F.col("begin")).alias("from_word"),
        (hi - F.col("begin")).alias("to_word"),
    )
    return mix, rows.select("row", "doc_id", "source", "size", "nth", "source_size", "target")


def _quotas(targets: DataFrame, block_words: int, shard_blocks: int, seed: int) -> DataFrame:
    """(rank, block, shard): the shard that owns each permuted block."""
    spark = targets.sparkSession
    per_source = [
        (row.rank, -(-round(row.target) // block_words)) for row in targets.select("rank", "target").collect()
    ]
    ranks = [rank for rank, _ in per_source]
    blocks = np.array([count for _, count in per_source], np.int64)
    shards = max(1, -(-int(blocks.sum()) // shard_blocks))

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                first = int(batch["id"].iloc[0])
                quotas = shard_quotas(blocks, shards, first, first + len(batch), seed)
                for i, (before, count) in enumerate(quotas):
                    yield pd.DataFrame(
                        {"rank": ranks, "shard": first + i, "first": before, "after": before + count}
                    )

    found = spark.range(shards).mapInPandas(leaves, "rank int, shard long, first long, after long")
    return found.filter("first < after").select(
        "rank", "shard", F.explode(F.expr("sequence(first, after - 1)")).alias("block")
    )


def mixed_texts(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents with the columns of ``docs``, shard after shard, each in the order of its places.

    A document stands in the mix as often as it is taken, as a whole, where its first words were drawn to.
    The one document per source that is cut to reach the target keeps its first words, with single
    blanks between them. Texts are shuffled twice: to the draws, and to their shards.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    source_col = options.get("source_col", "source")
    mix, measured = mix_documents(docs, **options)
    copies = mix.groupBy("row", "copy").agg(
        F.max("to_word").alias("words"), F.min(F.struct("from_word", "shard", "place")).alias("at")
    )
    keys = ["id_key", "source_key", "size"]
    draws = F.collect_list(F.struct("words", "at.shard", "at.place"))  # a copy is used three times at most
    uses = copies.groupBy("row").agg(draws.alias("uses")).join(measured, "row")
    uses = uses.select(*_keys("doc_id", "source"), "size", "nth", "uses")
    uses = stored(uses.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("nth", "uses"))).alias("by_nth")), "uses")
    others = [name for name in docs.columns if name != text_col]
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(others)]).alias("kept"),
        *_keys(id_col, source_col),
        F.col(text_col).cast("string").alias("whole"),
        count_words(whole_text(text_col)).alias("size"),
    )
    # rows that share id, source and size are told apart by their number, as the mix tells them apart
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64("whole")))
    found = rows.join(uses, keys).withColumn("nth", number)
    found = found.select("kept", "whole", "size", F.explode(F.element_at("by_nth", F.col("nth"))).alias("used"))
    first_words = F.array_join(F.slice(words_of(F.col("whole")), 1, F.col("used.words").cast("int")), " ")
    placed = found.withColumn("text", F.when(F.col("used.words") >= F.col("size"), F.col("whole")).otherwise(first_words))
    placed = placed.select("kept", "text", F.col("used.shard").alias("shard"), F.col("used.place").alias("place"))
    placed = placed.repartitionByRange("shard", "place").sortWithinPartitions("shard", "place")
    return placed.select(
        *[(F.col("text") if c == text_col else F.col(f"kept.c{others.index(c)}")).alias(c) for c in docs.columns]
    )


def _keys(id_col: str, source_col: str) -> list[Column]:
    """Id and source as keys that nulls share."""
    plain = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    return [plain(id_col).alias("id_key"), plain(source_col).alias("source_key")]
