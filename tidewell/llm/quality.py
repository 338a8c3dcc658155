"""Quality rules with risk-controlled cutoffs, in DataFrame operations only.

Every rule rejects documents whose score reaches a cutoff. Which cutoffs may be used is decided on
labelled documents, per stratum (language) and rule: a cutoff is safe if the exact binomial tail of
the good documents it rejects, at the false-rejection rate that is allowed, is below the error level
divided by the number of all tests (Bonferroni). The lowest safe cutoff is used; without one the rule
rejects nothing in that stratum.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ._common import WORD, stored, whole_text, words_of

#: Cutoffs to choose from, in the unit of the rule's score; a document is rejected from the cutoff on.
CUTOFFS = {
    "symbols": (20, 40, 60, 80, 100, 150, 200, 300),  # symbols per 1000 characters of words
    "capitals": (100, 150, 200, 300, 400, 500, 700),  # A-Z per 1000 characters of words
    "dup_lines": (50, 100, 200, 300, 400, 500, 700),  # repeated lines per 1000 lines
    "repeats": (20, 50, 75, 100, 125, 150, 175),  # words in repeated windows per 1000 words
    "long_words": (80, 90, 100, 110, 120, 150),  # characters per 10 words
}
#: Share of good documents that one rule may reject, and the chance that any rule in use rejects more.
RATE, ERROR = 0.02, 0.05
#: Words of a window.
WINDOW = 5


def repeated_words(hashes: str, size: str) -> tuple[Column, Column]:
    """Sorted (hash, place) of the windows if any repeats, and from that column the words covered."""
    windows = F.col(hashes)
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    placed = F.when(repeats, F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    column = F.col(size)
    pairs = F.zip_with(
        column,
        F.slice(column, 2, F.greatest(F.size(column), F.lit(1))),
        lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])),
    )
    places = F.array_sort(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))
    begin = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        places,
        begin,
        lambda acc, p: F.struct(
            p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"]).cast("long")).alias("n")
        ),
        lambda acc: acc["n"],
    )
    return placed, F.when(column.isNull(), F.lit(0).cast("long")).otherwise(covered)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """One row per document: doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines, n_capitals, base_failed, text_hash. A null text has no words, a null stratum is ''."""
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(WORD))
    windows = F.when(
        F.col("n_words") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.col("n_words").cast("int") - WINDOW),
            lambda i: F.xxhash64(*[F.get(F.col("word_hashes"), i + k) for k in range(WINDOW)]),
        ),
    )
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"),
        whole_text(text_col).alias("text"),
    )
    rows = rows.withColumn("words", words_of(F.col("text"))).withColumn("lines", lines)
    rows = rows.select(
        "doc_id",
        "stratum",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long").alias("n_capitals"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda word: F.xxhash64(word)).alias("word_hashes"),
        F.xxhash64("text").alias("text_hash"),
    )
    rows = rows.withColumn("windows", windows)
    placed, covered = repeated_words("windows", "placed")
    rows = rows.withColumn("placed", placed).withColumn("n_repeat_words", covered)
    return rows.select(
        "doc_id",
        "stratum",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_lines",
        "n_capitals",
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"),
        "text_hash",
    )


def scores() -> dict[str, Column]:
    """The score of each rule as a whole number."""
    share = lambda part, whole, unit: F.expr(f"{unit} * {part} div greatest({whole}, 1)")
    return {
        "symbols": share("n_symbols", "word_chars", 1000),
        "capitals": share("n_capitals", "word_chars", 1000),
        "dup_lines": share("n_dup_lines", "n_lines", 1000),
        "repeats": share("n_repeat_words", "n_words", 1000),
        "long_words": share("word_chars", "n_words", 10),
    }


def _log_factorial(n: Column) -> Column:
    """ln n!: a table below 10, Stirling's series from there on."""
    small = F.element_at(F.array(*[F.lit(math.lgamma(k + 1)) for k in range(10)]), F.least(n, F.lit(9)).cast("int") + 1)
    x = F.greatest(n, F.lit(1)).cast("double")
    series = 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, F.lit(5.0)))
    return F.when(n < 10, small).otherwise(x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + series)


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) for X of n trials at ``rate``; 1 where k is above the mean.

    Terms are added from k downwards, over twelve standard deviations and fifty more; what is left
    out is below the precision of a double.
    """
    log_term = (
        _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)
        + k * math.log(rate) + (n - k) * math.log1p(-rate)
    )
    steps = F.least(k, F.ceil(12 * F.sqrt(n * rate)) + 50)
    odds = (1 - rate) / rate
    total = F.aggregate(
        F.when(k > 0, F.sequence(k, F.greatest(k - steps + 1, F.lit(1).cast("long")), F.lit(-1).cast("long"))).otherwise(
            F.array().cast("array<long>")
        ),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda acc, j: F.struct(
            (acc["term"] * j * odds / (n - j + 1)).alias("term"),
            (acc["sum"] + acc["term"] * j * odds / (n - j + 1)).alias("sum"),
        ),
        lambda acc: acc["sum"],
    )
    return F.when(k > n * rate, F.lit(1.0)).otherwise(F.exp(log_term) * total)


def safe_cutoffs(good: DataFrame, cutoffs: dict = CUTOFFS, rate: float = RATE, error: float = ERROR) -> DataFrame:
    """(stratum, cuts): the lowest safe cutoff by rule, from the measures of the good documents."""
    rules = scores()
    tests = [(rule, cut) for rule, cuts in cutoffs.items() for cut in cuts]
    counts = good.groupBy("stratum").agg(
        F.count("*").alias("n"),
        *[F.count_if(rules[rule] >= cut).alias(f"k{i}") for i, (rule, cut) in enumerate(tests)],
    )
    counts = stored(counts, "holdout")
    each = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.lit(cut).alias("cut"), F.col(f"k{i}").alias("k"))
            for i, (rule, cut) in enumerate(tests)
        ]
    )
    level = error / max(1, len(tests) * counts.count())
    tested = counts.select("stratum", "n", F.explode(each).alias("t")).select("stratum", "n", "t.*")
    return (
        tested.filter(binomial_tail(F.col("k"), F.col("n"), rate) <= level)
        .groupBy("stratum", "rule")
        .agg(F.min("cut").alias("cut"))
        .groupBy("stratum")
        .agg(F.map_from_entries(F.collect_list(F.struct("rule", "cut"))).alias("cuts"))
    )


def judge(
    docs: DataFrame,
    labels: DataFrame,
    cutoffs: dict = CUTOFFS,
    rate: float = RATE,
    error: float = ERROR,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
) -> DataFrame:
    """The measures of every document and ``kept``: false if base_failed or a rule in use rejects it.

    ``labels`` has (doc_id, quality). The holdout are documents that pass the base rules, with labels of
    quality 1 and no lower one; the bound is for independent draws, so a document that is labelled again,
    and a text that stands in the stratum again, counts once. Null ids match no label. A null text has no words and
    fails the base rules; a null stratum is a stratum of its own. Repeated rows get the same verdict.
    Without labels only the base rules reject. Empty tables give no rows.
    """
    measured = stored(measure(docs, id_col, text_col, stratum_col), "measures")
    least = labels.groupBy(F.col("doc_id").alias("labelled")).agg(F.min("quality").alias("quality"))
    good = least.filter("quality = 1").select("labelled")
    holdout = measured.filter("not base_failed").join(good, F.col("doc_id") == F.col("labelled"))
    holdout = holdout.dropDuplicates(["stratum", "text_hash"])
    cuts = stored(safe_cutoffs(holdout, cutoffs, rate, error), "cutoffs")
    rejected = F.lit(False)
    for rule, score in scores().items():
        rejected = rejected | F.coalesce(score >= F.element_at("cuts", rule), F.lit(False))
    return measured.join(cuts, "stratum", "left").select(
        *[c for c in measured.columns if c != "text_hash"], (~F.col("base_failed") & ~rejected).alias("kept")
    )
