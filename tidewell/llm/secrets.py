"""Secret scan in DataFrame operations only: fixed patterns, and strings of high entropy.

A window slides over every candidate string; the counts of its characters are updated with the one
that enters and the one that leaves, and with them the sum from which the Shannon entropy follows.
What counts as high depends on the class of the characters the string is made of. Paths are measured
segment by segment as well. Strings of an allowed form, and those the patterns found already, are
left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ._common import whole_text

#: The patterns, in the order in which kinds are listed, and the least length of a match
#: (of ``assign``: of its second group).
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = {"assign": ASSIGN, "access": "AKIA[A-Z0-9]{12,}", "hex": "[0-9a-f]{32,}"}
LEAST_VALUE = 8

#: Candidates: runs of these characters.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
#: Characters of a window, and the bits per character from which on a window of the class is suspect.
WINDOW = 20
#: Strings without a digit and numbered names may be words and have the highest threshold.
CLASSES = {
    "^[0-9+/_=-]+$": None,
    "^[0-9A-Fa-f]+$": 3.0,
    "^[A-Za-z+/_=-]+$|^[A-Za-z]+([_/-][A-Za-z]+)*[_/-]?[0-9]{1,4}$": 4.0,
    "^[0-9A-Za-z]+$": 3.7,
    "": 3.9,
}
#: Forms that are no secrets: UUIDs, dates and times. The segments of a path have to be so each.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([Tt_-][0-9]{2}(-?[0-9]{2}){0,2}([Zz]|[+-][0-9]{2}-?[0-9]{2})?)?$",
)
#: A path is not measured across its segments, but each of them that is as long as a window is.
PATH = r"^/?([a-z][a-z_-]*/)+[a-z0-9_-]*$"


def found_spans(matches: str, pieces: str, kind: str, order: int, passes) -> Column:
    """Structs (start, order, end, kind, match) of the matches, from them and the pieces between.

    ``pieces`` are what a split at the same pattern leaves, so a match begins where the pieces and the
    matches before it end. Lengths are code points.
    """
    begin = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.array().cast("array<struct<start:long,order:int,end:long,kind:string,match:string>>").alias("spans"),
    )

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["piece"])
        end = start + F.length(pair["match"])
        span = F.struct(
            start.alias("start"),
            F.lit(order).alias("order"),
            end.alias("end"),
            F.lit(kind).alias("kind"),
            pair["match"].alias("match"),
        )
        return F.struct(
            end.alias("at"),
            F.when(passes(pair["match"]), F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
        )

    pairs = F.zip_with(
        F.col(matches),
        F.slice(F.col(pieces), 1, F.size(F.col(matches))),
        lambda match, piece: F.struct(match.alias("match"), piece.alias("piece")),
    )
    none = F.array().cast("array<struct<start:long,order:int,end:long,kind:string,match:string>>")
    return F.when(F.col(matches).isNull(), none).otherwise(F.aggregate(pairs, begin, step, lambda acc: acc["spans"]))


def _surprise(count: Column) -> Column:
    """count * log2 count, 0 for none."""
    return F.when(count > 0, count * F.log2(count.cast("double"))).otherwise(0.0)


def suspect_part(string: Column, threshold: Column) -> Column:
    """Struct (first, last): where in the string the first suspect window begins and the last one
    ends; nulls if there is none. ``threshold`` is in bits per character."""
    places = F.transform(F.split(string, "(?<=.)(?=.)"), lambda c: F.instr(F.lit(ALPHABET), c))
    n_chars = len(ALPHABET) + 1
    begin = F.struct(
        places.alias("places"),
        F.array_repeat(F.lit(0), n_chars).alias("counts"),
        F.lit(0.0).alias("sum"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
    )

    def step(acc: Column, i: Column) -> Column:
        entering = F.get(acc["places"], i)
        leaving = F.when(i >= WINDOW, F.get(acc["places"], i - WINDOW))
        n_in, n_out = F.get(acc["counts"], entering), F.get(acc["counts"], leaving)
        grown = F.when(
            leaving.isNull() | (entering != leaving),
            acc["sum"] + _surprise(n_in + 1) - _surprise(n_in)
            + F.coalesce(_surprise(n_out - 1) - _surprise(n_out), F.lit(0.0)),
        ).otherwise(acc["sum"])
        counts = F.transform(
            acc["counts"],
            lambda n, c: n
            + F.when(c == entering, 1).otherwise(0)
            - F.when(leaving.isNotNull() & (c == leaving), 1).otherwise(0),
        )
        # the entropy of a full window of n characters is log2 n - sum / n
        suspect = (i >= WINDOW - 1) & (math.log2(WINDOW) - grown / WINDOW >= threshold)
        return F.struct(
            acc["places"].alias("places"),
            counts.alias("counts"),
            grown.alias("sum"),
            F.when(suspect & acc["first"].isNull(), i - WINDOW + 1).otherwise(acc["first"]).alias("first"),
            F.when(suspect, i + 1).otherwise(acc["last"]).alias("last"),
        )

    return F.aggregate(
        F.sequence(F.lit(0), F.length(string) - 1),
        begin,
        step,
        lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")),
    )


def _threshold(string: Column) -> Column:
    threshold = F.lit(None).cast("double")
    for form, bits in reversed(CLASSES.items()):
        threshold = F.when(string.rlike(form), F.lit(bits).cast("double")).otherwise(threshold)
    return threshold


def _segments(candidate: Column) -> Column:
    """Structs (at, match) of a candidate as a whole, unless it is a path, and of its segments between
    slashes that are as long as a window."""
    whole = F.struct(F.lit(0).cast("long").alias("at"), candidate.alias("match"))
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<at:long,match:string>>").alias("parts"))
    cut = F.aggregate(
        F.split(candidate, "/", -1),
        begin,
        lambda acc, part: F.struct(
            (acc["at"] + F.length(part) + 1).alias("at"),
            F.when(
                F.length(part) >= WINDOW,
                F.array_append(acc["parts"], F.struct(acc["at"].alias("at"), part.alias("match"))),
            ).otherwise(acc["parts"]).alias("parts"),
        ),
        lambda acc: acc["parts"],
    )
    none = F.array().cast("array<struct<at:long,match:string>>")
    return F.concat(
        F.when(candidate.rlike(PATH), none).otherwise(F.array(whole)),
        F.when(F.contains(candidate, F.lit("/")), cut).otherwise(none),
    )


def _merged(spans: Column) -> Column:
    """Sorted spans with those that overlap joined to one."""

    def step(acc: Column, span: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        joined = F.struct(
            last["start"].alias("start"),
            last["order"].alias("order"),
            F.greatest(last["end"], span["end"]).alias("end"),
            last["kind"].alias("kind"),
            last["match"].alias("match"),
        )
        return F.when(
            span["start"] < last["end"], F.array_append(F.slice(acc, 1, F.size(acc) - 1), joined)
        ).otherwise(F.array_append(acc, span))

    return F.aggregate(
        F.array_sort(spans), F.array().cast("array<struct<start:long,order:int,end:long,kind:string,match:string>>"), step
    )


def _joined(spans: Column) -> Column:
    text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allowed: tuple = ALLOWED) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans.

    ``spans`` lists kind:start:end (code points, end exclusive) by start, then by kind in the order of
    the counts; base_sha256 is the digest of the same list without ``entropy``. Matches of a pattern
    are the leftmost ones that do not overlap; of ``assign`` those with a shorter value than 8 are
    dropped after matching. Null counts as empty; a text without secrets has the empty list. Repeated
    rows and null ids are rows like any others; other columns are not read. No table, no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    kinds = {**PATTERNS, "entropy": CANDIDATE}
    rows = rows.select("*", *[F.col("text").rlike(pattern).alias(f"has_{kind}") for kind, pattern in kinds.items()])
    rows = rows.select(
        "doc_id",
        *[
            F.when(F.col(f"has_{kind}"), F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias(f"{kind}_found")
            for kind, pattern in kinds.items()
        ],
        *[
            F.when(F.col(f"has_{kind}"), F.split("text", pattern, -1)).alias(f"{kind}_pieces")
            for kind, pattern in kinds.items()
        ],
    )

    def passes(kind: str):
        if kind == "assign":
            return lambda match: F.length(F.regexp_extract(match, "^" + ASSIGN, 1)) >= LEAST_VALUE
        return lambda match: F.lit(True)

    rows = rows.select(
        "doc_id",
        *[
            found_spans(f"{kind}_found", f"{kind}_pieces", kind, i, passes(kind)).alias(kind)
            for i, kind in enumerate(kinds)
        ],
    )
    rows = rows.withColumn("base", F.array_sort(F.concat(*PATTERNS)))
    strings = F.transform(
        "entropy",
        lambda s: F.transform(
            _segments(s["match"]),
            lambda x: F.struct(
                (s["start"] + x["at"]).alias("start"), s["order"].alias("order"), s["kind"].alias("kind"), x["match"].alias("match")
            ),
        ),
    )
    refused = lambda match: [match.rlike(form) for form in allowed]
    strings = F.filter(F.flatten(strings), lambda s: ~F.greatest(F.lit(False), *refused(s["match"]), F.lit(False)))
    rows = rows.withColumn("strings", strings)
    measured = F.transform(
        "strings",
        lambda s: F.struct(s.alias("span"), suspect_part(s["match"], _threshold(s["match"])).alias("part")),
    )
    rows = rows.withColumn("measured", measured)
    added = F.transform(
        F.filter("measured", lambda m: m["part"]["first"].isNotNull()),
        lambda m: F.struct(
            (m["span"]["start"] + m["part"]["first"]).alias("start"),
            m["span"]["order"].alias("order"),
            (m["span"]["start"] + m["part"]["last"]).alias("end"),
            m["span"]["kind"].alias("kind"),
            m["span"]["match"].alias("match"),
        ),
    )
    rows = rows.withColumn("suspects", _merged(added))
    news = F.filter(
        "suspects", lambda s: ~F.exists("base", lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"]))
    )
    rows = rows.withColumn("added", news)
    return rows.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in PATTERNS],
        F.size("added").cast("long").alias("n_entropy"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )
