"""Personal data: what names a person, and what gives away that it does.

Mail addresses, IP addresses, card numbers and phone numbers are found by their form: the protected
entities. A word that keeps standing beside one of them says as much about it as the corpus shows: with
``p`` over documents, the entity carries ``IC = -log p(e)`` of information, and the word reveals
``PMI = log p(e, t) / (p(e) p(t))`` of that. A word that reveals more than the threshold's share of an
entity is generalised, if its general form reveals less, and removed if not, in all documents that name
the entity beside it.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ._common import LOWER, UPPER, stored, whole_text

KINDS = ("email", "ip", "card", "phone")
#: The share of an entity's information beyond which a word discloses it.
THRESHOLD = 0.8
#: A word is evidence once it stands beside an entity in so many documents, in as many surroundings.
SUPPORT = 2
#: Words before and after an entity that are its surroundings.
WINDOW = 8
#: Letters of a word that its general form keeps; of a word with digits it keeps all but these.
PREFIX = 3
GENERAL = "*"  # begins general forms; no trimmed word does
LEAST_LETTERS = 3
#: Words that a task counts or remembers at a time.
REMEMBERED = 1 << 18

#: The forms of the four kinds. Possessive runs match what greedy ones would, in linear time.
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans(UPPER, LOWER)
_ZEROS = str.maketrans("123456789", "000000000")


def _mails(text: str) -> Iterator[tuple[int, int]]:
    """A mail address begins where the run of local characters before its ``@`` does, or where the last one ended."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            end = domain.end()
        at = text.find("@", max(end, at + 1))


def _luhn(digits: str) -> bool:
    doubled = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the four forms in code points, by kind, then start."""
    found = [("email", a, b) for a, b in _mails(text)]
    for m in ADDRESS.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 2 * 19 and 16 <= len(digits := _digits(m.group())) <= 19 and _luhn(digits):
            found.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= len(_digits(m.group())) <= 15:
            found.append(("phone", *m.span()))
    return found


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _entity(kind: str, value: str) -> int:
    """A protected value, however it is written, as a 64-bit number."""
    plain = value.translate(_LOWER) if kind == "email" else value if kind == "ip" else _digits(value)
    return xxhash.xxh64_intdigest(f"{kind}:{plain}") - (1 << 63)


def general(term: str) -> str:
    """A word with digits becomes its pattern, any other one all words with its first letters."""
    pattern = term.translate(_ZEROS)
    return GENERAL + (pattern if "0" in pattern else term[:PREFIX])


def _general(term: Column) -> Column:
    pattern = F.translate(term, "123456789", "000000000")
    return F.concat(F.lit(GENERAL), F.when(F.contains(pattern, F.lit("0")), pattern).otherwise(F.substring(term, 1, PREFIX)))


@dataclass
class Beside:
    """What stands beside the entities of one text."""

    entities: list[int]
    evidence: list[dict]  # entity, term (a word or a general form), and the surroundings it was seen in
    terms: list[dict]  # the words, with all their places in the text


def beside(text: str, spans: list[tuple[str, int, int]]) -> Beside:
    lowered = text.translate(_LOWER)
    marked = sorted((start, end) for _, start, end in spans)
    words: list[tuple[int, int, str]] = []  # outside the entities
    before: dict[int, int] = {}  # by where an entity starts: the words before it
    k, reached = 0, 0
    for m in _WORD.finditer(lowered):
        while k < len(marked) and marked[k][0] < m.end():
            before.setdefault(marked[k][0], len(words))
            reached = max(reached, marked[k][1])
            k += 1
        if m.start() >= reached:
            bare = m.group().strip(string.punctuation)
            at = m.start() + m.group().find(bare)
            words.append((at, at + len(bare), bare))
    for start, _ in marked[k:]:
        before.setdefault(start, len(words))
    seen: dict[tuple[int, str], set[int]] = {}
    entities, chosen = set(), set()
    for kind, start, end in spans:
        entity = _entity(kind, text[start:end])
        entities.add(entity)
        here = before[start]
        around = words[max(0, here - WINDOW) : here + WINDOW]
        surrounding = xxhash.xxh64_intdigest(" ".join(w for _, _, w in around)) - (1 << 63)
        for _, _, term in around:
            if len(term) >= LEAST_LETTERS and any(map(str.isalnum, term)):
                chosen.add(term)
                for form in (term, general(term)):
                    seen.setdefault((entity, form), set()).add(surrounding)
    places: dict[str, list[int]] = {term: [] for term in sorted(chosen)}
    for start, end, term in words:
        if term in places:
            places[term] += (start, end)
    return Beside(
        sorted(entities),
        [{"entity": e, "term": t, "windows": sorted(w)} for (e, t), w in sorted(seen.items())],
        [{"term": t, "places": p} for t, p in places.items()],
    )


_BASE = (
    "row long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, entities array<long>, "
    "evidence array<struct<entity:long,term:string,windows:array<long>>>, terms array<struct<term:string,places:array<int>>>"
)
_EVIDENCE = pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.string()), ("windows", pa.list_(pa.int64()))]))
_TERMS = pa.list_(pa.struct([("term", pa.string()), ("places", pa.list_(pa.int32()))]))


def _scan(carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {kind: [] for kind in KINDS}
            base, digests, near = [], [], []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text)
                for kind in KINDS:
                    counts[kind].append(sum(s[0] == kind for s in spans))
                base.append(listed(spans))
                digests.append(hashlib.sha256(base[-1].encode()).hexdigest())
                near.append(beside(text, spans) if spans else Beside([], [], []))
            yield pa.RecordBatch.from_pydict(
                {
                    "row": batch.column("row"),
                    **{f"n_{kind}": pa.array(counts[kind], pa.int64()) for kind in KINDS},
                    "base_sha256": pa.array(digests, pa.string()),
                    "base": pa.array(base, pa.string()),
                    "entities": pa.array([n.entities for n in near], pa.list_(pa.int64())),
                    "evidence": pa.array([n.evidence for n in near], _EVIDENCE),
                    "terms": pa.array([n.terms for n in near], _TERMS),
                    **{name: batch.column(name) for name in carried},
                }
            )

    return run


def find_entities(docs: DataFrame, carried: dict[str, Column], text_col: str) -> DataFrame:
    """One row per document with its base spans and what stands beside them, written once."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        whole_text(text_col).alias("text"),
        *[column.alias(name) for name, column in carried.items()],
    )
    extra = T.StructType([f for f in rows.schema.fields if f.name in carried])
    schema = T.StructType([*T._parse_datatype_string(_BASE).fields, *extra.fields])
    return stored(rows.mapInArrow(_scan(list(carried)), schema), "personal_data")


class _Forms:
    """The bare and the general form of words as they stand in texts, remembered up to a bound."""

    def __init__(self):
        self._known: dict[str, tuple[str, str]] = {}

    def __call__(self, word: str) -> tuple[str, str]:
        known = self._known.get(word)
        if known is None:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            bare = word.translate(_LOWER).strip(string.punctuation)
            known = self._known[word] = (bare, general(bare))
        return known


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the documents of a task, passed on whenever there are many words."""
    forms, counts = _Forms(), Counter()

    def told() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pydict(
            {"term": pa.array(counts.keys(), pa.string()), "documents": pa.array(counts.values(), pa.int64())}
        )
        counts.clear()
        return batch

    for batch in batches:
        for text in batch.column("text").to_pylist():
            words = {word for word in _WORD.findall(text) if len(word) >= LEAST_LETTERS}
            counts.update({form for word in words for form in forms(word)})
            if len(counts) >= REMEMBERED:
                yield told()
    yield told()


def document_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """term, documents: of every word and every general form the number of documents that have it."""
    counted = docs.select(whole_text(text_col).alias("text")).mapInArrow(_count, "term string, documents long")
    return counted.groupBy("term").agg(F.sum("documents").alias("documents"))


def disclosing_terms(
    found: DataFrame, counts: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT
) -> DataFrame:
    """entity, term, action: the words that disclose an entity, and whether to generalise or to remove them."""
    evidence = found.where(F.size("evidence") > 0).select(F.explode("evidence").alias("e")).select("e.*")
    measured = (
        evidence.select("entity", "term", F.posexplode("windows").alias("place", "window"))
        .groupBy("entity", "term", "window")
        .agg(F.count_if(F.col("place") == 0).alias("documents"))
        .groupBy("entity", "term")
        .agg(F.sum("documents").alias("joint"), F.count("*").alias("windows"))
    )
    measured = stored(measured, "beside")
    named = found.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("named"))
    total = found.count()
    enough = (F.col("joint") >= support) & (F.col("windows") >= support) & ~F.startswith("term", F.lit(GENERAL))
    suspects = measured.where(enough).select("entity", "term", "joint", _general(F.col("term")).alias("general"))
    suspects = stored(suspects.join(named.where(F.col("named") < total), "entity"), "suspects")
    asked = suspects.select(F.explode(F.array("term", "general")).alias("term")).distinct()
    known = stored(counts.join(asked, "term"), "counts")

    def share(joint: str, documents: str) -> Column:
        return F.log(F.col(joint) * total / (F.col("named") * F.col(documents))) / F.log(F.lit(total) / F.col("named"))

    wide = measured.select("entity", F.col("term").alias("general"), F.col("joint").alias("general_joint"))
    return (
        suspects.join(known, "term")
        .where(share("joint", "documents") >= threshold)
        .join(known.select(F.col("term").alias("general"), F.col("documents").alias("general_documents")), "general")
        .join(wide, ["entity", "general"])
        .select(
            "entity",
            "term",
            F.when(share("general_joint", "general_documents") < threshold, F.lit("generalise"))
            .otherwise(F.lit("remove"))
            .alias("action"),
        )
    )


def _with_spans(docs: DataFrame, carried: dict[str, Column], text_col: str, threshold: float, support: int) -> DataFrame:
    found = find_entities(docs, carried, text_col)
    terms = stored(disclosing_terms(found, document_counts(docs, text_col), threshold, support), "disclosing")
    near = found.where(F.size("evidence") > 0).select("row", F.explode("evidence").alias("e"))
    hits = near.select("row", "e.entity", "e.term").join(terms, ["entity", "term"])
    hits = hits.groupBy("row", "term").agg(F.max("action").alias("action"))  # removing is the stronger one
    hits = hits.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("term", "action"))).alias("actions"))

    def placed(t: Column) -> Column:
        action = F.get(F.map_values(F.map_filter("actions", lambda k, _: k == t["term"])), F.lit(0))
        starts = F.sequence(F.lit(0), F.size(t["places"]) - 2, F.lit(2))
        return F.transform(
            starts,
            lambda i: F.struct(
                action.alias("kind"), F.get(t["places"], i).alias("start"), F.get(t["places"], i + 1).alias("end")
            ),
        )

    told = F.filter("terms", lambda t: F.map_contains_key("actions", t["term"]))
    spans = F.sort_array(F.flatten(F.transform(told, placed)))
    text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    with_hits = found.where(F.size("evidence") > 0).join(hits, "row", "left").withColumn(
        "spans", F.concat_ws(",", "base", F.when(F.col("actions").isNotNull(), F.concat_ws(",", text)))
    )
    plain = found.where(F.size("evidence") == 0).withColumn("spans", F.col("base"))
    columns = [c for c in plain.columns if c not in ("entities", "evidence", "terms")]
    return plain.select(*columns).unionByName(with_hits.select(*columns))


def personal_data(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    support: int = SUPPORT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    ``spans`` lists kind:start:end in code points: the four forms first, then the words to generalise and
    to remove. Null texts count as empty and have no spans; rows without an id and repeated rows are
    rows like any other (an exact copy adds documents, but no surroundings, so copies alone are no
    evidence). Documents that name no entity are left alone. Other columns are not read; an empty
    table gives no rows.
    """
    rows = _with_spans(docs, {"doc_id": F.col(id_col)}, text_col, threshold, support)
    return rows.select("doc_id", *[f"n_{kind}" for kind in KINDS], "base_sha256", "spans")


def sanitised_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced: a form by its kind, a word by its general form or a blank mark.
    Of spans that overlap the first stands for all."""
    parts, end = [], 0
    for start, stop, kind in sorted((a, b, k) for k, a, b in spans):
        if start >= end:
            general_form = general(text[start:stop].translate(_LOWER))[len(GENERAL) :] + GENERAL
            parts += [text[end:start], general_form if kind == "generalise" else "[...]" if kind == "remove" else f"[{kind}]"]
        end = max(end, stop)
    return "".join(parts) + text[end:]


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            pieces = [s.split(":") for s in spans.split(",")] if spans else []
            texts.append(text if text is None else sanitised_text(text, [(k, int(a), int(b)) for k, a, b in pieces]))
        yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(texts, pa.string())], names=["kept", "text"])


def sanitise(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    support: int = SUPPORT,
    text_col: str = "text",
) -> DataFrame:
    """The documents, all columns as they were, with what ``personal_data`` finds taken out of the text.

    Texts of documents without an entity are not shuffled. A null text stays null.
    """
    kept = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    rows = _with_spans(docs, {"kept": kept}, text_col, threshold, support)
    text = F.col(f"kept.c{docs.columns.index(text_col)}").cast("string").alias("text")
    schema = T.StructType([rows.schema["kept"], T.StructField("text", T.StringType())])
    rewritten = rows.select("kept", text, "spans").mapInArrow(_rewrite, schema)
    return rewritten.select(
        *[(F.col("text") if c == text_col else F.col(f"kept.c{i}")).alias(c) for i, c in enumerate(docs.columns)]
    )
