"""Language ID by cross-parsing entropy.

A suffix automaton of labelled text per language answers how long a string goes on occurring there.
A word is cut greedily into the longest strings that occur in a language's text; the language that
needs the fewest phrases, weighted by the logarithm of its text's length, wins. Parsing restarts at
every word, so the counts of a word can be remembered.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ._common import kept_in_process, whole_text

UNKNOWN = "und"
#: Documents per language that are drawn to fit on, and characters of text per language and of all languages.
SAMPLE_DOCS, SAMPLE_CHARS, ALL_CHARS = 128, 40_000, 2_560_000
#: Words whose counts a worker remembers, and the longest word that is remembered.
REMEMBERED, LONGEST = 300_000, 64


class SuffixAutomaton:
    """The automaton of all substrings of a text."""

    def __init__(self, text: str):
        self.next: list[dict[str, int]] = [{}]
        link, length = [-1], [0]
        last = 0
        for c in text:
            now = len(length)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and c not in self.next[at]:
                self.next[at][c] = now
                at = link[at]
            if at >= 0:
                to = self.next[at][c]
                if length[to] == length[at] + 1:
                    link[now] = to
                else:
                    copy = len(length)
                    self.next.append(dict(self.next[to]))
                    length.append(length[at] + 1)
                    link.append(link[to])
                    while at >= 0 and self.next[at].get(c) == to:
                        self.next[at][c] = copy
                        at = link[at]
                    link[to] = link[now] = copy
            last = now

    def phrases(self, text: str) -> int:
        """How many phrases a greedy parse into substrings of the automaton's text needs."""
        step, count, at, end = self.next, 0, 0, len(text)
        while at < end:
            state, begin = 0, at
            while at < end:
                state = step[state].get(text[at], -1)
                if state < 0:
                    break
                at += 1
            at = max(at, begin + 1)  # an unseen character is a phrase of its own
            count += 1
        return count


def letters(word: str) -> str:
    """The letters of a word in lower case."""
    word = word.lower()
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


class CrossParser:
    """Phrase counts per language, with the counts of words remembered up to a bound."""

    def __init__(self, references: dict[str, str], remembered: int = REMEMBERED):
        self.languages = sorted(references)
        texts = [" " + " ".join(filter(None, map(letters, references[k].split()))) + " " for k in self.languages]
        self._automata = [SuffixAutomaton(text) for text in texts]
        self._weights = np.array([math.log2(max(2, len(text))) for text in texts])
        self._remembered = remembered
        self._forget()

    def _forget(self) -> None:
        self._index: dict[str, int] = {}
        self._counts = np.zeros((1024, len(self.languages)), np.int32)

    def _count(self, word: str) -> list[int]:
        word = letters(word)
        return [a.phrases(f" {word} ") for a in self._automata] if word else [0] * len(self._automata)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its lead over the next one, 0 to 1."""
        words = text.split() if text else []
        if not self.languages:
            return UNKNOWN, 0.0
        if len(self._index) > self._remembered:
            self._forget()
        total = np.zeros(len(self.languages), np.int64)
        rows = []
        for word in words:
            row = self._index.get(word)
            if row is None:
                counts = self._count(word)
                if len(word) > LONGEST:
                    total += counts
                    continue
                row = self._index[word] = len(self._index)
                if row >= len(self._counts):
                    self._counts = np.concatenate([self._counts, np.zeros_like(self._counts)])
                self._counts[row] = counts
            rows.append(row)
        total += self._counts[rows].sum(axis=0)
        if not total.any():
            return UNKNOWN, 0.0
        bits = total * self._weights
        best = int(bits.argmin())
        if len(bits) == 1:
            return self.languages[best], 1.0
        second = float(np.partition(bits, 1)[1])
        return self.languages[best], min(1.0, max(0.0, 1.0 - float(bits[best]) / second))


def _parser(references: dict[str, str]) -> CrossParser:
    """One parser per worker process; tasks of one model share it."""
    key = hashlib.sha256(repr(sorted(references.items())).encode()).hexdigest()
    return kept_in_process(("languages", key), lambda: CrossParser(references))


def held_out(id_col: str = "doc_id"):
    """Whether the crc32 of the id as text leaves the remainder 1 modulo 3; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
    sample_chars: int = SAMPLE_CHARS,
    all_chars: int = ALL_CHARS,
) -> dict[str, str]:
    """Reference text per language, from a bounded sample of the labelled documents not held out.

    Every language is learned, from up to ``sample_chars`` characters, or its share of ``all_chars`` if there
    are more languages than that suffices for. They come from the beginnings of up to ``sample_docs``
    documents in a fixed pseudo-random order, ``4 * sample_chars / sample_docs`` characters of each (1,250 by default,
    so that 32 long documents fill the text). This bounds what the driver holds.
    """
    labelled = docs.select(
        F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id") & F.col("text").rlike(r"\p{L}"))
    languages = [row.lang for row in labelled.select("lang").distinct().collect()]
    part = max(1, 4 * sample_chars // sample_docs)
    sample_chars = min(sample_chars, max(1, all_chars // max(1, len(languages))))
    sample_docs = min(sample_docs, -(-4 * sample_chars // part))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    sample = (
        labelled.select("lang", "doc_id", F.substring("text", 1, part).alias("text"))
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= sample_docs)
        .collect()
    )
    references = dict.fromkeys(sorted(languages), "")
    for row in sorted(sample, key=lambda row: (row.lang, row.place)):
        if len(references[row.lang]) < sample_chars:
            references[row.lang] += " " + row.text
    return {lang: text[:sample_chars] for lang, text in references.items()}


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(shared.value)
        for batch in batches:
            found = [parser.predict(text.as_py()) for text in batch.column("text")]
            lang, score = zip(*found) if found else ((), ())
            at = batch.schema.get_field_index("text")
            yield pa.RecordBatch.from_arrays(
                [c for i, c in enumerate(batch.columns) if i != at]
                + [pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=[n for i, n in enumerate(batch.schema.names) if i != at] + ["lang_pred", "score"],
            )

    return run


def identify(
    docs: DataFrame, references: dict[str, str], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Only the text is looked at. A text that is null or has no letter is ``und`` with score 0, as is
    every text if nothing was learned; ties go to the first language by name. Repeated rows get the
    same answer; other columns are not read. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(references)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), whole_text(text_col).alias("text")
    )
    schema = rows.select("doc_id", "held_out").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(_predict(shared), schema)


def keep_identified(
    docs: DataFrame,
    references: dict[str, str],
    text_col: str = "text",
    lang_col: str = "lang",
    min_score: float = 0.0,
) -> DataFrame:
    """The documents whose language is known with at least ``min_score``, all columns as they were but
    ``lang_col``, which holds the language that was found."""
    shared = docs.sparkSession.sparkContext.broadcast(references)

    @F.pandas_udf("string")
    def known(texts):
        parser = _parser(shared.value)
        found = [parser.predict(text) for text in texts]
        return texts.__class__([lang if lang != UNKNOWN and score >= min_score else None for lang, score in found], dtype=object)

    # not deterministic only in name: so that the filter does not make it run a second time
    told = docs.withColumn("_found", known.asNondeterministic()(whole_text(text_col))).where("_found IS NOT NULL")
    return told.withColumn(lang_col, F.col("_found")).select(*[F.col(f"`{c}`") for c in docs.columns])
