"""Best-fit packing: tokenized documents are packed into sequences of a fixed length.

Bounded-space online best-fit: a task keeps a fixed number of open sequences, filed by their free
space; a bitset over the free spaces finds the fullest sequence that still takes a piece. When too
many are open, the fullest one is closed.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ._common import LOWER, UPPER, kept_in_process, stored, whole_text

SEQUENCE = 2048
#: Sequences a task holds open, and pieces that it takes on average, 24 bytes each.
OPEN, PIECES_PER_TASK = 16_384, 20_000
#: Parts, and words, whose ids a worker remembers, some 400 bytes each; when full it starts anew.
REMEMBERED = 1_000_000
#: Texts that are tokenized together.
TEXTS_AT_ONCE = 256
#: Closing marks of a part: ASCII signs that the tokenizer keeps apart from letters. A quote is not
#: among them, as it may belong to a contraction, nor is a sign of the tokenizer's special tokens.
MARKS = ".,!?;:$%&#*"
_FOLDED = str.maketrans(UPPER, LOWER)

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = _PIECES + ", sequence_id long, offset long"


class WordIds:
    """Packed ids of whole texts, put together from the ids of their parts between blanks.

    The tokenizer never joins anything across a blank, so the ids of a text are those of its parts in
    order. A part of letters and closing marks is a word and a run of marks to the tokenizer, and A-Z
    are folded. Parts and words repeat; their ids are remembered up to a bound.
    """

    def __init__(self, tokenizer_file: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self._remembered = remembered
        self._tokenizer = Tokenizer.from_file(tokenizer_file)
        vocabulary = self._tokenizer.get_vocab()
        self._ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._parts: dict[str, bytes] = {}
        self._words: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = [text.replace("\n", " ").split(" ") for text in texts]
        if len(self._parts) > self._remembered:
            self._parts.clear()
        missing = set().union(*split).difference(self._parts)
        if missing:
            self._learn(missing)
        known = self._parts.__getitem__
        return [b"".join(map(known, parts)) for parts in split]

    def _learn(self, parts: set[str]) -> None:
        if len(self._words) > self._remembered:
            self._words.clear()
        composed, others = [], []
        for part in parts:
            word = part.rstrip(MARKS)
            if word.isalpha():
                folded = word.translate(_FOLDED) if word.isascii() else word
                composed.append((part, folded, part[len(word) :]))
            else:
                others.append(part)
        new = {word for _, word, _ in composed}.difference(self._words)
        self._words.update(self._of_words(list(new)))
        marks = {mark for _, _, mark in composed}.difference(self._words)
        self._words.update(self._one_by_one(list(marks)))
        for part, word, mark in composed:
            self._parts[part] = self._words[word] + self._words[mark]
        self._parts.update(self._one_by_one(others))

    def _of_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words of letters: in one text, cut after each token that ends a word."""
        if not words:
            return {}
        ids = np.array(self._tokenizer.encode(" ".join(words), add_special_tokens=False).ids, "<u4")
        ends = (4 * (np.flatnonzero(self._ends_word[ids]) + 1)).tolist()
        if len(ends) != len(words):
            return self._one_by_one(words)
        data = ids.tobytes()
        return {word: data[a:b] for word, a, b in zip(words, [0, *ends], ends)}

    def _one_by_one(self, parts: list[str]) -> dict[str, bytes]:
        found = self._tokenizer.encode_batch(parts, add_special_tokens=False) if parts else []
        return {part: np.array(x.ids, "<u4").tobytes() for part, x in zip(parts, found)}


def _encoder(tokenizer_file: str, remembered: int) -> WordIds:
    """One encoder per worker process; its tasks share what it remembers."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
    return kept_in_process(("ids", tokenizer_file, remembered), lambda: WordIds(tokenizer_file, remembered))


def _tokenize(tokenizer_file: str, size: int, remembered: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_file, remembered)
        step = 4 * size
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                rows: list[tuple] = []
                encoded = encoder.encode(batch.column("text").to_pylist())
                for doc_id, data in zip(batch.column("doc_id").to_pylist(), encoded):
                    data += b"\0\0\0\0"
                    for piece, begin in enumerate(range(0, len(data), step)):
                        part = data[begin : begin + step]
                        rows.append((doc_id, piece, begin // 4, len(part) // 4, zlib.crc32(part)))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


class BestFit:
    """Online best-fit over at most ``most`` open sequences of ``size`` tokens."""

    def __init__(self, size: int, most: int):
        self._size, self._most = size, most
        self._by_free: list[list[int]] = [[] for _ in range(size + 1)]
        self._bits = 0  # bit f is set when a sequence with f free tokens is open
        self._open = 0
        self._made = 0

    def put(self, length: int) -> tuple[int, int]:
        """The sequence that takes the piece and the place in it."""
        fitting = self._bits >> length << length
        if fitting:
            free = (fitting & -fitting).bit_length() - 1
            sequence = self._take(free)
        else:
            sequence, free = self._made, self._size
            self._made += 1
            if self._open >= self._most:
                self._take((self._bits & -self._bits).bit_length() - 1)  # the fullest closes
        left = free - length
        if left:
            self._by_free[left].append(sequence)
            self._bits |= 1 << left
            self._open += 1
        return sequence, self._size - free

    def _take(self, free: int) -> int:
        same = self._by_free[free]
        sequence = same.pop()
        if not same:
            self._bits &= ~(1 << free)
        self._open -= 1
        return sequence


def _pack(size: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = BestFit(size, most)
        for batch in batches:
            if not batch.num_rows:
                continue
            first = batch.column("task")[0].as_py() << 40
            placed = [bins.put(length) for length in batch.column("length").to_pylist()]
            sequence, offset = zip(*placed)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(5)]
                + [pa.array([first + s for s in sequence], pa.int64()), pa.array(offset, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer_file: str,
    size: int = SEQUENCE,
    most_open: int = OPEN,
    pieces_per_task: int = PIECES_PER_TASK,
    remembered: int = REMEMBERED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and a closing 0; null counts as empty, so it is the closing 0 alone. Only
    documents longer than ``size`` are cut. Repeated rows and repeated or null ids are packed like
    any others; other columns are not read. The ids stay with the documents: only the sizes of the
    pieces are shuffled, pseudo-randomly but always alike, to tasks of about ``pieces_per_task`` pieces,
    which take the longest first, as best-fit then leaves the least space. ``remembered`` words take memory
    of a worker and save time. An empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    pieces = stored(texts.mapInArrow(_tokenize(tokenizer_file, size, remembered), _PIECES), "pieces")
    tasks = max(2, -(-pieces.count() // pieces_per_task))
    order = F.xxhash64("doc_id", "piece", "ids_crc32")
    return (
        pieces.repartition(tasks, order)
        .sortWithinPartitions(F.desc("length"), "doc_id", "piece", "ids_crc32")
        .withColumn("task", F.spark_partition_id().cast("long"))
        .mapInArrow(_pack(size, most_open), _PACKED)
    )
