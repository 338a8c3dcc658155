"""Suffix-array dedup: bytes covered by a string of 50 bytes that an earlier document has too.

1. Sampled q-gram buckets. Every window of 50 bytes elects one of its q-grams (the one of least hash,
   the leftmost of equals), so equal windows elect equal q-grams at the same place. The elected q-grams
   are bucketed by hash; buckets of a single document are settled and need nothing further.
2. For the others the documents send the text that the windows of the election cover. Equal texts
   are merged where they arise, with the smallest document: any later document with the same text is
   covered. So a passage that very many documents share is one text per task.
3. Texts that differ are refined by bucket pointers: their suffixes are bucketed by the first eight
   bytes, and buckets with several members are sorted by the bucket identifiers of the suffixes at a
   later offset, first 8, then 16, then 18 bytes on. Each round reuses the identifiers that the round
   before has refined, so that depth 8 becomes 16, 32 and 50. Suffixes left in one bucket begin with the
   same 50 bytes, and the smallest document of the bucket covers all later ones.
4. The covered ranges go back to the documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from ._common import partitions, whole_text

#: Bytes of a window and of a q-gram.
LEAST, GRAM = 50, 20
#: Bytes that are looked at at once, and documents of a group.
SLAB, GROUP_DOCS = 1 << 22, 2000
_NO_ID = (1 << 63) - 1
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xBF58476D1CE4E5B9)]
_HASH_BYTES = 6
_HASH_MASK = np.uint64((1 << 48) - 1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the 20 bytes from each position on; ``data`` is followed by 4 spare bytes at least."""
    n = len(data) - GRAM - 4 + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    base = np.ascontiguousarray(data)

    def words(at: int) -> np.ndarray:
        return np.ndarray((n,), "<u8", base, at, (1,))

    value = words(0) * _MIX[0]
    value ^= value >> np.uint64(29)
    value += words(8)
    value *= _MIX[1]
    value ^= value >> np.uint64(32)
    value += words(16) & np.uint64(0xFFFFFFFF)
    value *= _MIX[2]
    value ^= value >> np.uint64(29)
    value *= _MIX[3]
    value ^= value >> np.uint64(32)
    return value


def elections(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that elect the same q-gram: (hash, place of the q-gram, first and last window).

    ``data`` holds texts back to back that end at ``ends``, and 4 spare bytes. No window crosses an end.
    """
    hashes = gram_hashes(data)
    span = LEAST - GRAM + 1
    n = len(hashes) - span + 1
    if n <= 0:
        empty = np.empty(0, np.int64)
        return np.empty(0, np.uint64), empty, empty, empty
    # one mask for slabs of any length, so that equal windows elect alike wherever they stand
    bits = np.uint64((SLAB + LEAST + 4).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: n], least[span - width :][:n])
    elected = (least & low).astype(np.int64)
    # windows may begin up to LEAST bytes before an end
    inside = np.ones(n + 1, np.int32)
    inside[0] = 0
    change = np.zeros(n + 1, np.int32)
    begins = np.concatenate([[0], ends[:-1]])
    first_bad = np.maximum(ends - LEAST + 1, begins)
    np.add.at(change, np.minimum(first_bad, n), 1)
    np.add.at(change, np.minimum(ends, n), -1)
    valid = np.cumsum(change[:-1]) == 0
    starts = np.flatnonzero(valid)
    if not len(starts):
        empty = np.empty(0, np.int64)
        return np.empty(0, np.uint64), empty, empty, empty
    chosen = elected[starts]
    new = np.flatnonzero((np.diff(chosen) != 0) | (np.diff(starts) != 1)) + 1
    first = starts[np.concatenate([[0], new])]
    last = starts[np.concatenate([new - 1, [len(starts) - 1]])]
    place = elected[first]
    return hashes[place] & _HASH_MASK, place, first, last


def slabs(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in pieces of bounded size: (data, ends, number of the text, offset in the text). Long
    texts are cut so that every window lies in one piece."""
    parts: list[bytes] = []
    owners: list[int] = []
    offsets: list[int] = []
    size = 0

    def flush():
        ends = np.cumsum([len(part) for part in parts])
        data = np.frombuffer(b"".join(parts) + b"\0\0\0\0", np.uint8)
        return data, ends, np.array(owners), np.array(offsets)

    for number, text in enumerate(texts):
        for at in range(0, max(len(text) - LEAST + 1, 0), SLAB):
            part = text[at : at + SLAB + LEAST - 1]
            if size + len(part) > SLAB and parts:
                yield flush()
                parts, owners, offsets, size = [], [], [], 0
            parts.append(part)
            owners.append(number)
            offsets.append(at)
            size += len(part)
    if parts:
        yield flush()


def _short(hashes: np.ndarray) -> bytes:
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_HASH_BYTES].tobytes()


def _long(data: bytes) -> np.ndarray:
    short = np.frombuffer(data, np.uint8).reshape(-1, _HASH_BYTES)
    full = np.zeros((len(short), 8), np.uint8)
    full[:, :_HASH_BYTES] = short
    return full.view("<u8").reshape(-1).astype(np.uint64)


_GRAMS = "bucket int, docs binary, counts binary, hashes binary"


def _elect(buckets: int):
    """Distinct (document, hash) of the elections, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            for data, ends, owners, _ in slabs(batch.column("text").to_pylist()):
                hashes, place, _, _ = elections(data, ends)
                if not len(hashes):
                    continue
                doc = ids[owners[np.searchsorted(ends, place, side="right")]]
                bucket = (hashes % np.uint64(buckets)).astype(np.int64)
                order = np.lexsort((hashes, doc, bucket))
                hashes, doc, bucket = hashes[order], doc[order], bucket[order]
                new = np.concatenate([[True], (np.diff(bucket) != 0) | (np.diff(doc) != 0) | (np.diff(hashes) != 0)])
                hashes, doc, bucket = hashes[new], doc[new], bucket[new]
                yield _by_bucket(bucket, doc, hashes, ["bucket", "docs", "counts", "hashes"])

    return run


def _by_bucket(bucket: np.ndarray, doc: np.ndarray, hashes: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """One row per bucket, from entries sorted by bucket and document."""
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    rows = []
    for part in np.split(np.arange(len(bucket)), cuts) if len(bucket) else []:
        lo, hi = part[0], part[-1] + 1
        begins = np.concatenate([[0], np.flatnonzero(np.diff(doc[lo:hi])) + 1])
        counts = np.diff(np.concatenate([begins, [hi - lo]]))
        rows.append(
            (
                int(bucket[lo]),
                doc[lo:hi][begins].astype("<i8").tobytes(),
                counts.astype("<u4").tobytes(),
                _short(hashes[lo:hi]),
            )
        )
    columns = list(zip(*rows)) or [()] * 4
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _entries(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    docs, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for d, c, h in zip(*(table.column(k).to_pylist() for k in ("docs", "counts", "hashes"))):
        docs.append(np.repeat(np.frombuffer(d, "<i8"), np.frombuffer(c, "<u4")))
        hashes.append(_long(h))
    return np.concatenate(docs), np.concatenate(hashes)


def _group_of(doc: np.ndarray, groups: int) -> np.ndarray:
    mixed = doc.view(np.uint64) * _MIX[0]
    return ((mixed >> np.uint64(33)) % np.uint64(groups)).astype(np.int64)


def _shared(groups: int):
    """Of a bucket, the (document, hash) whose hash several documents have, by group of documents."""

    def run(table: pa.Table) -> pa.Table:
        docs, hashes = _entries(table)
        order = np.lexsort((docs, hashes))
        docs, hashes = docs[order], hashes[order]
        begins = np.concatenate([[True], np.diff(hashes) != 0]) if len(hashes) else np.empty(0, bool)
        run_of = np.cumsum(begins) - 1
        first = np.flatnonzero(begins)
        last = np.concatenate([first[1:] - 1, [len(hashes) - 1]]) if len(first) else first
        several = (docs[first] != docs[last])[run_of] if len(first) else np.empty(0, bool)
        docs, hashes = docs[several], hashes[several]
        group = _group_of(docs, groups)
        order = np.lexsort((docs, group))
        return pa.Table.from_batches(
            [_by_bucket(group[order], docs[order], hashes[order], ["grp", "docs", "counts", "hashes"])]
        )

    return run


#: What documents send: the texts of shared elections, or ranges that are settled already.
_CONTEXTS = "bucket int, settled boolean, data binary"
_ENTRY = np.dtype([("hash", "<u8"), ("doc", "<i8"), ("tag", "<u4"), ("first", "<i8"), ("size", "<u2")])
_RANGE = np.dtype([("doc", "<i8"), ("tag", "<u4"), ("begin", "<i8"), ("end", "<i8")])


def _pack_contexts(entries: list[tuple], texts: list[bytes]) -> bytes:
    head = np.array(entries, _ENTRY)
    plain = len(head).to_bytes(8, "little") + head.tobytes() + b"".join(texts)
    return zstandard.ZstdCompressor(level=6).compress(plain)


def _unpack_contexts(data: bytes) -> tuple[np.ndarray, list[bytes]]:
    data = zstandard.ZstdDecompressor().decompress(data)
    n = int.from_bytes(data[:8], "little")
    head = np.frombuffer(data, _ENTRY, n, 8)
    ends = 8 + n * _ENTRY.itemsize + np.cumsum(head["size"].astype(np.int64))
    return head, [data[e - s : e] for e, s in zip(ends.tolist(), head["size"].tolist())]


def merge_ranges(ranges: np.ndarray) -> np.ndarray:
    """Ranges of rows united where they meet."""
    if not len(ranges):
        return ranges
    ranges = np.sort(ranges, order=["doc", "tag", "begin", "end"])
    owner = np.concatenate([[0], np.cumsum((np.diff(ranges["doc"]) != 0) | (np.diff(ranges["tag"].astype(np.int64)) != 0))])
    # within an owner, the furthest end so far; owners are kept apart by a large step
    step = np.int64(int(ranges["end"].max()) + 2)
    begin, end = ranges["begin"] + owner * step, ranges["end"] + owner * step
    reach = np.maximum.accumulate(end)
    new = np.concatenate([[True], begin[1:] > reach[:-1]])
    first = np.flatnonzero(new)
    out = ranges[first].copy()
    out["end"] = reach[np.concatenate([first[1:] - 1, [len(ranges) - 1]])] - owner[first] * step
    return out


def _send(buckets: int):
    """The texts of shared elections of a group of documents; equal ones are settled within the group."""

    def run(key, docs: pa.Table, shared: pa.Table) -> pa.Table:
        rows = []
        if shared.num_rows and docs.num_rows:
            hit_docs, hit_hashes = _entries(shared)
            hits = np.unique(_pair(hit_docs, hit_hashes))
            texts = docs.column("text").to_pylist()
            ids = docs.column("id").to_numpy()
            tags = docs.column("tag").to_numpy()
            found: dict[tuple[int, bytes], list[tuple[int, int, int]]] = {}
            for data, ends, owners, offsets in slabs(texts):
                hashes, place, first, last = elections(data, ends)
                if not len(hashes):
                    continue
                part = np.searchsorted(ends, place, side="right")
                text = owners[part]
                hit = np.flatnonzero(_member(_pair(ids[text], hashes), hits))
                begins = np.concatenate([[0], ends[:-1]])
                raw = data.tobytes()
                for h, t, a, b, o in zip(
                    hashes[hit].tolist(),
                    text[hit].tolist(),
                    first[hit].tolist(),
                    last[hit].tolist(),
                    (offsets[part] - begins[part])[hit].tolist(),
                ):
                    found.setdefault((h, raw[a : b + LEAST]), []).append((int(ids[t]), int(tags[t]), a + o))
            sent: dict[int, tuple[list, list]] = {}
            settled: list[tuple] = []
            for (h, text), places in found.items():
                least = min(places)[0]
                for doc, tag, at in places:
                    if doc == least:
                        entries, texts_sent = sent.setdefault(h % buckets, ([], []))
                        entries.append((h, doc, tag, at, len(text)))
                        texts_sent.append(text)
                    else:
                        settled.append((doc, tag, at, at + len(text)))
            rows = [(bucket, False, _pack_contexts(*both)) for bucket, both in sent.items()]
            if settled:
                ranges = merge_ranges(np.array(settled, _RANGE))
                rows.append((int(key[0].as_py()) % buckets, True, ranges.tobytes()))
        columns = list(zip(*rows)) or [()] * 3
        kinds = [pa.int32(), pa.bool_(), pa.binary()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["bucket", "settled", "data"])

    return run


def _pair(docs: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """One number per (document, hash); a collision only sends a text that nothing equals."""
    value = docs.view(np.uint64) * _MIX[1] ^ hashes * _MIX[0]
    return value ^ value >> np.uint64(31)


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return among[at] == values


def bucket_pointers(text: np.ndarray, room: np.ndarray, depth: int = LEAST) -> np.ndarray:
    """Bucket identifiers of the suffixes by their first ``depth`` bytes.

    ``room`` is how many bytes of its own text follow each position; identifiers are right where that
    is ``depth`` at least. A bucket is named by the place of its last member in sorted order, so that
    refining one leaves the names of all others as they are.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.ndarray((n,), ">u8", padded, 0, (1,)).astype(np.uint64)
    order = np.argsort(words, kind="stable")
    ends = np.concatenate([np.flatnonzero(np.diff(words[order])), [n - 1]])
    sizes = np.diff(np.concatenate([[-1], ends]))
    pointer = np.empty(n, np.int64)
    pointer[order] = np.repeat(ends, sizes)
    members = np.empty(n, np.int64)
    members[order] = np.repeat(sizes, sizes)
    have = 8
    while have < depth:
        offset = min(have, depth - have)
        have += offset
        some = np.flatnonzero((room >= have) & (members > 1))
        if not len(some):
            break
        parent, later = pointer[some], pointer[some + offset]
        order = np.lexsort((later, parent))
        parent, later, some = parent[order], later[order], some[order]
        last = np.arange(len(some))
        parent_end = _last_of_run(parent != np.roll(parent, -1), last)
        child = (parent != np.roll(parent, -1)) | (later != np.roll(later, -1))
        child[-1] = True
        child_end = _last_of_run(child, last)
        pointer[some] = parent - (parent_end - child_end)
        begins = np.concatenate([[0], np.flatnonzero(child)[:-1] + 1])
        sizes = np.diff(np.concatenate([begins, [len(some)]]))
        members[some] = np.repeat(sizes, sizes)
    return pointer


def _last_of_run(is_end: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The place of the end of the run that each place lies in."""
    is_end = is_end.copy()
    is_end[-1] = True
    ends = np.flatnonzero(is_end)
    return ends[np.searchsorted(ends, places)]


def _settle(table: pa.Table, groups: int) -> pa.Table:
    """The ranges that an earlier document covers, by group of documents."""
    ranges = [np.empty(0, _RANGE)]
    heads, texts = [np.empty(0, _ENTRY)], []
    for settled, data in zip(table.column("settled").to_pylist(), table.column("data").to_pylist()):
        if settled:
            ranges.append(np.frombuffer(data, _RANGE))
        else:
            head, parts = _unpack_contexts(data)
            heads.append(head)
            texts += parts
    head = np.concatenate(heads)
    if len(head):
        number: dict[tuple[int, bytes], int] = {}
        of = np.array([number.setdefault(key, len(number)) for key in zip(head["hash"].tolist(), texts)])
        least = np.full(len(number), _NO_ID, np.int64)
        np.minimum.at(least, of, head["doc"])
        later = head["doc"] > least[of]
        ranges.append(_as_ranges(head[later], 0, head[later]["size"].astype(np.int64)))
        ranges.append(_refine(head[~later], of[~later], list(number), least))
    found = merge_ranges(np.concatenate(ranges))
    group = _group_of(found["doc"].copy(), groups)
    order = np.argsort(group, kind="stable")
    group, found = group[order], found[order]
    begins = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1]) if len(group) else []
    rows = [(int(group[a]), part.tobytes()) for a, part in zip(begins, np.split(found, begins[1:]) if len(group) else [])]
    columns = list(zip(*rows)) or [()] * 2
    return pa.Table.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary())], names=["grp", "ranges"])


def _as_ranges(head: np.ndarray, begin, end) -> np.ndarray:
    out = np.empty(len(head), _RANGE)
    out["doc"], out["tag"] = head["doc"], head["tag"]
    out["begin"], out["end"] = head["first"] + begin, head["first"] + end
    return out


def _refine(head: np.ndarray, of: np.ndarray, keys: list[tuple[int, bytes]], least: np.ndarray) -> np.ndarray:
    """Ranges of texts that differ from the others of their q-gram, by the suffixes they share."""
    hashes = np.array([h for h, _ in keys], np.uint64)
    _, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    open_texts = np.flatnonzero(counts[inverse] > 1)
    if not len(open_texts):
        return np.empty(0, _RANGE)
    sizes = np.array([len(keys[i][1]) for i in open_texts])
    ends = np.cumsum(sizes)
    text = np.frombuffer(b"".join(keys[i][1] for i in open_texts), np.uint8)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    room = ends[owner] - np.arange(len(text))
    pointer = bucket_pointers(text, room)
    windows = np.flatnonzero(room >= LEAST)
    doc = least[open_texts][owner[windows]]
    first = np.full(len(text), _NO_ID, np.int64)
    np.minimum.at(first, pointer[windows], doc)
    covered = np.zeros(len(text), bool)
    covered[windows] = first[pointer[windows]] < doc
    # each entry of such a text has the ranges that its windows cover
    place = np.full(len(keys), -1, np.int64)
    place[open_texts] = np.arange(len(open_texts))
    begins = ends - sizes
    found = []
    for entry in np.flatnonzero(place[of] >= 0):
        k = place[of[entry]]
        hit = np.flatnonzero(covered[begins[k] : ends[k]])
        if len(hit):
            cut = np.flatnonzero(np.diff(hit) > LEAST) + 1
            for run in np.split(hit, cut) if len(cut) else [hit]:
                found.append((head[entry]["doc"], head[entry]["tag"], head[entry]["first"] + run[0], head[entry]["first"] + run[-1] + LEAST))
    return np.array(found, _RANGE)


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _remove(with_text: bool):
    def run(key, docs: pa.Table, covered: pa.Table) -> pa.Table:
        parts = [np.frombuffer(data, _RANGE) for data in covered.column("ranges").to_pylist()]
        ranges = merge_ranges(np.concatenate(parts)) if parts else np.empty(0, _RANGE)
        by_row: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for doc, tag, begin, end in ranges.tolist():
            by_row.setdefault((doc, tag), []).append((begin, end))
        rows = []
        for doc, tag, text in zip(*(docs.column(k).to_pylist() for k in ("id", "tag", "text"))):
            gone = by_row.get((doc, tag), [])
            kept, at = [], 0
            for begin, end in gone:
                kept.append(text[at:begin])
                at = end
            kept.append(text[at:])
            rest = b"".join(kept)
            rows.append(
                (None if doc == _NO_ID else doc, len(text), len(text) - len(rest), len(gone), hashlib.sha256(rest).hexdigest())
                + ((rest,) if with_text else ())
            )
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text
        kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * with_text
        columns = list(zip(*rows)) or [()] * len(names)
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def remove_repeats(
    docs: DataFrame, with_text: bool = False, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, as bytes).

    Texts are bytes in UTF-8; null counts as empty. Every byte is removed that lies in a string of 50
    bytes which also starts in a document with a smaller id; all strings are judged on the input, and
    overlaps count. n_spans are the maximal removed runs. A null id is greater than any other. Rows that
    repeat an id are not earlier than one another; texts below 50 bytes lose nothing. Other columns
    are not read. An empty table gives no rows.

    ``buckets`` (16 per shuffle partition by default) bounds what a task holds of the q-grams.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    buckets = buckets or 16 * n
    groups = max(1, -(-docs.count() // GROUP_DOCS))
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"), whole_text(text_col).cast("binary").alias("text")
    )
    grams = rows.mapInArrow(_elect(buckets), _GRAMS)
    shared = grams.groupBy("bucket").applyInArrow(_shared(groups), "grp int, docs binary, counts binary, hashes binary")
    tagged = rows.select(
        _group_column(F.col("id"), groups).alias("grp"), "id", F.crc32("text").cast("long").alias("tag"), "text"
    )
    contexts = tagged.groupBy("grp").cogroup(shared.groupBy("grp")).applyInArrow(_send(max(1, buckets // 4)), _CONTEXTS)
    ranges = contexts.groupBy("bucket").applyInArrow(lambda table: _settle(table, groups), "grp int, ranges binary")
    result = _RESULT + (", kept binary" if with_text else "")
    return tagged.groupBy("grp").cogroup(ranges.groupBy("grp")).applyInArrow(_remove(with_text), result)


def _group_column(doc, groups: int):
    """``_group_of`` as a column."""

    @F.pandas_udf("int")
    def group(ids):
        return ids.__class__(_group_of(ids.to_numpy().astype(np.int64), groups)).astype("int32")

    return group(doc)
