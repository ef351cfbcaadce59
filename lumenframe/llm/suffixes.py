"""Removal of byte strings that also start earlier in a corpus, by bucket-pointer refinement.

Suffixes are put in buckets by their first ``Q`` bytes and buckets are refined
by the bucket identifiers at later offsets: the bucket of 2L bytes at p is that
of the pair (bucket of L bytes at p, bucket of L bytes at p + L), and every
refinement uses the one before. Identifiers are 64-bit hashes of such pairs,
not ranks, so tasks give equal strings equal identifiers without asking each
other, and only buckets that may hold two suffixes are ever shuffled:

1. Of all suffixes that start a string of ``size`` bytes, one stands for its
   neighbours: the leftmost with the least ``Q``-byte identifier that lies in
   the string. Equal strings have the same one, at the same offset. So of some
   ``(size - Q) / 2`` positions one goes into the initial buckets.
2. A bucket with one member is done. In the others, members whose whole reach
   (the union of the strings they stand for) is equal are refined together:
   all but the earliest are repeats, all over.
3. Only where a bucket still holds different reaches, the earliest of each are
   refined string by string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.llm import blocks as B
from lumenframe.llm.substrings import intervals

SIZE = 100
Q = 32
#: Bytes of text that a task refines at a time; a longer text is cut in pieces that overlap by a string.
PIECE = 2_000_000
_PLACE = np.uint64((1 << 24) - 1)
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Identifier of a pair of identifiers."""
    x = (a ^ (a >> np.uint64(31))) * _K1 + b
    x = (x ^ (x >> np.uint64(32))) * _K2
    return x ^ (x >> np.uint64(29))


def refined(data: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket identifiers of every ``Q``-byte and of every ``size``-byte string in ``data``."""
    n = len(data)
    ids = np.zeros(max(0, n - 7), dtype=np.uint64)
    for k in range(8 if n > 7 else 0):
        ids |= data[k : n - 7 + k].astype(np.uint64) << np.uint64(8 * k)
    length, first = 8, None
    while length < size:
        step = min(length, size - length)  # the last step overlaps
        ids = pair(ids[: len(ids) - step], ids[step:]) if len(ids) > step else ids[:0]
        length += step
        if length == Q:
            first = ids
    return first, ids


def leaders(first: np.ndarray, n_strings: int, size: int) -> np.ndarray:
    """For each string the place of the leftmost of the least ``Q``-byte identifiers in it."""
    reach = size - Q + 1
    low = (first & ~_PLACE) | np.arange(len(first), dtype=np.uint64)
    width = 1
    while 2 * width <= reach:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = reach - width
    low = np.minimum(low[: len(low) - rest], low[rest:]) if rest else low
    return (low[:n_strings] & _PLACE).astype(np.int64)


class Piece:
    """Texts joined, with the strings of ``size`` bytes that lie in one of them."""

    def __init__(self, texts: list[bytes], size: int):
        self.size = size
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.at = np.concatenate([[0], np.cumsum(sizes)])
        self.first, self.whole = refined(data, size) if len(data) >= size else (np.zeros(0, np.uint64),) * 2
        room = np.repeat(self.at[1:], sizes)[: len(self.whole)] - np.arange(len(self.whole))
        self.start = np.flatnonzero(room >= size)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bucket, identifier of the reach, first and last string that it stands for."""
        if not len(self.start):
            empty = np.zeros(0, np.int64)
            return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty
        leader = leaders(self.first, len(self.whole), self.size)[self.start]
        new = np.flatnonzero(np.diff(leader, prepend=-1))
        lo, hi, leader = self.start[new], self.start[np.append(new[1:], len(self.start)) - 1], leader[new]
        shape = ((leader - lo) * 256 + (hi - lo)).astype(np.uint64)
        return self.first[leader], pair(pair(self.whole[lo], self.whole[hi]), shape), lo, hi


def pieces(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]]:
    """Runs of (ids, keys, offsets, texts) of bounded size."""
    for ids, keys, texts in B.chunks(batches, PIECE):
        if sum(map(len, texts)) <= 4 * PIECE:
            yield ids, keys, np.zeros(len(ids), np.int64), texts
            continue
        for i, k, t in zip(ids, keys, texts, strict=True):
            for at in range(0, max(1, len(t) - size + 1), PIECE):
                yield np.array([i]), np.array([k]), np.array([at]), [t[at : at + PIECE + size - 1]]


def smallest(keys: list[np.ndarray], ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows sorted by keys, id, place; where a key begins; which rows come after the first of their key."""
    order = np.lexsort((places, ids, *reversed(keys)))
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (ids[order] != ids[order][head]) | (places[order] != places[order][head])
    return order, new, later


def anchor_blocks(size: int, buckets: int):
    """Text rows to blocks: members of the initial buckets, and the chunk's directory of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, keys, offsets, texts in pieces(batches, size):
            piece = Piece(texts, size)
            bucket, reach, lo, hi = piece.anchors()
            if not len(lo):
                continue
            doc = np.searchsorted(piece.at, lo, side="right") - 1
            place = lo - piece.at[doc] + offsets[doc]
            chunk = B.chunk_name(np.append(ids, offsets), keys)
            order, _, later = smallest([bucket, reach], ids[doc], place)
            repeat = np.zeros(len(order), dtype=bool)
            repeat[order] = later
            own = chunk % buckets + buckets
            directory = (ids, keys, offsets, B.steps(piece.at), B.steps(lo), (hi - lo).astype(np.uint8))
            rows = [(own, chunk, B.pack(np.zeros(1, np.int8), *directory))]
            if repeat.any():
                rows.append((own, chunk, B.pack(np.ones(1, np.int8), B.steps(np.flatnonzero(repeat)))))
            n = np.flatnonzero(~repeat)
            for b, (m,) in B.deal((bucket[n] % np.uint64(buckets)).astype(np.int64), n):
                rows.append((b, chunk, B.pack(bucket[m], reach[m], B.steps(m), ids[doc[m]], place[m].astype(np.uint32 if place.max() < 1 << 32 else np.int64))))
            yield B.block(rows)

    return run


def refine_bucket(buckets: int):
    """Members of initial buckets to what their chunks must know: 1, those that are repeats in all their
    reach; 2, those that share a bucket with another reach."""

    def run(group: pa.Table) -> pa.Table:
        rows = list(zip(group.column("chunk").to_pylist(), group.column("body").to_pylist(), strict=True))
        if group.column("bucket")[0].as_py() >= buckets:
            return B.table((0, chunk, body) for chunk, body in rows)
        parts = [B.unpack(body) for _, body in rows]
        bucket, reach, ids, place = (np.concatenate([p[k] for p in parts]) for k in (0, 1, 3, 4))
        order, new, later = smallest([bucket, reach], ids, place)
        head = np.diff(bucket[order], prepend=~bucket[order[:1]]) != 0
        group_of = np.cumsum(head) - 1
        several = np.bincount(group_of, weights=new)[group_of] > 1
        state = np.zeros(len(order), dtype=np.int8)
        state[order] = np.where(later, 1, np.where(several, 2, 0))
        out, at = [], 0
        for (chunk, _), p in zip(rows, parts, strict=True):
            here, number = state[at : at + len(p[0])], B.back(p[2])
            at += len(p[0])
            for kind in (1, 2):
                if len(found := number[here == kind]):
                    out.append((0, chunk, B.pack(np.full(1, kind, np.int8), B.steps(found))))
        return B.table(out)

    return run


SPANS = "id long, key long, lo binary, hi binary, open_lo binary, open_hi binary"
_SPANS = pa.schema([("id", pa.int64()), ("key", pa.int64()), *((c, pa.binary()) for c in ("lo", "hi", "open_lo", "open_hi"))])


def to_spans(size: int):
    """Answers for a chunk to a row for each of its documents: strings that repeat, strings still open."""

    def run(group: pa.Table) -> pa.Table:
        directory, state = None, []
        for body in group.column("body").to_pylist():
            kind, *arrays = B.unpack(body)
            if kind[0] == 0:
                directory = arrays
            else:
                state.append((int(kind[0]), B.back(arrays[0])))
        if directory is None:
            raise RuntimeError("members of a chunk came back, but not its directory: its rows came in another order")
        ids, keys, offsets, at, lo, span = directory
        at, lo = B.back(at), B.back(lo)
        what = np.zeros(len(lo), dtype=np.int8)
        for kind, n in state:
            what[n] = kind
        n = np.flatnonzero(what)
        doc = np.searchsorted(at, lo[n], side="right") - 1
        rows = []
        for d, (m,) in B.deal(doc, n):
            place = lo[m] - at[d] + offsets[d]
            shut, still = what[m] == 1, what[m] == 2
            ends = (place[shut], place[shut] + span[m][shut], place[still], place[still] + span[m][still])
            rows.append((int(ids[d]), int(keys[d]), *(r.astype(np.int64).tobytes() for r in ends)))
        return pa.Table.from_batches([B.batch(rows, _SPANS)])

    return run


def ranges(parts: list[bytes] | None) -> np.ndarray:
    return np.frombuffer(b"".join(parts or []), dtype=np.int64)


def string_blocks(size: int, buckets: int):
    """(id, key, text, open strings) to blocks of their identifiers, dealt by the initial bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            entries = []
            for i, k, text, lo, hi in zip(*(c.to_pylist() for c in part.columns), strict=True):
                lo, hi = ranges(lo), ranges(hi)
                order = np.argsort(lo)
                for a, b in zip(lo[order].tolist(), hi[order].tolist(), strict=True):
                    first, whole = refined(np.frombuffer(text, dtype=np.uint8, count=b - a + size, offset=a), size)
                    entries.append((int(leaders(first, 1, size)[0]), i, k, a, whole, first))
            dealt: dict[int, list] = {}
            for leader, i, k, a, whole, first in entries:
                dealt.setdefault(int(first[leader] % np.uint64(buckets)), []).append((i, k, a, whole))
            if entries:
                yield B.block(
                    (b, 0, B.pack(*(np.array(c, np.int64) for c in list(zip(*e, strict=True))[:3]), np.array([len(x[3]) for x in e], np.int64), np.concatenate([x[3] for x in e])))
                    for b, e in dealt.items()
                )

    return run


STARTS = "id long, key long, start binary"
_STARTS = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("start", pa.binary())])


def refine_strings(group: pa.Table) -> pa.Table:
    """Open strings of some buckets to those that also start earlier."""
    parts = [B.unpack(body) for body in group.column("body").to_pylist()]
    i, k, a, n, whole = (np.concatenate([p[c] for p in parts]) for c in range(5))
    owner = np.repeat(np.arange(len(n)), n)
    place = a[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    order, _, later = smallest([whole], i[owner], place)
    found = order[later]
    found = found[np.lexsort((place[found], k[owner[found]], i[owner[found]]))]
    ids, keys, places = i[owner[found]], k[owner[found]], place[found]
    cuts = np.flatnonzero(np.concatenate([[True], (np.diff(ids) != 0) | (np.diff(keys) != 0)])) if len(found) else []
    rows = [(int(ids[lo]), int(keys[lo]), places[lo:hi].tobytes()) for lo, hi in zip(cuts, [*cuts[1:], len(found)], strict=True)]
    return pa.Table.from_batches([B.batch(rows, _STARTS)])


CUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, span_start array<long>, span_end array<long>"
_CUT = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
    ("kept_sha256", pa.string()), ("span_start", pa.list_(pa.int64())), ("span_end", pa.list_(pa.int64())),
])


def cut_bytes(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows = []
            for doc_id, text, lo, hi, one in zip(*(c.to_pylist() for c in part.columns), strict=True):
                lo, hi, one = ranges(lo), ranges(hi), ranges(one)
                change = np.zeros(len(text) + 1, dtype=np.int32)
                np.add.at(change, np.concatenate([lo, one]), 1)
                np.add.at(change, np.concatenate([hi, one]) + size, -1)
                removed = np.cumsum(change)[: len(text)] > 0
                start, end = intervals(removed)
                kept = text if not len(start) else np.frombuffer(text, dtype=np.uint8)[~removed].tobytes()
                rows.append((None if doc_id == B.NO_ID else doc_id, len(text), int(removed.sum()), len(start), hashlib.sha256(kept).hexdigest(), start.tolist(), end.tolist()))
            yield B.batch(rows, _CUT)

    return run


def remove_earlier_strings(docs: DataFrame, size: int = SIZE, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` (of the bytes
    left) and ``span_start``, ``span_end`` (maximal removed runs, in bytes).

    A byte goes if a string of ``size`` bytes (at least ``2 Q``) that covers it
    also starts earlier: in a document of smaller id, or before it in its own.
    Rows of one id count as one document: equal strings at equal places in them
    do not remove each other. Null ids come before all others (the least long number stands for them), null texts are
    empty, shorter texts lose nothing, other columns are not read, an empty
    table gives no rows.
    """
    if size < 2 * Q:
        raise ValueError(f"strings must have {2 * Q} bytes at least")
    buckets = B.partitions(docs)
    texts = B.text_rows(docs, text, doc_id)
    members = texts.mapInArrow(anchor_blocks(size, buckets), B.BLOCK)
    states = members.groupBy("bucket").applyInArrow(refine_bucket(buckets), B.BLOCK)
    per_piece = states.groupBy("chunk").applyInArrow(to_spans(size), SPANS)
    lists = [F.collect_list(c).alias(c) for c in ("lo", "hi", "open_lo", "open_hi")]
    spans = B.checkpoint(per_piece.groupBy(F.col("id").alias("_id"), F.col("key").alias("_key")).agg(*lists))
    on = (F.col("id") == F.col("_id")) & (F.col("key") == F.col("_key"))
    still = spans.where(F.exists("open_lo", lambda x: F.length(x) > 0))
    strings = texts.join(still, on).select("id", "key", "text", "open_lo", "open_hi").mapInArrow(string_blocks(size, buckets), B.BLOCK)
    starts = strings.groupBy("bucket").applyInArrow(refine_strings, STARTS)
    per_doc = starts.groupBy(F.col("id").alias("_id"), F.col("key").alias("_key")).agg(F.collect_list("start").alias("one"))
    found = spans.select("_id", "_key", "lo", "hi").join(per_doc, ["_id", "_key"], "full")
    # the same columns of the texts as above, so that they are shuffled once
    rows = texts.join(found, on, "left").select("id", "text", "lo", "hi", "one")
    return rows.mapInArrow(cut_bytes(size), CUT)
