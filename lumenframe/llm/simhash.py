"""SimHash near-duplicates through an inverted index of byte positions.

Two 64-bit fingerprints that differ in at most three bits agree in at least
five of their eight bytes. The index posts each different fingerprint under
bytes at fixed positions; fingerprints that share a posting are candidates,
their equal positional bytes are tallied, pairs below the guaranteed minimum
go, and the bits of the rest are compared. Postings of single bytes would hold
a 256th of the corpus each, so a posting takes ``KEY_BYTES`` positions at once:
every five of eight positions contain one of the chosen sets.

A posting gives the edges of a spanning forest of its links, not its pairs: a
fingerprint is compared with those of the posting that nothing has reached yet.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.llm import blocks as B
from lumenframe.llm.graphs import components

SHINGLE, DISTANCE = 3, 3
KEY_BYTES = 4
SEED = 42


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """A bit is one if it is one in more than half of the shingles' hashes; no word, no bit."""
    words = text.lower().split()  # bytes: A-Z only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    cuts = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    hashes = np.array([digest(line[a:b], SEED) for a, b in cuts], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 100_000):
        bits = np.unpackbits(hashes[at : at + 100_000].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


_FINGERPRINTS = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("fp", pa.int64())])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(id, key, fp): rows as ``blocks.text_rows`` names them, fingerprints as signed 64-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            fps = np.array([fingerprint(t, shingle) for t in part.column(2).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fps.view(np.int64))], schema=_FINGERPRINTS)

    return B.text_rows(docs, text, doc_id).mapInArrow(B.released(run), "id long, key long, fp long")


def position_sets(distance: int = DISTANCE, key_bytes: int = KEY_BYTES) -> list[tuple[int, ...]]:
    """Sets of byte positions such that any positions left by ``distance`` bytes contain one; found greedily."""
    same = 8 - distance
    if not 0 < key_bytes <= same:
        raise ValueError(f"keys take 1 to {same} bytes")
    open_ = set(combinations(range(8), same))
    sets = {c: {o for o in open_ if set(c) <= set(o)} for c in combinations(range(8), key_bytes)}
    chosen = []
    while open_:
        best = max(sets, key=lambda c: (len(sets[c] & open_), c))
        chosen.append(best)
        open_ -= sets[best]
    return chosen


def linked(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among different fingerprints."""
    edges, rest = [], fps
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            one = front.pop()
            differ = rest ^ one
            tally = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            near = tally >= 8 - distance
            near[near] = np.bitwise_count(differ[near]) <= distance
            if near.any():
                found = rest[near]
                edges += [(int(one), int(f)) for f in found]
                front += list(found)
                rest = rest[~near]
    return edges


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def link_postings(distance: int):
    """Rows (set, key, fp), sorted by posting, to edges; a posting may run over several batches."""

    def edges(parts: list[np.ndarray]) -> list[tuple[int, int]]:
        fps = np.concatenate(parts)
        return linked(fps, distance) if len(fps) > 1 else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_key = [], None
        for part in batches:
            n, key, fps = (np.asarray(c) for c in part.columns)
            fps = fps.view(np.uint64)
            cuts = np.flatnonzero((np.diff(n) != 0) | (np.diff(key) != 0)) + 1
            out = []
            for lo, hi in zip([0, *cuts], [*cuts, len(n)], strict=True):
                if hi <= lo:
                    continue
                if held_key != (n[lo], key[lo]):
                    out += edges(held) if held else []
                    held, held_key = [], (n[lo], key[lo])
                held.append(fps[lo:hi])
            if out:
                yield _edge_rows(out)
        if held and (out := edges(held)):
            yield _edge_rows(out)

    return run


def _edge_rows(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(edges, dtype=np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=_EDGES)


def links(fps: DataFrame, distance: int = DISTANCE, key_bytes: int = KEY_BYTES) -> DataFrame:
    """(a, b): edges that connect different fingerprints as all their links do."""
    masks = [sum(0xFF << 8 * p for p in s) for s in position_sets(distance, key_bytes)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    posting = F.explode(F.array(*(F.struct(F.lit(i).alias("n"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed))))
    posted = fps.select("fp", posting.alias("p")).select("p.n", "p.key", "fp")
    dealt = posted.repartition(B.partitions(fps), "n", "key").sortWithinPartitions("n", "key")
    return dealt.mapInArrow(B.released(link_postings(distance)), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, key_bytes: int = KEY_BYTES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id``, ``fp``, ``component_id`` (the least id that links reach, its own included),
    and ``id``, ``key``, ``first`` (the row as ``blocks.text_rows`` names it, and the least such row of its group).

    Copies share a fingerprint and enter the index once. Null, empty and
    wordless texts have fingerprint 0 and link like any other; fewer words than
    a shingle make one shingle. A null id is never a component's id unless all
    its ids are null. Other columns are not read. An empty table gives no rows.
    """
    marked = B.checkpoint(fingerprints(docs, shingle, text, doc_id))
    own_id = F.when(F.col("id") != B.NO_ID, F.col("id"))
    different = B.checkpoint(marked.groupBy("fp").agg(F.min(own_id).alias("least_id"), F.min(F.struct("id", "key")).alias("least")))
    roots = components(links(different.select("fp"), distance, key_bytes))
    rooted = different.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"), F.min("least").alias("first"))
    ids = rooted.join(least, "root").select("fp", "component_id", "first")
    return marked.join(ids, "fp").select(own_id.alias("doc_id"), "fp", "component_id", "id", "key", "first")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` that come first in their groups, by id, once each; columns as they were.

    Of rows alike in id and text any one stays, as nothing that is compared tells them apart. Null and empty texts
    are one group. An empty table stays empty.
    """
    rows, own_id, own_key = B.named(docs)
    near = near_duplicates(docs, shingle, distance).where(F.col("first") == F.struct("id", "key"))
    first = near.select(F.col("id").alias(own_id), F.col("key").alias(own_key)).distinct()
    return rows.dropDuplicates([own_id, own_key]).join(first, [own_id, own_key], "left_semi").select(*B.columns_of(docs))
