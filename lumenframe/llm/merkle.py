"""Manifest of a corpus as a Merkle tree: a proof of inclusion for every row.

Leaves are appended to aligned blocks of a fixed number of leaves, block by
block in parallel. Within a block each open subtree holds the witnesses of its
leaves so far; when a run of siblings is complete, all of them are extended by
the siblings they lack. Roots of blocks are appended to blocks of the next
level in the same way, and what they get there extends the witnesses below.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.llm import blocks as B
from lumenframe.llm.places import placed

#: Siblings in a run, and levels in a block: 8^4 leaves.
FAN, HEIGHT = 8, 4
BLOCK_LEAVES = FAN**HEIGHT
#: The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows handed to Spark at a time.
ROWS = 1024


def digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def field(value: Column) -> Column:
    """``-`` for null, else the number of bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


class Appender:
    """Witnesses of the leaves of one block, extended as the runs they are in are completed."""

    def __init__(self, height: int = HEIGHT):
        self.height = height
        self.open: list[list[tuple[bytes, int, int]]] = [[] for _ in range(height + 1)]  # (digest, its leaves from, to)
        self.places: list[list[int]] = []  # of each leaf: size of the run and place in it, level by level
        self.siblings: list[list[bytes]] = []

    def append(self, leaf: bytes) -> None:
        n = len(self.places)
        self.places.append([])
        self.siblings.append([])
        self._push(0, (leaf, n, n + 1))

    def _push(self, level: int, node: tuple[bytes, int, int]) -> None:
        self.open[level].append(node)
        if level < self.height and len(self.open[level]) == FAN:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        for place, (_, lo, hi) in enumerate(run):
            others = b"".join(d for k, (d, _, _) in enumerate(run) if k != place)
            for leaf in range(lo, hi):
                self.places[leaf] += (len(run), place)
                self.siblings[leaf].append(others)
        above = sha256(b"".join(d.hex().encode() for d, _, _ in run)).digest()
        self._push(level + 1, (above, run[0][1], run[-1][2]))

    def finish(self, alone: bool) -> bytes:
        """Complete what is open and give the root; a block that is ``alone`` ends where one node is left."""
        for level in range(self.height):
            last = len(self.open[level]) == 1 and not any(self.open[level + 1 :])
            if self.open[level] and not (alone and last):
                self._complete(level)
        return next(run[0][0] for run in self.open if run)


_IN = ["grp", "block", "pos", "digest", "doc_id", "copy", "places", "siblings", "subroot"]
NODES = "grp string, block long, pos long, digest binary, doc_id long, copy binary, places array<int>, siblings binary, subroot binary"


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows of one group and block; a block is bounded, so it is held whole."""
    name, held = None, []
    for part in batches:
        for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
            if row[:2] != name:
                if held:
                    yield name, held
                name, held = row[:2], []
            held.append(row)
    if held:
        yield name, held


def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("grp", pa.string()), ("pos", pa.int64()), ("digest", pa.binary())])
    out = []
    for (grp, block), rows in blocks_of(batches):
        appender = Appender()
        for row in rows:
            appender.append(row[3])
        out.append((grp, block, appender.finish(alone=block == 0 and len(rows) < BLOCK_LEAVES)))
        if len(out) >= ROWS:
            yield B.batch(out, schema)
            out = []
    yield B.batch(out, schema)


_NODES = pa.schema([
    ("grp", pa.string()), ("pos", pa.int64()), ("digest", pa.binary()), ("doc_id", pa.int64()), ("copy", pa.binary()),
    ("places", pa.list_(pa.int32())), ("siblings", pa.binary()), ("subroot", pa.binary()),
])


def witnesses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their whole witness: that of their block, from the row at place -1, extends what the block gives."""
    for (grp, block), (head, *rows) in blocks_of(batches):
        if head[2] != -1:
            raise RuntimeError(f"no witness for block {block}")
        appender = Appender()
        for row in rows:
            appender.append(row[3])
        appender.finish(alone=block == 0 and len(rows) < BLOCK_LEAVES)
        for at in range(0, len(rows), ROWS):
            yield B.batch(
                (
                    (grp, row[2], row[3], row[4], row[5], appender.places[at + k] + head[6], b"".join(appender.siblings[at + k]) + head[7], head[8])
                    for k, row in enumerate(rows[at : at + ROWS])
                ),
                _NODES,
            )


def _in_blocks(rows: DataFrame) -> DataFrame:
    return rows.repartition(B.partitions(rows), "grp", "block").sortWithinPartitions("grp", "block", "pos")


def _block() -> Column:
    return F.floor(F.col("pos") / BLOCK_LEAVES).cast("long")


def _levels(nodes: DataFrame) -> list[DataFrame]:
    """(grp, pos, digest) of leaves, of their blocks' roots, …, until each group has one node, which is in the last table."""
    out = [nodes]
    while (out[-1].agg(F.max("pos")).first()[0] or 0) > 0:
        rows = out[-1].select("grp", _block().alias("block"), "pos", "digest")
        out.append(B.checkpoint(_in_blocks(rows).mapInArrow(roots, "grp string, pos long, digest binary")))
    return out


def _extended(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """``nodes`` with witnesses; ``above`` has those of the roots of their blocks."""
    void = {"doc_id": "long", "copy": "binary"}
    lower = nodes.select("grp", _block().alias("block"), "pos", "digest", *[F.col(c) if c in nodes.columns else F.lit(None).cast(t).alias(c) for c, t in void.items()])
    lower = lower.select("*", F.lit(None).cast("array<int>").alias("places"), F.lit(None).cast("binary").alias("siblings"), F.lit(None).cast("binary").alias("subroot"))
    heads = above.select(
        "grp", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), "digest", F.lit(None).cast("long").alias("doc_id"),
        F.lit(None).cast("binary").alias("copy"), "places", "siblings", "subroot",
    )
    schema = "grp string, pos long, digest binary, doc_id long, copy binary, places array<int>, siblings binary, subroot binary"
    return _in_blocks(lower.select(*_IN).union(heads.select(*_IN))).mapInArrow(witnesses, schema)


def _down(levels: list[DataFrame], top: DataFrame) -> DataFrame:
    for nodes in reversed(levels[:-1]):
        top = _extended(nodes, top)
    return top


def manifest(docs: DataFrame, copy: Column | None = None, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``places``, ``siblings``, ``copy_leaf``.

    A leaf is the SHA-256 of ``fields``, each ``-`` if null, else its bytes'
    number, a colon and the value. Leaves of a ``group`` ascend by ``order``. A node above
    is the SHA-256 of the lowercase hex of up to eight consecutive ones; a group's
    last node is its subroot, and subroots, ordered by group (null first, by
    bytes), have the root above them in the same way. ``siblings`` are the
    others of each run from the leaf to the root, 32 bytes each, from left to
    right; ``places`` has the size of each run and the place in it.
    ``copy_leaf`` is the leaf with the column expression ``copy`` as its last field,
    such as what a store gives back for it.

    Null ids come first; rows of one id are ordered by their leaf, and rows alike in
    all fields have neighbouring leaves, one each. Any field may be null or empty;
    texts are hashed whole, where they are, and only digests are
    shuffled. An empty table gives no rows. Other columns are not read.
    """
    parts = [field(F.col(f"`{f}`")) for f in fields]
    leaf = digest(*parts)
    other = digest(*parts[:-1], field(copy)) if copy is not None else F.lit(None).cast("binary")
    rows = docs.select(F.col(f"`{group}`").cast("string").alias("grp"), F.col(f"`{order}`").cast("long").alias("doc_id"), leaf.alias("digest"), other.alias("copy"))
    leaves = B.checkpoint(placed(rows, ["grp"], ["doc_id", "digest"]))
    levels = _levels(leaves)
    tops = levels[-1].select(F.lit("").alias("all"), F.col("grp").alias("name"), "digest")
    subroots = B.checkpoint(placed(tops, ["all"], ["name"]).select(F.col("all").alias("grp"), "pos", "digest", "name"))
    upper = _levels(subroots.drop("name"))
    whole = upper[-1].select(F.col("digest")).first()
    root = bytes(whole[0]) if whole else b""
    none = F.array().cast("array<int>")
    top = upper[-1].select("grp", "pos", "digest", none.alias("places"), F.lit(b"").alias("siblings"), F.lit(b"").alias("subroot"))
    proven = _down(upper, top).select("pos", "places", "siblings")
    tops = subroots.join(proven, "pos").select(F.col("name").alias("grp"), F.lit(0).cast("long").alias("pos"), "digest", "places", "siblings", F.col("digest").alias("subroot"))
    # a single leaf in each group: the leaves themselves are the subroots
    below = _down(levels, B.checkpoint(tops)) if len(levels) > 1 else _extended(leaves, B.checkpoint(tops))
    return below.select("doc_id", F.col("digest").alias("leaf"), "subroot", F.lit(root).alias("root"), "places", "siblings", F.col("copy").alias("copy_leaf"))


def hex_text(value: Column) -> Column:
    return F.lower(F.hex(value))


def fold(leaf: Column, places: Column, siblings: Column) -> Column:
    """The root that a leaf and a witness give, as lowercase hex."""
    hexed = hex_text(siblings)

    def step(done: Column, k: Column) -> Column:
        size, place = F.get(places, 2 * k), F.get(places, 2 * k + 1)
        left = F.substring(hexed, 64 * done["used"] + 1, 64 * place)
        right = F.substring(hexed, 64 * (done["used"] + place) + 1, 64 * (size - 1 - place))
        return F.struct(F.sha2(F.concat(left, done["node"], right), 256).alias("node"), (done["used"] + size - 1).alias("used"))

    steps = F.when(F.size(places) > 0, F.sequence(F.lit(0), F.floor(F.size(places) / 2).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, F.struct(hex_text(leaf).alias("node"), F.lit(0).alias("used")), step, lambda done: done["node"])
