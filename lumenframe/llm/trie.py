"""Trie of conversation prefixes: how many conversations share each, and what is below.

A node is named by its depth and two 64-bit hashes of the turns before it; the
hashes are exclusive sums over turns, so a parent's name follows from its
child's. Totals of subtrees go up by time-forward processing: nodes are sorted
by descending depth, and a queue that spills to disk brings each node what its
children have sent, before it sends its own total on.

Shards are cut so that none is large. A node with more than ``light``
conversations is heavy and stands for itself; their number is below turns /
``light``. Below heavy nodes, a shard is a subtree of at most ``band`` levels,
with at most ``light`` conversations. Shards send the total of their root to
the tree of heavy nodes and roots that other shards hang from, which is bounded
too and is passed in the same way; where a shard has others below it, it is
passed once more with their totals.
"""

from __future__ import annotations

import heapq
import struct
import tempfile
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumenframe.llm import blocks as B
from lumenframe.llm.places import placed

WORD = r"[^\x20\x09-\x0D]+"
#: Nodes of the upper tree, heavy ones and shards with shards below, are kept to about this many of each kind.
UPPER_NODES = 200_000
#: The least ``light`` and ``band``.
LEAST_LIGHT, LEAST_BAND = 16, 64
#: Messages a queue holds in memory; the later ones spill beyond that.
IN_MEMORY = 200_000
#: Bytes of the list of ids that are a row while they are hashed.
PIECE = 1 << 20

NAME = ["d", "x1", "x2"]


def turn_digests(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, digest, words) of every turn: its place, a SHA-256 of role and text, the words of its text.

    Turns are ordered by number, null first, and those of one number by digest; a null
    role or text is empty. Rows without ``conv_id`` belong to no conversation.
    """
    said, by = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (text, role))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said), 256))
    rows = conversations.select(
        F.col(f"`{conv_id}`").cast("long").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
        digest.alias("digest"), F.regexp_count(said, F.lit(WORD)).cast("long").alias("words"),
    )
    return placed(rows.where("conv is not null"), ["conv"], ["turn", "digest"]).select("conv", "pos", "digest", "words")


def with_lead(turns: DataFrame, lead: Column, base: Column, longest: int) -> DataFrame:
    """Turns of conversations that begin with the first ``lead`` (below ``longest``) ones of the conversation ``base``, then go on with their own after ``lead``.

    A ``base`` that has fewer turns gives all it has, one that is absent none.
    """
    own = turns.where(F.col("pos") >= lead)
    heads = turns.where(F.col("pos") < longest).select(F.col("conv").alias("_base"), "pos", "digest", "words")
    wanted = turns.select("conv").distinct().select("conv", lead.alias("_lead"), base.alias("_from")).where("_lead > 0")
    given = wanted.join(heads, F.col("_from") == F.col("_base")).where("pos < _lead")
    both = own.unionByName(given.select(own.columns))
    return placed(both.withColumnRenamed("pos", "_at"), ["conv"], ["_at"]).select(turns.columns)


def _named(columns: list[str], prefix: str) -> list[Column]:
    return [F.col(c).alias(prefix + c) for c in columns]


def _paths(turns: DataFrame, band: int) -> DataFrame:
    """A row for each turn with the name of the node it leads to, that of the parent (p…), and its band."""
    each = turns.select("conv", "pos", "words", F.floor(F.col("pos") / band).cast("long").alias("band"), *[F.xxhash64(F.lit(k), "pos", "digest").alias(f"g{k}") for k in (1, 2)])
    so_far = W.partitionBy("conv", "band").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    local = each.withColumns({f"l{k}": F.bit_xor(f"g{k}").over(so_far) for k in (1, 2)})
    before = W.partitionBy("conv").orderBy("band").rowsBetween(W.unboundedPreceding, -1)
    whole = each.groupBy("conv", "band").agg(F.bit_xor("g1").alias("t1"), F.bit_xor("g2").alias("t2"))
    carried = whole.withColumns({f"c{k}": F.bit_xor(f"t{k}").over(before) for k in (1, 2)}).where("band > 0").drop("t1", "t2")
    rows = local.join(carried, ["conv", "band"], "left")
    x = [F.col(f"l{k}").bitwiseXOR(F.coalesce(f"c{k}", F.lit(0))) for k in (1, 2)]
    rows = rows.select("conv", "pos", "band", "words", "g1", "g2", (F.col("pos") + 1).cast("long").alias("d"), x[0].alias("x1"), x[1].alias("x2"))
    parents = [F.col("pos").cast("long").alias("pd"), F.col("x1").bitwiseXOR(F.col("g1")).alias("px1"), F.col("x2").bitwiseXOR(F.col("g2")).alias("px2")]
    return rows.select("conv", "pos", "band", "words", *NAME, *parents)


class SpillingQueue:
    """Messages by the node they are for, the next one first; beyond ``in_memory`` of them the later half goes to a file."""

    _ROW = struct.Struct("<5q")

    def __init__(self, in_memory: int = IN_MEMORY):
        self.in_memory, self.heap, self.heads, self.spills = in_memory, [], [], 0

    def push(self, message: tuple[int, int, int, int, int]) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.in_memory:
            self.heap.sort()
            half = len(self.heap) // 2
            file = tempfile.TemporaryFile()  # has no name: gone with the task
            file.writelines(self._ROW.pack(*m) for m in self.heap[half:])
            file.seek(0)
            del self.heap[half:]
            self.spills += 1
            self._next(self.spills, self._read(file))

    def _read(self, file) -> Iterator[tuple]:
        with file:
            while data := file.read(self._ROW.size * 1000):
                yield from self._ROW.iter_unpack(data)

    def _next(self, number: int, run: Iterator[tuple]) -> None:
        if (message := next(run, None)) is not None:
            heapq.heappush(self.heads, (message, number, run))

    def take(self, node: tuple[int, int, int]) -> tuple[int, int]:
        """Sums of the messages for a node, which must come before all others that are left."""
        leaves = saved = 0
        while True:
            own = self.heap[0] if self.heap else None
            spilt = self.heads[0][0] if self.heads else None
            first = spilt if own is None or (spilt is not None and spilt < own) else own
            if first is None or first[:3] > node:
                return leaves, saved
            if first[:3] < node:
                raise RuntimeError("a message for a node that is not here")
            if first is own:
                heapq.heappop(self.heap)
            else:
                _, number, run = heapq.heappop(self.heads)
                self._next(number, run)
            leaves, saved = leaves + first[3], saved + first[4]


def passed_up(in_memory: int = IN_MEMORY):
    """Totals of subtrees for rows sorted by descending depth; a row with ``top`` sends nothing on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(in_memory)
        for part in batches:
            at = {n: part.column(n).to_pylist() for n in (*NAME, "ud", "ux1", "ux2", "top", "leaves", "saved")}
            leaves, saved = [], []
            for d, x1, x2, ud, ux1, ux2, top, own, cost in zip(*at.values(), strict=True):
                below = queue.take((-d, x1, x2))
                leaves.append(own + below[0])
                saved.append(cost + below[1])
                if not top:
                    queue.push((-ud, ux1, ux2, leaves[-1], saved[-1]))
            for name, values in (("leaves", leaves), ("saved", saved)):
                part = part.set_column(part.schema.get_field_index(name), name, pa.array(values, pa.int64()))
            yield part
        if queue.heap or queue.heads:
            raise RuntimeError("messages are left for nodes that are not here")

    return run


def _totals(rows: DataFrame, *shard: str, in_memory: int = IN_MEMORY) -> DataFrame:
    dealt = rows.repartition(B.partitions(rows), *shard) if shard else rows.repartition(1)
    ordered = dealt.sortWithinPartitions(F.col("d").desc(), "x1", "x2")
    return ordered.mapInArrow(passed_up(in_memory), ordered.schema)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of a node, in order, as pieces of the comma-joined text."""
    schema = pa.schema([("d", pa.int64()), ("x1", pa.int64()), ("x2", pa.int64()), ("first", pa.int64()), ("piece", pa.binary())])
    name, held, size, out = None, [], 0, []
    for part in batches:
        for *node, conv in zip(*(c.to_pylist() for c in part.columns), strict=True):
            if node != name or size >= PIECE:
                if held:
                    out.append((*name, held[0], ",".join(map(str, held)).encode()))
                name, held, size = node, [], 0
            held.append(conv)
            size += 8
        if len(out) >= 1000 or size >= PIECE:
            yield B.batch(out, schema)
            out = []
    if held:
        out.append((*name, held[0], ",".join(map(str, held)).encode()))
    yield B.batch(out, schema)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("d", pa.int64()), ("x1", pa.int64()), ("x2", pa.int64()), ("ends_sha256", pa.string())])
    name, state = None, None
    for part in batches:
        out = []
        for *node, piece in zip(*(part.column(c).to_pylist() for c in (*NAME, "piece")), strict=True):
            if node == name:
                state.update(b"," + piece)
                continue
            if name:
                out.append((*name, state.hexdigest()))
            name, state = node, sha256(piece)
        yield B.batch(out, schema)
    yield B.batch([(*name, state.hexdigest())] if name else [], schema)


def _ends(ends: DataFrame) -> DataFrame:
    """(d, x1, x2, ends_sha256) of the ids (conv) that end at each node; a node's ids lie in several tasks in a row."""
    n, shape = B.partitions(ends), "d long, x1 long, x2 long, "
    dealt = ends.select(*NAME, "conv").repartitionByRange(n, *NAME, "conv").sortWithinPartitions(*NAME, "conv")
    pieces = dealt.mapInArrow(_pieces, shape + "first long, piece binary")
    return pieces.repartition(n, *NAME).sortWithinPartitions(*NAME, "first").mapInArrow(_hashed, shape + "ends_sha256 string")


def _on(left: list[str], right: list[str]) -> Column:
    same = [F.col(a) == F.col(b) for a, b in zip(left, right, strict=True)]
    return same[0] & same[1] & same[2]


def trie(turns: DataFrame, members: DataFrame, light: int | None = None, band: int | None = None, in_memory: int = IN_MEMORY) -> DataFrame:
    """One row per node: ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    ``turns`` (conv, pos from 0, digest, words) are as ``turn_digests`` gives
    them; ``members`` (conv) has every conversation, those without turns too.
    A node is a sequence of first turns that conversations share, from the root
    that has none. ``conv_id`` is the least of its conversations, which with the
    depth names it; ``n_leaves`` and ``saved_tokens`` are sums over its subtree
    (itself included) of childless nodes and of words that need not be read again.

    Without members there is no node. Conversations alike in all turns end
    at one node. A conversation may be of any length and any number of them may
    begin alike; ``light`` and ``band`` only say where shards are cut.
    """
    turns = B.checkpoint(turns)
    n_rows = turns.count()
    light = light or max(LEAST_LIGHT, n_rows // UPPER_NODES + 1)
    band = band or max(LEAST_BAND, n_rows // UPPER_NODES + 1)
    paths = B.checkpoint(_paths(turns, band))

    # heavy nodes: below n_rows / light of them, and of names and numbers only
    heavy = B.checkpoint(paths.groupBy(*NAME).agg(F.count("*").alias("n")).where(F.col("n") > light).select(*_named(NAME, "h")))
    rows = paths.join(F.broadcast(heavy), _on(NAME, ["hd", "hx1", "hx2"]), "left").withColumn("heavy", F.col("hd").isNotNull()).drop("hd", "hx1", "hx2")
    own = F.struct(*NAME)
    above = W.partitionBy("conv", "band").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("shard", F.first(F.when(~F.col("heavy"), own), ignorenulls=True).over(above))
    tops = paths.join(F.broadcast(heavy), _on(NAME, ["hd", "hx1", "hx2"]), "left_anti").groupBy("conv", "band").agg(F.min(own).alias("before"))
    # the shard of the parent, where that is a light node of the band above
    starts = tops.where("before.d is not null").select("conv", (F.col("band") + 1).alias("band"), F.lit(True).alias("at_start"), "before")
    rows = rows.withColumn("at_start", F.col("pos") == F.col("band") * band).join(starts, ["conv", "band", "at_start"], "left")
    nodes = rows.groupBy(*NAME).agg(
        F.count("*").alias("n_convs"), F.min("conv").alias("conv_id"), *[F.first(c).alias(c) for c in ("words", "pd", "px1", "px2", "heavy", "shard", "before")]
    )
    alone = members.agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id")).where("n_convs > 0")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = alone.select(
        *[zero.alias(c) for c in NAME], "n_convs", "conv_id", zero.alias("words"), *[none.alias(c) for c in ("pd", "px1", "px2")], F.lit(True).alias("heavy"),
        F.lit(None).cast(nodes.schema["shard"].dataType).alias("shard"), F.lit(None).cast(nodes.schema["before"].dataType).alias("before"),
    )
    nodes = B.checkpoint(nodes.unionByName(root))

    children = nodes.groupBy("pd", "px1", "px2").agg(F.count("*").alias("n_children")).where("pd is not null").select(F.col("pd").alias("d"), F.col("px1").alias("x1"), F.col("px2").alias("x2"), "n_children")
    last = turns_end(paths, members)
    whole = nodes.join(children, NAME, "left").join(_ends(last), NAME, "left").fillna({"n_children": 0, "ends_sha256": sha256(b"").hexdigest()})
    whole = whole.withColumn("leaves", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")).withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
    whole = B.checkpoint(_with_parents(whole))
    return _finished(whole, in_memory)


def turns_end(paths: DataFrame, members: DataFrame) -> DataFrame:
    """(conv, d, x1, x2): the node at which each conversation ends; without turns that is the root."""
    ends = paths.groupBy("conv").agg(F.max(F.struct(*NAME)).alias("last"))
    return members.select("conv").join(ends, "conv", "left").select("conv", *[F.coalesce(F.col(f"last.{c}"), F.lit(0).cast("long")).alias(c) for c in NAME])


def _with_parents(nodes: DataFrame) -> DataFrame:
    """``parent_conv_id`` and whether the parent is heavy: few heavy parents may have any number of children, others few."""
    parents = nodes.select(*_named(NAME, "q"), F.col("conv_id").alias("parent_conv_id"), F.col("heavy").alias("q_heavy"))
    on = _on(["pd", "px1", "px2"], ["qd", "qx1", "qx2"])
    below = nodes.join(F.broadcast(parents.where("q_heavy")), on, "left")
    found = below.where("q_heavy or d = 0").drop("qd", "qx1", "qx2")
    others = below.where("q_heavy is null and d > 0").drop("qd", "qx1", "qx2", "parent_conv_id", "q_heavy")
    return found.unionByName(others.join(parents.where("not q_heavy"), on).drop("qd", "qx1", "qx2"))


def _finished(whole: DataFrame, in_memory: int) -> DataFrame:
    """Totals of subtrees: within shards, across their roots, and again in shards with others below."""
    up = [F.col("pd").alias("ud"), F.col("px1").alias("ux1"), F.col("px2").alias("ux2")]
    inside = whole.where("not heavy").withColumn("top", F.struct(*NAME) == F.col("shard")).select("*", *up)
    first = B.checkpoint(_totals(inside, "shard", in_memory=in_memory))
    roots = first.where("top").select(*NAME, "pd", "px1", "px2", "q_heavy", "leaves", "saved", F.coalesce("before", F.struct(F.col("pd").alias("d"), F.col("px1").alias("x1"), F.col("px2").alias("x2"))).alias("over"))
    # shards with others below them: less than turns / band
    inner = B.checkpoint(roots.where("not q_heavy").select("over").distinct())
    roots = roots.join(inner.select(F.col("over").alias("_in"), F.lit(True).alias("is_inner")), F.struct(*NAME) == F.col("_in"), "left").drop("_in")
    roots = B.checkpoint(roots.withColumn("is_inner", F.coalesce("is_inner", F.lit(False))))
    sent = roots.where("not is_inner").groupBy("over").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    parent = F.struct(F.col("pd").alias("d"), F.col("px1").alias("x1"), F.col("px2").alias("x2"))
    heavy = whole.where("heavy").select(*NAME, parent.alias("over"), "leaves", "saved").unionByName(roots.where("is_inner").select(*NAME, "over", "leaves", "saved"))
    heavy = heavy.join(sent.withColumnRenamed("over", "_to"), F.struct(*NAME) == F.col("_to"), "left")
    heavy = heavy.select(
        *NAME, F.col("over.d").alias("ud"), F.col("over.x1").alias("ux1"), F.col("over.x2").alias("ux2"), (F.col("d") == 0).alias("top"),
        *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")],
    )
    upper = B.checkpoint(_totals(heavy, in_memory=in_memory).select(*NAME, "leaves", "saved"))

    # totals that the shards below send to their parents in a light shard
    full = roots.where("not q_heavy").select(*NAME, "pd", "px1", "px2", "is_inner", "leaves", "saved").join(upper.select(*NAME, F.col("leaves").alias("all_leaves"), F.col("saved").alias("all_saved")), NAME, "left")
    extra = full.groupBy(F.col("pd").alias("d"), F.col("px1").alias("x1"), F.col("px2").alias("x2")).agg(
        F.sum(F.when(F.col("is_inner"), F.col("all_leaves")).otherwise(F.col("leaves"))).alias("add_leaves"),
        F.sum(F.when(F.col("is_inner"), F.col("all_saved")).otherwise(F.col("saved"))).alias("add_saved"),
    )
    mark = inner.select(F.col("over").alias("shard"))
    again = inside.join(mark, "shard", "left_semi").join(extra, NAME, "left")
    again = again.withColumns({c: F.col(c) + F.coalesce(f"add_{c}", F.lit(0)) for c in ("leaves", "saved")}).select(inside.columns)
    second = _totals(again, "shard", in_memory=in_memory)

    kept = ["conv_id", "d", "parent_conv_id", "n_convs", "n_children", "leaves", "saved", "ends_sha256"]
    done = first.join(mark, "shard", "left_anti").select(kept).unionByName(second.select(kept))
    done = done.unionByName(whole.where("heavy").drop("leaves", "saved").join(upper, NAME).select(kept))
    return done.select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends_sha256"
    )


def prefix_trie(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``trie`` of a table of turns; other columns are not read."""
    turns = B.checkpoint(turn_digests(conversations, conv_id, turn, role, text))
    return trie(turns, turns.select("conv").distinct())
