"""Mixing sources to token targets by entropy balancing; DataFrame operations only.

Every document has a rate: how often the mix takes it. Of all rates between 0
and ``most`` that give each source its target of tokens, the ones nearest to
"once each" in relative entropy are exponentially tilted: exp(lambda * size),
capped at ``most``. The multiplier of a source solves the dual, which is convex
in it. Newton steps, kept inside a bracket, find all multipliers together; a
step is one aggregate over a table of (source, size, documents of that size),
which is far smaller than the corpus.

Rates become whole copies with one hash of the document's id as its random
number, as in systematic rounding. The common shift of those numbers that
fills a source's target is then found digit by digit, each digit one aggregate.
The document at which it would overflow is left out, and those behind it that
are small enough fill what remains, ``TIERS`` times in all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumenframe.llm import blocks as B

WORD = r"[^\x20\x09-\x0D]+"
MOST = 2
TOLERANCE = 1e-7
MAX_STEPS = 80
#: Binary digits of a document's number, and how many of them one aggregate settles.
DIGITS, AT_ONCE = 32, 11
TIERS = 3
#: Sources up to which the table of multipliers is broadcast; beyond, it is joined.
BROADCAST_SOURCES = 100_000


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """The source as a text that is never null; a null sorts last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def shares(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float = MOST) -> DataFrame:
    """(src, source_size, target) from (src, size, n): sources in code-point order weigh ``weights``, repeating,
    and share ``share`` times all tokens, up to ``most`` times their own; what is above goes to the others by weight.

    The level at which that ends is found among the sources in the order they
    reach their limit. The table has one row a source.
    """
    total = sizes.groupBy("src").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    rank = F.row_number().over(W.orderBy("src")) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (rank % len(weights) + 1).cast("int"))
    limit = F.col("source_size") * float(most)
    rows = total.withColumn("weight", weight).withColumn("full_at", limit / F.col("weight"))
    before = W.orderBy("full_at", "src").rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    spent, weighed = (F.coalesce(F.sum(c).over(before), F.lit(0.0)) for c in (limit, F.col("weight")))
    level = (F.sum("source_size").over(everything) * share - spent) / (F.sum("weight").over(everything) - weighed)
    rows = rows.withColumn("level", level)
    reached = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "level"))).over(everything)
    target = F.least(limit, F.coalesce(reached["level"], F.lit(float("inf"))) * F.col("weight"))
    return rows.select("src", "source_size", target.alias("target"))


def rate(size: Column, most: float = MOST) -> Column:
    """Rate of a document of ``size`` tokens under the columns of ``solve``."""
    tilted = F.least(F.lit(float(most)), F.exp(F.least(F.lit(50.0), F.col("lam") * size / F.col("scale"))))
    return F.when(F.col("target") >= most * F.col("source_size"), float(most)).when(F.col("target") <= 0, 0.0).otherwise(tilted)


def solve(sizes: DataFrame, targets: DataFrame, most: float = MOST) -> DataFrame:
    """``targets`` with the multiplier ``lam`` (per ``scale`` tokens) of each source."""
    moments = sizes.groupBy("src").agg((F.sum(F.col("n") * F.col("size") * F.col("size")) / F.sum(F.col("n") * F.col("size"))).alias("scale"))
    start = {"scale": F.coalesce("scale", F.lit(1.0)), "lam": F.lit(0.0), "lo": F.lit(float("-inf")), "hi": F.lit(float("inf"))}
    state = B.checkpoint(targets.join(moments, "src", "left").withColumns(start))
    fixed = (F.col("target") >= most * F.col("source_size")) | (F.col("target") <= 0)
    mass = F.col("n") * F.col("size")
    for _ in range(MAX_STEPS):
        tilt = rate(F.col("size"), most)
        slope = F.when(tilt < most, mass * tilt * F.col("size") / F.col("scale")).otherwise(0.0)
        sums = sizes.join(state, "src").groupBy("src").agg(F.sum(mass * tilt).alias("got"), F.sum(slope).alias("slope"))
        now = state.join(sums, "src", "left").withColumn("off", F.when(fixed, 0.0).otherwise(F.col("got") - F.col("target")))
        now = now.withColumn("lo", F.when(F.col("off") < 0, F.col("lam")).otherwise(F.col("lo")))
        now = now.withColumn("hi", F.when(F.col("off") > 0, F.col("lam")).otherwise(F.col("hi")))
        newton = F.col("lam") - F.when(F.col("slope") > 0, F.col("off") / F.col("slope")).otherwise(F.signum("off") * float("inf"))
        inside = (newton > F.col("lo")) & (newton < F.col("hi")) & (F.abs(newton - F.col("lam")) <= 4 * (1 + F.abs("lam")))
        bounded = (F.col("lo") > float("-inf")) & (F.col("hi") < float("inf"))
        wide = F.col("lam") - F.signum("off") * 2 * (1 + F.abs("lam"))
        step = F.when(inside, newton).when(bounded, (F.col("lo") + F.col("hi")) / 2).otherwise(wide)
        error = F.when(fixed, 0.0).otherwise(F.abs("off") / F.col("target"))
        done = error <= TOLERANCE
        state = B.checkpoint(now.select("src", "source_size", "target", "scale", F.when(done, F.col("lam")).otherwise(step).alias("lam"), "lo", "hi", error.alias("error")))
        if (state.agg(F.max("error")).first()[0] or 0.0) <= TOLERANCE:
            break
        state = state.drop("error")
    # the last digits depend on the order in which tasks' sums arrive
    return state.select("src", "source_size", "target", "scale", F.round("lam", 9).alias("lam"))


def whole_part(size: Column, most: float = MOST) -> Column:
    """Copies before rounding: the floor of the rate, but below ``most``, which no document may pass."""
    return F.least(F.floor(rate(size, most)), F.lit(int(most) - 1)).cast("long")


def number(doc_id: Column, size: Column, most: float = MOST) -> Column:
    """The smaller, the sooner a document is rounded up; below ``2 ** DIGITS`` if its rate says so by itself."""
    uniform = F.shiftrightunsigned(F.xxhash64(doc_id, F.lit("mix")), 64 - DIGITS)
    part = ((rate(size, most) - whole_part(size, most)) * float(1 << DIGITS)).cast("long")
    return uniform - part + F.lit(1 << DIGITS)


def crossing(rows: DataFrame, at: DataFrame) -> DataFrame:
    """For each source the number at which its rows, in the order of their numbers, pass ``need`` beyond
    ``spent`` (or one above all of them), and what those before it have spent: (src, need, cut, spent)."""
    left = DIGITS + 1
    at = at.withColumn("cut", F.lit(0).cast("long"))
    while left > 0:
        bits = min(AT_ONCE, left)
        left -= bits
        inside = place(rows, at.select("src", "need", "spent", "cut")).where(F.shiftright("number", left + bits) == F.col("cut"))
        bins = inside.groupBy("src", "need", "spent", F.shiftright("number", left).alias("bin")).agg(F.sum("size").alias("tokens"))
        bins = bins.withColumn("after", F.col("spent") + F.sum("tokens").over(W.partitionBy("src").orderBy("bin")))
        over = F.min(F.when(F.col("after") > F.col("need"), F.struct("bin", "after", "tokens")))
        found = bins.groupBy("src").agg(over.alias("over"), F.max("after").alias("all"))
        first = F.shiftleft(F.col("cut"), bits)  # without a crossing the next digit starts behind all of them
        behind = F.when(F.col("all").isNull(), first).otherwise(first + (1 << bits))
        spent = F.coalesce(F.col("over.after") - F.col("over.tokens"), "all", "spent")
        at = B.checkpoint(at.join(found, "src", "left").select("src", "need", F.coalesce("over.bin", behind).alias("cut"), spent.alias("spent")))
    return at


def settle(sized: DataFrame, state: DataFrame, most: float = MOST) -> DataFrame:
    """``state`` with ``tiers``: bounds (above, below, size) of the documents to round up."""
    near = place(sized.where("size > 0"), state)
    sure = (F.col("size") * whole_part(F.col("size"), most)).alias("sure")
    numbered = B.checkpoint(near.select("src", "size", number(F.col("doc_id"), F.col("size"), most).alias("number"), sure))
    need = state.join(numbered.groupBy("src").agg(F.sum("sure").alias("sure")), "src", "left")
    at = need.select("src", (F.col("target") - F.coalesce("sure", F.lit(0))).alias("need"), F.lit(0).cast("long").alias("spent"))
    at = B.checkpoint(crossing(numbered, at).withColumn("tiers", F.array(F.struct(F.lit(-1).cast("long").alias("above"), F.col("cut").alias("below"), F.lit(1 << 62).alias("size")))))
    for _ in range(TIERS - 1):
        room = F.col("need") - F.col("spent")
        behind = place(numbered, at.select("src", "cut", room.alias("room"))).where("number > cut and size <= room")
        last = at.select("src", F.col("cut").alias("above"), F.floor(room).alias("size"), "tiers")
        tier = F.struct("above", F.col("cut").alias("below"), "size")
        at = crossing(behind.select("src", "size", "number"), at.select("src", "need", "spent")).join(last, "src")
        at = B.checkpoint(at.select("src", "need", "spent", "cut", F.concat("tiers", F.array(tier)).alias("tiers")))
    return B.checkpoint(state.join(at.select("src", "tiers"), "src"))


def place(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with their source's columns; a table of sources of a checked size is broadcast."""
    small = sources.count() <= BROADCAST_SOURCES
    return rows.join(F.broadcast(sources) if small else sources, "src")


def sized(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), source_key(F.col(source)).alias("src"), words_in(F.col(text)).alias("size"))


def copies(doc_id: Column, size: Column, most: float = MOST) -> Column:
    """Copies of a document beside the columns of ``plan``."""
    own = number(doc_id, size, most)
    up = F.exists("tiers", lambda t: (own > t["above"]) & (own < t["below"]) & (size <= t["size"]))
    return F.when(size == 0, 0).otherwise(whole_part(size, most) + F.when(up, 1).otherwise(0))


def plan(docs: DataFrame, weights: tuple[float, ...], share: float, most: float = MOST, targets: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents as (doc_id, src, size), and what ``copies`` needs of each source.

    ``targets`` (src, source_size, target) replaces the targets made from
    weights; ``src`` is ``source_key`` of the source.
    """
    rows = B.checkpoint(sized(docs))
    sizes = B.checkpoint(rows.groupBy("src", "size").agg(F.count("*").alias("n")))
    targets = B.checkpoint(shares(sizes, weights, share, most)) if targets is None else targets
    return rows, settle(rows, solve(sizes, targets, most), most)


def mix(docs: DataFrame, weights: tuple[float, ...], share: float, most: float = MOST, targets: DataFrame | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size`` (words), ``source_size``, ``target``, ``rate``,
    ``copies`` and ``taken`` (words in the mix).

    Null texts have no words and are not taken; a null source is a source of
    its own, the last. The same id always gets the same number, so reruns agree
    and rows of one id and size fare alike. An empty table gives no rows.
    """
    rows, sources = plan(docs, weights, share, most, targets)
    near = place(rows, sources)
    n = copies(F.col("doc_id"), F.col("size"), most)
    return near.select(
        "doc_id", F.when(F.col("src").startswith("0"), F.substring("src", 2, 1 << 30)).alias("source"), "size", "source_size",
        "target", rate(F.col("size"), most).alias("rate"), n.alias("copies"), (n * F.col("size")).alias("taken"),
    )


def mixed_documents(docs: DataFrame, weights: tuple[float, ...], share: float, most: float = MOST) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; columns as they were."""
    _, sources = plan(docs, weights, share, most)
    keep = [F.col(f"_doc.`{c}`").alias(c) for c in docs.columns]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"))
    rows = rows.withColumns({"src": source_key(F.col("_doc.source")), "_size": words_in(F.col("_doc.text"))})
    n = copies(F.col("_doc.doc_id").cast("long"), F.col("_size"), most)
    return place(rows, sources).withColumn("_n", n).where("_n > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_n"))).select(*keep)
