"""A hierarchical Pitman-Yor language model of words, sampled by Gibbs on Spark.

Each context (the word before, by its 64-bit hash) is a restaurant that seats
the words that follow it at tables; every table sends one customer to the
restaurant of single words, which all contexts share as their parent; its base
is uniform over the known words and one that stands for any other. Tasks own
words, so a word's tables in all contexts, and in the parent, are in one place.
What restaurants have in total goes round: a round draws seatings under the
totals of the round before, and tasks add up new totals. Those of common
contexts, of which there are ``CLASSES`` at most, are an array that all tasks
get. Those of all others, however many, are added up in shards of contexts,
which tell each bucket the totals of the contexts that it has.

In a round, the number of tables of each word in each restaurant is drawn anew
from its exact distribution given the totals (a blocked Gibbs step: all of its
customers move, so nothing of its own last seating is needed): t tables of n
customers weigh pull^t S(n, t), with generalised Stirling numbers S up to
``EXACT`` customers, and beyond that by an integral of their generating
function. Words that fill much of a sample are split by context among tasks, and
their totals go round as well.

A round goes on from what the one before has left: words with their customers
and tables in the parent, and what shards tell of contexts. The pairs that can
have several tables, a small part of the counts, are dealt once and stay; what
changes is written after each round and read for the next.

The score averages predictive probabilities over the rounds after the burn-in;
the tables of these rounds are drawn once more where the counts of all pairs are.
Its sums per document return by the chunk that the document came in.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.llm import blocks as B
from lumenframe.llm.words import Words
from lumenframe.session import work_dir

#: Size of arrays by common context; the last place is for all others together.
CLASSES = 1 << 16
OTHERS = NO_CODE = CLASSES - 1
#: ``MOVES`` customers of each word that are seated again, one by one, after a draw; it is exact, so needs none.
#: Burn-in ends when totals have settled; more samples change held-out perplexity by less than a thousandth.
BURN_IN, SAMPLES, MOVES = 4, 7, 0
#: Customers up to which Stirling numbers are tabled, and points of the integral beyond.
EXACT, POINTS = 512, 256
WIDTHS = [3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512]
#: Buckets a partition; a task counts one at a time. Bytes of text in a chunk, and of document sums that a task holds.
SPLIT, CHUNK, HELD_SUMS = 4, 6_000_000, 64_000_000
STRENGTH = 1.0
FOLDS, HELD_OUT = 7, 2
#: Words that fill more than this share of a sample of the documents are split by context, this many at most.
HOT_SHARE, HOT_WORDS, HOT_PARTS = 1 / 2000, 4096, 64
#: Names of the end as a word, of the start as a context.
END, START = np.uint64(0x656E64), np.uint64(0x7374617274)
NO_NAMES = np.zeros(0, dtype=np.uint64)

#: What buckets and shards of contexts tell each other, ``chunk`` being the shard: totals, a bucket's words that move
#: and what a round makes of them, contexts that it asks for, answers to a bucket; what a shard keeps, tables of a round.
NOTE = "part long, kind long, bucket long, chunk long, body binary"
_NOTE = pa.schema([("part", pa.int64()), ("kind", pa.int64()), ("bucket", pa.int64()), ("chunk", pa.int64()), ("body", pa.binary())])
TOTAL, STATE, MOVED, ASKED, TOLD, LISTED, COUNTED, ADDED = range(8)


@dataclass(frozen=True)
class Totals:
    """What a round knows of all restaurants; of a fixed size."""

    tokens: int
    types: int
    known: np.ndarray  # names of common contexts, ascending
    customers: np.ndarray  # of each of them, and at the last place of all others; so are the next two
    tables: np.ndarray
    fixed: np.ndarray  # tables that never move
    fixed_words: int  # words of one customer, which never move
    parent_customers: int
    parent_tables: int
    discount: float
    parent_discount: float
    hot: np.ndarray  # hashes of split words, ascending
    hot_count: np.ndarray
    hot_customers: np.ndarray  # in the parent
    hot_tables: np.ndarray  # in the parent

    def base(self) -> float:
        return 1.0 / (self.types + 1)

    def parent(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Probability of words in the parent, from their customers and tables there."""
        spread = (STRENGTH + self.parent_discount * self.parent_tables) * self.base()
        return (customers - self.parent_discount * tables + spread) / (STRENGTH + self.parent_customers)


def is_held_out(ids: np.ndarray) -> np.ndarray:
    return np.array([zlib.crc32(b"" if i == B.NO_ID else str(i).encode()) % FOLDS == HELD_OUT for i in ids.tolist()], dtype=bool)


def common_words(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Words by how common they are, and those to split, ascending; a matter of what is sent and where, so a sample of documents tells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, texts in B.chunks(batches):
            words = Words(texts, lower=True)
            some, n = np.unique(np.append(words.hash, np.full(len(texts), END)), return_counts=True)
            yield from counted_rows(some, n)

    return most_common(rows.where("pmod(key, 32) = 0").mapInArrow(run, B.BLOCK))


def counted_rows(names: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Names as buckets, their counts as chunks."""
    some = [pa.array(names.view(np.int64)), pa.array(counts.astype(np.int64)), pa.array([b""] * len(names), pa.binary())]
    yield pa.RecordBatch.from_arrays(some, schema=B.block(()).schema)


def most_common(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Names by count, the start first, as many as arrays by common context have places; those to split."""
    most = counted.groupBy("bucket").agg(F.sum("chunk").alias("n")).orderBy(F.desc("n"), "bucket").limit(NO_CODE - 1).toArrow()
    names, n = most["bucket"].to_numpy().view(np.uint64), most["n"].to_numpy()
    return np.append(START, names[names != START]), np.sort(names[n > HOT_SHARE * n.sum()][:HOT_WORDS])


def is_hot(hot: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(hot, w), max(0, len(hot) - 1))
    return (hot[at] == w if len(hot) else np.zeros(len(w), dtype=bool)), at


def places_of(known: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Where the totals of these contexts are in arrays by common context."""
    at = np.minimum(np.searchsorted(known, names), max(0, len(known) - 1))
    return np.where(known[at] == names, at, OTHERS) if len(known) else np.full(len(names), OTHERS)


def coded(code: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, ...]:
    """Codes of common words, low and high bytes, and the names of what has none, in order."""
    return (code & 255).astype(np.uint8), (code >> 8).astype(np.uint8), names[code == NO_CODE]


def pair_blocks(hot: np.ndarray, buckets: int, common: np.ndarray = NO_NAMES):
    """Rows of text to blocks: words, their contexts with counts in training, and the documents they are in.

    Words and contexts among ``common`` are sent as two bytes, all others by their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.argsort(common)
        for seq, (ids, keys, texts) in enumerate(B.chunks(batches, CHUNK)):
            words = Words(texts, lower=True)
            at = words.first + np.arange(len(texts) + 1)  # each text's tokens: its words and the end
            token = np.full(at[-1] + 1, END, dtype=np.uint64)
            doc = np.repeat(np.arange(len(texts)), np.diff(at))
            token[np.arange(len(words.hash)) + words.text] = words.hash
            token[-1] = START
            names, word = np.unique(token, return_inverse=True)
            start, word = word[-1], word[:-1]
            context = np.empty_like(word)
            context[1:] = word[:-1]
            context[at[:-1]] = start
            place = places_of(common[order], names)
            code = np.where(place == OTHERS, NO_CODE, np.append(order, NO_CODE)[np.minimum(place, len(order))])
            held = is_held_out(ids)
            pair = np.argsort(word * len(names) + context, kind="stable")  # documents ascend in each
            word, context, doc = word[pair], context[pair], doc[pair]
            step = np.ones((3, len(word)), dtype=bool)  # a new document of a pair, a new pair, a new word
            step[2, 1:] = word[1:] != word[:-1]
            step[1, 1:] = step[2, 1:] | (context[1:] != context[:-1])
            step[0, 1:] = step[1, 1:] | (doc[1:] != doc[:-1])
            in_doc, in_pair = np.flatnonzero(step[0]), np.flatnonzero(step[1])
            times = np.diff(np.append(in_doc, len(word)))
            trained = np.add.reduceat((~held[doc]).astype(np.int64), in_pair)
            docs_of = np.diff(np.append(np.searchsorted(in_doc, in_pair), len(in_doc)))
            w, k = word[in_pair], context[in_pair]
            split, _ = is_hot(hot, names)
            salt = np.where(split[w], (names[k] >> np.uint64(20)) % np.uint64(HOT_PARTS), np.uint64(0))
            bucket = ((names[w] + salt * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(buckets)).astype(np.int64)
            task = TaskContext.get().partitionId() if TaskContext.get() else 0
            chunk = xxhash.xxh64_intdigest(ids.tobytes() + keys.tobytes() + b"%d,%d" % (task, seq)) >> 1
            rows = [(buckets + chunk % buckets, chunk, B.pack(np.zeros(1, np.int8), ids, held, np.diff(at)))]
            starts = np.cumsum(docs_of) - docs_of
            for b, (n,) in B.deal(bucket, np.arange(len(w))):
                entries = np.repeat(starts[n] - (np.cumsum(docs_of[n]) - docs_of[n]), docs_of[n]) + np.arange(docs_of[n].sum())
                new = np.flatnonzero(np.diff(w[n], prepend=-1))
                some, of = doc[in_doc[entries]], w[n][new]
                rows.append((b, chunk, B.pack(
                    *coded(code[of], names[of]), np.diff(np.append(new, len(n))).astype(np.uint32), *coded(code[k[n]], names[k[n]]), trained[n].astype(np.uint32),
                    docs_of[n].astype(np.uint32), some.astype(np.uint16 if len(texts) < 1 << 16 else np.uint32), times[entries].astype(np.uint32), np.array([len(texts)]),
                )))
            yield B.block(rows)

    return run


class Bucket:
    """Words of a bucket with their contexts, counted over all chunks; what it holds does not depend on ``common``.

    ``context`` is the number among ``names``, those of all contexts here, ascending.
    """

    def __init__(self, number: int, rows: list[tuple[int, bytes]], common: np.ndarray = NO_NAMES):
        self.number, self.parts = number, []
        ws, named_ws, ns, ks, named_ks, cs = [], [], [], [], [], []
        for chunk, body in rows:
            low, high, named_w, n, low_k, high_k, named_k, c, docs_of, doc, times, n_docs = B.unpack(body)
            ws.append(low + (high.astype(np.int64) << 8))
            named_ws.append(named_w)
            ns.append(n)
            ks.append(low_k + (high_k.astype(np.int64) << 8))
            named_ks.append(named_k)
            cs.append(c)
            self.parts.append((chunk, len(c), docs_of, doc, times, int(n_docs[0])))
        padded = np.concatenate([common, np.zeros(CLASSES - len(common), np.uint64)])
        w, k, c = np.concatenate(ws), np.concatenate(ks), np.concatenate(cs).astype(np.int64)
        by_name, w = w == NO_CODE, padded[w]
        w[by_name] = np.concatenate(named_ws)
        self.words, w = np.unique(w, return_inverse=True)
        w = np.repeat(w, np.concatenate(ns))
        rare, at = np.unique(np.concatenate(named_ks), return_inverse=True)
        k[k == NO_CODE] = CLASSES + at
        here = np.zeros(CLASSES + len(rare), dtype=bool)
        here[k] = True
        here = np.flatnonzero(here)
        self.names = np.concatenate([padded, rare])[here]
        by_hash = np.argsort(self.names)
        self.names, number_of = self.names[by_hash], np.zeros(CLASSES + len(rare), np.int64)
        number_of[here[by_hash]] = np.arange(len(here))
        pair = w * len(self.names) + number_of[k]
        order = np.argsort(pair, kind="stable")  # of ascending runs, one a chunk
        pair = pair[order]
        new = np.diff(pair, prepend=-1) != 0
        first = np.flatnonzero(new)
        self.word, self.context = np.divmod(pair[first], len(self.names))
        self.count = np.add.reduceat(c[order], first)
        self.of_entry = np.empty(len(w), dtype=np.int64)  # the pair that each chunk's entry is
        self.of_entry[order] = np.cumsum(new) - 1
        self.word_count = np.bincount(self.word, weights=self.count, minlength=len(self.words)).astype(np.int64)


def seat(count: np.ndarray, pull: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables after ``count`` customers of each word; ``pull`` is the weight of a new table.

    With j customers at t tables, the chance that none of the next k opens one
    is the k-th moment of a Beta(j - discount t, pull), so the wait for the
    next table is geometric given a draw of it.
    """
    tables = (count > 0).astype(np.int64)
    seated = tables.copy()
    active = np.flatnonzero(count > 1)
    while len(active):
        join = rng.beta(seated[active] - discount * tables[active], pull[active])
        wait = rng.geometric(np.clip(1.0 - join, 1e-12, 1.0))
        seated[active] += np.minimum(wait, 1 << 60)
        opened = seated[active] <= count[active]
        tables[active[opened]] += 1
        active = active[opened & (seated[active] < count[active])]
    return tables


def gibbs(count: np.ndarray, tables: np.ndarray, pull: np.ndarray, discount: float, moves: int, rng: np.random.Generator) -> np.ndarray:
    """Tables after ``moves`` moves: of every word with several customers a random one leaves and is seated again."""
    some = np.flatnonzero(count > 1)
    if not len(some) or not moves:
        return tables
    n, t, weight = count[some], tables[some].copy(), pull[some]
    owner = np.repeat(np.arange(len(some)), t)
    share = rng.standard_gamma(1.0 - discount, size=len(owner)) + 1e-300
    share /= np.bincount(owner, weights=share)[owner]
    size = 1 + np.floor(share * (n - t)[owner]).astype(np.int64)
    head = np.cumsum(t) - t
    size[head] += n - np.bincount(owner, weights=size).astype(np.int64)
    for _ in range(moves):
        ends = np.cumsum(size)
        before = np.append(0, ends)[head]
        leaves = np.searchsorted(ends, before + np.minimum((rng.random(len(n)) * n).astype(np.int64), n - 1), side="right")
        size[leaves] -= 1
        t -= size[leaves] == 0
        open_ = np.where(size > 0, size - discount, 0.0)
        ends = np.cumsum(open_)
        before = np.append(0.0, ends)[head]
        staying = n - 1 - discount * t
        draw = rng.random(len(n)) * (staying + weight)
        fresh = draw >= staying
        joins = np.minimum(np.searchsorted(ends, before + draw, side="right"), np.append(head[1:], len(size)) - 1)
        while (empty := ~fresh & (size[joins] == 0)).any():  # rounding at an edge
            joins[empty] -= 1
        size[joins[~fresh]] += 1
        keep = size > 0
        size, owner = np.append(size[keep], np.ones(fresh.sum(), np.int64)), np.append(owner[keep], np.flatnonzero(fresh))
        order = np.argsort(owner, kind="stable")
        size, owner = size[order], owner[order]
        t = t + fresh
        head = np.cumsum(t) - t
    out = tables.copy()
    out[some] = t
    return out


@lru_cache(4)
def log_stirling(discount: float) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers S(n, t) up to ``EXACT``: weights of all seatings of n at t tables."""
    out = np.full((EXACT + 1, EXACT + 1), -np.inf)
    out[0, 0] = 0.0
    t = np.arange(EXACT + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        for n in range(EXACT):
            joined = out[n] + np.log(np.maximum(n - discount * t, 0.0))
            out[n + 1, 1:] = np.logaddexp(out[n, :-1], np.where(t[1:] <= n, joined[1:], -np.inf))
    return out


def saddles(count: np.ndarray, pull: np.ndarray, discount: float) -> np.ndarray:
    """The logarithm of w for each count, where (1 - w) pull w^(d - 1) = n."""
    low, high = np.full(len(count), -700.0), np.zeros(len(count))
    start, most = np.log(pull), np.log(count)
    with np.errstate(divide="ignore"):  # at w = 1
        for _ in range(60):
            middle = (low + high) / 2
            above = start + (discount - 1) * middle + np.log1p(-np.exp(middle)) > most
            low, high = np.where(above, middle, low), np.where(above, high, middle)
    return low


def log_weights(count: int, pull: float, discount: float, saddle: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of tables that ``count`` customers may have, and their log weights, for a large count.

    pull^t S(n, t) is, but for a constant, a^t / t! times the n-th coefficient of (1 - (1 - x)^d)^t, with a = pull / d.
    That is an integral along x = 1 - w (1 + iy)^2, which passes the saddle of the sum over t and goes round the cut.
    """
    a = pull / discount
    low = float(saddles(np.array([count]), np.array([pull]), discount)[0]) if saddle is None else saddle
    w = max(math.exp(low), 1.0 / count)
    centre, spread = a * (1 - w**discount), math.sqrt(a + 1)
    t = np.arange(max(1, int(centre - 9 * spread - 3)), min(count, int(centre + 9 * spread + 15)) + 1)
    y = np.linspace(0, 1, POINTS) * math.sqrt(45 / ((1 - discount) * count * w))  # the other half is its mirror image
    x = 1 - w * (1 + 1j * y) ** 2
    inner, outer = np.log(1 - w**discount * (1 + 1j * y) ** (2 * discount)), np.log(1 + 1j * y) - (count + 1) * np.log(x)
    # the integrand at t = t0 + stride i + j is a product of one factor of i and one of j
    stride = math.isqrt(len(t)) + 1
    rise, start = inner - inner[0], outer - outer[0] + t[0] * (inner - inner[0])
    start[0] -= math.log(2)
    left = np.exp(start + stride * np.arange(-(-len(t) // stride))[:, None] * rise)
    total = (left @ np.exp(np.arange(stride)[:, None] * rise).T).real.ravel()[: len(t)]
    out = np.log(np.maximum(total, 1e-300)) + outer[0].real + t * inner[0].real
    return t, out + t * math.log(a) - np.cumsum(np.log(t))


def draw(count: np.ndarray, pull: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of ``count`` customers of each word, drawn from their distribution; ``pull`` is the weight of a new table."""
    tables = (count > 0).astype(np.int64)
    logs = np.log(pull)
    uniform = rng.random(len(count))
    two = np.flatnonzero(count == 2)  # the second joins the first or opens a table
    tables[two] += uniform[two] * (pull[two] + 1 - discount) >= 1 - discount
    some = np.flatnonzero((count > 2) & (count <= EXACT))
    order = some[np.argsort(count[some], kind="stable")]
    edges = np.searchsorted(count[order], WIDTHS, side="right")
    for lo, hi, width in zip([0, *edges[:-1]], edges, WIDTHS, strict=True):  # numbers of customers that are much alike
        size = 100_000 // width + 1
        for at in range(lo, hi, size):
            part = order[at : min(at + size, hi)]
            weights = log_stirling(discount)[count[part], 1 : width + 1] + logs[part, None] * np.arange(1, width + 1)
            weights -= weights.max(axis=1, keepdims=True)
            shares = np.cumsum(np.exp(weights, out=weights), axis=1)
            tables[part] = 1 + np.minimum(count[part] - 1, (shares < uniform[part, None] * shares[:, -1:]).sum(axis=1))
    large = np.flatnonzero(count > EXACT)
    for k, saddle in zip(large.tolist(), saddles(count[large], pull[large], discount).tolist(), strict=True):
        t, weights = log_weights(int(count[k]), float(pull[k]), discount, saddle)
        shares = np.cumsum(np.exp(weights - weights.max()))
        tables[k] = t[min(len(t) - 1, int(np.searchsorted(shares, uniform[k] * shares[-1])))]
    return tables


class Moving:
    """What rounds change of a bucket: tables of pairs with several customers, and words that have such or several pairs.

    All else stays at one table. Split words are among these whatever they have. ``customers`` and ``in_parent`` are the
    words' customers and tables in the parent after the last round, at first those of one table a pair.
    """

    def __init__(self, number: int, place: np.ndarray | None, context: np.ndarray, count: np.ndarray, pairs: np.ndarray, alone: np.ndarray, hot: np.ndarray, customers: np.ndarray, in_parent: np.ndarray, names: np.ndarray = NO_NAMES):
        self.number, self.names = number, names
        self.place = None if place is None else place.astype(np.int64)  # of each context in arrays by common context
        self.context, self.count = context.astype(np.int64), count.astype(np.int64)
        self.pairs, self.word = pairs, np.repeat(np.arange(len(pairs)), pairs)  # pairs of each word, and the word of each
        self.alone, self.hot = alone.astype(np.int64), hot.astype(np.int64)  # pairs of one customer; the split word, or -1
        self.customers, self.in_parent = customers.astype(np.int64), in_parent.astype(np.int64)

    def packed(self) -> bytes:
        small = (x.astype(np.uint32) for x in (self.context, self.count, self.pairs, self.alone))
        return B.pack(self.place.astype(np.uint16), *small, self.hot.astype(np.int32), *self.moved())

    def moved(self) -> tuple[np.ndarray, np.ndarray]:
        return self.customers.astype(np.uint32), self.in_parent.astype(np.uint32)

    def others(self) -> np.ndarray:
        """Contexts that are not among the common ones, by name."""
        return np.flatnonzero(self.place == OTHERS)

    def shared(self, own: np.ndarray, split: np.ndarray) -> np.ndarray:
        """What is known of the words: their own figures, or those of split words from all parts."""
        return np.where(self.hot >= 0, split[self.hot], own) if len(split) else own

    def above(self, totals: Totals) -> np.ndarray:
        return totals.parent(self.shared(self.customers, totals.hot_customers), self.shared(self.in_parent, totals.hot_tables))

    def seat_again(self, totals: Totals, number: int, moves: int, told: np.ndarray = NO_NAMES) -> np.ndarray:
        """Tables of the pairs in one more round; its draws depend on its number, what is here and the totals alone.

        ``told`` are tables of the contexts that are not common.
        """
        if self.place is None:
            self.place = places_of(totals.known, self.names)
        rng = np.random.default_rng([number, self.number])
        of_context, others = totals.tables[self.place], self.others()
        if len(told) != len(others):
            raise RuntimeError("contexts of a bucket and their totals did not meet")
        of_context[others] = told
        pull = (STRENGTH + totals.discount * of_context[self.context]) * self.above(totals)[self.word]
        tables = gibbs(self.count, draw(self.count, pull, totals.discount, rng), pull, totals.discount, moves, rng)
        self.customers = self.alone + np.bincount(self.word, weights=tables, minlength=len(self.alone)).astype(np.int64)
        self.in_parent = parent_tables(self.customers, totals, moves, rng)
        return tables


def moving(bucket: Bucket, hot: np.ndarray, known: np.ndarray | None = None) -> tuple[Moving, np.ndarray, np.ndarray]:
    """What moves of a bucket before the first round; the numbers of these pairs and words in it."""
    size = len(bucket.words)
    customers = np.bincount(bucket.word, weights=bucket.count > 0, minlength=size).astype(np.int64)
    several = np.bincount(bucket.word, weights=bucket.count > 1, minlength=size).astype(np.int64)
    split, at = is_hot(hot, bucket.words)
    pairs, words = np.flatnonzero(bucket.count > 1), np.flatnonzero((several > 0) | (customers > 1) | split)
    alone, at = (customers - several)[words], np.where(split, at, -1)[words]
    here = np.zeros(len(bucket.names), dtype=bool)
    here[bucket.context[pairs]] = True
    names, context = bucket.names[here], (np.cumsum(here) - 1)[bucket.context[pairs]]
    place = None if known is None else places_of(known, names)
    out = Moving(bucket.number, place, context, bucket.count[pairs], several[words], alone, at, customers[words], customers[words] > 0, names)
    return out, pairs, words


def parent_tables(customers: np.ndarray, totals: Totals, moves: int, rng: np.random.Generator) -> np.ndarray:
    pull = np.full(len(customers), (STRENGTH + totals.parent_discount * totals.parent_tables) * totals.base())
    return gibbs(customers, draw(customers, pull, totals.parent_discount, rng), pull, totals.parent_discount, moves, rng)


_SLICES = 16
#: Buckets of the rows with totals: slices of the contexts, then the other figures.
TOTALS = -1 - _SLICES


def sums(bucket: Bucket, hot: np.ndarray, known: np.ndarray) -> list[np.ndarray]:
    """A bucket's share of the totals, each pair at one table: of each common context; of each split word; single figures.

    Of contexts: customers, tables, tables that never move. Of these figures the last two are words and their tables that never move.
    """
    split, at = is_hot(hot, bucket.words)
    customers = np.bincount(bucket.word, weights=bucket.count > 0, minlength=len(bucket.words)).astype(np.int64)
    trained, own = bucket.word_count > 0, ~split
    fixed = own & (customers == 1) & (bucket.word_count == 1)
    figures = [
        bucket.word_count.sum(), (trained & own).sum(), customers.sum(), (customers[own] > 0).sum(), (bucket.count == 1).sum(), (bucket.count == 2).sum(),
        (customers[own] == 1).sum(), (customers[own] == 2).sum(), fixed.sum(),
    ]
    context = places_of(known, bucket.names)[bucket.context]
    per_context = [np.bincount(context, weights=x, minlength=CLASSES) for x in (bucket.count, bucket.count > 0, bucket.count == 1)]
    per_hot = [np.bincount(at[split], weights=x[split], minlength=len(hot)) for x in (bucket.word_count, customers)]
    return [x.astype(np.int64) for x in (*per_context, *per_hot, np.array(figures))]


def moved_sums(m: Moving, tables: np.ndarray, n_hot: int) -> list[np.ndarray]:
    """What moves of a bucket's share of the totals after a round: tables of each common context; customers of each split word; customers and tables in the parent."""
    own = m.hot < 0
    per_context = np.bincount(m.place[m.context], weights=tables, minlength=CLASSES)
    per_hot = np.bincount(m.hot[~own], weights=m.customers[~own], minlength=n_hot)
    return [x.astype(np.int64) for x in (per_context, per_hot, np.array([m.customers.sum(), m.in_parent[own].sum()]))]


def total_rows(total: list[np.ndarray]) -> pa.RecordBatch:
    """Totals as rows: of contexts in slices, ``_SLICES`` of them, and one of the rest."""
    cuts = [np.array_split(x, _SLICES) for x in total if len(x) == CLASSES]
    rows = [(-1 - k, 0, B.pack(*(c[k] for c in cuts))) for k in range(_SLICES)]
    return B.block([*rows, (TOTALS, 0, B.pack(*total[len(cuts) :]))])


def added_up(rows: DataFrame) -> list[np.ndarray]:
    """The sum of all tasks' totals; none if there were no buckets."""

    def add(group: pa.Table) -> pa.Table:
        parts = [B.unpack(b) for b in group.column("body").to_pylist()]
        return B.table([(group.column("bucket")[0].as_py(), 0, B.pack(*(np.sum(x, axis=0) for x in zip(*parts, strict=True))))])

    found = {r["bucket"]: B.unpack(bytes(r["body"])) for r in rows.where("bucket < 0").groupBy("bucket").applyInArrow(add, B.BLOCK).collect()}
    if not found:
        return []
    return [np.concatenate(x) for x in zip(*(found[-1 - k] for k in range(_SLICES)), strict=True)] + found[TOTALS]


def own_buckets(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """The blocks of a partition by bucket; directories under -1."""
    held: dict[int, list[tuple[int, bytes]]] = {}
    for part in batches:
        for b, chunk, body in zip(*(c.to_pylist() for c in part.columns), strict=True):
            held.setdefault(b if b < buckets else -1, []).append((chunk, body))
    yield from held.items()


class Parts:
    """Where buckets and shards of contexts are: a part a partition, named so that Spark deals one to each.

    Of many parts not all have a shard, as each part writes to each shard.
    """

    def __init__(self, df: DataFrame):
        self.n = B.partitions(df)
        self.n_shards = min(self.n, 24 + self.n // 10)
        own: dict[int, int] = {}
        tried = 16 * self.n
        while len(own) < self.n:
            found = df.sparkSession.range(tried).select("id", F.pmod(F.hash("id"), F.lit(self.n)).alias("partition"))
            own = {r["partition"]: r["id"] for r in found.collect()}
            tried *= 2
        self.names = [own[k] for k in range(self.n)]

    def of(self, bucket: int) -> int:
        return self.names[bucket % self.n]

    def column(self) -> Column:
        return F.element_at(F.lit(self.names), (F.col("bucket") % self.n + 1).cast("int")).cast("long")

    def shards(self, names: np.ndarray) -> Iterator[tuple[int, slice]]:
        """Shards of contexts by name, and where in ``names``, which ascend, theirs are."""
        shard = ((names >> np.uint64(32)) * np.uint64(self.n_shards) >> np.uint64(32)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(shard, prepend=-1)).tolist()
        for lo, hi in zip(cuts, [*cuts[1:], len(names)], strict=True):
            yield int(shard[lo]), slice(lo, hi)


def dealt(rows: DataFrame) -> DataFrame:
    """The rows by part, written to the shared folder; Spark knows afterwards how they are dealt, which it does not of adaptive plans."""
    conf, adaptive = rows.sparkSession.conf, "spark.sql.adaptive.enabled"
    before = conf.get(adaptive)
    conf.set(adaptive, "false")
    try:
        return B.checkpoint(rows.repartition(B.partitions(rows), "part"))
    finally:
        conf.set(adaptive, before)


def notes(rows: Iterator[tuple[int, int, int, int, bytes]]) -> pa.RecordBatch:
    return B.batch(rows, _NOTE)


def note_rows(some: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, int, int, bytes]]:
    """Kind, bucket, shard and body."""
    yield from zip(*(some.column(c).to_pylist() for c in ("kind", "bucket", "chunk", "body")), strict=True)


def total_notes(total: list[np.ndarray]) -> pa.RecordBatch:
    return notes((0, TOTAL, *row) for row in zip(*(c.to_pylist() for c in total_rows(total).columns), strict=True))


def asked(bucket: Bucket, known: np.ndarray, parts: Parts) -> Iterator[tuple[int, int, int, int, bytes]]:
    """A bucket's contexts that are not common, by shard: names, customers, pairs of one, pairs of several."""
    others = np.flatnonzero(places_of(known, bucket.names) == OTHERS)
    if len(others):
        each = [np.bincount(bucket.context, weights=x, minlength=len(bucket.names))[others].astype(np.uint32) for x in (bucket.count, bucket.count == 1, bucket.count > 1)]
        names = bucket.names[others]
        for shard, at in parts.shards(names):
            yield parts.of(shard), ASKED, bucket.number, shard, B.pack(np.diff(names[at], prepend=np.uint64(0)), *(x[at] for x in each))


def first_round(hot: np.ndarray, buckets: int, common: np.ndarray, known: np.ndarray, parts: Parts):
    """Blocks to what moves of them, each pair at one table, to totals, and to what is asked of shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for number, rows in own_buckets(batches, buckets):
            if number >= 0:
                bucket = Bucket(number, rows, common)
                share = sums(bucket, hot, known)
                total = share if total is None else [a + b for a, b in zip(total, share, strict=True)]
                yield notes([(parts.of(number), STATE, number, -1, moving(bucket, hot, known)[0].packed()), *asked(bucket, known, parts)])
        if total is not None:
            yield total_notes(total)

    return run


def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, int, list[np.ndarray]]]]]:
    """The notes to the shards of a partition: kind, bucket, arrays."""
    held: dict[int, list[tuple[int, int, bytes]]] = {}
    for some in batches:
        for kind, b, shard, body in note_rows(some):
            held.setdefault(shard, []).append((kind, b, body))
    for shard, rows in held.items():
        yield shard, [(kind, b, B.unpack(body)) for kind, b, body in rows]


def first_answers(parts: Parts):
    """What a bucket needs in rounds: its moving contexts' numbers in the shard, tables that never move, all others. What the shard keeps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in by_shard(batches):
            names, at = np.unique(np.concatenate([np.cumsum(x[0], dtype=np.uint64) for _, _, x in rows]), return_inverse=True)
            customers, fixed, several = (np.bincount(at, weights=np.concatenate([x[k] for _, _, x in rows]), minlength=len(names)).astype(np.int64) for k in (1, 2, 3))
            out, done = [(parts.of(shard), COUNTED, -1, shard, B.pack(*(x.astype(np.uint32) for x in (customers, fixed, several))))], 0
            for _, b, x in rows:
                own = at[done : done + len(x[0])]
                done += len(own)
                out.append((parts.of(shard), LISTED, b, shard, B.pack(B.steps(own))))
                move = own[x[3] > 0]
                if len(move):
                    out.append((parts.of(b), TOLD, b, shard, B.pack(B.steps(move), fixed[move].astype(np.uint32), several[move].astype(np.uint32))))
            yield notes(out)

    return run


def answers():
    """Tables of a round, added up, to each part that has the context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in by_shard(batches):
            own = [B.back(x[1]) for _, _, x in rows]
            total = np.zeros(max(int(at[-1]) for at in own) + 1, np.int64)
            for at, (_, _, x) in zip(own, rows, strict=True):
                total[at] += x[2]
            yield notes((part, TOLD, -1, shard, B.pack(total[at].astype(np.uint32))) for at, (_, part, _) in zip(own, rows, strict=True))

    return run


def history(parts: Parts, rounds: int):
    """Customers of each context that a bucket asked for, and its tables before the first round and after each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in by_shard(batches):
            customers, fixed, several = next(x for kind, _, x in rows if kind == COUNTED)
            moved = np.flatnonzero(several)
            number = np.cumsum(several > 0) - 1
            tables = np.zeros((rounds + 1, len(moved)), np.int64)
            tables[0] = several[moved]
            for _, _, x in (r for r in rows if r[0] == ADDED):
                tables[x[0][0], number[B.back(x[1])]] += x[2]
            changes = np.diff(tables, axis=0).astype(np.int32)
            for _, b, x in (r for r in rows if r[0] == LISTED):
                own = B.back(x[0])
                move = several[own] > 0
                yield notes([(parts.of(b), TOLD, b, shard, B.pack(customers[own], fixed[own] + several[own], move, changes[:, number[own[move]]].ravel()))])

    return run


@dataclass(frozen=True)
class Others:
    """Contexts of a bucket that are not common: customers of each, and tables before the first round and after each."""

    customers: np.ndarray
    tables: np.ndarray

    @classmethod
    def told(cls, by_shards: dict[int, list[np.ndarray]], rounds: int) -> Others:
        customers, tables = [np.zeros(0, np.int64)], [np.zeros((rounds + 1, 0), np.int64)]
        for _, (n, first, move, changes) in sorted(by_shards.items()):
            some = np.zeros((rounds + 1, len(n)), np.int64)
            some[0], some[1:, move] = first, changes.reshape(rounds, -1)
            customers.append(n)
            tables.append(np.cumsum(some, axis=0))
        return cls(np.concatenate(customers).astype(np.int64), np.concatenate(tables, axis=1))


def next_round(totals: Totals, number: int, moves: int, parts: Parts):
    """What moves of a part, seated once more under these totals and those that shards told, and the totals of that."""

    def run(still: pa.Table, moved: pa.Table) -> pa.Table:
        states: dict[int, Moving] = {}
        numbers, tables, last = {}, {}, {}
        for kind, b, shard, body in note_rows(still):
            if kind == STATE:
                place, *rest = B.unpack(body)
                states[b] = Moving(b, place, *rest)
            else:
                steps, fixed, several = B.unpack(body)
                numbers.setdefault(b, {})[shard] = B.back(steps), fixed, several
        for kind, b, shard, body in note_rows(moved):
            if kind == MOVED:
                last[b] = B.unpack(body)
            else:
                tables[shard] = B.unpack(body)[0]
        of_part: dict[int, list[np.ndarray]] = {}
        for own in numbers.values():
            for shard, (at, *_) in own.items():
                of_part.setdefault(shard, []).append(at)
        here = {shard: np.unique(np.concatenate(some)) for shard, some in sorted(of_part.items())}
        added = {shard: np.zeros(len(at), np.int64) for shard, at in here.items()}
        rows, total = [], None
        for b, m in sorted(states.items()):
            if number:
                m.customers, m.in_parent = (x.astype(np.int64) for x in last[b])
            own = [(shard, np.searchsorted(here[shard], at), fixed, several) for shard, (at, fixed, several) in sorted(numbers.get(b, {}).items())]
            told = [fixed + (tables[shard][at] if number else several) for shard, at, fixed, several in own]
            drawn = m.seat_again(totals, number, moves, np.concatenate([NO_NAMES, *told]))
            per_context, done = np.bincount(m.context, weights=drawn, minlength=len(m.place))[m.others()].astype(np.int64), 0
            for shard, at, *_ in own:
                added[shard][at] += per_context[done : done + len(at)]
                done += len(at)
            rows.append((parts.of(b), MOVED, b, -1, B.pack(*m.moved())))
            share = moved_sums(m, drawn, len(totals.hot))
            total = share if total is None else [x + y for x, y in zip(total, share, strict=True)]
        for shard, at in here.items():
            rows.append((parts.of(shard), ADDED, still["part"][0].as_py(), shard, B.pack(np.array([number + 1]), B.steps(at), added[shard].astype(np.uint32))))
        return pa.Table.from_batches([notes(rows), *([] if total is None else [total_notes(total)])], schema=_NOTE)

    return run


def common_contexts(blocks: DataFrame, buckets: int, common: np.ndarray) -> np.ndarray:
    """The most common contexts of the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in own_buckets(batches, buckets):
            if number >= 0:
                bucket = Bucket(number, rows, common)
                yield from counted_rows(bucket.names, np.bincount(bucket.context, weights=bucket.count))

    return most_common(blocks.mapInArrow(run, B.BLOCK))[0]


def all_rounds(blocks: DataFrame, hot: np.ndarray, buckets: int, number: int, moves: int, known: np.ndarray | None = None) -> list[Totals]:
    """Totals before the first of ``number`` rounds and after each; contexts ``known`` have places in them, by default the most common."""
    known = common_contexts(blocks, buckets, NO_NAMES) if known is None else known
    return seated(blocks, hot, buckets, number, moves, NO_NAMES, np.unique(known), Parts(blocks))[0]


def seated(blocks: DataFrame, hot: np.ndarray, buckets: int, number: int, moves: int, common: np.ndarray, known: np.ndarray, parts: Parts) -> tuple[list[Totals], DataFrame]:
    """Totals before the first of ``number`` rounds and after each; those of contexts that are not ``known``, as told to the buckets that have them.

    What never changes is dealt once and stays where it is. A round reads what changed in the one before, words'
    customers and tables in the parent and the tables that shards tell, and writes that again, so it costs the same
    whatever its number.
    """
    spark = blocks.sparkSession

    def stored(rows: DataFrame, label: str) -> DataFrame:
        folder = work_dir(spark, label)
        rows.write.parquet(folder)
        return spark.read.schema(NOTE).parquet(folder)

    def shards(rows: DataFrame, run) -> DataFrame:
        return rows.repartition(F.col("part")).mapInArrow(run, NOTE)

    left = stored(blocks.select("bucket", "chunk", "body").mapInArrow(B.released(first_round(hot, buckets, common, known, parts)), NOTE), "seating")
    counted = added_up(left.where(f"kind = {TOTAL}").select("bucket", "chunk", "body"))
    if not counted:
        nothing = [np.zeros(CLASSES, np.int64)] * 3 + [np.zeros(len(hot), np.int64)] * 2 + [np.zeros(9, np.int64)]
        return [first_totals(hot, known, nothing)], left
    rounds = [first_totals(hot, known, counted)]
    kept = stored(shards(left.where(f"kind = {ASKED}"), first_answers(parts)), "contexts")
    still = dealt(left.where(f"kind = {STATE}").union(kept.where(f"kind = {TOLD}"))).groupBy("part")
    added, moved = [], left.where("false")
    for n in range(number):
        left = stored(still.cogroup(moved.groupBy("part")).applyInArrow(next_round(rounds[-1], n, moves, parts), NOTE), "seating")
        added.append(left.where(f"kind = {ADDED}"))
        moved = left.where(f"kind = {MOVED}").union(shards(added[-1], answers()))
        rounds.append(next_totals(rounds[-1], added_up(left.where(f"kind = {TOTAL}").select("bucket", "chunk", "body")), n, moves))
    told = shards(reduce(DataFrame.union, added, kept.where(f"kind in ({LISTED}, {COUNTED})")), history(parts, number))
    return rounds, told


def first_totals(hot: np.ndarray, known: np.ndarray, counted: list[np.ndarray]) -> Totals:
    customers, tables, fixed, hot_count, hot_customers, figures = counted
    tokens, types, parent_customers, own_tables, once, twice, parent_once, parent_twice, fixed_words = figures.tolist()
    split = (hot_customers > 0).astype(np.int64)
    # discounts by the usual estimate from the words seen once and twice
    estimate = [min(0.95, max(0.05, a / max(1, a + 2 * b))) for a, b in ((once, twice), (parent_once, parent_twice))]
    return Totals(
        tokens, types + int(split.sum()), known, customers, tables, fixed, fixed_words, parent_customers, own_tables + int(split.sum()), *estimate, hot, hot_count, hot_customers, split
    )


def next_totals(before: Totals, counted: list[np.ndarray], number: int, moves: int) -> Totals:
    tables, hot_customers, figures = counted
    split = parent_tables(hot_customers, before, moves, np.random.default_rng([number, 1 << 40]))
    return replace(
        before, tables=before.fixed + tables, parent_customers=int(before.fixed_words + figures[0]),
        parent_tables=int(before.fixed_words + figures[1] + split.sum()), hot_customers=hot_customers, hot_tables=split,
    )


def probabilities(bucket: Bucket, rounds: list[Totals], others: Others, moves: int, burn_in: int) -> np.ndarray:
    """Predictive probability of each pair, averaged over the rounds after ``burn_in``; ``rounds`` ends with the last round's own totals."""
    first = rounds[0]
    m, pairs, words = moving(bucket, first.hot, first.known)
    place = places_of(first.known, bucket.names)
    own = np.flatnonzero(place == OTHERS)
    if len(own) != len(others.customers):
        raise RuntimeError("contexts of a bucket and their totals did not meet")
    move = np.isin(bucket.names[own], m.names)
    customers = np.bincount(bucket.word, weights=bucket.count > 0, minlength=len(bucket.words)).astype(np.int64)
    in_parent = (customers > 0).astype(np.int64)
    total, n = np.zeros(len(bucket.count)), 0
    for number, totals in enumerate(rounds[:-1]):
        tables = m.seat_again(totals, number, moves, others.tables[number][move])
        if number < burn_in:
            continue
        now = rounds[number + 1]
        above = now.parent(customers, in_parent)
        above[words] = m.above(now)
        of_context = now.tables[place]
        of_context[own] = others.tables[number + 1]
        total += (STRENGTH + now.discount * of_context)[bucket.context] * above[bucket.word]
        total[pairs] -= now.discount * tables
        n += 1
    seated = bucket.count - first.discount * (bucket.count == 1)
    in_context = first.customers[place]
    in_context[own] = others.customers
    return (seated + total / n) / (STRENGTH + in_context[bucket.context])


def score_blocks(buckets: int, rounds: list[Totals], moves: int, burn_in: int, common: np.ndarray):
    """Blocks of pairs of a part, and what its buckets are told, to sums for the documents of each chunk: score, base score, known tokens."""

    def sent(held: dict[int, np.ndarray]) -> pa.RecordBatch:
        rows = []
        for chunk, parts in held.items():
            some = np.flatnonzero(parts[3])
            # seven digits of a share of the sampled score will do; the base score is exact
            shares = (parts[0][some].astype(np.float32), parts[1][some], parts[2][some].astype(np.uint32))
            rows.append((0, chunk, B.pack(np.ones(1, np.int8), B.steps(some), *shares)))
        return B.block(rows)

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        told: dict[int, dict[int, list[np.ndarray]]] = {}
        for _, b, shard, body in note_rows(answers):
            told.setdefault(b, {})[shard] = B.unpack(body)
        held: dict[int, np.ndarray] = {}
        out = [B.block(())]
        for number, rows in own_buckets(blocks.select(["bucket", "chunk", "body"]).to_batches(), buckets):
            if number < 0:
                out.append(B.block((0, chunk, body) for chunk, body in rows))
                continue
            bucket, last = Bucket(number, rows, common), rounds[-1]
            split, place = is_hot(last.hot, bucket.words)
            count = bucket.word_count.copy()
            count[split] = last.hot_count[place[split]]
            logs = np.log10(probabilities(bucket, rounds, Others.told(told.pop(number, {}), len(rounds) - 1), moves, burn_in))
            base = np.log10((count + 1) / (last.tokens + last.types + 1))[bucket.word]
            known = (count > 0)[bucket.word]
            at = 0
            for chunk, size, docs_of, doc, times, n_docs in bucket.parts:
                pair = np.repeat(bucket.of_entry[at : at + size], docs_of)
                at += size
                sums = np.array([np.bincount(doc, weights=w, minlength=n_docs) for w in (logs[pair] * times, base[pair] * times, known[pair] * times, times)])
                held[chunk] = held[chunk] + sums if chunk in held else sums
            if sum(x.nbytes for x in held.values()) > HELD_SUMS:
                out.append(sent(held))
                held = {}
        return pa.Table.from_batches([*out, sent(held)])

    return run


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_SCORES = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
    ("base_score", pa.float64()), ("score", pa.float64()),
])


def to_documents(tokens: int):
    def run(group: pa.Table) -> pa.Table:
        parts = [B.unpack(body) for body in group.column("body").to_pylist()]
        directory = next((p[1:] for p in parts if p[0][0] == 0), None)
        if directory is None or len(parts) < 2:
            raise RuntimeError("a chunk's sums and its directory did not meet: its rows came in another order")
        ids, held, sizes = directory
        total = np.zeros((3, len(ids)))
        for kind, *arrays in parts:
            if kind[0] == 1:
                at, shares = B.back(arrays[0]), arrays[1:]
                for c, share in enumerate(shares):
                    total[c, at] += share
        columns = ([None if i == B.NO_ID else i for i in ids.tolist()], held, sizes, total[2].astype(np.int64), np.full(len(ids), tokens), total[1], total[0])
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _SCORES, strict=True)], schema=_SCORES)

    return run


def score_documents(docs: DataFrame, samples: int = SAMPLES, burn_in: int = BURN_IN, moves: int = MOVES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and
    ``score`` (log10 of the text's probability), its tokens being lower-cased words and one end.

    Learns from documents whose id's hash is not in the held-out fold (a null
    id counts as an empty text). Null and empty texts have the end alone. Rows
    of one id are scored each by its own text. With nothing to learn from, all
    words are the one unknown type. Other columns are not read.
    """
    rows = B.text_rows(docs, text, doc_id)
    common, hot = common_words(rows)
    return scores(rows, hot, common, samples, burn_in, moves)


def scores(rows: DataFrame, hot: np.ndarray, common: np.ndarray, samples: int, burn_in: int, moves: int) -> DataFrame:
    """The same whatever ``common`` is: contexts among them have their totals in an array, all others in shards."""
    parts, buckets = Parts(rows), SPLIT * B.partitions(rows)
    blocks = dealt(rows.mapInArrow(B.released(pair_blocks(hot, buckets, common)), B.BLOCK).withColumn("part", parts.column()))
    rounds, told = seated(blocks, hot, buckets, burn_in + samples, moves, common, np.sort(common), parts)
    scored = blocks.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(score_blocks(buckets, rounds, moves, burn_in, common), B.BLOCK)
    return scored.groupBy("chunk").applyInArrow(to_documents(rounds[0].tokens), SCORES)
