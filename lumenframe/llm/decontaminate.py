"""Documents that hold passages of a benchmark, also reworded: latent semantic retrieval, then word order.

Documents are read once, as their words of the benchmark in order, named by 64-bit
hashes and counted exactly; other words have no weight. All overlapping passages
of them, weighted by root term frequency and inverse frequency, make a matrix. Its
Gram matrix is one sum over Spark's partitions; a randomised SVD, each step of it
a product with that matrix, gives the leading directions. Benchmark items that
these do not hold get directions of their own. Every passage is searched: those
whose cosine to an item in that space is high enough, and those with enough of
its words in any order whatever their cosine, are compared word by word:
longest common subsequence, and the item's answer, its last words. What shares too few
words with an item in any order fails that at once. So the cosine ranks, but loses nothing.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.llm import blocks as B
from lumenframe.llm.words import Words

#: Words by which passages advance; a passage has two such steps, its neighbourhood for the word check four.
STEP = 16
RANK, OVERSAMPLE, POWER_STEPS = 128, 16, 2
LEAST_COSINE = 0.3
#: Share of an item's words found in order that is enough, and that is enough if the answer is there too.
LCS_ALONE, LCS_WITH_ANSWER = 0.8, 0.5
ANSWER_WORDS, ANSWER_FOUND = 8, 0.85
#: Benchmark items that are searched for at a time; a larger benchmark is gone through in blocks.
BLOCK_ITEMS = 500
#: Numbers of the Gram matrix that a task adds up at a time, and of passages times items that it looks at.
GRAM_SIZE, SEARCH_SIZE = 1 << 24, 1 << 19
#: Bytes of text that a task works through at a time; nothing is sent a chunk, so small ones cost little.
CHUNK = 2_000_000

_TO_SPACE = bytes(32 if chr(i) in string.punctuation else i for i in range(256))


def plain(text: str) -> bytes:
    return text.lower().encode("utf-8").translate(_TO_SPACE)


class Vocabulary:
    """Words by their hashes, ascending; a small table of bits tells most others apart at once."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.mask = np.uint64((1 << max(16, (8 * len(hashes)).bit_length())) - 1)
        self.maybe = np.zeros(int(self.mask) + 1, dtype=bool)
        self.maybe[hashes & self.mask] = True

    def places(self, words: np.ndarray) -> np.ndarray:
        """Numbers of words in the vocabulary, or -1."""
        out = np.full(len(words), -1, dtype=np.int64)
        some = np.flatnonzero(self.maybe[words & self.mask])
        at = np.minimum(np.searchsorted(self.hashes, words[some]), len(self.hashes) - 1)
        known = self.hashes[at] == words[some] if len(some) else np.zeros(0, dtype=bool)
        out[some[known]] = at[known]
        return out


def words_of(benchmark: DataFrame) -> np.ndarray:
    """Hashes of all words of the benchmark, ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            some = np.unique(Words([plain(t) for t in part.column(0).to_pylist()]).hash)
            yield pa.RecordBatch.from_arrays([pa.array(some.view(np.int64))], names=["word"])

    found = benchmark.select("text").mapInArrow(B.released(run), "word long").distinct().toArrow().column(0)
    return np.sort(found.to_numpy().astype(np.int64).view(np.uint64))


def texts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    return docs.select(B.row_id(doc_id).alias("id"), B.row_key(text, doc_id).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def known_words(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The documents' words of the vocabulary, in order, by steps of ``STEP`` words; a row holds those of a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, keys, some in B.chunks(batches, CHUNK):
            words = Words([plain(t) for t in some])
            t = vocabulary.places(words.hash)
            steps = -(-words.counts // STEP)
            step = (np.arange(len(t)) - words.first[words.text]) // STEP + (np.cumsum(steps) - steps)[words.text]
            known = t >= 0
            of_step = np.bincount(step[known], minlength=int(steps.sum())).astype(np.uint8)
            yield B.block([(0, 0, B.pack(ids, keys, steps, of_step, t[known].astype(np.uint32)))])

    return rows.mapInArrow(B.released(run), B.BLOCK)


def word_frequencies(rows: DataFrame, vocabulary: Vocabulary) -> tuple[np.ndarray, int]:
    """How often each word of the vocabulary stands in the documents, and the number of steps of ``STEP`` words in them."""
    return frequencies(known_words(rows, vocabulary), len(vocabulary.hashes))


def frequencies(held: DataFrame, size: int) -> tuple[np.ndarray, int]:
    parts = 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, steps = np.zeros(size, dtype=np.int64), 0
        for part in batches:
            for body in part.column("body").to_pylist():
                *_, of_step, t = B.unpack(body)
                seen += np.bincount(t, minlength=size)
                steps += len(of_step)
        yield B.block([(p, 0, B.pack(x)) for p, x in enumerate(np.array_split(seen, parts))] + [(parts, 0, B.pack(np.array([steps])))])

    def add(group: pa.Table) -> pa.Table:
        total = sum(B.unpack(b)[0] for b in group.column("body").to_pylist())
        return B.table([(group.column("bucket")[0].as_py(), 0, B.pack(np.asarray(total)))])

    found = {r["bucket"]: B.unpack(bytes(r["body"]))[0] for r in held.mapInArrow(B.released(run), B.BLOCK).groupBy("bucket").applyInArrow(add, B.BLOCK).collect()}
    if not found:
        return np.zeros(size, dtype=np.int64), 0
    return np.concatenate([found[p] for p in range(parts)]), int(found[parts][0])


class Query:
    """Benchmark items, cut into pieces no longer than a passage, as vectors over the benchmark's own words."""

    def __init__(self, items: list[tuple[int | None, str]], known: Vocabulary, idf: np.ndarray):
        self.item, words, answer = [], [], []
        for item, text in items:
            hashes = Words([plain(text or "")]).hash
            for lo in range(0, len(hashes), 2 * STEP):
                piece = hashes[lo : lo + 2 * STEP]
                if lo and len(piece) < STEP // 2:
                    continue  # the end of a long item, too little to tell by
                self.item.append(item)
                words.append(piece)
                answer.append(hashes[-ANSWER_WORDS:])
        own = np.unique(np.concatenate(words + answer)) if words else np.zeros(0, np.uint64)
        self.width = len(own)
        self.columns = np.full(len(known.hashes), -1, dtype=np.int32)  # of the words of the whole benchmark
        self.columns[known.places(own)] = np.arange(len(own))
        self.idf = idf[known.places(own)]
        self.words, self.answer = ([np.searchsorted(own, w) for w in some] for some in (words, answer))
        self.vectors = np.zeros((len(words), len(own)), dtype=np.float32)
        for row, t in enumerate(self.words):
            columns, weights = weighted(t, self.idf)
            self.vectors[row, columns] = weights
        # of a word's places in each piece (at most 32), how many one, two ... of it in a text can fill; a row for each such number
        self.most = np.ones(len(own), dtype=np.int64)
        counts = [np.unique(t, return_counts=True) for t in self.words]
        for some, n in counts:
            self.most[some] = np.maximum(self.most[some], n)
        self.fill = np.cumsum(self.most) - self.most  # where a word's rows start
        self.fills = np.zeros((int(self.most.sum()), len(words)), dtype=np.uint8)
        for row, (some, n) in enumerate(counts):
            for w, k in zip(some.tolist(), n.tolist(), strict=True):
                self.fills[self.fill[w] : self.fill[w] + self.most[w], row] = np.minimum(k, np.arange(1, self.most[w] + 1))
        self.least = np.array([math.ceil(LCS_WITH_ANSWER * len(t) - 1e-9) for t in self.words], dtype=np.uint8)


def weighted(t: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns and weights of a passage's known words, divided by their length: rare neighbours do not make an item smaller."""
    some, n = np.unique(t[t >= 0], return_counts=True)
    norm = np.sqrt((n * np.square(idf[some], dtype=np.float64)).sum())
    return some, (np.sqrt(n) * idf[some] / max(norm, 1e-12)).astype(np.float32)


class Passages:
    """All passages of a chunk: the steps that each spans, and those of its neighbourhood."""

    def __init__(self, body: bytes, query: Query):
        self.ids, self.keys, steps, of_step, t = B.unpack(body)
        column = query.columns[t]
        own = column >= 0
        self.column, self.width = column[own].astype(np.int64), query.width
        step = np.repeat(np.arange(len(of_step)), of_step)[own]
        self.cuts = np.searchsorted(step, np.arange(len(of_step) + 1))  # where each step's words start
        n = np.maximum(1, steps - 1) * (steps > 0)  # the last passage ends with the text
        self.doc = np.repeat(np.arange(len(steps)), n)
        first, end = (np.cumsum(steps) - steps)[self.doc], np.cumsum(steps)[self.doc]
        self.lo = first + np.arange(len(self.doc)) - np.repeat(np.cumsum(n) - n, n)
        self.hi = np.minimum(self.lo + 2, end)
        self.before, self.behind = np.maximum(first, self.lo - 1), np.minimum(end, self.hi + 1)

    def entries(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the different words of each span of steps start, their columns, and how often they stand in it."""
        a, size = self.cuts[lo], self.cuts[hi] - self.cuts[lo]
        at = np.repeat(a - (np.cumsum(size) - size), size) + np.arange(size.sum())
        key, n = np.unique(np.repeat(np.arange(len(lo)), size) * self.width + self.column[at], return_counts=True)
        return np.searchsorted(key, np.arange(len(lo) + 1) * self.width), key % max(1, self.width), n

    def around(self, n: int) -> np.ndarray:
        return self.column[self.cuts[self.before[n]] : self.cuts[self.behind[n]]]

    def vectors(self, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each passage's entries start, their columns and weights, as ``weighted`` has them."""
        starts, column, n = self.entries(self.lo, self.hi)
        of = np.repeat(np.arange(len(self.lo)), np.diff(starts))
        norm = np.sqrt(np.bincount(of, weights=n * np.square(idf[column], dtype=np.float64), minlength=len(self.lo)))
        return starts, column, (np.sqrt(n) * idf[column] / np.maximum(norm, 1e-12)[of]).astype(np.float32)


def alike(starts: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of passages with equally many entries, and which these are, row by row; about ``size`` entries at a time."""
    n = np.diff(starts)
    order = np.argsort(n, kind="stable")
    edges = np.searchsorted(n[order], np.arange(1, n.max(initial=0) + 2))
    for k, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True), 1):
        for at in range(lo, hi, step := max(1, size // k)):
            some = order[at : min(at + step, hi)]
            yield some, starts[some][:, None] + np.arange(k)


def passages(held: DataFrame, query: Query) -> Iterator[DataFrame]:
    """The Gram matrix of all passages of all documents, some rows of it at a time: (bucket, first row, rows)."""
    width, idf = query.width, query.idf
    height = max(1, GRAM_SIZE // width)

    def of_rows(first: int, end: int) -> DataFrame:
        edges = np.linspace(first, end, 17).astype(int).tolist()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((end - first) * width, dtype=np.float32)
            for part in batches:
                for body in part.column("body").to_pylist():
                    starts, column, weight = Passages(body, query).vectors(idf)
                    for _, at in alike(starts, 1 << 13):
                        c, w = column[at], weight[at]
                        place, value = (c[:, :, None] - first) * width + c[:, None, :], w[:, :, None] * w[:, None, :]
                        if end - first < width:
                            mine = np.broadcast_to(((c >= first) & (c < end))[:, :, None], place.shape)
                            place, value = place[mine], value[mine]
                        np.add.at(total, place.ravel(), value.ravel())
            yield B.block((a, 0, B.pack(total[(a - first) * width : (b - first) * width])) for a, b in zip(edges, edges[1:], strict=False) if b > a)

        def add(group: pa.Table) -> pa.Table:
            total = 0.0
            for body in group.column("body"):
                total = total + B.unpack(body.as_py())[0].astype(np.float64)
            return B.table([(group.column("bucket")[0].as_py(), 0, B.pack(total.astype(np.float32)))])

        return held.mapInArrow(B.released(run), B.BLOCK).groupBy("bucket").applyInArrow(add, B.BLOCK)

    for first in range(0, width, height):
        yield of_rows(first, min(first + height, width))


def gram_times(gram: DataFrame, basis: np.ndarray) -> np.ndarray:
    """A'(A basis) for the matrix A of passages, by blocks of rows of its Gram matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for first, body in zip(part.column("bucket").to_pylist(), part.column("body").to_pylist(), strict=True):
                yield B.block([(first, 0, B.pack((B.unpack(body)[0].reshape(-1, len(basis)) @ basis).ravel()))])

    out = np.zeros_like(basis)
    for r in gram.mapInArrow(B.released(run), B.BLOCK).collect():
        product = B.unpack(bytes(r["body"]))[0].reshape(-1, basis.shape[1])
        out[r["bucket"] : r["bucket"] + len(product)] = product
    return out


def latent_basis(gram: DataFrame, query: Query, rank: int, seed: int = 1) -> np.ndarray:
    """Leading right singular directions of the passages and items, and one for each item they do not hold."""
    width = query.width
    size = min(width, rank + OVERSAMPLE)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, size)))[0].astype(np.float32)
    for _ in range(POWER_STEPS):
        product = gram_times(gram, basis) + query.vectors.T @ (query.vectors @ basis)
        basis = np.linalg.qr(product)[0].astype(np.float32)
    inner = basis.T @ (gram_times(gram, basis) + query.vectors.T @ (query.vectors @ basis))
    basis = basis @ np.linalg.eigh((inner + inner.T) / 2)[1][:, ::-1][:, : min(rank, size)]
    rest = query.vectors - (query.vectors @ basis) @ basis.T
    rest = rest[np.linalg.norm(rest, axis=1) > 0.3]
    return np.linalg.qr(np.hstack([basis, rest.T]))[0].astype(np.float32) if len(rest) else basis.astype(np.float32)


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, a machine word of ``a`` at a time."""
    places: dict[int, int] = {}
    for k, w in enumerate(a.tolist()):
        places[w] = places.get(w, 0) | 1 << k
    row, full = (1 << len(a)) - 1, (1 << len(a)) - 1
    for w in b.tolist():
        if m := places.get(w):
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


_MATCH = "id long, key long, item_id long, cosine double, lcs double, answer boolean"
_MATCHES = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("item_id", pa.int64()), ("cosine", pa.float64()), ("lcs", pa.float64()), ("answer", pa.bool_())])


def search(held: DataFrame, query: Query, basis: np.ndarray, least: float) -> DataFrame:
    """Candidates, of a high cosine in the latent space or with enough of an item's words, that pass the word checks. Every passage is looked at."""
    items = (basis @ (query.vectors @ basis).T).astype(np.float32)  # a passage's entries times these are its cosines
    n_items, names = len(query.item), query.item

    def possible(some: Passages) -> np.ndarray:
        """Numbers of passage and piece that share enough words in any order; no others can pass the word checks."""
        starts, column, n = some.entries(some.before, some.behind)
        row = query.fill[column] + np.minimum(n, query.most[column]) - 1
        out = [np.zeros(0, dtype=np.int64)]
        for of, at in alike(starts, max(1, SEARCH_SIZE // n_items)):
            k, q = np.nonzero(query.fills[row[at]].sum(axis=1, dtype=np.uint8) >= query.least)
            out.append(of[k] * n_items + q)
        return np.sort(np.concatenate(out))

    def near(some: Passages) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of passage and piece whose cosine is high enough, ascending, and the cosines."""
        starts, column, weight = some.vectors(query.idf)
        keys, values = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.float32)]
        for of, at in alike(starts, max(1, SEARCH_SIZE // n_items)):
            cosines = np.matmul(weight[at][:, None, :], items[column[at]])[:, 0]
            k, q = np.nonzero(cosines >= least)
            keys.append(of[k] * n_items + q)
            values.append(cosines[k, q])
        key, value = np.concatenate(keys), np.concatenate(values)
        order = np.argsort(key)
        return key[order], value[order]

    def cosine(some: Passages, n: int, q: int) -> float:
        column, weights = weighted(some.column[some.cuts[some.lo[n]] : some.cuts[some.hi[n]]], query.idf)
        return float(weights @ items[column, q])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for body in part.column("body").to_pylist():
                some, out = Passages(body, query), []
                key, value = near(some)
                enough = possible(some)
                # a candidate of the cosine with too few of the item's words in any order fails the word checks at once
                for pair in np.union1d(key[np.isin(key, enough)], enough).tolist():
                    n, q = divmod(pair, n_items)
                    seen = some.around(n)
                    lcs = common_subsequence(query.words[q], seen) / len(query.words[q])
                    if lcs < LCS_WITH_ANSWER:
                        continue
                    answer = common_subsequence(query.answer[q], seen) >= ANSWER_FOUND * len(query.answer[q])
                    if lcs >= LCS_ALONE or answer:
                        at = int(np.searchsorted(key, pair))
                        found = float(value[at]) if at < len(key) and key[at] == pair else cosine(some, n, q)
                        out.append((int(some.ids[some.doc[n]]), int(some.keys[some.doc[n]]), names[q], found, lcs, bool(answer)))
                if out:
                    yield B.batch(out, _MATCHES)

    return held.mapInArrow(B.released(run), _MATCH)


def matches(docs: DataFrame, benchmark: DataFrame, rank: int = RANK, least: float = LEAST_COSINE) -> DataFrame:
    """(id, key, item_id, cosine, lcs, answer): documents, named as in ``blocks.text_rows``, that hold a
    benchmark item, with its best cosine and share of words in order, and whether its answer is there.

    Null and empty texts and items match nothing. Rows of one id are judged
    each by its own text, items of one id as one. The benchmark is gone through
    in blocks of ``BLOCK_ITEMS``, which bounds what is sent to the tasks.
    """
    rows = texts(docs)
    held = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    known = Vocabulary(words_of(held))
    blocks = -(-held.count() // BLOCK_ITEMS)
    if not blocks or not len(known.hashes):
        return docs.sparkSession.createDataFrame([], _MATCH)
    read = B.checkpoint(known_words(rows, known))
    found, steps = frequencies(read, len(known.hashes))
    idf = (np.log1p(steps / (1 + found)) + 0.01).astype(np.float32)
    out = None
    for b in range(blocks):
        block = held.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        query = Query([(r["item_id"], r["text"]) for r in block.collect()], known, idf)
        if not query.words:
            continue
        gram = B.checkpoint(reduce(DataFrame.union, passages(read.coalesce(max(8, B.partitions(docs) // 8)), query)))
        some = search(read, query, latent_basis(gram, query, rank), least)
        out = some if out is None else out.union(some)
    if out is None:
        return docs.sparkSession.createDataFrame([], _MATCH)
    return out.groupBy("id", "key", "item_id").agg(F.max("cosine").alias("cosine"), F.max("lcs").alias("lcs"), F.max("answer").alias("answer"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item it holds: ``doc_id``, ``item_id``, ``cosine``, ``lcs``, ``answer_found``."""
    found = matches(docs, benchmark)
    doc_id = F.when(F.col("id") != B.NO_ID, F.col("id"))
    return found.select(doc_id.alias("doc_id"), "item_id", "cosine", "lcs", F.col("answer").alias("answer_found"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item; columns as they were.

    Rows alike in id and text go or stay together. Null and empty texts hold nothing; an empty benchmark or table changes nothing.
    """
    rows, own_id, own_key = B.named(docs)
    found = matches(docs, benchmark).select(F.col("id").alias(own_id), F.col("key").alias(own_key)).distinct()
    return rows.join(found, [own_id, own_key], "left_anti").select(*B.columns_of(docs))
