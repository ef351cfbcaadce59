"""Toxicity scores: boosted trees over a few dense features, with isotonic calibration.

Features count, per word, the hits of a general lexicon and of one learnt from
labelled documents (words, and beginnings of words, that toxic documents have
and others have not), hits near a second-person pronoun, capitals, punctuation
and obfuscation. At most ``SAMPLE`` labelled rows are used, the first in the
order of a hash of their ids: a part for the lexicon, one for the trees, one
for the calibration, so that none judges what it was made from.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.llm import blocks as B
from lumenframe.llm.vocabularies import Remember

#: Labelled rows that training takes at most, and the parts of a hundred for lexicon and trees; the rest calibrates.
SAMPLE = 30_000
LEXICON_PART, TREES_PART = 45, 35
#: Entries of the learnt lexicon at most; documents of the sample that must have one; least ratio of shares.
ENTRIES, LEAST_DOCUMENTS, LEAST_RATIO = 400, 4, 12.0
PREFIXES = (4, 5, 6)
NEAR = 5
INSULTS = frozenset(
    "idiot idiots stupid moron morons loser losers pathetic scum worthless trash garbage clown disgusting dumb fool "
    "imbecile jerk filth filthy vermin hate ugly liar coward freak creep shut kill die idiota estúpido estúpida imbécil "
    "basura asqueroso dummkopf blöd abschaum müll ekelhaft hässlich crétin connard débile ordure dégoûtant".split()
)
SECOND_PERSON = frozenset("you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer usted ustedes tú ti vosotros".split())
_EDGE = ".,;:!?\"'()[]{}«»“”‘’…-–—¡¿|"
_MIXED = re.compile(r"[^\W\d_][\d@$*!#%&]+[^\W\d_]")
_LONG = re.compile(r"([^\W\d_])\1\1")
_BURST = re.compile(r"[!?]{2,}")
FEATURES = [
    "insults", "learnt_words", "learnt_beginnings", "any_insult", "any_word", "any_beginning", "second_person", "near_second_person",
    "capitals", "shouted", "exclaimed", "punctuation", "bursts", "mixed", "elongated", "log_words",
]


class Lexicon:
    def __init__(self, words: frozenset[str] = frozenset(), beginnings: frozenset[str] = frozenset()):
        self.words, self.beginnings = words, beginnings

    def marks(self, token: str) -> int:
        word = token.lower().strip(_EDGE)
        mark = (word in INSULTS) + 2 * (word in self.words) + 8 * (word in SECOND_PERSON)
        mark += 4 * any(word[:n] in self.beginnings for n in PREFIXES if len(word) >= n)
        mark += 16 * bool(_MIXED.search(word)) + 32 * bool(_LONG.search(word))
        return mark + 64 * (token.isupper() and len(word) > 2)


def entries(words: list[str]) -> set[str]:
    """What a document says to the lexicon: its words, and beginnings of them with a mark."""
    plain = {w.lower().strip(_EDGE) for w in words}
    return plain | {w[:n] + "\0" for w in plain for n in PREFIXES if len(w) >= n}


def features(text: str, known: Remember) -> list[float]:
    words = text.split()
    n = max(1, len(words))
    marks = np.fromiter(map(known.__getitem__, words), dtype=np.uint8, count=len(words))
    hits, you = np.flatnonzero(marks & 7), np.flatnonzero(marks & 8)
    near = 0
    if len(hits) and len(you):
        at = np.searchsorted(you, hits)
        before, after = np.append(-NEAR - 1, you)[at], np.append(you, hits[-1] + NEAR + 1)[at]
        near = int(((hits - before <= NEAR) | (after - hits <= NEAR)).sum())
    share = [100.0 * int((marks & bit > 0).sum()) / n for bit in (1, 2, 4)]
    some = [float(x > 0) for x in share]
    data = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
    size = max(1, len(data))
    upper = int(((data >= 65) & (data <= 90)).sum())
    points = int(np.isin(data, np.frombuffer(b".,;:!?", dtype=np.uint8)).sum())
    rest = [len(you) / n, near / n, upper / size, int((marks & 64 > 0).sum()) / n, text.count("!") / n, points / size, len(_BURST.findall(text)) / n]
    return share + some + rest + [int((marks & 16 > 0).sum()) / n, int((marks & 32 > 0).sum()) / n, float(np.log1p(len(words)))]


def _texts(docs: DataFrame) -> DataFrame:
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), body)


_FEATURES = pa.schema([("doc_id", pa.int64()), ("features", pa.list_(pa.float64()))])


def measured(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, features) of every document; an empty text has zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remember(lambda tokens: map(lexicon.marks, tokens))
        for part in batches:
            ids, texts = (c.to_pylist() for c in part.columns)
            for lo in range(0, len(texts), 500):
                some = texts[lo : lo + 500]
                known.learn(w for t in some for w in t.split())
                yield B.batch(((i, features(t, known)) for i, t in zip(ids[lo : lo + 500], some, strict=True)), _FEATURES)

    return _texts(docs).mapInArrow(run, "doc_id long, features array<double>")


def held_out(doc_id: Column, folds: int = 5, fold: int = 0) -> Column:
    """Whether a hash of the id as text falls into ``fold``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def sample(labels: DataFrame, train: Column, limit: int) -> DataFrame:
    """(doc_id, label, part) of at most ``limit`` labelled rows, one for each id."""
    rows = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & train)
    rows = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("double")).alias("label"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return B.checkpoint(rows.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(100))))


_COUNTS = pa.schema([("entry", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])


def learn_lexicon(docs: DataFrame, rows: DataFrame) -> Lexicon:
    """Words and beginnings of words whose share of toxic documents is many times that of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            counts = (Counter(), Counter())
            for text, label in zip(*(c.to_pylist() for c in part.columns), strict=True):
                counts[int(label)].update(entries(text.split()))
            yield B.batch(((e, counts[1][e], counts[0][e]) for e in counts[0] | counts[1]), _COUNTS)

    near = docs.join(F.broadcast(rows), "doc_id")  # at most SAMPLE rows
    counts = near.select("text", "label").mapInArrow(run, "entry string, toxic long, clean long")
    counts = counts.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where((F.col("toxic") >= LEAST_DOCUMENTS) & (F.col("entry") != ""))
    sizes = rows.groupBy("label").count().collect()
    n = {int(r["label"]): r["count"] for r in sizes}
    ratio = ((F.col("toxic") + 0.5) / (n.get(1, 0) + 1)) / ((F.col("clean") + 0.5) / (n.get(0, 0) + 1))
    best = counts.withColumn("ratio", ratio).where(F.col("ratio") >= LEAST_RATIO)
    best = best.orderBy((F.col("toxic") * F.log("ratio")).desc(), "entry").limit(ENTRIES).select("entry").collect()  # bounded
    found = [r["entry"] for r in best]
    return Lexicon(frozenset(e for e in found if "\0" not in e), frozenset(e[:-1] for e in found if e.endswith("\0")))


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, limit: int = SAMPLE) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score`` (0 to 1), ``predicted``.

    Learns from labels of ids outside ``fold``; other label values than 0 and 1
    and null ids are left out, an id labelled both ways counts as toxic. Rows
    of one id are scored each by its own text; null is an empty text. With
    labels of one class, or none, every score is the share of that class, or 0.
    """
    known = sample(labels, ~held_out(F.col("doc_id"), folds, fold), limit)
    texts = _texts(docs)
    lexicon = learn_lexicon(texts, known.where(f"part < {LEXICON_PART}"))
    rows = B.checkpoint(measured(docs, lexicon)).withColumn("vector", array_to_vector("features"))
    # the sample's rows by broadcast, in a fixed order
    trained = rows.join(F.broadcast(known), "doc_id").where(f"part >= {LEXICON_PART}").select("doc_id", "vector", "label", "part")
    trained = B.checkpoint(trained.repartition(8, "doc_id").sortWithinPartitions("doc_id", F.xxhash64(F.col("vector").cast("string"))))
    for_trees, for_scale = trained.where(f"part < {LEXICON_PART + TREES_PART}"), trained.where(f"part >= {LEXICON_PART + TREES_PART}")
    out = F.coalesce(held_out(F.col("doc_id"), folds, fold), F.lit(True)).alias("held_out")
    if for_trees.select("label").distinct().count() < 2 or for_scale.isEmpty():
        share = known.agg(F.avg("label")).first()[0] or 0.0
        score = F.lit(float(share))
        return rows.select("doc_id", out, score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
    trees = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=25, maxDepth=4, minInstancesPerNode=5, stepSize=0.2, seed=7).fit(for_trees)
    leaning = vector_to_array("probability")[1]
    scale = IsotonicRegression(featuresCol="leaning", labelCol="label").setPredictionCol("risk")
    scale = scale.fit(trees.transform(for_scale).withColumn("leaning", leaning).select("leaning", "label"))
    scored = scale.transform(trees.transform(rows).select("doc_id", leaning.alias("leaning")))
    # a thousandth of the uncalibrated score orders documents of one calibrated step
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.999 * F.col("risk") + 0.001 * F.col("leaning")))
    return scored.select("doc_id", out, score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
