"""Quality rules: how well a public vocabulary fits a text, and a few plain counts.

A vocabulary made from much clean text cuts such text into long pieces. Junk
falls into short ones, or into single bytes, and repeated text uses few
different ones. Three measures, each with bands per language and script outside
of which a document is rejected: characters per token, share of tokens that
are single bytes, and entropy of the document's tokens in bits. The bands come
from the corpus itself: medians and quartiles of all documents of a group.

Words are encoded one by one (the vocabulary never crosses white space), so a
word that recurs is encoded once a task.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenframe.llm import blocks as B
from lumenframe.llm.substrings import covered
from lumenframe.llm.vocabularies import Remember, in_worker, public_path
from lumenframe.session import work_dir

VOCABULARY = "piece_bpe_32k.model"
SYMBOLS = "#*$%&|<>"
SPACES = "\t\n\v\f\r "
MIN_WORDS, MAX_REPEATED = 50, 50
WINDOW = 3


class Band(NamedTuple):
    """What a document may measure; ``entropy`` in bits a token."""

    least_chars: float
    most_chars: float
    most_bytes: float
    least_entropy: float


#: Bands where there are too few documents to learn from, by script; "" is for text without letters, "*" for other scripts,
#: which fall back to bytes, so only their entropy says much. Given bands go by language (the column ``lang``, if
#: ``by_lang``) or script, and "" is for all that have none.
BANDS = {
    "LATIN": Band(1.3, 12.0, 0.10, 3.0),
    "CYRILLIC": Band(1.2, 12.0, 0.10, 3.0),
    "GREEK": Band(0.7, 12.0, 0.30, 3.0),
    "": Band(1.3, 12.0, 0.10, 3.0),
    "*": Band(0.3, 12.0, 0.95, 3.0),
}

#: Documents of a script and language from which a band is learnt.
LEAST_DOCS = 30
#: Robust standard deviations (quartile distance over 1.349) by which a document may differ from its group's median:
#: lists and tables of a third of sf0.1 reach 8.5, its prose 5.1. Short
#: texts vary more, as one over the root of their words; from ``STEADY_WORDS`` on, tables and lists do and not chance.
SPREADS, STEADY_WORDS = 9.0, 300
#: A language is learnt from only if its median is within this many spreads of all documents of its script: others are junk, or too odd to tell.
GROUP_SPREADS = 3.0
#: A spread is at least this share of the median; single bytes may always be this share, and entropy is never less.
LEAST_SPREAD, FREE_BYTES, LEAST_ENTROPY = 0.01, 0.10, 3.0


class PieceCounts:
    """For words: ids of their tokens, how many those are, how many of them single bytes, code points, script."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])
        self.known = Remember(self._ask)

    def _ask(self, words: list[bytes]) -> list[tuple[bytes, int, int, int, str]]:
        texts = [w.decode("utf-8", "replace") for w in words]
        encoded = self.model.encode(texts, num_threads=1)
        sizes = list(map(len, encoded))
        flat = np.fromiter(chain.from_iterable(encoded), dtype="<i4", count=sum(sizes))
        ends = np.cumsum(sizes)
        single = np.concatenate([[0], np.cumsum(self.is_byte[flat])])
        data, starts = flat.tobytes(), (ends - sizes).tolist()
        n_bytes = (single[ends] - single[starts]).tolist()
        cuts = zip(starts, ends.tolist(), sizes, n_bytes, texts, strict=True)
        return [(data[4 * a : 4 * b], n, k, len(t), script_of(t)) for a, b, n, k, t in cuts]


@lru_cache(100_000)
def script_of_letter(letter: str) -> str:
    return unicodedata.name(letter, "").split(" ", 1)[0]


def script_of(word: str) -> str:
    """Script of the first letter, by its Unicode name."""
    return next((script_of_letter(c) for c in word if c.isalpha()), "")


def entropy(ids: np.ndarray) -> float:
    if not len(ids):
        return 0.0
    _, n = np.unique(ids, return_counts=True)
    p = n / len(ids)
    return float(max(0.0, -(p * np.log2(p)).sum()))


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words that lie in a window of ``size`` words found twice or more in the text."""
    if len(words) <= size:
        return 0
    windows = list(zip(*(words[k:] for k in range(size)), strict=False))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    starts = [i for i, w in enumerate(windows) if counts[w] > 1]
    return int(covered(len(words), np.array(starts, dtype=np.int64), size).sum())


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


_FIELDS = [
    ("lang", pa.string()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("n_tokens", pa.int64()), ("n_byte_tokens", pa.int64()),
    ("token_entropy", pa.float64()), ("script", pa.string()),
]
_MEASURES = pa.schema(_FIELDS)
MEASURES = "lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, n_byte_tokens long, token_entropy double, script string"


def measure_text(text: str, raw: bytes, words: list[bytes], known: dict) -> tuple:
    ids, sizes, singles, chars, scripts = zip(*map(known.__getitem__, words), strict=True) if words else ((),) * 5
    ids = np.frombuffer(b"".join(ids), dtype="<i4")
    counted = Counter(scripts)
    main = max((s for s in counted if s), key=lambda s: (counted[s], s), default="")
    return (
        len(words), sum(chars), sum(map(text.count, SYMBOLS)), duplicate_lines(raw), repeated_words(words),
        sum(sizes), sum(singles), entropy(ids), main,
    )


def measured(docs: DataFrame, column: str, vocabulary: str | None = None, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` as they are, with a column of all measures, whose name ``docs`` must not have.

    A null text has no words, all counts zero and no script.
    """
    path = vocabulary or public_path(VOCABULARY)
    places = {c: docs.columns.index(c) for c in (text, lang) if c in docs.columns}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = in_worker(PieceCounts, path)
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                part = whole.slice(lo, 500)
                some = [t or "" for t in part.column(places[text]).cast(pa.string()).to_pylist()]
                langs = part.column(places[lang]).cast(pa.string()).to_pylist() if lang in places else [None] * len(some)
                raw = [t.encode("utf-8") for t in some]
                words = [r.split() for r in raw]
                pieces.known.learn(w for ws in words for w in ws)
                rows = [(n, *measure_text(t, r, w, pieces.known)) for n, t, r, w in zip(langs, some, raw, words, strict=True)]
                found = pa.StructArray.from_arrays(B.batch(rows, _MEASURES).columns, names=_MEASURES.names)
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=[*part.schema.names, column])

    return docs.mapInArrow(B.released(run), T.StructType([*docs.schema.fields, T.StructField(column, T.StructType.fromDDL(MEASURES))]))


def base_failed(of: Callable[[str], Column]) -> Column:
    return (of("n_words") < MIN_WORDS) | (100 * of("n_repeat_words") > MAX_REPEATED * of("n_words"))


def verdict(of: Column, bands: dict[str, Band] = BANDS, by_lang: bool = False) -> dict[str, Column]:
    """``base_failed``, ``chars_per_token``, ``byte_share`` and ``kept`` from a column of measures.

    Too short or repetitive texts fail at once. The others are kept inside the
    band of their script (or language), or that under "" where it has none.
    """
    group = of["lang" if by_lang else "script"]
    chars = of["word_chars"] / F.nullif(of["n_tokens"], F.lit(0))
    share = of["n_byte_tokens"] / F.nullif(of["n_tokens"], F.lit(0))

    def inside(b: Band) -> Column:
        return chars.between(b.least_chars, b.most_chars) & (share <= b.most_bytes) & (of["token_entropy"] >= b.least_entropy)

    passed = inside(bands[""])
    for name, band in bands.items():
        if name:
            passed = F.when(group == name, inside(band)).otherwise(passed)
    return {"base_failed": base_failed(of.getField), "chars_per_token": chars, "byte_share": share, "kept": ~base_failed(of.getField) & F.coalesce(passed, F.lit(False))}


def learnt(measures: DataFrame) -> dict[str, list[Row]]:
    """Bands by ``group_key`` from the documents of a table of measures that are neither too short nor repetitive.

    A group that is too small, or whose characters per token are far from those of its script (random letters under a
    language of their own), goes by any band of its script, or else of all scripts; text without letters makes
    no band of its own. Without any group to learn from, ``BANDS`` hold.
    """
    words = F.least(F.col("n_words"), F.lit(STEADY_WORDS))
    values = {"chars": F.col("word_chars") / F.col("n_tokens"), "bytes": F.col("n_byte_tokens") / F.col("n_tokens"), "entropy": F.col("token_entropy"), "words": words}
    quartiles = [F.percentile_approx(c, [0.25, 0.5, 0.75], 10_000).alias(n) for n, c in values.items()]
    good = measures.where(~base_failed(F.col) & (F.col("script") != "") & (F.col("n_tokens") > 0))
    groups = good.groupBy("script", F.coalesce("lang", F.lit("")).alias("lang")).agg(F.count("*").alias("n"), *quartiles)
    whole = {r["script"]: r["chars"] for r in good.groupBy("script").agg(quartiles[0]).collect()}
    out: dict[str, list[Row]] = {}

    def spread(q: list[float]) -> float:
        return max((q[2] - q[0]) / 1.349, LEAST_SPREAD * q[1])

    def around(q: list[float]) -> float:
        return SPREADS * spread(q)

    for g in groups.where(F.col("n") >= LEAST_DOCS).collect():
        if abs(g["chars"][1] - whole[g["script"]][1]) > GROUP_SPREADS * spread(whole[g["script"]]):
            continue
        band = Row(
            middle=float(g["chars"][1]), width=float(around(g["chars"]) * g["words"][1] ** 0.5), most_bytes=float(g["bytes"][1] + max(FREE_BYTES, around(g["bytes"]))),
            least_entropy=float(max(LEAST_ENTROPY, g["entropy"][1] - around(g["entropy"]))),
        )
        for key in (f"{g['script']}\0{g['lang']}", g["script"], "*"):
            out.setdefault(key, []).append(band)
    for script, b in BANDS.items():
        if script not in out and (script or not out):
            width = (b.most_chars - b.least_chars) / 2 * STEADY_WORDS**0.5
            out[script] = [Row(middle=(b.least_chars + b.most_chars) / 2, width=width, most_bytes=b.most_bytes, least_entropy=b.least_entropy)]
    return out


def learnt_verdict(of: Column, bands: dict[str, list[Row]]) -> dict[str, Column]:
    """As ``verdict``, with the bands of ``learnt``."""
    as_column = [F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in b.asDict().items())) for b in some)) for some in bands.values()]
    of_group = F.create_map(*chain.from_iterable(zip(map(F.lit, bands), as_column, strict=True)))
    script, lang = of["script"], F.coalesce(of["lang"], F.lit(""))
    some = F.coalesce(F.try_element_at(of_group, F.concat(script, F.lit("\0"), lang)), F.try_element_at(of_group, script), F.try_element_at(of_group, F.lit("*")))
    measures = verdict(of)
    chars, share = measures["chars_per_token"], measures["byte_share"]
    root = F.sqrt(F.least(of["n_words"], F.lit(STEADY_WORDS)))
    fits = F.exists(some, lambda b: (F.abs(chars - b["middle"]) * root <= b["width"]) & (share <= b["most_bytes"]) & (of["token_entropy"] >= b["least_entropy"]))
    return {**measures, "kept": ~measures["base_failed"] & F.coalesce(fits, F.lit(False))}


def quality(docs: DataFrame, vocabulary: str | None = None, bands: dict[str, Band] | None = None, by_lang: bool = False) -> DataFrame:
    """``doc_id``, all measures and the verdict for every document; rows of one id get one each. Other columns are not read.

    Without ``bands`` they are learnt from all of ``docs``. Null and empty texts have no words and fail; texts are
    measured whole, however long; equal measures get equal verdicts, so copies do. An empty table gives no rows.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(c).cast("string").alias(c) for c in ("text", "lang") if c in docs.columns))
    rows, of = measured(read, "__measures", vocabulary), F.col("__measures")
    if bands is None:
        rows = B.checkpoint(rows.select("doc_id", "__measures"))
        judged = learnt_verdict(of, learnt(rows.select("__measures.*")))
    else:
        judged = verdict(of, bands, by_lang)
    return rows.select("doc_id", "__measures.*", *(c.alias(n) for n, c in judged.items()))


def good_documents(docs: DataFrame, vocabulary: str | None = None, bands: dict[str, Band] | None = None, by_lang: bool = False) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns as they were, without a shuffle.

    Given ``bands`` judge where rows are read. To learn them, rows are written once with their measures, which are not
    taken twice. Rows alike in all columns are judged alike; an empty table stays empty, and columns may have any names.
    """
    column = B.free_name(docs, "__measures")
    rows, of = measured(docs, column, vocabulary), F.col(column)
    if bands is None:
        folder = work_dir(docs.sparkSession, "measures")
        rows.write.parquet(folder)
        rows = docs.sparkSession.read.schema(rows.schema).parquet(folder)
        judged = learnt_verdict(of, learnt(rows.select(f"{column}.*")))
    else:
        judged = verdict(of, bands, by_lang)
    return rows.where(judged["kept"]).drop(column)
