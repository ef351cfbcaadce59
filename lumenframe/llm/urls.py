"""URL filters: prefix rules, and a list of URLs behind a blocked Bloom filter.

Each listed URL sets eight bits in one block of 64 bytes. Blocks are made by an
ordinary aggregation, and their number has a bound, so the filter can go to
every task. What passes it may be listed; an exact hash join decides.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from string import ascii_lowercase, ascii_uppercase
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.llm import blocks as B

#: A block is this many 64-bit words, each with one bit of a URL.
WORDS = 8
#: Bits of the filter for each listed URL, up to this many bytes in all; a longer list only lets more URLs through to the join.
BITS_PER_URL, FILTER_BYTES = 16, 32 << 20
#: Odd multipliers below 2^31, one for each word: consecutive powers of an odd base.
SALTS = [pow(0x9E3779B1, k + 1, 1 << 31) | 1 for k in range(WORDS)]


class Rule(NamedTuple):
    """URLs of ``host`` and its subdomains whose path starts with ``path`` get ``verdict`` (allow or block)."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _lower(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty for null or where there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return _lower(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


#: Query parameters that say where a visitor came from, not what is shown.
TRACKING = "^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def canonical(url: Column) -> Column:
    """One spelling for URLs of one page; null where there is no host.

    Scheme, user, default ports, a last dot of the host, ``www.``, fragment,
    tracking parameters, ``index.html`` and a last slash go; the other
    parameters are sorted.
    """
    host = host_of(url)
    for pattern in ("^[^@]*@", ":(80|443)?$", "[.]$", "^www[.]"):
        host = F.regexp_replace(host, pattern, "")
    path = F.regexp_replace(path_of(url), "/(index[.]html?)?$", "")
    given = F.split(F.regexp_extract(_after_scheme(url), "^[^?#]*[?]([^#]*)", 1), "&")
    kept = F.array_sort(F.filter(given, lambda p: (p != "") & ~F.rlike(p, F.lit(TRACKING))))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(host != "", F.concat(host, path, query))


def _hash(key: Column) -> Column:
    return F.xxhash64(key)


def _block(h: Column, n_blocks: int) -> Column:
    """Block of a hash, from its upper half."""
    return F.shiftright(F.shiftrightunsigned(h, 32) * n_blocks, 32)


def filter_blocks(listed: DataFrame, n_blocks: int) -> DataFrame:
    """(block, w0, …): the blocks in which a URL of ``listed`` (key) has bits."""
    low = F.col("h").bitwiseAND(0xFFFFFFFF)
    bits = [F.expr(f"shiftleft(1L, cast(shiftright(({salt}L * (h & 4294967295L)) & 4294967295L, 26) as int))").alias(f"b{k}") for k, salt in enumerate(SALTS)]
    rows = listed.select(_hash(F.col("key")).alias("h")).where(low.isNotNull()).select(_block(F.col("h"), n_blocks).alias("block"), *bits)
    return rows.groupBy("block").agg(*[F.bit_or(f"b{k}").alias(f"w{k}") for k in range(WORDS)])


def build_filter(listed: DataFrame, filter_bytes: int = FILTER_BYTES) -> np.ndarray:
    """The filter as an array of blocks; at most ``filter_bytes`` of it, whatever the list."""
    n_blocks = max(1, min(listed.count() * BITS_PER_URL // (64 * WORDS) + 1, filter_bytes // (8 * WORDS)))
    out = np.zeros((n_blocks, WORDS), dtype=np.int64)
    found = filter_blocks(listed, n_blocks).toArrow()
    out[found["block"].to_numpy()] = np.stack([found[f"w{k}"].to_numpy() for k in range(WORDS)], axis=1) if len(found) else 0
    return out


def may_hold(blocks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the filter has all bits of each hash."""
    h = hashes.astype(np.int64).view(np.uint64)
    block = ((h >> np.uint64(32)) * np.uint64(len(blocks)) >> np.uint64(32)).astype(np.int64)
    low, out = h & np.uint64(0xFFFFFFFF), np.ones(len(h), dtype=bool)
    for k, salt in enumerate(SALTS):
        shift = (low * np.uint64(salt) & np.uint64(0xFFFFFFFF)) >> np.uint64(26)
        out &= (blocks[block, k].view(np.uint64) >> shift & np.uint64(1)).astype(bool)
    return out


def _probe(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            h = part.column("h")
            held = may_hold(shared.value, h.fill_null(0).to_numpy(zero_copy_only=False)) & h.is_valid().to_numpy(zero_copy_only=False)
            yield part.set_column(part.schema.get_field_index("h"), "possible", pa.array(held))

    return run


def judge(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame, url: str = "url", page_id: str = "page_id", filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``host``, ``path``, ``canonical``, ``rule``, ``listed``, ``verdict``.

    The longest rule that fits decides (of two of one length the one with the
    longer host, then a block). Without one, pages whose canonical URL is that
    of a row of ``listed`` (column ``url``) are blocked and all others allowed;
    ``listed`` is false where a rule decides, as the list is not asked then.

    A null URL or one without ``://`` has an empty host and path, fits no rule and
    is not listed: allowed. Pages alike in all columns, or in id or URL only,
    each keep a row. An empty table gives no rows; an empty list lists nothing.
    Long URLs are compared whole. Other columns are not read, so their names
    cannot clash. Rules are written by hand: each is a comparison in the plan.
    """
    spark = pages.sparkSession
    of = F.col("url")
    read = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"))
    ranked = sorted(((r.verdict, r.host.lower(), r.path) for r in rules), key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block"))
    fits = [
        (((F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))) & F.startswith("path", F.lit(path)), verdict, host + path)
        for verdict, host, path in ranked
    ]
    none = F.lit(None).cast("string")
    rule = F.coalesce(*[F.when(fit, F.struct(F.lit(name).alias("name"), F.lit(v).alias("verdict"))) for fit, v, name in fits], F.struct(none.alias("name"), none.alias("verdict")))
    parsed = read.select("page_id", "url", host_of(of).alias("host"), path_of(of).alias("path"), canonical(of).alias("canonical"))
    parsed = parsed.withColumn("_rule", rule).select("*", F.col("_rule.name").alias("rule"), F.col("_rule.verdict").alias("by_rule")).drop("_rule")

    keys = B.checkpoint(listed.select(canonical(F.col(f"`{url}`").cast("string")).alias("key")).where("key is not null").distinct())
    shared = spark.sparkContext.broadcast(build_filter(keys, filter_bytes))
    asked = parsed.withColumn("h", F.when(F.col("by_rule").isNull() & F.col("canonical").isNotNull(), _hash(F.col("canonical"))))
    schema = "page_id long, url string, host string, path string, canonical string, rule string, by_rule string, possible boolean"
    probed = asked.mapInArrow(_probe(shared), schema)
    # the join may split a URL that many pages have: their side is only streamed past the list
    hits = probed.where("possible").join(keys.withColumn("found", F.lit(True)), F.col("canonical") == F.col("key"), "left").drop("key")
    rows = hits.unionByName(probed.where("not possible").withColumn("found", F.lit(None).cast("boolean")))
    exact = F.coalesce("found", F.lit(False))
    verdict = F.coalesce("by_rule", F.when(exact, F.lit("block")).otherwise("allow"))
    return rows.select("page_id", "url", "host", "path", "canonical", "rule", exact.alias("listed"), verdict.alias("verdict"))


def allowed_pages(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame, url: str = "url", page_id: str = "page_id") -> DataFrame:
    """The rows of ``pages`` that ``judge`` allows, with all their columns; a verdict hangs on the URL alone."""
    blocked = judge(pages, rules, listed, url, page_id).where("verdict = 'block'").select(F.col("url").alias("__lumenframe_url")).distinct()
    return pages.join(blocked, F.col(f"`{url}`").cast("string") == F.col("__lumenframe_url"), "left_anti")
