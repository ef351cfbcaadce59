"""Registered queries of this subpackage: each operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.llm import blocks, decontaminate, fertility, lines, merkle, mixing, pitmanyor, simhash, substrings, suffixes, tokenfiles, toxicity, trie, urls
from lumenframe.session import work_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeated_windows(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.remove_earlier_strings(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


#: Sources in code-point order weigh this, repeating; their targets add up to this share of all words.
MIX_WEIGHTS, MIX_SHARE = (3.0, 1.0, 2.0), 1.5


@query()
def op1_mix_to_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS, MIX_SHARE)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query("""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
line AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS pos, unnest(ls) AS x FROM split),
run AS (
  SELECT doc_id, pos, x || chr(10) || lead(x, 1) OVER w || chr(10) || lead(x, 2) OVER w AS three
  FROM line WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
),
ranked AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY three ORDER BY doc_id, pos) AS r FROM run WHERE three IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM ranked WHERE r > 1)
SELECT doc_id, count(*) AS n_lines, count(g.pos) AS n_removed,
       sha256(coalesce(string_agg(x, chr(10) ORDER BY l.pos) FILTER (g.pos IS NULL), '')) AS kept_sha256
FROM line l LEFT JOIN gone g USING (doc_id, pos) GROUP BY doc_id
""")
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.remove_earlier_lines(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query()
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query()
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "tokens")
    tokenfiles.write_tokens(table(spark, sf_dir, "documents"), folder)
    return tokenfiles.checked_tokens(spark, folder)


@query()
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = fertility.quality(table(spark, sf_dir, "documents"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select("doc_id", *base, "chars_per_token", "byte_share", "token_entropy", "script")


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("contaminated", F.lit(True))


@query()
def op7_pitman_yor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitmanyor.score_documents(table(spark, sf_dir, "documents"))


#: Rules that come before the list of URLs.
URL_RULES = (
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
)
#: A host with one of these names is on the list, with each of its pages that was seen.
LISTED_NAMES = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
_LISTED = f"(^|[.])({'|'.join(LISTED_NAMES)})[.]"


def listed_pages(pages: DataFrame) -> DataFrame:
    """The list of URLs: what is known of hosts with a listed name."""
    return pages.where(F.rlike(urls.host_of(F.col("url")), F.lit(_LISTED))).select("url")


_HOST_SQL = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(host, '^[^@]*@', ''), ':(80|443)?$', ''), '[.]$', ''), '^www[.]', '')"
_RULES_SQL = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in URL_RULES)


@query(f"""
WITH cut AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
part AS (
  SELECT page_id, url,
         translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path,
         list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*[?]([^#]*)', 1), '&'),
                               lambda p: p <> '' AND NOT regexp_matches(p, '{urls.TRACKING}'))) AS params
  FROM cut
),
page AS (
  SELECT page_id, host, path, CASE WHEN {_HOST_SQL} <> '' THEN
           {_HOST_SQL} || regexp_replace(path, '/(index[.]html?)?$', '') || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END
         END AS canonical, row_number() OVER () AS r
  FROM part
),
rule (verdict, rule_host, rule_path) AS (VALUES {_RULES_SQL}),
fit AS (
  SELECT r, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM page JOIN rule ON (host = rule_host OR suffix(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY r
),
listed AS (SELECT DISTINCT canonical FROM page WHERE canonical IS NOT NULL AND regexp_matches(host, '{_LISTED}'))
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM page LEFT JOIN fit USING (r)
""")
def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages, URL_RULES, listed_pages(pages)).select("page_id", "host", "path", "rule", "verdict")


def crc32_sql(text: str) -> str:
    """CRC-32 of ASCII text, bit by bit."""
    step = "list_reduce(range(8), lambda x, y: xor(x >> 1, (x & 1) * 3988292384), xor(c, b))"
    codes = f"list_transform(list_filter(string_split({text}, ''), lambda s: s <> ''), lambda s: ord(s)::BIGINT)"
    return f"xor(4294967295::BIGINT, list_reduce({codes}, lambda c, b: {step}, 4294967295::BIGINT))"


_UPPER, _LOWER = f"'{ascii_uppercase}'", f"'{ascii_lowercase}'"


def _field_sql(value: str) -> str:
    text = f"({value})::VARCHAR"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


def _climb_sql(name: str, key: str, levels: int) -> str:
    """``name``_0 (key, pos, d) up to ``name``_``levels``, and paths from ``name``_path_0 (r, key, pos, now, proof) up."""
    key_of = f"{key}, " if key else ""
    same = f"n.{key} IS NOT DISTINCT FROM p.{key} AND " if key else ""
    over = f"OVER (PARTITION BY {key})" if key else "OVER ()"
    out = []
    for k in range(levels):
        out.append(f"""
{name}_run_{k} AS (
  SELECT {key_of}up, max(n) AS n, list(d ORDER BY pos) AS ds
  FROM (SELECT {key_of}pos, pos // 8 AS up, d, count(*) {over} AS n FROM {name}_{k}) GROUP BY {key_of}up
),
{name}_{k + 1} AS (
  SELECT {key_of}up AS pos, CASE WHEN n > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d FROM {name}_run_{k}
),
{name}_path_{k + 1} AS (
  SELECT r, {f"p.{key}, " if key else ""}up AS pos,
         CASE WHEN n > 1 THEN sha256(array_to_string(ds[1:(p.pos % 8)::INT], '') || now || array_to_string(ds[(p.pos % 8)::INT + 2:], '')) ELSE now END AS now,
         CASE WHEN n > 1 THEN proof || array_to_string(ds[1:(p.pos % 8)::INT], '') || array_to_string(ds[(p.pos % 8)::INT + 2:], '') ELSE proof END AS proof
  FROM {name}_path_{k} p JOIN {name}_run_{k} n ON {same}n.up = p.pos // 8
),""")
    return "".join(out)


#: Levels that the SQL has: 8^7 documents of a language, 8^3 languages.
_LANG_LEVELS, _TOP_LEVELS = 7, 3


@query(f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, lang,
         sha256(concat({", ".join(_field_sql(f) for f in merkle.FIELDS)})) AS leaf,
         sha256(concat({", ".join(_field_sql(f) for f in merkle.FIELDS[:-1])}, {_field_sql(
             f"CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 3 = 0 THEN translate(text, {_UPPER}, {_LOWER}) ELSE text END")})) AS now
  FROM documents
),
leaf AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM doc),
t_0 AS (SELECT lang, pos, leaf AS d FROM leaf),
t_path_0 AS (SELECT r, lang, pos, now, '' AS proof FROM leaf),
{_climb_sql("t", "lang", _LANG_LEVELS)}
lang AS (SELECT lang, d, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos FROM t_{_LANG_LEVELS}),
u_0 AS (SELECT pos, d FROM lang),
u_path_0 AS (SELECT r, l.pos, now, proof FROM t_path_{_LANG_LEVELS} p JOIN lang l ON l.lang IS NOT DISTINCT FROM p.lang),
{_climb_sql("u", "", _TOP_LEVELS)}
root AS (SELECT d AS root FROM u_{_TOP_LEVELS})
SELECT doc_id, leaf, l.d AS subroot, root, sha256(proof) AS proof_sha256, p.now AS folded_root, p.now = root AS verified
FROM leaf JOIN u_path_{_TOP_LEVELS} p USING (r) JOIN lang l ON l.lang IS NOT DISTINCT FROM leaf.lang, root
""")
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    # what a careless store would give back for a third of the documents
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    copy = F.when(hit, F.translate("text", ascii_uppercase, ascii_lowercase)).otherwise(F.col("text"))
    rows = merkle.manifest(table(spark, sf_dir, "documents"), copy)
    folded = merkle.fold(F.col("copy_leaf"), F.col("places"), F.col("siblings"))
    proven = rows.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.hex_text(F.col("siblings")), 256).alias("proof_sha256"), folded.alias("folded_root"))
    hexed = {c: merkle.hex_text(F.col(c)) for c in ("leaf", "subroot", "root")}
    return proven.withColumns(hexed).withColumn("verified", F.col("folded_root") == F.col("root"))


#: Conversations begin with up to three turns of the first one of their twenty.
LEADS, LEAD_SPAN = 4, 20
_WORDS_SQL = "len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))"


@query(f"""
WITH said AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS h
  FROM conversations WHERE conv_id IS NOT NULL
),
told AS (SELECT c, h, {_WORDS_SQL} AS words, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, h) - 1 AS pos FROM said),
conv AS (SELECT c, c - c % {LEAD_SPAN} AS base, {crc32_sql("c::VARCHAR")} % {LEADS} AS lead FROM (SELECT DISTINCT c FROM told)),
rebuilt AS (
  SELECT c, 0 AS part, pos, h, words FROM conv JOIN (SELECT c AS base, pos, h, words FROM told) USING (base) WHERE pos < lead
  UNION ALL
  SELECT c, 1, pos, h, words FROM told JOIN conv USING (c) WHERE pos >= lead
),
path AS (
  SELECT c, row_number() OVER w AS d, list(h) OVER w AS seq, words FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY part, pos ROWS UNBOUNDED PRECEDING)
  UNION ALL
  SELECT c, 0, []::VARCHAR[], 0 FROM conv
),
node AS (SELECT d, seq, count(*) AS n, min(c) AS id, any_value(words) AS words, row_number() OVER () AS k FROM path GROUP BY d, seq),
on_path AS (SELECT c, p.d, k FROM path p JOIN node n ON n.d = p.d AND n.seq = p.seq),
last AS (SELECT c, max(d) AS d FROM path GROUP BY c),
ends AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends FROM on_path JOIN last USING (c, d) GROUP BY k),
up AS (SELECT n.k, p.k AS parent FROM node n JOIN on_path p ON p.c = n.id AND p.d = n.d - 1),
children AS (SELECT parent AS k, count(*) AS n_children FROM up GROUP BY parent),
below AS (
  SELECT p.k, sum(CASE WHEN ch.k IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n.n - 1) * n.words) AS saved
  FROM node n JOIN on_path p ON p.c = n.id AND p.d <= n.d LEFT JOIN children ch ON ch.k = n.k GROUP BY p.k
)
SELECT node.id AS conv_id, node.d AS depth, above.id AS parent_conv_id, node.n AS n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       saved AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM node JOIN below USING (k) LEFT JOIN children USING (k) LEFT JOIN ends USING (k) LEFT JOIN up USING (k) LEFT JOIN node above ON above.k = up.parent
""")
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = blocks.checkpoint(trie.turn_digests(table(spark, sf_dir, "conversations")))
    conv = F.col("conv")
    lead = F.crc32(conv.cast("string").cast("binary")) % LEADS
    return trie.trie(trie.with_lead(turns, lead, conv - conv % LEAD_SPAN, LEADS - 1), turns.select("conv").distinct())
