"""Text, map and time queries over page addresses, names and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.catalog.registry import query, table
from lumenframe.functions import maps, text, times


@query("""WITH u AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN replace(replace(url, 'https:', 'gs:'), 'http:', 'gs:')
    WHEN 1 THEN url WHEN 2 THEN 'gs://' || split_part(split_part(url, '://', 2), '/', 1)
    WHEN 3 THEN 'gs:///' || split_part(url, '://', 2) ELSE 'gs://' || split_part(split_part(url, '://', 2), '/', 1) || '/' END AS uri
    FROM pages),
r AS (SELECT page_id, uri, substr(uri, 6) AS rest FROM u),
e AS (SELECT *, CASE WHEN NOT starts_with(uri, 'gs://') THEN 'Invalid path format: ' || uri || '. Must start with gs://'
    WHEN strpos(rest, '/') = 0 THEN 'Invalid path format: ' || uri || '. Expected gs://bucket/object.'
    WHEN strpos(rest, '/') = 1 OR strpos(rest, '/') = length(rest) THEN 'Invalid path format: ' || uri || '. Bucket or object name is missing.'
    END AS error FROM r)
SELECT page_id, CASE WHEN error IS NULL THEN substr(rest, 1, strpos(rest, '/') - 1) END AS bucket,
       CASE WHEN error IS NULL THEN substr(rest, strpos(rest, '/') + 1) END AS object, error FROM e""")
def uri_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page addresses rewritten into good object addresses and each kind of bad one."""
    url, kind = F.col("url"), F.col("page_id") % 5
    bare = F.split_part(url, F.lit("://"), F.lit(2))
    host = F.split_part(bare, F.lit("/"), F.lit(1))
    uri = (
        F.when(kind == 0, F.concat(F.lit("gs://"), bare)).when(kind == 1, url)
        .when(kind == 2, F.concat(F.lit("gs://"), host)).when(kind == 3, F.concat(F.lit("gs:///"), bare))
        .otherwise(F.concat(F.lit("gs://"), host, F.lit("/")))
    )
    return table(spark, sf_dir, "pages").select("page_id", text.parse_uri(uri).alias("_u")).select("page_id", "_u.*")


@query("""WITH p AS (SELECT page_id, url || CASE WHEN page_id % 2 = 0 THEN '/' || replace(url, '://', '/') ELSE '' END AS p FROM pages)
SELECT page_id, CASE WHEN length(p) > 70 THEN left(p, 35) || '...' || right(p, 30) ELSE p END AS elided,
       CASE WHEN length('File: ' || p) > 80 THEN left('File: ' || p, 77) || '...' ELSE 'File: ' || p END AS line FROM p""")
def path_elide(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    longer = F.concat(url, F.lit("/"), F.replace(url, F.lit("://"), F.lit("/")))
    path = F.when(F.col("page_id") % 2 == 0, longer).otherwise(url)
    return table(spark, sf_dir, "pages").select(
        "page_id",
        text.elide_path(path).alias("elided"),
        text.truncate_line(F.concat(F.lit("File: "), path)).alias("line"),
    )


@query(r"""SELECT doc_id, regexp_replace(CASE WHEN length(text) > 0 THEN text ELSE 'unknown_patient' END,
    '[^\p{L}\p{N}]', '_', 'g') AS safe FROM documents""")
def safe_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts as ids: letters of all languages stay."""
    return table(spark, sf_dir, "documents").select("doc_id", text.safe_id(F.col("text")).alias("safe"))


@query(r"""WITH b AS (SELECT page_id, url, string_split(url, '/')[-1] AS base FROM pages)
SELECT page_id, base, regexp_replace(base, '(?s)^(\.*[^.].*)\.[^.]*$', '\1') AS stem,
       lower(url) LIKE '%.html' AS is_html, starts_with(url, 'https://') AS is_secure FROM b""")
def base_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    base = text.base_name(url)
    return table(spark, sf_dir, "pages").select(
        "page_id",
        base.alias("base"),
        text.strip_extension(base).alias("stem"),
        text.has_suffix(url, ".HTML").alias("is_html"),
        F.startswith(url, F.lit("https://")).alias("is_secure"),
    )


@query(r"""SELECT o_orderkey,
  'reports/' || replace(replace('gs://bucket/' || o_orderkey || '/scan.v1.dcm', 'gs://', ''), '/', '_') || '.pdf' AS by_path,
  'reports/report_Customer#' || o_custkey || '_scan.v1.pdf' AS by_patient,
  'out/Customer_' || o_custkey || '_report_' || strftime(o_orderdate, '%Y%m%d%H%M%S%f') || '.pdf' AS stamped FROM orders""")
def report_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("gs://bucket/"), F.col("o_orderkey").cast("string"), F.lit("/scan.v1.dcm"))
    patient = F.concat(F.lit("Customer#"), F.col("o_custkey").cast("string"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.report_name_from_path(path).alias("by_path"),
        text.report_name_for_patient(patient, path).alias("by_patient"),
        text.report_name_stamped("out/", patient, times.micro_stamp(F.col("o_orderdate"))).alias("stamped"),
    )


@query("""SELECT c_custkey,
  upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) || ' Segment' AS title,
  CASE WHEN c_custkey % 4 = 0 THEN 'N/A' ELSE printf('%.2f%%', c_acctbal / 100) END AS pct2,
  CASE WHEN c_custkey % 4 = 0 THEN 'N/A' ELSE printf('%.1f%%', c_nationkey * 1.5::DOUBLE) END AS pct1,
  CASE c_custkey % 3 WHEN 2 THEN c_name ELSE 'N/A' END AS name,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'red' ELSE 'green' END AS colour,
  starts_with(c_mktsegment, 'ERROR_') AS is_error, c_acctbal::INT::VARCHAR AS shown
FROM customer""")
def labels_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title case, percentages, defaults, highlight, error marker, value as text."""
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    number = lambda c: F.when(key % 4 != 0, c)
    name = F.when(key % 3 == 2, F.col("c_name")).when(key % 3 == 1, F.lit(""))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        text.title_key(F.concat(F.lower("c_mktsegment"), F.lit("_segment"))).alias("title"),
        text.percent_text(number(balance / 100)).alias("pct2"),
        text.percent_text(number(F.col("c_nationkey") * 1.5), 1).alias("pct1"),
        text.or_default(name).alias("name"),
        text.highlight(F.col("c_mktsegment"), alert="MACHINERY").alias("colour"),
        text.is_error(F.col("c_mktsegment")).alias("is_error"),
        F.bround(balance).cast("int").cast("string").alias("shown"),
    )


@query("""WITH k AS (SELECT event_id, event_type, user_id, (json_extract_string(props, '$.k')) AS k FROM events)
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'none' ELSE k END AS found,
  CASE WHEN event_id % 5 = 0 THEN 0 ELSE 1 END + 2 AS n_entries,
  CASE WHEN event_id % 5 = 0 THEN '' ELSE 'k: ' || k || chr(10) END || 'obs: new' || chr(10) || 'user: ' || user_id AS lines
FROM k""")
def map_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Look up with default, add entries to a null or filled map, list the entries."""
    props = F.from_json("props", "map<string,string>")
    metadata = F.when(F.col("event_id") % 5 != 0, props)
    grown = maps.with_entries(
        F.map_concat(maps.or_empty(metadata), F.create_map(F.lit("obs"), F.col("event_type"))),
        {"obs": F.lit("new"), "user": F.col("user_id").cast("string")},
    )
    return (
        table(spark, sf_dir, "events")
        .withColumns({"m": metadata, "g": grown})
        .select(
            "event_id",
            maps.get_or(F.col("m"), ["K", "k"], "none").alias("found"),
            F.size("g").alias("n_entries"),
            F.array_join(maps.entry_lines(F.col("g")), "\n").alias("lines"),
        )
    )


@query("""SELECT c_custkey, 'K' || (c_custkey % 2) AS key, c_name AS value FROM customer
UNION ALL SELECT c_custkey, 'K' || (1 - c_custkey % 2), 'seg ' || c_mktsegment FROM customer""")
def map_from_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key/value lists with a repeated key, of which the last counts."""
    own = F.concat(F.lit("K"), (F.col("c_custkey") % 2).cast("string"))
    other = F.concat(F.lit("K"), (1 - F.col("c_custkey") % 2).cast("string"))
    pair = lambda k, v: F.struct(k.alias("key"), v.alias("value"))
    pairs = F.array(
        pair(own, F.lit("first")),
        pair(other, F.concat(F.lit("seg "), F.col("c_mktsegment"))),
        pair(own, F.col("c_name")),
    )
    folded = table(spark, sf_dir, "customer").select("c_custkey", maps.from_pairs(pairs).alias("m"))
    return folded.select("c_custkey", F.explode("m").alias("key", "value"))


@query("""SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS run_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown,
  strftime(ts, '%Y%m%d%H%M%S%f') AS stamp,
  round(date_diff('microsecond', ts, TIMESTAMP '2024-01-15 00:00:00') / 1000000, 6) AS age_s,
  date_diff('microsecond', ts, TIMESTAMP '2024-01-15 00:00:00') > 3600000000 AS is_old FROM events""")
def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, as_of = F.col("ts"), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        "event_id",
        times.run_id(ts).alias("run_id"),
        times.display_time(ts).alias("shown"),
        times.micro_stamp(ts).alias("stamp"),
        F.round(times.age_seconds(as_of, ts.cast("timestamp")), 6).alias("age_s"),
        times.older_than(as_of, ts.cast("timestamp"), 3600).alias("is_old"),
    )
