"""Joins, lookups, snapshots and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.catalog.registry import query, table
from lumenframe.operators import lookups, ranks
from lumenframe.session import work_dir
from lumenframe.sources import snapshots
from lumenframe.streaming.incremental import run_available

AS_OF = "1998-06-01 00:00:00"
TTL_DAYS = 90


@query("""SELECT o_orderkey, o_custkey, coalesce(c_name, 'N/A') AS patient_name, coalesce(c_mktsegment, 'N/A') AS obs
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 7 <> 3) ON o_custkey = c_custkey""")
def merge_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results with the metadata of their patient, which every seventh patient lacks."""
    results = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    metadata = (
        table(spark, sf_dir, "customer")
        .where("c_custkey % 7 <> 3")
        .select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("patient_name"), F.col("c_mktsegment").alias("obs"))
    )
    return lookups.merge_metadata(results, metadata, "o_custkey", ["patient_name", "obs"])


@query("SELECT c_custkey AS path FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def unprocessed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("path"))
    done = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("path"))
    return lookups.unprocessed(listing, done)


@query(f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
SELECT c_custkey AS patient_id, o_orderkey AS report_path,
       CASE WHEN o_orderdate IS NULL THEN 'missing'
            WHEN date_diff('microsecond', o_orderdate, TIMESTAMP '{AS_OF}') > {TTL_DAYS * 86400}000000 THEN 'expired' ELSE 'ok' END AS status
FROM customer LEFT JOIN r ON o_custkey = c_custkey AND rn = 1""")
def latest_report_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("patient_id"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        F.col("o_orderkey").alias("report_path"),
    )
    patients = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("patient_id"))
    as_of = F.lit(AS_OF).cast("timestamp_ntz").cast("timestamp")
    return lookups.latest_report(reports, patients, as_of, TTL_DAYS * 86400).select("patient_id", "report_path", "status")


@query("SELECT page_id, url, (row_number() OVER (ORDER BY url, page_id) - 1) // 20 + 1 AS batch FROM pages")
def file_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return ranks.file_batches(pages, 20, "url", "page_id")


@query("SELECT page_id, url FROM pages ORDER BY url, page_id LIMIT 100")
def listing_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hundred of a listing: the cap is the feature."""
    return table(spark, sf_dir, "pages").select("page_id", "url").orderBy("url", "page_id").limit(100)


@query("""SELECT event_id, user_id, event_type, strftime(ts, '%Y%m%d') AS run_ts FROM events
WHERE strftime(ts, '%Y%m%d') = (SELECT max(strftime(ts, '%Y%m%d')) FROM events)""")
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events stored as one snapshot per day; only the newest complete one is read."""
    base = work_dir(spark, "snapshots")
    events = table(spark, sf_dir, "events").withColumn("run_ts", F.date_format("ts", "yyyyMMdd"))
    events.select("event_id", "user_id", "event_type", "run_ts").write.partitionBy("run_ts").parquet(base)
    days = [r["run_ts"] for r in events.select("run_ts").distinct().collect()]
    for day in days:
        snapshots.mark_complete(spark, base, day)
    return snapshots.read_latest(spark, base, "event_id long, user_id long, event_type string")


@query("SELECT DISTINCT strftime(ts, '%Y%m%d') AS run_ts FROM events")
def snapshot_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct snapshot names taken from the file paths of a stored table."""
    base = work_dir(spark, "folders")
    events = table(spark, sf_dir, "events").withColumn("run_ts", F.date_format("ts", "yyyyMMdd"))
    events.select("event_id", "run_ts").write.partitionBy("run_ts").parquet(base)
    path = F.col("_metadata.file_path")
    return spark.read.parquet(base).select(F.regexp_extract(path, "/run_ts=([^/]+)/", 1).alias("run_ts")).distinct()


@query("""SELECT event_type, count(*) AS n, round(sum(value), 2) AS total, max(ceil(event_id / 1e9)) * 0 + 0 AS lost
FROM events GROUP BY event_type""")
def incremental_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event files taken two at a time through a stream; all rows must arrive exactly once."""
    folder = work_dir(spark, "incremental")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    events.repartition(7, "event_id").write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")
    run_available(
        stream, lambda df, n: df.write.mode("overwrite").parquet(f"{folder}/out/batch={n}"), f"{folder}/checkpoint"
    )
    return (
        spark.read.parquet(f"{folder}/out")
        .groupBy("event_type")
        .agg(
            F.count("*").alias("n"),
            F.round(F.sum("value"), 2).alias("total"),
            (F.count("*") - F.countDistinct("event_id")).cast("double").alias("lost"),
        )
    )
