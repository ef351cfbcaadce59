"""Run states at the expiry edge, log lines, ranks and lookups with a hot key."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from lumenframe.operators import lookups, ranks, runs

T0 = datetime(2024, 1, 1)


def events(spark, rows):
    filled = [(j, T0 + timedelta(seconds=s), i, status, "m", float(p), 0, 20, 1) for i, (j, s, status, p) in enumerate(rows)]
    return spark.createDataFrame(filled, runs.EVENT_SCHEMA)


def test_expiry_edge(spark):
    ev = events(spark, [("a", 0, "running", 0), ("a", 10, "completed", 100), ("b", 9, "error", 5), ("c", 0, "running", 1)])
    as_of = F.lit(T0 + timedelta(seconds=3610))
    assert [r["job_id"] for r in runs.run_expired(ev, as_of).collect()] == ["b"]
    assert sorted(r["job_id"] for r in runs.run_retained(ev, as_of).collect()) == ["a", "c"]
    assert tuple(runs.run_summary(ev).first()) == (3, 1, 1, 1)


def test_status_of_unknown_jobs_and_ties(spark):
    ev = events(spark, [("a", 5, "running", 0), ("a", 5, "completed", 100)])
    jobs = spark.createDataFrame([("a",), ("zz",)], "job_id string")
    found = {r["job_id"]: (r["status"], r["message"]) for r in runs.run_status(ev, jobs).collect()}
    assert found == {"a": ("completed", "m"), "zz": ("idle", "Job not found.")}
    assert {r["job_id"]: r["may_start"] for r in runs.run_may_start(ev, jobs).collect()} == {"a": True, "zz": True}


def test_log_lines(spark):
    lines = [" PROGRESS: batch 2 PROGRESS:\t", "x Starting pipeline", "Pipeline completed successfully", "other", "  "]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = [(r["kind"], r["message"], r["progress"]) for r in runs.parse_run_log(df).collect()]
    assert got == [
        ("progress", "batch 2", None), ("start", "Initializing Spark pipeline...", None),
        ("success", "Pipeline completed successfully!", 100.0), ("touch", None, None), ("touch", None, None),
    ]


def test_progress_message(spark):
    ev = events(spark, [("a", 0, "running", 0)]).withColumn("current_batch", F.lit(2).cast("long"))
    row = runs.run_progress(ev, F.lit(5)).first()
    assert (row["batches"], row["processed"], row["progress"]) == (4, 10, 50.0)
    assert row["message"] == "Processing batch 2 of 4 (10/20 images)"


def test_global_rank_with_a_hot_value(spark):
    df = spark.range(0, 5000, numPartitions=7).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.hash("id").cast("string"))).alias("path"), "id"
    )
    ranked = ranks.global_rank(df, "path", "id")
    assert ranked.columns == ["path", "id", "rank"]
    rows = sorted((r["path"], r["id"], r["rank"]) for r in ranked.collect())
    assert [r[2] for r in rows] == list(range(1, 5001))
    batches = ranks.file_batches(df, 64, "path", "id").groupBy("batch").count().orderBy("batch").collect()
    assert [b["count"] for b in batches] == [64] * 78 + [8]


def test_empty_listing_has_no_batches(spark):
    assert ranks.file_batches(spark.range(0), 5, "id").count() == 0


def test_lookups(spark):
    reports = spark.createDataFrame(
        [("p", T0, "old"), ("p", T0 + timedelta(days=2), "new"), ("q", T0, "only")],
        "patient_id string, created_at timestamp, report_path string",
    )
    asked = spark.createDataFrame([("p",), ("q",), ("r",)], "patient_id string")
    found = lookups.latest_report(reports, asked, F.lit(T0 + timedelta(days=3)), 2 * 86400).collect()
    assert {r["patient_id"]: (r["report_path"], r["status"]) for r in found} == {
        "p": ("new", "ok"), "q": ("only", "expired"), "r": (None, "missing"),
    }
    listing = spark.createDataFrame([("a",), ("b",)], "path string")
    done = spark.createDataFrame([("a",)] * 5, "path string")
    assert [r[0] for r in lookups.unprocessed(listing, done).collect()] == ["b"]


def test_newest_row_of_a_hot_key(spark):
    df = spark.range(0, 3000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("v")
    )
    found = {r["k"]: r["v"] for r in lookups.latest_by(df, "k", ["v"]).collect()}
    assert found["hot"] == 2997 and found["2999"] == 2999 and len(found) == 2001


def test_hot_key_joins_without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        results = spark.range(3000).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
        )
        metadata = spark.range(1500).select(F.col("id").alias("k"), F.lit("m").alias("name"))
        merged = lookups.merge_metadata(results, metadata, "k", ["name"])
        counts = {r["name"]: r["count"] for r in merged.groupBy("name").count().collect()}
        assert counts == {"m": 1000 + 1000, "N/A": 1000}
        done = results.select("k")
        assert lookups.unprocessed(metadata, done, "k").count() == 499
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
