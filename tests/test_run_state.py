"""Run states as streams: rows in any slices, state that ends, hot jobs combined before the shuffle."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest

from lumenframe.catalog import runs as catalog_runs
from lumenframe.streaming import run_state
from lumenframe.streaming.incremental import run_available

T0 = datetime(2024, 1, 1)
SCHEMA = "job_id string, event_ts timestamp, event_id long, status string"


def history():
    rng = random.Random(8)
    rows, at = [], 0
    for i in range(600):
        at += rng.choice([0, 1, 30, 400, 5000])
        job = rng.choice(["hot", "hot", "a", "b", "c", None])
        rows.append((job, T0 + timedelta(seconds=at), i, rng.choice(["running", "running", "completed", "error"])))
    rows += [("early", T0, 1000, "completed"), ("never", T0 + timedelta(seconds=5), 1001, "running"), ("x", None, 1002, "completed")]
    return rows, T0 + timedelta(seconds=at)


def plain_expired(rows, newest, ttl, late):
    out, jobs = [], {}
    for r in rows:
        if r[0] is not None and r[1] is not None:
            jobs.setdefault(r[0], []).append(r)
    for events in jobs.values():
        events.sort(key=lambda r: (r[1], r[2]))
        for e, following in zip(events, [*events[1:], None]):
            over = following[1] - e[1] > timedelta(seconds=ttl) if following else newest - e[1] > timedelta(seconds=ttl + late)
            if e[3] in ("completed", "error") and over:
                out.append((e[0], e[3], e[1]))
    return sorted(out)


def as_stream(spark, rows, slices, folder):
    """Files that arrive in time order, a slice each."""
    timed = sorted(rows, key=lambda r: (r[1] is None, r[1] or T0, r[2]))
    size = -(-len(timed) // slices)
    for n in range(slices):
        part = timed[n * size : (n + 1) * size]
        spark.createDataFrame(part, SCHEMA).repartition(3).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


@pytest.mark.parametrize("slices", [1, 5])
def test_expiry_does_not_hang_on_slices(spark, tmp_path, slices):
    rows, newest = history()
    stream = run_state.expired_stream(as_stream(spark, rows, slices, tmp_path), 1000, "10 minutes")
    run_available(stream, lambda df, n: df.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={n}"), f"{tmp_path}/ck")
    found = spark.read.parquet(f"{tmp_path}/out").select("job_id", "status", "last_update").collect()
    wanted = plain_expired(rows, newest, 1000, 600)
    assert sorted(map(tuple, found)) == wanted and len(wanted) > 20


@pytest.mark.parametrize(("make", "mode"), [(run_state.latest_stream, "update"), (lambda s, w: run_state.expired_stream(s, 60, w), "append")])
def test_state_ends(spark, tmp_path, make, mode):
    """Of a thousand jobs that each say something once, only the last ones have state."""
    rows = [(f"j{i}", T0 + timedelta(minutes=i), i, "completed" if i % 2 else "running") for i in range(1000)]
    stream = as_stream(spark, rows, 4, tmp_path)
    writer = make(stream, "5 minutes").writeStream.outputMode(mode).foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={n}"))
    query = writer.option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    query.awaitTermination()
    kept = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert kept[-1] < 60
    assert spark.read.parquet(f"{tmp_path}/out").select("job_id").distinct().count() == (1000 if mode == "update" else 496)


def test_a_hot_job_is_combined_before_the_shuffle():
    times = [T0 + timedelta(seconds=s) for s in [0, 10, 20, 2000, 2001, 9000]]
    rows = pd.DataFrame({"job_id": ["h"] * 6, "status": list("abcdef"), "event_ts": times, "event_id": range(6)})
    runs = pd.concat(run_state._combine(1000 * 1_000_000)([rows.sample(frac=1, random_state=1)]))
    assert runs["status"].tolist() == ["c", "e", "f"]
    assert runs["began"].tolist() == [times[0], times[3], times[5]]
    assert pd.concat(run_state._combine(None)([rows]))["status"].tolist() == ["f"]
    assert list(run_state._combine(None)([rows[:0]])) == []


def test_a_slice_of_many_files_is_one_batch(spark, tmp_path):
    """Events in four files: were a slice's files batches of their own, all but the newest events of the first would come too late."""
    users = [(i, i % 5, T0 + timedelta(minutes=37 * i), ("purchase", "view", "error")[i % 3]) for i in range(300)]
    rows = [(i, user, at, kind, 1.0, '{"k": 1}') for i, user, at, kind in users]
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, event_type string, value double, props string")
    df.repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    stated = [(str(u), at, i, {"purchase": "completed", "error": "error"}.get(kind, "running")) for i, u, at, kind in users]
    found = catalog_runs.run_expired_stream(spark, str(tmp_path)).collect()
    wanted = [(j, s, int((at - datetime(1970, 1, 1)).total_seconds() * 1_000_000)) for j, s, at in plain_expired(stated, users[-1][2], 3600, 3600)]
    assert sorted(map(tuple, found)) == sorted(wanted) and len(wanted) > 100


def test_jobs_of_a_shard_are_worked_through_together():
    """The newest event so far, by job; of events alike the one known first counts."""
    rows = pd.DataFrame({"job_id": list("aaabb"), "ts": [5, 9, 7, 3, 3], "event_id": [1, 2, 3, 4, 4]})
    first, _, newest = run_state._ranked(rows)
    assert first.tolist() == [True, False, False, True, False]
    assert newest.tolist() == [0, 1, 1, 3, 3]
