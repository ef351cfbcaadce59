"""Run bookkeeping as a stream: the newest state per job, and expiry of finished jobs.

A job's state is its newest event. It ends as soon as the watermark has passed
what it is for: no event that is still accepted can be older then, so a job that
reports again starts over with the same result. Jobs are dealt to shards, whose
states are worked through as tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lumenframe.operators.runs import FINISHED, TTL_S

WATERMARK = "1 hour"
EVENT = "job_id string, status string, event_ts timestamp, event_id long"
#: A run of events of a job with no long gap: its last event, and when it began.
RUN = f"{EVENT}, began timestamp"
#: Groups of jobs that have their state in one value; a checkpoint is for this number.
SHARDS = 256
#: What is known of a job.
_KEPT = {"job_id": "str", "ts": "int64", "event_id": "int64", "status": "str"}
_KEPT_ARROW = pa.schema([("job_id", pa.string()), ("ts", pa.int64()), ("event_id", pa.int64()), ("status", pa.string())])
#: Timers need this state store.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _micros(times: pd.Series) -> np.ndarray:
    return times.to_numpy("datetime64[us]").astype("int64")


def _combine(ttl_us: int | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if not len(rows):
                continue
            rows = rows.sort_values(["job_id", "event_ts", "event_id"], kind="stable")
            job, at = rows["job_id"].to_numpy(), _micros(rows["event_ts"])
            ends = np.append(job[1:] != job[:-1], True)
            if ttl_us is not None:
                ends |= np.append(at[1:] - at[:-1] > ttl_us, False)
            starts = np.append(0, np.flatnonzero(ends)[:-1] + 1)
            yield rows[ends].assign(began=rows["event_ts"].to_numpy()[starts])

    return run


def combined(events: DataFrame, ttl_s: int | None = None) -> DataFrame:
    """Runs of events of a job, cut at gaps longer than ``ttl_s`` (none: not cut): before any shuffle, as a job may have any number of them."""
    rows = events.select("job_id", "status", "event_ts", "event_id").where("job_id IS NOT NULL AND event_ts IS NOT NULL")
    return rows.mapInPandas(_combine(None if ttl_s is None else ttl_s * 1_000_000), RUN)


def _ranked(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows by job: where a job begins, the place of each row's event in the order of time, and the row of the newest event so far.

    Of events alike in time and id the first row counts.
    """
    job = rows["job_id"].to_numpy()
    first = np.append(True, job[1:] != job[:-1])
    number = np.cumsum(first) - 1
    n = len(rows)
    order = np.lexsort((-np.arange(n), rows["event_id"].to_numpy(), rows["ts"].to_numpy()))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.arange(n)
    return first, rank, order[np.maximum.accumulate(number * n + rank) % n]


class _Newest(StatefulProcessor):
    """Keeps the newest event of each job of a shard until the watermark has passed it.

    A shard's jobs are one value, so that what a batch costs goes by its rows and
    not by calls for each job; jobs that are over leave the value at once.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.jobs = handle.getValueState("jobs", "jobs binary")

    def due(self, jobs: pd.DataFrame) -> np.ndarray:
        """Time in microseconds that the watermark must have passed for a job to be over."""
        raise NotImplementedError

    def _known(self) -> pd.DataFrame:
        if not self.jobs.exists():
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in _KEPT.items()})
        return pa.ipc.open_stream(self.jobs.get()[0]).read_all().to_pandas()

    def _merged(self, rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
        """Known jobs and new runs by job, in the order of their beginnings; what was known first."""
        parts = [self._known().assign(began=np.iinfo("int64").min, new=False)]
        for part in rows:
            events = pd.DataFrame({"job_id": part["job_id"], "ts": _micros(part["event_ts"]), "event_id": part["event_id"].fillna(-1).astype("int64"), "status": part["status"]})
            parts.append(events.assign(began=_micros(part["began"]), new=True))
        found = pd.concat([p for p in parts if len(p)], ignore_index=True)
        return found.sort_values(["job_id", "began", "ts", "event_id"], kind="stable", ignore_index=True)

    def _keep(self, jobs: pd.DataFrame, now_ms: int) -> pd.DataFrame:
        """Store the jobs that the watermark has not passed; returns those that are over."""
        ends = self.due(jobs) // 1000 + 1
        over = ends <= now_ms
        left = jobs[~over]
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if len(left):
            sink = pa.BufferOutputStream()
            table = pa.Table.from_pandas(left[list(_KEPT)], schema=_KEPT_ARROW, preserve_index=False)
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(table)
            self.jobs.update((sink.getvalue().to_pybytes(),))
            # the timer may not lie before the watermark
            self.handle.registerTimer(max(int(ends[~over].min()) - 1, now_ms + 1))
        elif self.jobs.exists():
            self.jobs.clear()
        return jobs[over]

    def close(self) -> None:
        pass


class Latest(_Newest):
    def due(self, jobs: pd.DataFrame) -> np.ndarray:
        return jobs["ts"].to_numpy()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = self._merged(rows)
        first, _, newest = _ranked(found)
        last = found.iloc[newest[np.append(np.flatnonzero(first)[1:], len(found)) - 1]]
        self._keep(last, timerValues.getCurrentWatermarkInMs())
        told = last[last["new"]]
        yield pd.DataFrame({"job_id": told["job_id"], "status": told["status"], "event_ts": pd.to_datetime(told["ts"], unit="us"), "event_id": told["event_id"]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._keep(self._known(), timerValues.getCurrentWatermarkInMs())
        return iter(())


class Expired(_Newest):
    def __init__(self, ttl_s: int):
        self.ttl_us = ttl_s * 1_000_000

    def due(self, jobs: pd.DataFrame) -> np.ndarray:
        return jobs["ts"].to_numpy() + self.ttl_us * jobs["status"].isin(FINISHED).to_numpy()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = self._merged(rows)
        first, _, newest = _ranked(found)
        again = np.flatnonzero(~first)
        before = found.iloc[newest[again - 1]]
        silent = found["began"].to_numpy()[again] - before["ts"].to_numpy() > self.ttl_us
        ran_out = before[silent & before["status"].isin(FINISHED).to_numpy()]  # before the job reported again
        last = found.iloc[newest[np.append(np.flatnonzero(first)[1:], len(found)) - 1]]
        over = self._keep(last, timerValues.getCurrentWatermarkInMs())
        yield self._rows(pd.concat([ran_out, over[over["status"].isin(FINISHED)]]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        over = self._keep(self._known(), timerValues.getCurrentWatermarkInMs())
        yield self._rows(over[over["status"].isin(FINISHED)])

    @staticmethod
    def _rows(gone: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"job_id": gone["job_id"], "status": gone["status"], "last_update": pd.to_datetime(gone["ts"], unit="us")})


def _sharded(events: DataFrame, ttl_s: int | None, watermark: str):
    rows = combined(events, ttl_s).withWatermark("event_ts", watermark)
    return rows.withColumn("shard", F.pmod(F.xxhash64("job_id"), F.lit(SHARDS))).groupBy("shard")


def latest_stream(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Newest status per job, for the ``update`` output mode; a job has state until the watermark passes its newest event."""
    events.sparkSession.conf.set(*STATE_STORE)
    grouped = _sharded(events, None, watermark)
    return grouped.transformWithStateInPandas(Latest(), EVENT, "Update", "EventTime")


def expired_stream(events: DataFrame, ttl_s: int = TTL_S, watermark: str = WATERMARK) -> DataFrame:
    """Each time that a job had finished and then said nothing for longer than ``ttl_s`` seconds: job, status, time of its last event.

    A row is given as soon as the job reports again after so long, or the
    watermark has passed; how events are cut into batches makes no difference
    while none comes later than the watermark allows. Unfinished jobs never run out, and
    have state only until the watermark passes their newest event.
    """
    events.sparkSession.conf.set(*STATE_STORE)
    grouped = _sharded(events, ttl_s, watermark)
    return grouped.transformWithStateInPandas(Expired(ttl_s), "job_id string, status string, last_update timestamp", "Append", "EventTime")
