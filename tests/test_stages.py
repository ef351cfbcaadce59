"""Snapshots, the staged run, slices of a listing, and restarts."""

from dataclasses import replace
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.operators import previews
from lumenframe.operators.scoring import LinearHead
from lumenframe.plans.stages import STAGES, Settings, run_pipeline, run_reports, run_stage
from lumenframe.sources import dicom, files, snapshots
from lumenframe.streaming import incremental, slices

HEAD = LinearHead((tuple(np.linspace(-1, 1, 16)), tuple(np.linspace(1, -1, 16))), (0.0, 0.1))
RUN = "20240305060708"
SETTINGS = Settings(model=HEAD, size=(4, 4), clock=lambda: datetime(2024, 3, 5, 6, 7, 8))


def test_newest_complete_run_wins(spark, tmp_path):
    base = str(tmp_path / "stage")
    with pytest.raises(FileNotFoundError):
        snapshots.read_latest(spark, base)
    for run, rows in (("20240101000000", 3), ("20240202000000", 5)):
        snapshots.write_snapshot(spark.range(rows), base, run)
    unfinished = tmp_path / "stage" / "run_ts=20240303000000"
    unfinished.mkdir()
    (unfinished / "part-0.parquet").write_bytes(b"half")
    assert snapshots.list_runs(spark, base) == ["20240101000000", "20240202000000"]
    latest = snapshots.read_latest(spark, base)
    assert latest.count() == 5 and latest.select("run_ts").first()[0] == "20240202000000"
    assert snapshots.read_latest(spark, base, "id long").count() == 5
    snapshots.write_snapshot(spark.range(2), base, "20240202000000")
    assert snapshots.read_latest(spark, base).count() == 2


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    """Seven images, one cut off and one empty file."""
    folder = tmp_path_factory.mktemp("src")
    rng = np.random.default_rng(1)
    rows = [(f"i{k}.dcm", rng.integers(0, 255, 36).tolist(), 6, 6, {"patient_id": f"p{k}", "obs": "chest"}) for k in range(8)]
    df = spark.createDataFrame(rows, "name string, pixels array<int>, rows int, cols int, metadata map<string,string>")
    dicom.write_dicom(df, str(folder))
    cut = folder / "i7.dcm"
    cut.write_bytes(cut.read_bytes()[:-10])
    (folder / "empty.dcm").write_bytes(b"")
    return str(folder)


def result(df):
    columns = ["path", "patient_id", "prediction", "confidence", "report_path", "report_status", "body",
               "decode_error", "preprocess_error", "inference_error"]
    return sorted(tuple(r) for r in df.select(*[c for c in columns if c in df.columns]).collect())


def test_staged_sliced_and_one_pass_runs_agree(spark, source, tmp_path):
    staged = run_pipeline(spark, source, str(tmp_path / "a"), SETTINGS, "20240305060708")
    rows = {r["path"].rsplit("/", 1)[-1]: r for r in staged.collect()}
    assert len(rows) == 9
    assert rows["i0.dcm"]["prediction"] in ("NORMAL", "PNEUMONIA") and 50 <= rows["i0.dcm"]["confidence"] <= 100
    assert "Report Generated: 2024-03-05 06:07:08" in rows["i0.dcm"]["body"]
    for bad in ("i7.dcm", "empty.dcm"):
        assert rows[bad]["prediction"] is None and rows[bad]["decode_error"] and rows[bad]["preprocess_error"]
        assert rows[bad]["inference_error"] == "Missing tensor"
    sliced = run_pipeline(
        spark, source, str(tmp_path / "b"), SETTINGS, "20240305060708", batch_size=3
    )
    one_pass = run_pipeline(
        spark, source, str(tmp_path / "c"), Settings(model=HEAD, size=(4, 4), keep=("reports",)), "20240305060708"
    )
    by_spark = run_pipeline(
        spark, source, str(tmp_path / "d"), Settings(model=HEAD, size=(4, 4), keep=("reports",), through_spark=True),
        "20240305060708", batch_size=100,
    )
    assert result(staged) == result(sliced) == result(one_pass) == result(by_spark)
    assert sorted({r["batch"] for r in sliced.select("batch").collect()}) == [0, 1, 2]
    for stage in STAGES:
        assert snapshots.latest_run(spark, str(tmp_path / "a" / stage)) == "20240305060708"
        assert snapshots.latest_run(spark, str(tmp_path / "b" / stage)) == "20240305060708"
    assert not (tmp_path / "c" / "dicom").exists()
    events = spark.read.parquet(str(tmp_path / "a" / "run_events")).orderBy("event_id").collect()
    assert [(e["status"], e["processed"], e["progress"]) for e in events] == [("running", 0, 0.0), ("completed", 9, 100.0)]


def test_restart_takes_only_new_files(spark, source, tmp_path):
    out = str(tmp_path / "out")
    args = dict(batch_size=4)
    first = result(run_pipeline(spark, source, out, SETTINGS, "20240101000000", **args))
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "out" / "reports").rglob("batch=[0-9]*/*.parquet")}
    again = run_pipeline(spark, source, out, SETTINGS, "20240101000000", **args)
    assert first == result(again) and again.count() == 9
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "out" / "reports").rglob("batch=[0-9]*/*.parquet")}
    assert before == after


def test_broken_slice_is_done_again(spark, source, tmp_path):
    out = tmp_path / "out"
    first = result(run_pipeline(spark, source, str(out), SETTINGS, RUN, batch_size=4))
    (out / "reports" / f"run_ts={RUN}" / "batch=2" / "_SUCCESS").unlink()
    assert result(run_pipeline(spark, source, str(out), SETTINGS, RUN, batch_size=4)) == first


def test_no_file_is_skipped_for_its_name(spark, tmp_path):
    """Names and folders that file sources skip, an empty file among them, on every way through the stages."""
    folder = tmp_path / "src"
    rows = [(n, list(range(36)), 6, 6, {"patient_id": n}) for n in ("a.dcm", "_b.dcm", ".c.dcm", "e.dcm", "g.dcm", "h[1].dcm")]
    schema = "name string, pixels array<int>, rows int, cols int, metadata map<string,string>"
    dicom.write_dicom(spark.createDataFrame(rows, schema), str(folder / "_d" / "k"))
    for name in ("a.dcm", "_b.dcm", ".c.dcm", "h[1].dcm"):
        (folder / name).write_bytes((folder / "_d" / "k" / name).read_bytes())
    (folder / "_none.dcm").write_bytes(b"")
    only = replace(SETTINGS, keep=("reports",))
    runs = [
        run_pipeline(spark, str(folder), str(tmp_path / str(n)), replace(only, through_spark=by_spark), RUN, batch_size=size)
        for n, (by_spark, size) in enumerate([(False, None), (True, None), (False, 4), (True, 4)])
    ]
    assert runs[0].count() == 11
    assert all(result(run) == result(runs[0]) for run in runs[1:])
    events = spark.read.parquet(str(tmp_path / "2" / "run_events")).orderBy("event_id").collect()
    assert [(e["status"], e["processed"], e["total"]) for e in events] == [
        ("running", 0, 0), ("running", 4, 11), ("running", 8, 11), ("running", 11, 11), ("completed", 11, 11)
    ]


def test_listing_cap_and_slices_together(spark, source, tmp_path):
    listing = files.list_images(spark, source).where("path NOT LIKE '%i3.dcm'")
    for n, by_spark in enumerate((False, True)):
        run = run_pipeline(
            spark, source, str(tmp_path / str(n)), replace(SETTINGS, keep=("reports",), through_spark=by_spark), RUN,
            max_images=5, batch_size=2, listing=listing,
        )
        assert sorted(r["path"].rsplit("/", 1)[-1] for r in run.collect()) == ["empty.dcm", "i0.dcm", "i1.dcm", "i2.dcm", "i4.dcm"]
        assert {r["batch"] for r in run.collect()} == {0, 1, 2}
    assert run_pipeline(spark, source, str(tmp_path / "none"), SETTINGS, RUN, batch_size=2, listing=listing.where("false")).count() == 0


def test_each_output_remembers_its_own_progress(spark, source, tmp_path):
    only = Settings(model=HEAD, size=(4, 4), keep=("reports",))
    for name in ("one", "two", "one"):
        assert run_pipeline(spark, source, str(tmp_path / name), only, RUN, batch_size=8).count() == 9


def test_failed_run_is_recorded(spark, source, tmp_path):
    class Broken:  # cannot be loaded; one that fails on images gives error rows
        def __reduce__(self):
            return exec, ("raise RuntimeError('no such model')",)

        def __call__(self, batch):
            return batch[:, :2]

    out = str(tmp_path / "out")
    with pytest.raises(Exception, match="no such model"):
        run_pipeline(spark, source, out, Settings(model=Broken(), size=(4, 4)), "20240102000000")
    events = spark.read.parquet(out + "/run_events").orderBy("event_id").collect()
    assert [e["status"] for e in events] == ["running", "error"]
    with pytest.raises(FileNotFoundError):
        snapshots.read_latest(spark, out + "/reports")


def test_arguments(spark, source, tmp_path):
    with pytest.raises(ValueError):
        run_pipeline(spark, source, str(tmp_path / "y"), SETTINGS, "yesterday")
    out = str(tmp_path / "x")
    with pytest.raises(ValueError):
        run_pipeline(spark, source, out, SETTINGS, RUN, batch_size=0)
    with pytest.raises(ValueError):
        run_pipeline(spark, source, out, Settings(model=HEAD, keep=("dicom",)), RUN)
    capped = run_pipeline(spark, source, out, SETTINGS, RUN, max_images=2)
    assert capped.agg(F.max("path")).first()[0].endswith("i0.dcm") and capped.count() == 2


def test_stages_as_separate_jobs(spark, source, tmp_path):
    out = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        run_stage(spark, out, "preprocessed", SETTINGS, RUN)
    whole = run_pipeline(spark, source, out, SETTINGS, "20240305060708", batch_size=5)
    wanted = result(whole)
    for stage in STAGES[1:]:
        again = run_stage(spark, out, stage, replace(SETTINGS, keep=("reports",)), "20240305060709")
    body = lambda rows: [r[:6] + r[7:] for r in rows]  # noqa: E731  (the text names the run's time)
    assert body(result(again)) == body(wanted)
    assert run_reports(spark, out, SETTINGS, "20240305060710").count() == 9
    snapshots.write_snapshot(spark.range(3), out + "/inference", "20250101000000")
    with pytest.raises(ValueError, match="'path', 'patient_id', 'metadata', 'prediction', 'confidence'"):
        run_reports(spark, out, SETTINGS, "20250101000001")
    with pytest.raises(ValueError):
        run_stage(spark, out, "dicom", SETTINGS, RUN)


def test_slices_are_appended_and_survive_a_broken_addition(spark, tmp_path):
    plan, ids = str(tmp_path / "plan"), lambda n: spark.range(n).selectExpr("format_string('f%04d', id) AS path", "id AS length")
    assert slices.add_slices(spark, plan, ids(0), 10) == 0 and slices.planned_files(spark, plan).count() == 0
    assert slices.add_slices(spark, plan, ids(25), 10) == 3
    # an addition that wrote more and was lost before it was logged
    ids(99).selectExpr("*", "3 + length % 7 AS batch").write.mode("append").partitionBy("batch").parquet(f"{plan}/listing")
    assert slices.planned_files(spark, plan).count() == 25
    assert slices.add_slices(spark, plan, ids(40), 10) == 5
    rows = sorted(tuple(r) for r in slices.planned_files(spark, plan).collect())
    assert [r[0] for r in rows] == [f"f{i:04d}" for i in range(40)]
    assert [r[2] for r in rows] == [0] * 10 + [1] * 10 + [2] * 5 + [3] * 10 + [4] * 5
    seen = []
    slices.run_slices(spark, plan, lambda n, files: seen.append((n, files.count())), str(tmp_path / "checkpoint"))
    assert seen == [(0, 10), (1, 10), (2, 5), (3, 10), (4, 5)]
    slices.run_slices(spark, plan, lambda n, files: seen.append(n), str(tmp_path / "checkpoint"))
    assert len(seen) == 5


def test_waiting_slices_go_through_the_stages_together(spark, source, tmp_path, monkeypatch):
    """Nine files in slices of two: three runs of the stages of two slices at most, each slice stored for itself."""
    calls, run = [], incremental.run_slices_stages
    monkeypatch.setattr(incremental, "run_slices_stages", lambda *args: calls.append(args[-1]) or run(*args))
    monkeypatch.setattr(incremental, "TOGETHER_FILES", 4)
    out, only = str(tmp_path / "out"), replace(SETTINGS, keep=("inference", "reports"))
    reports = run_pipeline(spark, source, out, only, RUN, batch_size=2)
    assert calls == [range(0, 2), range(2, 4), range(4, 5)]
    assert result(reports) == result(run_pipeline(spark, source, str(tmp_path / "whole"), only, RUN))
    assert {(r["batch"], r["count"]) for r in reports.groupBy("batch").count().collect()} == {(0, 2), (1, 2), (2, 2), (3, 2), (4, 1)}
    events = spark.read.parquet(out + "/run_events").orderBy("event_id").collect()
    assert [(e["processed"], e["current_batch"]) for e in events if e["message"].startswith("Processed")] == [(2, 1), (4, 2), (6, 3), (8, 4), (9, 5)]


def test_the_run_is_not_whole_before_all_its_slices_are(spark, tmp_path):
    rows, base = spark.range(6).selectExpr("id", "id div 2 AS batch"), str(tmp_path / "reports")
    snapshots.write_batches(rows, base, RUN, range(0, 3))
    assert snapshots.complete_batches(spark, base, RUN) == [0, 1, 2] and snapshots.list_runs(spark, base) == []
    snapshots.write_batches(rows.where("batch = 1").selectExpr("id + 10 AS id", "batch"), base, RUN, range(1, 2))
    assert sorted(r["id"] for r in spark.read.parquet(f"{base}/run_ts={RUN}").collect()) == [0, 1, 4, 5, 12, 13]


def test_new_files_of_a_run_form_new_slices(spark, source, tmp_path):
    out, only = str(tmp_path / "out"), Settings(model=HEAD, size=(4, 4), keep=("reports",))
    listing = files.list_images(spark, source)
    some = listing.where("path LIKE '%i1.dcm' OR path LIKE '%i2.dcm' OR path LIKE '%i3.dcm'")
    assert run_pipeline(spark, source, out, only, RUN, batch_size=2, listing=some).count() == 3
    again = run_pipeline(spark, source, out, only, RUN, batch_size=4, listing=listing)
    assert again.count() == 9 and again.select("path").distinct().count() == 9
    assert {r["batch"] for r in again.select("batch").distinct().collect()} == {0, 1, 2, 3}


def test_log_of_complete_runs(spark, tmp_path):
    base = str(tmp_path / "snap")
    runs = [f"2024{n:010d}" for n in range(40)]
    for run in runs:
        snapshots.mark_complete(spark, base, run)
    (tmp_path / "snap" / "run_ts=20250000000000").mkdir()  # being written
    (tmp_path / "snap" / "run_ts=20230000000000").mkdir()
    (tmp_path / "snap" / "run_ts=20230000000000" / "_SUCCESS").touch()  # written by something else
    (tmp_path / "snap" / "_runs" / "20260000000000").touch()  # its folder is gone
    assert snapshots.list_runs(spark, base) == ["20230000000000", *runs]
    assert (tmp_path / "snap" / "_runs" / "20230000000000").exists()
    for run in runs:  # known from the log alone
        (tmp_path / "snap" / f"run_ts={run}" / "_SUCCESS").unlink()
    assert snapshots.list_runs(spark, base) == ["20230000000000", *runs]
    snapshots.write_snapshot(spark.range(3), base, runs[-1])
    assert snapshots.read_latest(spark, base).count() == 3
    with pytest.raises(Exception, match="lost"):
        snapshots.write_snapshot(spark.range(3).select(F.raise_error(F.lit("lost")).alias("x")), base, runs[-1])
    assert snapshots.latest_run(spark, base) == runs[-2]


def test_previews(spark):
    df = spark.createDataFrame([(2, "x" * 30, None), (1, "short", [1, 2])], "a int, b string, `c d` array<int>")
    assert [tuple(r) for r in previews.schema_rows(df).collect()] == [(1, "a", "int"), (2, "b", "string"), (3, "c d", "array<int>")]
    assert [tuple(r) for r in previews.shown_rows(df, 5, "a").collect()] == [("1", "short", "[1, 2]"), ("2", "x" * 17 + "...", "NULL")]
    assert [r["a"] for r in previews.first_rows(df, 1, "a").collect()] == [1]
    with pytest.raises(ValueError):
        previews.first_rows(df, 0, "a")
