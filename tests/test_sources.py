"""Listings of flat folders, tasks of equal bytes, and the data source of images."""

import os
import statistics
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lumenframe.sources import dicom, elements, files, image_source
from tests.test_dicom import AS_EXPLICIT, IMAGE, body, header


def paths(df):
    return sorted(r["path"] for r in df.select("path").collect())


def test_flat_folder_is_listed_by_many_tasks(spark, tmp_path):
    flat = tmp_path / "flat"
    (flat / "below").mkdir(parents=True)
    for i in range(3000):
        (flat / f"f{i}.dcm").write_bytes(b"x" * (i % 7))
    (flat / "below" / "é.dcm").write_bytes(b"")
    os.symlink(flat / "nothing", flat / "link.dcm")
    whole = files.walk_files(spark, str(tmp_path))
    shared = files.walk_files(spark, str(tmp_path), most=200)
    assert sorted(map(tuple, shared.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    assert whole.count() == 3002
    found = list(files._local_entries(str(flat), "file:", 0, 0, 200))
    assert [f[4:] for f in found] == [(k, 16) for k in range(16)]
    sizes = [len(list(files._local_entries(str(flat), "file:", k, 16, 200))) for k in range(16)]
    assert sum(sizes) == 3002 and max(sizes) < 300


def test_a_task_reads_a_folder_once_for_all_its_shares(tmp_path, monkeypatch):
    for i in range(500):
        (tmp_path / f"f{i}.dcm").write_bytes(b"x")
    scans, scandir = [], os.scandir
    monkeypatch.setattr(os, "scandir", lambda folder: scans.append(folder) or scandir(folder))
    shares = pa.RecordBatch.from_pydict({"path": [str(tmp_path)] * 20, "share": list(range(20)), "shares": [50] * 20})
    found = [p for part in files._lister(10)(iter([shares.slice(0, 7), shares.slice(7)])) for p in part.column("path").to_pylist()]
    assert len(scans) == 1
    wanted = [f for f in os.listdir(tmp_path) if zlib.crc32(f.encode()) % 50 < 20]
    assert sorted(p.rsplit("/", 1)[-1] for p in found) == sorted(wanted)


def test_tasks_of_equal_bytes(spark):
    # one file in ten is a hundred times as large
    rows = [(f"/d/{i:05d}.dcm", 100_000_000 if i % 10 == 0 else 1_000_000) for i in range(2000)]
    listing = spark.createDataFrame(rows, "path string, length long").repartition(5)
    tasks, n = files.task_numbers(listing, task_bytes=1 << 30)
    sums = {r["task"]: r["b"] for r in tasks.groupBy("task").agg(F.sum("length").alias("b")).collect()}
    assert sorted(sums) == list(range(n)) and n > 15
    assert max(sums.values()) <= 2 * statistics.median(sums.values())
    dealt = files.spread_listing(listing)
    assert sorted(r["path"] for r in dealt.collect()) == [r[0] for r in rows]


@pytest.mark.parametrize("sizes", [[], [0], [0] * 30, [None, 5, 10**12, 3]])
def test_tasks_of_odd_listings(spark, sizes):
    listing = spark.createDataFrame([(f"p{i}", s) for i, s in enumerate(sizes)], "path string, length long")
    tasks, n = files.task_numbers(listing, 1000, 4)
    got = [r["task"] for r in tasks.orderBy("path").collect()]
    assert len(got) == len(sizes) and got == sorted(got) and all(0 <= t < n for t in got)
    assert files.spread_listing(listing).count() == len(sizes)


@pytest.fixture
def folder(tmp_path):
    good = header(elements.EXPLICIT) + body(AS_EXPLICIT, IMAGE.tobytes())
    (tmp_path / "deep").mkdir()
    for name, data in {"a.dcm": good, "b.DCM": good, "c.dcm": good[:-3], "deep/e.dcm": b"", "deep/_f.dcm": good, "other.txt": b"x"}.items():
        (tmp_path / name).write_bytes(data)
    return str(tmp_path)


def test_source_gives_what_the_listing_gives(spark, folder):
    listed = files.list_images(spark, folder)
    through = image_source.image_source(spark, folder, content=False)
    assert sorted(map(tuple, through.collect())) == sorted(map(tuple, listed.collect()))
    spark.dataSource.register(image_source.ImageFiles)
    plain = spark.read.format("image_files").option("content", "false").load(folder)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, listed.collect()))
    columns = ["path", "metadata", "image_data_bytes", "image_shape", "image_dtype", "decode_error", "patient_id"]
    ways = [dicom.read_dicom(spark, folder, through_source=t).select(columns).collect() for t in (False, True)]
    assert sorted(map(str, ways[0])) == sorted(map(str, ways[1])) and len(ways[0]) == 5


def test_filters_are_taken_over(spark, folder):
    source = image_source.image_source(spark, folder, least=5)
    asked = source.where(F.col("path").contains("/deep/") & (F.col("length") > 0) & F.col("path").isin(*paths(source)))
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan or "image_files" in plan
    assert paths(asked) == [f"file:{folder}/deep/_f.dcm"]
    for condition in ("path = 'x'", f"path >= 'file:{folder}/c'", "length <= 0", f"path LIKE 'file:{folder}/b%'", "length IN (0, 1)", "NOT path LIKE '%a.dcm'", "length IS NULL"):
        assert paths(source.where(condition)) == paths(files.list_images(spark, folder).where(condition))


def test_files_that_do_not_match_are_not_opened(spark, folder):
    reader = image_source.ImageReader({"path": folder}, True)
    left = list(reader.pushFilters([image_source.StringEndsWith(("path",), "a.dcm"), image_source.EqualTo(("fetch_error",), "x")]))
    assert [type(f) for f in left] == [image_source.EqualTo]
    tasks = reader.partitions()
    assert [[f[0] for f in t.files] for t in tasks] == [[f"file:{folder}/a.dcm"]]


def test_tasks_without_a_match_are_not_started(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"f{i:02d}.dcm").write_bytes(b"x")
    plan = image_source.plan_images(spark, files.list_images(spark, str(tmp_path)), least=8)
    for value, most in ((f"file:{tmp_path}/f07.dcm", 1), (f"file:{tmp_path}/f1", 3), ("file:/z", 0)):
        reader = image_source.ImageReader({"plan": plan}, False)
        kind = image_source.EqualTo if value.endswith("dcm") else image_source.StringStartsWith
        assert list(reader.pushFilters([kind(("path",), value)])) == []
        started = [t for t in reader.partitions() if t.listing]
        assert len(started) <= most and len(image_source.ImageReader({"plan": plan}, False).partitions()) == 8
        found = [r for t in started for b in reader.read(t) for r in b.column("path").to_pylist()]
        assert found == [f"file:{tmp_path}/f{i:02d}.dcm" for i in range(40) if TEST[kind](f"file:{tmp_path}/f{i:02d}.dcm", value)]


TEST = image_source.TESTS


def test_a_file_that_is_gone_is_an_error_row(spark, folder):
    listing = spark.createDataFrame([(f"file:{folder}/a.dcm", 1), (f"file:{folder}/gone.dcm", 2)], "path string, length long")
    rows = {r["path"][-8:]: r for r in image_source.image_source(spark, listing=listing).collect()}
    assert rows["gone.dcm"]["content"] is None and rows["gone.dcm"]["fetch_error"].startswith("Worker processing error")
    assert image_source.image_source(spark, listing=listing.limit(0)).count() == 0


def test_a_store_that_only_spark_reaches(spark, folder):
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.pictures.link./in", f"file://{folder}")
    base = "viewfs://pictures/in"
    assert not files.reached_by_tasks(base) and files.reached_by_tasks(folder)
    rows = {r["path"].rsplit("/", 1)[-1]: r for r in dicom.read_dicom(spark, base, through_spark=True).collect()}
    assert sorted(rows) == ["a.dcm", "b.DCM", "c.dcm"]  # Spark leaves out empty files and hidden names
    assert rows["a.dcm"]["decode_error"] is None and rows["c.dcm"]["decode_error"]
    assert len(dicom.read_dicom(spark, base, max_images=2, through_spark=True).collect()) == 2


def test_two_rows_of_one_name(spark, tmp_path):
    rows = spark.createDataFrame([("a", b"1"), ("b", b"2"), ("a", b"3")], "name string, content binary")
    with pytest.raises(ValueError, match="have the name of"):
        files.write_files(rows, str(tmp_path / "out"))
