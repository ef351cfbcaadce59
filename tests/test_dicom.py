"""DICOM files: round trip, header variants, damaged files, listings."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.functions.maps import EXTENDED_KEYS
from lumenframe.operators.images import preprocess_images
from lumenframe.operators.quality import verify_images
from lumenframe.operators.scoring import LinearHead, score
from lumenframe.sources import dicom, elements, files


HEAD = LinearHead(((1.0, 0.0), (0.0, 1.0)), (0.25, 0.0))


def explicit(tag, vr, value):
    if len(value) % 2:
        value += b" "
    long = vr in elements.LONG_TYPES
    size = struct.pack("<HI", 0, len(value)) if long else struct.pack("<H", len(value))
    return struct.pack("<HH", *tag) + vr.encode() + size + value


def implicit(tag, value):
    if len(value) % 2:
        value += b" "
    return struct.pack("<HHI", *tag, len(value)) + value


def us(v):
    return struct.pack("<H", v)


def body(encode, pixels, rows=2, cols=3, bits=16, extra=()):
    tag = elements.TAG_OF
    parts = {
        tag["PatientID"]: ("LO", b"P7"),
        tag["Rows"]: ("US", us(rows)),
        tag["Columns"]: ("US", us(cols)),
        tag["BitsAllocated"]: ("US", us(bits)),
        tag["PixelData"]: ("OW", pixels),
        **dict(extra),
    }
    return b"".join(encode(t, vr, v) for t, (vr, v) in sorted(parts.items()))


def header(syntax):
    meta = explicit(elements.TAG_OF["TransferSyntaxUID"], "UI", syntax.encode())
    return b"\0" * 128 + b"DICM" + meta


IMAGE = np.arange(6, dtype="<u2") * 1000
AS_EXPLICIT = lambda t, vr, v: explicit(t, vr, v)
AS_IMPLICIT = lambda t, vr, v: implicit(t, v)


@pytest.mark.parametrize(
    "data",
    [
        header(elements.EXPLICIT) + body(AS_EXPLICIT, IMAGE.tobytes()),
        header(elements.IMPLICIT) + body(AS_IMPLICIT, IMAGE.tobytes()),
        body(AS_IMPLICIT, IMAGE.tobytes()),
        body(AS_EXPLICIT, IMAGE.tobytes()),
    ],
)
def test_header_variants(data):
    row = dicom.decode_file(data, True)
    assert row["error"] is None
    assert (row["pixels"], row["shape"], row["dtype"]) == (IMAGE.tobytes(), [2, 3], "uint16")
    assert {t["keyword"]: t["value"] for t in row["tags"]}["PatientID"] == "P7"


def test_frames_channels_and_sign():
    tag = elements.TAG_OF
    frames = np.arange(12, dtype="<i2") - 6
    extra = [(tag["NumberOfFrames"], ("IS", b"2")), (tag["PixelRepresentation"], ("US", us(1)))]
    row = dicom.decode_file(header(elements.EXPLICIT) + body(AS_EXPLICIT, frames.tobytes(), extra=extra), True)
    assert (row["shape"], row["dtype"]) == ([2, 2, 3], "int16")
    planes = np.arange(18, dtype=np.uint8).reshape(3, 2, 3)
    extra = [(tag["SamplesPerPixel"], ("US", us(3))), (tag["PlanarConfiguration"], ("US", us(1)))]
    row = dicom.decode_file(header(elements.EXPLICIT) + body(AS_EXPLICIT, planes.tobytes(), bits=8, extra=extra), True)
    assert (row["shape"], row["dtype"]) == ([2, 3, 3], "uint8")
    assert row["pixels"] == planes.transpose(1, 2, 0).tobytes()


@pytest.mark.parametrize("defined", [True, False])
def test_sequences_are_skipped(defined):
    inner = explicit((0x0008, 0x1150), "UI", b"1.2")
    nested = struct.pack("<HHI", *elements.ITEM, elements.UNDEFINED) + inner + struct.pack("<HHI", *elements.ITEM_END, 0)
    if defined:
        sequence = explicit((0x0008, 0x1140), "SQ", struct.pack("<HHI", *elements.ITEM, len(inner)) + inner)
    else:
        sequence = (
            struct.pack("<HH2sHI", 0x0008, 0x1140, b"SQ", 0, elements.UNDEFINED)
            + nested + struct.pack("<HHI", *elements.ITEM, len(inner)) + inner
            + struct.pack("<HHI", *elements.SEQUENCE_END, 0)
        )
    row = dicom.decode_file(header(elements.EXPLICIT) + sequence + body(AS_EXPLICIT, IMAGE.tobytes()), True)
    assert row["error"] is None and row["shape"] == [2, 3]
    kinds = [t["vr"] for t in row["tags"]]
    assert kinds.count("SQ") == 1 and "1.2" not in [t["value"] for t in row["tags"]]


@pytest.mark.parametrize(
    ("data", "words"),
    [
        (header("1.2.840.10008.1.2.4.70") + body(AS_EXPLICIT, IMAGE.tobytes()), "Unsupported transfer syntax"),
        (header(elements.EXPLICIT) + body(AS_EXPLICIT, IMAGE.tobytes())[:-4], "file ends inside"),
        (header(elements.EXPLICIT) + body(AS_EXPLICIT, IMAGE.tobytes()[:-4]), "bytes, 12 expected"),
        (header(elements.EXPLICIT) + body(AS_EXPLICIT, IMAGE.tobytes(), bits=1), "unsupported pixel width"),
        (header(elements.EXPLICIT), "no pixel data"),
        (b"not an image at all, just text", ""),
        (b"", "empty file"),
    ],
)
def test_damaged_files(data, words):
    row = dicom.decode_file(data, True)
    assert row["error"] and words in row["error"] and row["pixels"] is None


@pytest.mark.parametrize(
    ("vr", "value", "wanted"),
    [
        ("LO", b"abc ", "abc"),
        ("UI", b"1.2\0", "1.2"),
        ("CS", b"ORIGINAL\\PRIMARY", "['ORIGINAL', 'PRIMARY']"),
        ("DS", b" 0.5\\1 ", "[0.5, 1]"),
        ("US", us(7), "7"),
        ("US", us(7) + us(8), "[7, 8]"),
        ("PN", "Silvão".encode("latin-1"), "Silvão"),
        ("LO", b"", ""),
        ("OB", b"\1\2", None),
        ("UN", b"\1\2", None),
        ("UN", b"as text ", "as text"),
        ("AT", us(0x28) + us(0x10), "(0028,0010)"),
        ("SV", b"\xff" * 8, "-1"),
    ],
)
def test_values_as_text(vr, value, wanted):
    assert elements.as_text(elements.Element((8, 8), vr, memoryview(value))) == wanted


def big(tag, vr, value):
    return elements.encode_element(tag, vr, value, elements.SYNTAXES[elements.BIG_ENDIAN])


@pytest.mark.parametrize(("dtype", "vr"), [(">u2", "OW"), (">u4", "OW"), (">i2", "OW"), ("u1", "OB"), ("u1", "OW"), (">f4", "OF"), (">f8", "OD")])
@pytest.mark.parametrize("with_header", [True, False])
def test_big_endian(dtype, vr, with_header):
    tag = elements.TAG_OF
    pixels = (np.arange(6) * 7).astype(dtype)
    data = pixels.tobytes()
    if vr == "OW" and dtype == "u1":  # words of two pixels, swapped
        data = pixels.reshape(-1, 2)[:, ::-1].tobytes()
    name = {"OF": "FloatPixelData", "OD": "DoubleFloatPixelData"}.get(vr, "PixelData")
    numbers = {"Rows": 2, "Columns": 3, "BitsAllocated": pixels.itemsize * 8, "PixelRepresentation": int(dtype == ">i2")}
    parts = {tag[k]: ("US", struct.pack(">H", v)) for k, v in numbers.items()}
    parts |= {tag[name]: (vr, data), (0x0018, 0x9999): ("FD", struct.pack(">d", 2.5)), tag["PatientID"]: ("LO", b"P7")}
    parts[tag["ReferencedImageSequence"]] = ("SQ", struct.pack(">HHI", *elements.ITEM, 10) + big(tag["ReferencedSOPClassUID"], "UI", b"1"))
    file = b"".join(big(t, v, x) for t, (v, x) in sorted(parts.items()))
    row = dicom.decode_file((header(elements.BIG_ENDIAN) if with_header else b"") + file, True)
    assert row["error"] is None and row["shape"] == [2, 3]
    assert row["pixels"] == pixels.astype(pixels.dtype.newbyteorder("<")).tobytes()
    values = {(t["keyword"], t["vr"]): t["value"] for t in row["tags"]}
    assert values["Rows", "US"] == "2" and values["", "FD"] == "2.5" and values["PatientID", "LO"] == "P7"


TERMS = {
    ("ISO_IR 100",): "Müller^Jörg",
    ("ISO_IR 101",): "Łukasz^Żak",
    ("ISO_IR 144",): "Люкceмбypг",
    ("ISO_IR 126",): "Διονυσιος",
    ("ISO_IR 138",): "שרון^דבורה",
    ("ISO_IR 166",): "สวัสดี",
    ("ISO_IR 13", "ISO 2022 IR 87"): "ﾔﾏﾀﾞ^ﾀﾛｳ=山田^太郎=やまだ^たろう",
    ("", "ISO 2022 IR 87"): "Yamada^Tarou=山田^太郎=やまだ^たろう",
    ("", "ISO 2022 IR 159", "ISO 2022 IR 87"): "A^丂=山田",
    ("", "ISO 2022 IR 149"): "Hong^Gildong=洪^吉洞=홍^길동",
    ("", "ISO 2022 IR 58"): "Zhang^XiaoDong=张^小东=",
    ("ISO 2022 IR 100", "ISO 2022 IR 144", "ISO 2022 IR 126"): "Buc^Jérôme=Люк^Διο",
    ("GB18030",): "王^小東",
    ("GBK",): "王^小东",
    ("ISO_IR 192",): "Wang^XiaoDong=王^小東=é",
}


@pytest.mark.parametrize("terms", sorted(TERMS))
@pytest.mark.parametrize("vr", ["PN", "LO"])
def test_character_sets(terms, vr):
    text = TERMS[terms]
    stored = elements.encode_text(text, terms, vr)
    assert elements.decode_text(stored, terms, vr) == text
    found = [elements.Element((8, 5), "CS", memoryview("\\".join(terms).encode())), elements.Element((0x10, 0x10), vr, memoryview(stored))]
    assert elements.as_text(found[1], elements.terms_of(found)) == text


def test_fixed_bytes_of_character_sets():
    """Bytes as the standard's examples have them."""
    korean = b"Hong^Gildong=\x1b$)C\xfb\xf3^\x1b$)C\xd1\xce\xd4\xd7=\x1b$)C\xc8\xab^\x1b$)C\xb1\xe6\xb5\xbf"
    assert elements.decode_text(korean, ("", "ISO 2022 IR 149"), "PN") == "Hong^Gildong=洪^吉洞=홍^길동"
    japanese = b"Yamada^Tarou=\x1b$B;3ED\x1b(B^\x1b$BB@O:\x1b(B=\x1b$B$d$^$@\x1b(B^\x1b$B$?$m$&\x1b(B"
    assert elements.decode_text(japanese, ("", "ISO 2022 IR 87"), "PN") == "Yamada^Tarou=山田^太郎=やまだ^たろう"
    katakana = b"\xd4\xcf\xc0\xde^\xc0\xdb\xb3=\x1b$B;3ED\x1b(J^\x1b$BB@O:\x1b(J"
    assert elements.decode_text(katakana, ("ISO_IR 13", "ISO 2022 IR 87"), "PN") == "ﾔﾏﾀﾞ^ﾀﾛｳ=山田^太郎"
    assert elements.decode_text(b"\xff\xfeab", ("ISO_IR 192",), "LO").endswith("ab")
    assert elements.decode_text(b"M\xfcller", ("no such set",), "LO") == "M\ufffdller"


def test_elements_of_ranges_and_a_given_dictionary(spark, tmp_path):
    assert elements.lookup((0x6002, 0x3000)) == ("OverlayData", "OW")
    assert elements.lookup((0x0009, 0x0010)) == ("", "LO") and elements.lookup((0x0009, 0x1010)) == ("", "UN")
    assert elements.lookup((0x0011, 0x0000)) == ("GenericGroupLength", "UL")
    extra = [((0x0009, 0x1001), ("UN", b"maker's text")), ((0x0009, 0x1002), ("UN", struct.pack("<H", 300)))]
    file = header(elements.IMPLICIT) + body(AS_IMPLICIT, IMAGE.tobytes(), extra=extra)
    (tmp_path / "a.dcm").write_bytes(file)
    table = spark.createDataFrame([(0x0009, 0x1002, "VendorNumber", "US")], "group int, element int, keyword string, vr string")
    for dictionary, wanted in ((elements.ELEMENTS, ("", "UN", None)), (dicom.read_dictionary(table), ("VendorNumber", "US", "300"))):
        rows = {(r["group"], r["element"]): r for r in dicom.dicom_tags(spark, str(tmp_path), dictionary).collect()}
        assert rows[9, 0x1001]["value"] == "maker's text"
        assert tuple(rows[9, 0x1002][c] for c in ("keyword", "vr", "value")) == wanted
    unknown = implicit((0x0009, 0x1003), struct.pack("<HHI", *elements.ITEM, 0))
    kinds = [t["vr"] for t in dicom.decode_file(header(elements.IMPLICIT) + unknown, False)["tags"]]
    assert kinds == ["UI", "SQ"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("images")
    (base / "deep" / "er").mkdir(parents=True)
    good = header(elements.EXPLICIT) + body(AS_EXPLICIT, IMAGE.tobytes())
    (base / "a.dcm").write_bytes(good)
    (base / "deep" / "b.DCM").write_bytes(good)
    (base / "deep" / "er" / "c.Dcm").write_bytes(good[:-3])
    (base / "deep" / "empty.dcm").write_bytes(b"")
    (base / "notes.txt").write_bytes(b"text")
    return str(base)


def names(df):
    return sorted(r["path"].rsplit("/", 1)[-1] for r in df.collect())


def test_listing(spark, folder):
    assert names(files.list_images(spark, folder)) == ["a.dcm", "b.DCM", "c.Dcm", "empty.dcm"]
    assert names(files.list_images(spark, folder, max_images=2)) == ["a.dcm", "b.DCM"]
    assert len(names(files.list_images(spark, folder, max_images=0))) == 4
    assert len(names(files.list_images(spark, "file://" + folder))) == 4
    with pytest.raises(ValueError):
        files.list_images(spark, folder, max_images=-1)
    listed = {r["path"] for r in files.list_images(spark, folder).where("length > 0").collect()}
    assert listed == {r["path"] for r in files.binary_files(spark, folder).select("path").collect()}


def test_every_file_gives_a_row(spark, folder):
    rows = {r["path"].rsplit("/", 1)[-1]: r for r in dicom.read_dicom(spark, folder).collect()}
    assert sorted(rows) == ["a.dcm", "b.DCM", "c.Dcm", "empty.dcm"]
    assert rows["a.dcm"]["metadata"] == {"patient_id": "P7", "patient_name": "", "obs": ""}
    assert rows["a.dcm"]["patient_id"] == "P7" and rows["a.dcm"]["decode_error"] is None
    for name in ("c.Dcm", "empty.dcm"):
        assert rows[name]["image_data_bytes"] is None and rows[name]["image_shape"] is None
        assert rows[name]["metadata"]["error"] == rows[name]["decode_error"]
        assert rows[name]["patient_id"] == ""
    assert names(dicom.read_dicom(spark, folder, max_images=3)) == ["a.dcm", "b.DCM", "empty.dcm"]
    assert names(dicom.read_dicom(spark, folder, max_images=4)) == ["a.dcm", "b.DCM", "c.Dcm", "empty.dcm"]


@pytest.mark.parametrize("head", [HEAD, np.negative, LinearHead(((1.0,), (2.0,)), (0.0, 0.0))])
@pytest.mark.parametrize("sentinels", [False, True])
def test_scoring_in_the_same_step(spark, folder, head, sentinels):
    source = dicom.image_files(spark, folder)
    two = score(dicom.preprocess_files(source, size=(1, 2)), head, compat_sentinels=sentinels)
    one = dicom.score_files(source, head, size=(1, 2), compat_sentinels=sentinels)
    columns = sorted(two.columns)
    assert sorted(one.columns) == columns
    rows = [sorted(map(str, df.select(columns).collect())) for df in (one, two)]
    assert rows[0] == rows[1] and len(rows[0]) == 4


def test_awkward_names(spark, tmp_path):
    good = header(elements.EXPLICIT) + body(AS_EXPLICIT, IMAGE.tobytes())
    wanted = ["a b.dcm", "c#d.dcm", "e%20f.dcm", "é.dcm"]
    (tmp_path / "x y").mkdir()
    for name in wanted:
        (tmp_path / "x y" / name).write_bytes(good)
    for base in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}/"):
        rows = dicom.read_dicom(spark, base).collect()
        assert sorted(r["path"].rsplit("/", 1)[-1] for r in rows) == wanted
        assert all(r["decode_error"] is None for r in rows)
    listed = {r["path"] for r in files.list_images(spark, str(tmp_path)).collect()}
    assert listed == {r["path"] for r in files.binary_files(spark, str(tmp_path)).select("path").collect()}


@pytest.mark.parametrize(
    ("path", "root", "inner", "prefix"),
    [("s3://bucket/a b/c.dcm", "bucket", "bucket/a b/c.dcm", "s3://"), ("hdfs://nn:8020/a/b.dcm", "/", "/a/b.dcm", "hdfs://nn:8020")],
)
def test_paths_of_other_file_systems(monkeypatch, path, root, inner, prefix):
    monkeypatch.setattr(files, "_remote", lambda scheme, authority: ("fs", root))
    assert files.locate(path) == ("fs", inner, prefix)
    assert prefix + inner == path


def test_both_ways_to_read_agree(spark, folder):
    columns = ["path", "metadata", "image_data_bytes", "image_shape", "image_dtype", "decode_error", "patient_id"]
    ways = [dicom.read_dicom(spark, folder, through_spark=t).select(columns).collect() for t in (False, True)]
    assert sorted(map(str, ways[0])) == sorted(map(str, ways[1])) and len(ways[0]) == 4
    capped = dicom.read_dicom(spark, folder, max_images=1, through_spark=True).select(columns).collect()
    first = min(ways[0], key=lambda r: r["path"])
    assert [str(r) for r in capped] == [str(first)]
    fetched = files.fetch_files(files.list_images(spark, folder)).collect()
    assert sorted(len(r["content"]) == 0 for r in fetched) == [False, False, False, True]


def test_given_listing(spark, folder):
    listing = spark.createDataFrame(
        [(f"{folder}/a.dcm", 10), (f"{folder}/deep/empty.dcm", 0), (f"{folder}/gone.dcm", 5), ("nofs://x/y.dcm", 5)],
        "path string, length long",
    )
    rows = {r["path"].rsplit("/", 1)[-1]: r for r in dicom.read_dicom(spark, folder, listing=listing).collect()}
    assert rows["a.dcm"]["decode_error"] is None and rows["a.dcm"]["image_shape"] == [2, 3]
    assert rows["empty.dcm"]["decode_error"] == "empty file"
    for name in ("gone.dcm", "y.dcm"):
        assert rows[name]["decode_error"].startswith("Worker processing error for")
        assert rows[name]["metadata"]["patient_id"] == ""


@pytest.mark.parametrize("through_spark", [False, True])
def test_one_step_equals_two(spark, folder, through_spark):
    source = dicom.image_files(spark, folder, through_spark=through_spark)
    two = preprocess_images(dicom.decode_table(source), size=(3, 4))
    one = dicom.preprocess_files(source, size=(3, 4))
    assert sorted(one.columns) == sorted(two.columns)
    columns = sorted(one.columns)
    rows = [sorted(map(str, df.select(columns).collect())) for df in (one, two)]
    assert rows[0] == rows[1] and len(rows[0]) == 4


def test_verification_statuses(spark, folder):
    found = {r["path"].rsplit("/", 1)[-1]: r for r in verify_images(dicom.read_dicom(spark, folder)).collect()}
    assert (found["a.dcm"]["status"], found["a.dcm"]["px_min"], found["a.dcm"]["px_max"]) == ("ok", 0.0, 5000.0)
    assert found["a.dcm"]["bytes_ok"] and found["a.dcm"]["ndim"] == 2
    assert found["c.Dcm"]["status"] == found["empty.dcm"]["status"] == "prior_error"


def test_tags(spark, folder):
    tags = dicom.dicom_tags(spark, folder).where(F.endswith("path", F.lit("a.dcm")))
    assert {r["keyword"]: r["value"] for r in tags.collect()}["Rows"] == "2"


def test_written_files_read_back(spark, tmp_path):
    out = str(tmp_path / "out")
    meta = {"patient_id": "1", "patient_name": "Ana^B", "inference_result": "0", "inference_confidence": "0.5", "obs": "é"}
    df = spark.createDataFrame(
        [("x.dcm", [0, 128, 255, 10], 2, 2, meta), ("y.dcm", [3, 3, 3, 3], 1, 4, {})],
        "name string, pixels array<int>, rows int, cols int, metadata map<string,string>",
    )
    manifest = dicom.write_dicom(df, out)
    assert names(manifest) == ["x.dcm", "y.dcm"]
    first = {p.name: p.read_bytes() for p in (tmp_path / "out").glob("*.dcm")}
    dicom.write_dicom(df, out)
    assert first == {p.name: p.read_bytes() for p in (tmp_path / "out").glob("*.dcm")}
    rows = {r["path"][-5:]: r for r in dicom.read_dicom(spark, out, keys=EXTENDED_KEYS).collect()}
    assert list(np.frombuffer(rows["x.dcm"]["image_data_bytes"], "<u2")) == [0, 32896, 65535, 2570]
    assert rows["x.dcm"]["metadata"] == {
        "patient_id": "1", "patient_name": "Ana^B", "infer_results": "0", "infer_confidence": "0.5", "obs": "é",
    }
    assert rows["y.dcm"]["image_shape"] == [1, 4]
    assert list(np.frombuffer(rows["y.dcm"]["image_data_bytes"], "<u2")) == [0, 0, 0, 0]
