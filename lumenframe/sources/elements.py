"""Elements of DICOM files: names and types, byte orders, character sets."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np

Tag = tuple[int, int]
Dictionary = Mapping[Tag, tuple[str, str]]

# Public data element tags, as group, element → keyword, value type.
ELEMENTS: dict[Tag, tuple[str, str]] = {
    (0x0002, 0x0000): ("FileMetaInformationGroupLength", "UL"),
    (0x0002, 0x0001): ("FileMetaInformationVersion", "OB"),
    (0x0002, 0x0002): ("MediaStorageSOPClassUID", "UI"),
    (0x0002, 0x0003): ("MediaStorageSOPInstanceUID", "UI"),
    (0x0002, 0x0010): ("TransferSyntaxUID", "UI"),
    (0x0002, 0x0012): ("ImplementationClassUID", "UI"),
    (0x0002, 0x0013): ("ImplementationVersionName", "SH"),
    (0x0002, 0x0016): ("SourceApplicationEntityTitle", "AE"),
    (0x0008, 0x0005): ("SpecificCharacterSet", "CS"),
    (0x0008, 0x0008): ("ImageType", "CS"),
    (0x0008, 0x0012): ("InstanceCreationDate", "DA"),
    (0x0008, 0x0013): ("InstanceCreationTime", "TM"),
    (0x0008, 0x0014): ("InstanceCreatorUID", "UI"),
    (0x0008, 0x0016): ("SOPClassUID", "UI"),
    (0x0008, 0x0018): ("SOPInstanceUID", "UI"),
    (0x0008, 0x0020): ("StudyDate", "DA"),
    (0x0008, 0x0021): ("SeriesDate", "DA"),
    (0x0008, 0x0022): ("AcquisitionDate", "DA"),
    (0x0008, 0x0023): ("ContentDate", "DA"),
    (0x0008, 0x002A): ("AcquisitionDateTime", "DT"),
    (0x0008, 0x0030): ("StudyTime", "TM"),
    (0x0008, 0x0031): ("SeriesTime", "TM"),
    (0x0008, 0x0032): ("AcquisitionTime", "TM"),
    (0x0008, 0x0033): ("ContentTime", "TM"),
    (0x0008, 0x0050): ("AccessionNumber", "SH"),
    (0x0008, 0x0060): ("Modality", "CS"),
    (0x0008, 0x0064): ("ConversionType", "CS"),
    (0x0008, 0x0068): ("PresentationIntentType", "CS"),
    (0x0008, 0x0070): ("Manufacturer", "LO"),
    (0x0008, 0x0080): ("InstitutionName", "LO"),
    (0x0008, 0x0081): ("InstitutionAddress", "ST"),
    (0x0008, 0x0090): ("ReferringPhysicianName", "PN"),
    (0x0008, 0x0100): ("CodeValue", "SH"),
    (0x0008, 0x0102): ("CodingSchemeDesignator", "SH"),
    (0x0008, 0x0104): ("CodeMeaning", "LO"),
    (0x0008, 0x0201): ("TimezoneOffsetFromUTC", "SH"),
    (0x0008, 0x1010): ("StationName", "SH"),
    (0x0008, 0x1030): ("StudyDescription", "LO"),
    (0x0008, 0x1032): ("ProcedureCodeSequence", "SQ"),
    (0x0008, 0x103E): ("SeriesDescription", "LO"),
    (0x0008, 0x1040): ("InstitutionalDepartmentName", "LO"),
    (0x0008, 0x1048): ("PhysiciansOfRecord", "PN"),
    (0x0008, 0x1050): ("PerformingPhysicianName", "PN"),
    (0x0008, 0x1060): ("NameOfPhysiciansReadingStudy", "PN"),
    (0x0008, 0x1070): ("OperatorsName", "PN"),
    (0x0008, 0x1080): ("AdmittingDiagnosesDescription", "LO"),
    (0x0008, 0x1090): ("ManufacturerModelName", "LO"),
    (0x0008, 0x1110): ("ReferencedStudySequence", "SQ"),
    (0x0008, 0x1111): ("ReferencedPerformedProcedureStepSequence", "SQ"),
    (0x0008, 0x1115): ("ReferencedSeriesSequence", "SQ"),
    (0x0008, 0x1120): ("ReferencedPatientSequence", "SQ"),
    (0x0008, 0x1140): ("ReferencedImageSequence", "SQ"),
    (0x0008, 0x1150): ("ReferencedSOPClassUID", "UI"),
    (0x0008, 0x1155): ("ReferencedSOPInstanceUID", "UI"),
    (0x0008, 0x2111): ("DerivationDescription", "ST"),
    (0x0008, 0x2112): ("SourceImageSequence", "SQ"),
    (0x0008, 0x2218): ("AnatomicRegionSequence", "SQ"),
    (0x0010, 0x0010): ("PatientName", "PN"),
    (0x0010, 0x0020): ("PatientID", "LO"),
    (0x0010, 0x0021): ("IssuerOfPatientID", "LO"),
    (0x0010, 0x0030): ("PatientBirthDate", "DA"),
    (0x0010, 0x0032): ("PatientBirthTime", "TM"),
    (0x0010, 0x0040): ("PatientSex", "CS"),
    (0x0010, 0x1000): ("OtherPatientIDs", "LO"),
    (0x0010, 0x1001): ("OtherPatientNames", "PN"),
    (0x0010, 0x1010): ("PatientAge", "AS"),
    (0x0010, 0x1020): ("PatientSize", "DS"),
    (0x0010, 0x1030): ("PatientWeight", "DS"),
    (0x0010, 0x1040): ("PatientAddress", "LO"),
    (0x0010, 0x2000): ("MedicalAlerts", "LO"),
    (0x0010, 0x2110): ("Allergies", "LO"),
    (0x0010, 0x2160): ("EthnicGroup", "SH"),
    (0x0010, 0x2180): ("Occupation", "SH"),
    (0x0010, 0x21B0): ("AdditionalPatientHistory", "LT"),
    (0x0010, 0x21C0): ("PregnancyStatus", "US"),
    (0x0010, 0x4000): ("PatientComments", "LT"),
    (0x0012, 0x0062): ("PatientIdentityRemoved", "CS"),
    (0x0012, 0x0063): ("DeidentificationMethod", "LO"),
    (0x0018, 0x0010): ("ContrastBolusAgent", "LO"),
    (0x0018, 0x0015): ("BodyPartExamined", "CS"),
    (0x0018, 0x0022): ("ScanOptions", "CS"),
    (0x0018, 0x0050): ("SliceThickness", "DS"),
    (0x0018, 0x0060): ("KVP", "DS"),
    (0x0018, 0x0088): ("SpacingBetweenSlices", "DS"),
    (0x0018, 0x1000): ("DeviceSerialNumber", "LO"),
    (0x0018, 0x1004): ("PlateID", "LO"),
    (0x0018, 0x1020): ("SoftwareVersions", "LO"),
    (0x0018, 0x1030): ("ProtocolName", "LO"),
    (0x0018, 0x1110): ("DistanceSourceToDetector", "DS"),
    (0x0018, 0x1111): ("DistanceSourceToPatient", "DS"),
    (0x0018, 0x1150): ("ExposureTime", "IS"),
    (0x0018, 0x1151): ("XRayTubeCurrent", "IS"),
    (0x0018, 0x1152): ("Exposure", "IS"),
    (0x0018, 0x1160): ("FilterType", "SH"),
    (0x0018, 0x1164): ("ImagerPixelSpacing", "DS"),
    (0x0018, 0x1190): ("FocalSpots", "DS"),
    (0x0018, 0x1260): ("PlateType", "SH"),
    (0x0018, 0x1400): ("AcquisitionDeviceProcessingDescription", "LO"),
    (0x0018, 0x1405): ("RelativeXRayExposure", "IS"),
    (0x0018, 0x5100): ("PatientPosition", "CS"),
    (0x0018, 0x5101): ("ViewPosition", "CS"),
    (0x0018, 0x6000): ("Sensitivity", "DS"),
    (0x0020, 0x000D): ("StudyInstanceUID", "UI"),
    (0x0020, 0x000E): ("SeriesInstanceUID", "UI"),
    (0x0020, 0x0010): ("StudyID", "SH"),
    (0x0020, 0x0011): ("SeriesNumber", "IS"),
    (0x0020, 0x0012): ("AcquisitionNumber", "IS"),
    (0x0020, 0x0013): ("InstanceNumber", "IS"),
    (0x0020, 0x0020): ("PatientOrientation", "CS"),
    (0x0020, 0x0032): ("ImagePositionPatient", "DS"),
    (0x0020, 0x0037): ("ImageOrientationPatient", "DS"),
    (0x0020, 0x0052): ("FrameOfReferenceUID", "UI"),
    (0x0020, 0x0060): ("Laterality", "CS"),
    (0x0020, 0x0062): ("ImageLaterality", "CS"),
    (0x0020, 0x1041): ("SliceLocation", "DS"),
    (0x0020, 0x4000): ("ImageComments", "LT"),
    (0x0028, 0x0002): ("SamplesPerPixel", "US"),
    (0x0028, 0x0004): ("PhotometricInterpretation", "CS"),
    (0x0028, 0x0006): ("PlanarConfiguration", "US"),
    (0x0028, 0x0008): ("NumberOfFrames", "IS"),
    (0x0028, 0x0009): ("FrameIncrementPointer", "AT"),
    (0x0028, 0x0010): ("Rows", "US"),
    (0x0028, 0x0011): ("Columns", "US"),
    (0x0028, 0x0030): ("PixelSpacing", "DS"),
    (0x0028, 0x0034): ("PixelAspectRatio", "IS"),
    (0x0028, 0x0100): ("BitsAllocated", "US"),
    (0x0028, 0x0101): ("BitsStored", "US"),
    (0x0028, 0x0102): ("HighBit", "US"),
    (0x0028, 0x0103): ("PixelRepresentation", "US"),
    (0x0028, 0x0106): ("SmallestImagePixelValue", "US"),
    (0x0028, 0x0107): ("LargestImagePixelValue", "US"),
    (0x0028, 0x0301): ("BurnedInAnnotation", "CS"),
    (0x0028, 0x1040): ("PixelIntensityRelationship", "CS"),
    (0x0028, 0x1041): ("PixelIntensityRelationshipSign", "SS"),
    (0x0028, 0x1050): ("WindowCenter", "DS"),
    (0x0028, 0x1051): ("WindowWidth", "DS"),
    (0x0028, 0x1052): ("RescaleIntercept", "DS"),
    (0x0028, 0x1053): ("RescaleSlope", "DS"),
    (0x0028, 0x1054): ("RescaleType", "LO"),
    (0x0028, 0x1055): ("WindowCenterWidthExplanation", "LO"),
    (0x0028, 0x2110): ("LossyImageCompression", "CS"),
    (0x0028, 0x3000): ("ModalityLUTSequence", "SQ"),
    (0x0028, 0x3010): ("VOILUTSequence", "SQ"),
    (0x0032, 0x1032): ("RequestingPhysician", "PN"),
    (0x0032, 0x1060): ("RequestedProcedureDescription", "LO"),
    (0x0040, 0x0244): ("PerformedProcedureStepStartDate", "DA"),
    (0x0040, 0x0245): ("PerformedProcedureStepStartTime", "TM"),
    (0x0040, 0x0253): ("PerformedProcedureStepID", "SH"),
    (0x0040, 0x0254): ("PerformedProcedureStepDescription", "LO"),
    (0x0040, 0x0275): ("RequestAttributesSequence", "SQ"),
    (0x0040, 0x0555): ("AcquisitionContextSequence", "SQ"),
    (0x2050, 0x0020): ("PresentationLUTShape", "CS"),
    (0x6000, 0x0010): ("OverlayRows", "US"),
    (0x6000, 0x0011): ("OverlayColumns", "US"),
    (0x6000, 0x0022): ("OverlayDescription", "LO"),
    (0x6000, 0x0040): ("OverlayType", "CS"),
    (0x6000, 0x0045): ("OverlaySubtype", "LO"),
    (0x6000, 0x0050): ("OverlayOrigin", "SS"),
    (0x6000, 0x0100): ("OverlayBitsAllocated", "US"),
    (0x6000, 0x0102): ("OverlayBitPosition", "US"),
    (0x6000, 0x1500): ("OverlayLabel", "LO"),
    (0x6000, 0x3000): ("OverlayData", "OW"),
    (0x7FE0, 0x0008): ("FloatPixelData", "OF"),
    (0x7FE0, 0x0009): ("DoubleFloatPixelData", "OD"),
    (0x7FE0, 0x0010): ("PixelData", "OW"),
}
TAG_OF = {keyword: tag for tag, (keyword, _) in ELEMENTS.items()}
# Groups that a range of even groups repeats.
REPEATED = {0x6000: 0x60FE}

LONG_TYPES = {"OB", "OD", "OF", "OL", "OV", "OW", "SQ", "SV", "UC", "UN", "UR", "UT", "UV"}
# Numpy types of numbers, without their byte order.
NUMBER_TYPES = {"US": "u2", "SS": "i2", "UL": "u4", "SL": "i4", "FL": "f4", "FD": "f8", "SV": "i8", "UV": "u8"}
# Text that the character set of a file is for; all other text is plain ASCII.
LOCAL_TEXT = {"LO", "LT", "PN", "SH", "ST", "UC", "UT"}
ITEM, ITEM_END, SEQUENCE_END = (0xFFFE, 0xE000), (0xFFFE, 0xE00D), (0xFFFE, 0xE0DD)
UNDEFINED = 0xFFFFFFFF


class Syntax(NamedTuple):
    explicit: bool
    big: bool = False

    @property
    def order(self) -> str:
        return ">" if self.big else "<"


# Transfer syntaxes of uncompressed files.
IMPLICIT, EXPLICIT, BIG_ENDIAN = "1.2.840.10008.1.2", "1.2.840.10008.1.2.1", "1.2.840.10008.1.2.2"
SYNTAXES = {IMPLICIT: Syntax(False), EXPLICIT: Syntax(True), BIG_ENDIAN: Syntax(True, True)}


class Element(NamedTuple):
    tag: Tag
    vr: str
    value: memoryview
    big: bool = False


def lookup(tag: Tag, dictionary: Dictionary = ELEMENTS) -> tuple[str, str]:
    """Keyword and value type of a tag; of an unknown one an empty keyword and UN."""
    group, element = tag
    found = dictionary.get(tag)
    if found is None:
        for first, last in REPEATED.items():
            if first <= group <= last and not group % 2:
                found = dictionary.get((first, element))
    if found:
        return found
    if element == 0:
        return "GenericGroupLength", "UL"
    if group % 2 and 0x10 <= element <= 0xFF:
        return "", "LO"  # names the maker of a private block
    return "", "UN"


def header(buf: memoryview, at: int, syntax: Syntax, dictionary: Dictionary) -> tuple[Tag, str, int, int]:
    """Tag, type, value length and value position of the element at ``at``."""
    order = syntax.order
    tag = struct.unpack_from(f"{order}HH", buf, at)
    if tag[0] == 0xFFFE or not syntax.explicit:
        return tag, lookup(tag, dictionary)[1], struct.unpack_from(f"{order}I", buf, at + 4)[0], at + 8
    vr = bytes(buf[at + 4 : at + 6]).decode("ascii", "replace")
    if vr in LONG_TYPES:
        return tag, vr, struct.unpack_from(f"{order}I", buf, at + 8)[0], at + 12
    return tag, vr, struct.unpack_from(f"{order}H", buf, at + 6)[0], at + 8


def skip_items(buf: memoryview, at: int, syntax: Syntax, dictionary: Dictionary) -> int:
    """Position after a sequence of undefined length."""
    while True:
        tag, _, length, at = header(buf, at, syntax, dictionary)
        if tag == SEQUENCE_END:
            return at
        if tag != ITEM:
            raise ValueError("broken sequence")
        if length != UNDEFINED:
            at += length
            continue
        while True:
            tag, vr, length, at = header(buf, at, syntax, dictionary)
            if tag == ITEM_END:
                break
            if length != UNDEFINED:
                at += length
            else:
                # an unknown element of undefined length holds an implicit sequence
                at = skip_items(buf, at, SYNTAXES[IMPLICIT] if vr == "UN" and not syntax.big else syntax, dictionary)


def elements(buf: memoryview, at: int, syntax: Syntax, dictionary: Dictionary, group: int | None = None) -> Iterator[tuple[Element, int]]:
    """Top-level elements with the position after each; only those of ``group`` if given."""
    item = struct.pack(f"{syntax.order}HH", *ITEM)
    while at + 8 <= len(buf):
        tag, vr, length, at = header(buf, at, syntax, dictionary)
        if group is not None and tag[0] != group:
            return
        if length == UNDEFINED:
            if tag == TAG_OF["PixelData"]:
                raise ValueError("Unsupported transfer syntax: encapsulated pixel data")
            at = skip_items(buf, at, SYNTAXES[IMPLICIT] if vr == "UN" and syntax.explicit and not syntax.big else syntax, dictionary)
            yield Element(tag, "SQ", buf[:0]), at
            continue
        if at + length > len(buf):
            raise ValueError(f"file ends inside element ({tag[0]:04x},{tag[1]:04x})")
        value = buf[at : at + length]
        if vr == "UN" and bytes(value[:4]) == item:
            vr = "SQ"
        yield Element(tag, vr, value, syntax.big), at + length
        at += length


def parse(data: bytes, dictionary: Dictionary = ELEMENTS) -> list[Element]:
    """All top-level elements of a file, file header included."""
    buf = memoryview(data)
    if not buf:
        raise ValueError("empty file")
    at = 132 if bytes(buf[128:132]) == b"DICM" else 0
    found = []
    for element, after in elements(buf, at, SYNTAXES[EXPLICIT], dictionary, group=0x0002):
        found.append(element)
        at = after
    name = next((as_text(e) for e in found if e.tag == TAG_OF["TransferSyntaxUID"]), "")
    if name and name not in SYNTAXES:
        raise ValueError(f"Unsupported transfer syntax: {name}")
    syntax = SYNTAXES.get(name)
    if syntax is None:
        # no header: an explicit element spells its value type in two capitals, and the first groups are low numbers
        code = bytes(buf[at + 4 : at + 6])
        explicit = len(code) == 2 and code.isalpha() and code.isupper()
        syntax = Syntax(explicit, explicit and bytes(buf[at : at + 1]) == b"\0" and bytes(buf[at + 1 : at + 2]) != b"\0")
    found += [element for element, _ in elements(buf, at, syntax, dictionary)]
    return found


# Defined terms of character sets → Python's names of them.
CHARACTER_SETS = {
    "": "ascii",
    "ISO_IR 6": "ascii",
    "ISO_IR 100": "iso8859_1",
    "ISO_IR 101": "iso8859_2",
    "ISO_IR 109": "iso8859_3",
    "ISO_IR 110": "iso8859_4",
    "ISO_IR 144": "iso8859_5",
    "ISO_IR 127": "iso8859_6",
    "ISO_IR 126": "iso8859_7",
    "ISO_IR 138": "iso8859_8",
    "ISO_IR 148": "iso8859_9",
    "ISO_IR 203": "iso8859_15",
    "ISO_IR 13": "shift_jis",
    "ISO_IR 166": "iso8859_11",
    "ISO_IR 192": "utf_8",
    "GB18030": "gb18030",
    "GBK": "gbk",
    "ISO 2022 IR 87": "iso2022_jp",
    "ISO 2022 IR 159": "iso2022_jp_2",
    "ISO 2022 IR 149": "euc_kr",
    "ISO 2022 IR 58": "gb2312",
}
# Escape sequences that switch to a set, by its defined term. Those of the first line switch the lower half.
LOWER_ESCAPES = {b"\x1b(B": "ISO_IR 6", b"\x1b(J": "ISO_IR 13", b"\x1b$B": "ISO 2022 IR 87", b"\x1b$@": "ISO 2022 IR 87", b"\x1b$(D": "ISO 2022 IR 159"}
UPPER_ESCAPES = {
    b"\x1b)I": "ISO_IR 13",
    b"\x1b-A": "ISO_IR 100",
    b"\x1b-B": "ISO_IR 101",
    b"\x1b-C": "ISO_IR 109",
    b"\x1b-D": "ISO_IR 110",
    b"\x1b-F": "ISO_IR 126",
    b"\x1b-G": "ISO_IR 127",
    b"\x1b-H": "ISO_IR 138",
    b"\x1b-L": "ISO_IR 144",
    b"\x1b-M": "ISO_IR 148",
    b"\x1b-T": "ISO_IR 166",
    b"\x1b-b": "ISO_IR 203",
    b"\x1b$)C": "ISO 2022 IR 149",
    b"\x1b$)A": "ISO 2022 IR 58",
}
ESCAPE_OF = {term: mark for mark, term in [*LOWER_ESCAPES.items(), *UPPER_ESCAPES.items()] if mark != b"\x1b$@"}
_ESCAPE = re.compile(b"(" + b"|".join(re.escape(m) for m in sorted([*LOWER_ESCAPES, *UPPER_ESCAPES], key=len, reverse=True)) + b")")
# What ends the reach of an escape sequence: values, lines, and the parts of a person's name.
_ENDS = re.compile(rb"([\\\n\r\t\f])")
_NAME_ENDS = re.compile(rb"([\\\n\r\t\f^=])")


def codec(term: str) -> str:
    """Python's codec of a defined term; with code extensions, single sets are spelt ``ISO 2022 IR n``."""
    found = CHARACTER_SETS.get(term) or CHARACTER_SETS.get(term.replace("ISO 2022 IR ", "ISO_IR "))
    return found or "ascii"


def decode_text(value: bytes, terms: tuple[str, ...], vr: str) -> str:
    """Text of a value by the character sets of its file (none given: UTF-8, or else Latin-1)."""
    if not terms:
        try:
            return value.decode("utf-8")
        except UnicodeDecodeError:
            return value.decode("latin-1")
    first = codec(terms[0])
    if b"\x1b" not in value:
        return value.decode(first, "replace")
    ends = _NAME_ENDS if vr == "PN" else _ENDS
    out, lower, upper = [], None, first
    for part in _ESCAPE.split(value):
        if part in LOWER_ESCAPES:
            lower = None if LOWER_ESCAPES[part] in ("ISO_IR 6", "ISO_IR 13") else part
            continue
        if part in UPPER_ESCAPES:
            upper = codec(UPPER_ESCAPES[part])
            continue
        if lower:  # two bytes a character, none of them a mark that ends
            out.append((lower + part).decode("iso2022_jp_2", "replace"))
            continue
        for piece in ends.split(part):
            if ends.fullmatch(piece):
                upper = first
            out.append(piece.decode(upper, "replace"))
    return "".join(out)


def encode_text(text: str, terms: tuple[str, ...], vr: str) -> bytes:
    """Bytes of a text; what the first set lacks is written in the first other one that has it, behind its escape sequence."""
    if not terms:
        return text.encode()
    marks = r"([\\\n\r\t\f^=])" if vr == "PN" else r"([\\\n\r\t\f])"
    return b"".join(_encode_piece(piece, terms) for piece in re.split(marks, text))


def _encoded(text: str, term: str) -> bytes | None:
    try:
        data = text.encode(codec(term))
    except UnicodeEncodeError:
        return None
    return None if term.endswith("IR 13") and len(data) != len(text) else data  # that set has single bytes only


def _encode_piece(piece: str, terms: tuple[str, ...]) -> bytes:
    """Text up to the next mark that ends a switch: runs of characters that one set has."""
    whole = _encoded(piece, terms[0])
    if whole is not None:
        return whole
    runs: list[tuple[int, str]] = []
    for c in piece:
        last = runs[-1][0] if runs else 0
        n = last if _encoded(c, terms[last]) is not None else next((k for k, t in enumerate(terms) if _encoded(c, t) is not None), 0)
        if runs and n == last:
            runs[-1] = (n, runs[-1][1] + c)
        else:
            runs.append((n, c))
    out, active = [], 0
    for n, text in runs:
        data = _encoded(text, terms[n]) or text.encode(codec(terms[n]), "replace")
        if b"\x1b" not in data and not data.isascii() and n != active:  # other codecs write their escape sequences themselves
            out.append(ESCAPE_OF.get(terms[n].replace("ISO 2022 IR ", "ISO_IR "), ESCAPE_OF.get(terms[n], b"")))
            active = n
        out.append(data)
    return b"".join(out)


def terms_of(found: list[Element]) -> tuple[str, ...]:
    """Defined terms of a file's character sets."""
    value = next((bytes(e.value) for e in found if e.tag == TAG_OF["SpecificCharacterSet"]), b"")
    terms = tuple(t.strip(" \0") for t in value.decode("ascii", "replace").split("\\"))
    return terms if any(terms) else ()


def as_text(element: Element, terms: tuple[str, ...] = ()) -> str | None:
    """Value as text; several values as a bracketed list; binary and sequence values as null."""
    _, vr, value, big = element
    if vr in NUMBER_TYPES:
        items = [str(v) for v in np.frombuffer(value, (">" if big else "<") + NUMBER_TYPES[vr]).tolist()]
        return items[0] if len(items) == 1 else f"[{', '.join(items)}]" if items else ""
    if vr == "AT":
        pairs = np.frombuffer(value, (">" if big else "<") + "u2").reshape(-1, 2).tolist()
        items = [f"({g:04X},{e:04X})" for g, e in pairs]
        return items[0] if len(items) == 1 else f"[{', '.join(items)}]" if items else ""
    if vr == "UN":  # of unknown type: shown where it reads as text
        shown = decode_text(bytes(value), terms, vr).rstrip("\0 ")
        return shown if shown.isprintable() and "�" not in shown else None
    if vr in LONG_TYPES - {"UC", "UR", "UT"}:
        return None
    full = decode_text(bytes(value), terms if vr in LOCAL_TEXT else (), vr).rstrip("\0 ")
    if vr in ("LT", "ST", "UT", "UR") or "\\" not in full:
        return full.strip(" ") if vr in ("IS", "DS") else full
    parts = full.split("\\")
    items = [p.strip(" ") for p in parts] if vr in ("IS", "DS") else [repr(p) for p in parts]
    return items[0] if len(items) == 1 else f"[{', '.join(items)}]" if items else ""


def encode_element(tag: Tag, vr: str, value: bytes, syntax: Syntax = SYNTAXES[EXPLICIT]) -> bytes:
    if len(value) % 2:
        value += b"\0" if vr in ("UI", "OB") else b" "
    order = syntax.order
    start = struct.pack(f"{order}HH", *tag)
    if not syntax.explicit:
        return start + struct.pack(f"{order}I", len(value)) + value
    size = struct.pack(f"{order}HI", 0, len(value)) if vr in LONG_TYPES else struct.pack(f"{order}H", len(value))
    return start + vr.encode() + size + value


def encode_sequence(tag: Tag, items: list[bytes], syntax: Syntax) -> bytes:
    """A sequence of items, each the encoded elements of one."""
    order = syntax.order
    body = b"".join(struct.pack(f"{order}HHI", *ITEM, len(i)) + i for i in items)
    return encode_element(tag, "SQ", body, syntax)
