"""Expressions over ``map<string,string>`` metadata."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

METADATA_TYPE = "map<string,string>"

# DICOM keyword → metadata key.
CANONICAL_KEYS = {
    "PatientID": "patient_id",
    "PatientName": "patient_name",
    "SeriesDescription": "obs",
}
# The five-key variant written by the DICOM writer.
EXTENDED_KEYS = {
    "PatientID": "patient_id",
    "PatientName": "patient_name",
    "ImageComments": "infer_results",
    "StudyDescription": "infer_confidence",
    "SeriesDescription": "obs",
}


def get_or(metadata: Column, keys: list[str], default: str = "N/A") -> Column:
    """First key that is present, else ``default``."""
    return F.coalesce(*[F.element_at(metadata, F.lit(k)) for k in keys], F.lit(default))


def canonical_metadata(lookup: Callable[[str], Column], keys: dict[str, str] = CANONICAL_KEYS) -> Column:
    """Map with our key names; ``lookup`` finds a keyword, an absent one gives an empty string."""
    parts: list[Column] = []
    for keyword, key in keys.items():
        parts += [F.lit(key), F.coalesce(lookup(keyword), F.lit(""))]
    return F.create_map(*parts)


def error_metadata(message: Column) -> Column:
    """Metadata of an image that could not be read: the message and blank ids."""
    parts: list[Column] = [F.lit("error"), message]
    for key in CANONICAL_KEYS.values():
        parts += [F.lit(key), F.lit("")]
    return F.create_map(*parts)


def or_empty(metadata: Column) -> Column:
    return F.coalesce(metadata, F.create_map().cast(METADATA_TYPE))


def with_entries(metadata: Column, extra: dict[str, Column]) -> Column:
    """Copy of ``metadata`` in which the entries of ``extra`` win."""
    base = F.map_filter(or_empty(metadata), lambda k, _: ~k.isin(*extra))
    parts = [c for key, value in extra.items() for c in (F.lit(key), value)]
    return F.map_concat(base, F.create_map(*parts))


def from_pairs(pairs: Column) -> Column:
    """``array<struct<key,value>>`` → map, the last of equal keys winning, in the order of those last ones."""
    numbered = F.transform(pairs, lambda p, i: F.struct(p["key"].alias("key"), i.alias("at"), p["value"].alias("value")))
    by_key = F.sort_array(numbered)
    # only a neighbour can have the same key; past the end there is null
    last = F.filter(by_key, lambda p, i: ~p["key"].eqNullSafe(F.get(by_key, i + 1)["key"]))
    placed = F.sort_array(F.transform(last, lambda p: F.struct(p["at"].alias("at"), p["key"].alias("key"), p["value"].alias("value"))))
    return F.map_from_entries(F.transform(placed, lambda p: F.struct(p["key"].alias("key"), p["value"].alias("value"))))


def entry_lines(metadata: Column, limit: int | None = None) -> Column:
    """``key: value`` lines in map order, at most ``limit`` of them."""
    entries = F.map_entries(or_empty(metadata))
    if limit is not None:
        entries = F.slice(entries, 1, limit)
    return F.transform(entries, lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("None"))))
