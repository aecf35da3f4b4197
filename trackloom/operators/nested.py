"""Scans and sensor descriptions out of documents whose shape varies with the software that wrote them.

Documents are VARIANT values: their paths are read as they are, without a schema.  An attribute that is null counts as
absent where a value is looked for, and as present where only its name is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where a source keeps its sensor description, what makes a document a scan, and how fields may be named.
INFO_PLACES = ("metadata", "metadatas", "infos", "sensor_info")
SCAN_PARTS = ("fields", "h", "w", "timestamp")
FIELD_NAMES = ("{0}", "ChanField.{0}")


def part(doc: Column, name: str) -> Column:
    """The attribute ``name``; null if it is absent (a variant null if it is there and null)."""
    return F.try_variant_get(doc, f"$['{name}']", "variant")


def is_list(doc: Column) -> Column:
    return F.coalesce(F.schema_of_variant(doc).startswith("ARRAY"), F.lit(False))


def _value(doc: Column) -> Column:
    """``doc``, or null where it is a variant null."""
    return F.when(~F.is_variant_null(doc), doc)


def items(doc: Column) -> Column:
    """The items of a list; of anything else the value alone; of null none."""
    own = F.when(doc.isNotNull(), F.array(doc)).otherwise(F.array().cast("array<variant>"))
    return F.when(is_list(doc), F.try_variant_get(doc, "$", "array<variant>")).otherwise(own)


def first_value(values: Column) -> Column:
    """The first item that is not null."""
    return F.get(F.filter(values, lambda x: x.isNotNull() & ~F.coalesce(F.is_variant_null(x), F.lit(True))), F.lit(0))


def first_sensor_info(doc: Column, places: Sequence[str] = INFO_PLACES) -> Column:
    """The first description that is not null in the first of ``places`` that holds any; a list that holds none is passed over."""
    return F.coalesce(*[first_value(items(_value(part(doc, p)))) for p in places])


def is_scan(doc: Column) -> Column:
    """Whether a document has all attributes of a scan."""
    out = F.lit(True)
    for p in SCAN_PARTS:
        out = out & part(doc, p).isNotNull()
    return F.coalesce(out, F.lit(False))


def first_scan(doc: Column, depth: int = 1) -> Column:
    """The document itself if it is a scan, else the first scan in its lists, which are searched ``depth`` levels deep, in order."""
    found = items(doc) if depth > 0 else F.array(doc)
    for _ in range(1, depth):
        found = F.flatten(F.transform(found, items))
    return F.when(is_scan(doc), doc).otherwise(F.get(F.filter(found, is_scan), F.lit(0)))


def _named(scan: Column, field: str) -> list[Column]:
    """The field's values under each of its names, in the scan's map of fields."""
    return [F.try_variant_get(scan, f"$.field['{n.format(field)}']", "variant") for n in FIELD_NAMES]


def has_field(scan: Column, field: str) -> Column:
    """Whether the scan lists the field, under any of its names, or holds its values."""
    listed = F.try_variant_get(scan, "$.fields", "array<string>")
    out = F.lit(False)
    for n in FIELD_NAMES:
        out = out | F.coalesce(F.array_contains(listed, n.format(field)), F.lit(False))
    for v in _named(scan, field):
        out = out | v.isNotNull()
    return F.coalesce(out, F.lit(False))


def get_field(scan: Column, field: str, kind: str = "array<double>") -> Column:
    """The field's values; null where the scan has none."""
    return F.coalesce(*[F.try_variant_get(F.when(~F.is_variant_null(v), v), "$", kind) for v in _named(scan, field)])
