"""Record hashes and date-part keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Partition columns of the dated bronze layout and their patterns.
DATE_PARTS = {"ano": "yyyy", "mes": "MM", "dia": "dd"}


# How values are spelled in the hashed text, whatever the session's settings.
HASHED_AS = {
    "ignoreNullFields": "false",
    "timeZone": "UTC",
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "locale": "en-US",
}


def record_hash(columns: Sequence[Column]) -> Column:
    """MD5 over the columns as one JSON object, nulls spelled out.

    Equal values give equal hashes in every session: instants are written in
    UTC with microseconds. Columns with maps go through ``canonical`` first, which
    needs their type. The bytes hashed are defined here and are not those of any
    other tool.
    """
    return F.md5(F.to_json(F.struct(*columns), HASHED_AS))


def holds_map(kind: T.DataType) -> bool:
    """Whether a value of this type has a map in it, at any depth."""
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return holds_map(kind.elementType)
    return isinstance(kind, T.StructType) and any(holds_map(field.dataType) for field in kind.fields)


def canonical(value: Column, kind: T.DataType) -> Column:
    """The value in a form that is equal for equal values: maps become their entries, sorted by key.

    Goes down into arrays, structs and the maps themselves; values without a map stay as they are.
    """
    if not holds_map(kind):
        return value
    if isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(value), lambda entry: F.struct(
            canonical(entry.getField("key"), kind.keyType).alias("key"),
            canonical(entry.getField("value"), kind.valueType).alias("value"),
        ))
        # Keys are never equal, and unlike values they can always be ordered.
        return F.array_sort(entries, lambda a, b: F.when(a.getField("key") < b.getField("key"), -1).otherwise(1))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda element: canonical(element, kind.elementType))
    fields = [canonical(value.getField(field.name), field.dataType).alias(field.name) for field in kind.fields]
    return F.when(value.isNotNull(), F.struct(*fields))


def date_parts(day: Column) -> dict[str, Column]:
    """Year, month and day as zero-padded strings."""
    return {name: F.date_format(day, pattern) for name, pattern in DATE_PARTS.items()}


def run_stamp(moment: Column) -> Column:
    """Timestamp as the run-stamp string."""
    return F.date_format(moment, "yyyyMMdd_HHmmss")
