"""Keep-first deduplication and its counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.operators.columns import column

_RANK = "__rank"


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per key, the first by ``order_by``.

    A table has no row order, so the order must be given; by default it is all
    other columns, which leaves only equal rows tied. Null is a key value.
    Columns with maps, which have no order, are ordered by their JSON text.

    Filtering ``row_number() = 1`` lets Spark limit every key to one row inside
    each map task before the shuffle, so a key that holds a third of the table
    sends one row per task and not the third.
    """
    order = list(order_by or [])
    if not order:
        order = [_orderable(df, name) for name in df.columns if name not in keys] or [F.lit(0)]
    window = Window.partitionBy(*[column(key) for key in keys]).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def duplicate_count(df: DataFrame, keys: Sequence[str], name: str = "removed") -> DataFrame:
    """Rows beyond the first of each key, as a one-row table.

    Reads the key columns only and counts inside the map tasks first. Keys are
    compared by value, whatever their length, so collations hold.
    """
    named = [column(key).alias(f"__key{i}") for i, key in enumerate(keys)]
    per_key = df.groupBy(*named).agg(F.count(F.lit(1)).alias("__rows"))
    surplus = F.sum(F.col("__rows") - 1)
    return per_key.agg(F.coalesce(surplus, F.lit(0).cast("bigint")).alias(name))


def duplicates_of(key: str) -> Column:
    """Rows beyond the first of each value of a column, as an aggregate.

    Several of them share one scan and one shuffle.
    """
    value = column(key)
    distinct = F.count_distinct(value) + F.least(F.count_if(value.isNull()), F.lit(1).cast("bigint"))
    return F.count(F.lit(1)) - distinct


def counts_distinct(kind: T.DataType) -> bool:
    """Whether Spark counts distinct values of the type."""
    return not _has(kind, (T.MapType, T.VariantType))


def _orderable(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.MapType) and not any(_has(part, T.MapType) for part in (kind.keyType, kind.valueType)):
        return F.to_json(F.array_sort(F.map_entries(column(name))))
    return F.to_json(F.struct(column(name))) if _has(kind, T.MapType) else column(name)


def _has(kind: T.DataType, sought: type | tuple[type, ...]) -> bool:
    """Whether the type is, or holds, one of those sought."""
    if isinstance(kind, sought):
        return True
    if isinstance(kind, T.StructType):
        return any(_has(field.dataType, sought) for field in kind.fields)
    return isinstance(kind, T.ArrayType) and _has(kind.elementType, sought)
