"""Projection, nesting and metadata columns: all narrow, none moves a row."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions.keys import canonical, date_parts, record_hash
from tierlake.run import RunInfo

METADATA_PREFIX = "_"


def quoted(name: str) -> str:
    """A column name that may contain dots, for ``F.col``."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def leaf_paths(schema: T.StructType, above: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    """Paths of all non-struct fields, in schema order. Arrays are leaves."""
    for field in schema.fields:
        path = (*above, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from leaf_paths(field.dataType, path)
        else:
            yield path


def _leaf(path: tuple[str, ...]) -> Column:
    return F.col(".".join(quoted(part) for part in path))


def flatten(df: DataFrame) -> DataFrame:
    """Every nested leaf becomes a column named by its dotted path."""
    return _select_unique(df, {path: ".".join(path) for path in leaf_paths(df.schema)})


def normalised_name(name: str, prefix: str, separators: str) -> str:
    for separator in separators:
        name = name.replace(separator, "_")
    return prefix + name.lower()


def expand_nested(df: DataFrame, name: str, prefix: str, separators: str) -> DataFrame:
    """Put the leaves of one nested entity behind the other columns.

    Takes a struct column ``name``, or the ``name.*`` columns of a table that
    was flattened earlier. The leaves stay on their row: there is no join.
    """
    head = name + "."
    fields = {field.name: field.dataType for field in df.schema.fields}
    if isinstance(fields.get(name), T.StructType):
        leaves = {(name, *path): ".".join(path) for path in leaf_paths(fields[name])}
    else:
        leaves = {(full,): full[len(head):] for full in fields if full.startswith(head)}
    kept = {(full,): full for full in fields if full != name and not full.startswith(head)}
    renamed = {
        path: normalised_name(leaf, prefix, separators) for path, leaf in leaves.items()
    }
    return _select_unique(df, {**kept, **renamed})


def _select_unique(df: DataFrame, names: Mapping[tuple[str, ...], str]) -> DataFrame:
    taken = list(names.values())
    clashes = sorted({name for name in taken if taken.count(name) > 1})
    if clashes:
        raise ValueError(f"several columns would be named {clashes}")
    return df.select(*[_leaf(path).alias(name) for path, name in names.items()])


def business_columns(df: DataFrame) -> list[str]:
    """Column names that are not pipeline metadata."""
    return [name for name in df.columns if not name.startswith(METADATA_PREFIX)]


def drop_metadata(df: DataFrame) -> DataFrame:
    return df.select(*[column(name) for name in business_columns(df)])


def with_record_hash(df: DataFrame) -> DataFrame:
    """Add the hash of the business columns as they are now."""
    kinds = {field.name: field.dataType for field in df.schema.fields}
    hashed = record_hash([canonical(column(name), kinds[name]).alias(name) for name in business_columns(df)])
    return df.withColumn("_record_hash", hashed)


def with_snapshot_lineage(df: DataFrame, run: RunInfo, source_url: str, source_system: str) -> DataFrame:
    return df.withColumns(
        {
            "_ingestion_timestamp": F.lit(run.stamp),
            "_source_url": F.lit(source_url),
            "_source_system": F.lit(source_system),
        }
    )


def with_job_lineage(df: DataFrame, run: RunInfo, source_url: str, entity: str) -> DataFrame:
    return df.withColumns(
        {
            "_ingestion_timestamp": F.lit(run.stamp),
            "_ingestion_date": F.lit(run.date),
            "_source_url": F.lit(source_url),
            "_source_entity": F.lit(entity),
            "_job_name": F.lit(run.job_name),
        }
    )


def with_date_parts(df: DataFrame, day: Column) -> DataFrame:
    """Add the string partition columns for a date."""
    return df.withColumns(date_parts(day))


def with_process_stamp(df: DataFrame, layer: str, run: RunInfo, version: bool = False) -> DataFrame:
    stamps = {f"_{layer}_processed_at": F.lit(run.started_at)}
    if version:
        stamps["_pipeline_version"] = F.lit(run.pipeline_version)
    return df.withColumns(stamps)


def literal_rows(rows: Sequence[Mapping | None], schema: T.StructType) -> Column:
    """A few known rows as one array literal, whatever their number."""
    return F.from_json(F.lit(json.dumps(rows)), T.ArrayType(schema))


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Those of the names that the table has, in the given order."""
    return [name for name in names if name in df.columns]
