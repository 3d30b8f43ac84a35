"""Entities landed as files, read lazily by the executors."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake import schemas
from tierlake.operators.columns import column
from tierlake.sources import arrays
from tierlake.sources.sinks import write_folder

CORRUPT, CORRUPT_OPTION, PARSED = "_corrupt_record", "columnNameOfCorruptRecord", "_parsed"
# Formats of text whose reader can be told to stop at a malformed record.
STRICT_FORMATS = frozenset({"json", "csv", "xml"})
POSITION = ("_source_file", "_source_block", "_source_row")


@dataclass(frozen=True)
class EntitySpec:
    """Where an entity lands and how to read it.

    Files have a record per line and split freely. ``multi_line`` is for JSON
    arrays that span lines: their records are cut and stored once, a file per task,
    and split freely from then on. Without a schema Spark infers one, at the cost of
    a pass over the files; arrays that span lines then take one task per file.
    Fields that the schema declares not null are required of a tolerant read.
    """

    name: str
    path: str
    schema: T.StructType | None = None
    format: str = "json"
    multi_line: bool = False
    options: Mapping[str, str] = field(default_factory=dict)
    source_url: str | None = None
    source_system: str = "landing_files"

    @property
    def url(self) -> str:
        return self.source_url or self.path


def landed(base: str, names: Mapping[str, T.StructType] = schemas.ENTITIES, **fields) -> dict[str, EntitySpec]:
    """One spec per entity, landed under ``<base>/<entity>``."""
    return {
        name: EntitySpec(name, f"{base}/{name}", schema=schema, **fields)
        for name, schema in names.items()
    }


def read_entity(spark: SparkSession, spec: EntitySpec, with_position: bool = False) -> DataFrame:
    """The records as landed; a malformed one stops the run, in any text format.

    ``with_position`` adds columns that order the rows as they stand in the
    files, whatever way Spark splits them: path, block start, row. Sources that
    aren't files have no such columns.
    """
    if _cut(spec):
        found = arrays.records(spark, spec.path)
        broken = F.raise_error(F.concat(F.lit("Malformed record in "), arrays.FILE, F.lit(": "), F.substring(arrays.RECORD, 1, 200)))
        parsed = F.when(F.col(arrays.WHOLE), F.from_json(arrays.RECORD, spec.schema, _options(spec, "FAILFAST"))).otherwise(broken)
        df = found.select(parsed.alias(PARSED), arrays.FILE, arrays.NUMBER)
        place = [F.col(arrays.FILE), F.lit(0).cast("bigint"), F.col(arrays.NUMBER).cast("bigint")]
        return df.select(f"{PARSED}.*", *(column.alias(name) for column, name in zip(place, POSITION) if with_position))
    df = _reader(spark, spec, spec.schema, "FAILFAST").load(spec.path)
    return _positioned(df) if with_position else df


def read_tolerant(spark: SparkSession, spec: EntitySpec, staged: str) -> tuple[DataFrame, DataFrame]:
    """Good records, and rejects as (file, raw text), for a reject table.

    Any source will do. Text formats say themselves which records they could not parse,
    and give their text. A source may also offer it in a column ``_corrupt_record``. From
    every source a record is rejected that lacks a field the schema declares not null; its
    text is the record as JSON then. The file is null for sources that have none.

    The records are parsed once, with every column, into the ``staged`` path.
    Read lazily, a plan that needs few columns would parse just those and
    judge a record by them, and each of the two results would parse anew.
    """
    if spec.schema is None:
        raise ValueError("a tolerant read needs a schema")
    names = spec.schema.fieldNames()
    schema = T.StructType([T.StructField(field.name, field.dataType) for field in spec.schema.fields])
    with_text = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    if _cut(spec):
        found = arrays.records(spark, spec.path)
        parsed = F.from_json(arrays.RECORD, with_text, {**_options(spec, "PERMISSIVE"), CORRUPT_OPTION: CORRUPT})
        df = found.select(parsed.alias(PARSED), F.col(arrays.FILE).alias(POSITION[0]), arrays.WHOLE, arrays.RECORD)
        text = F.when(F.col(arrays.WHOLE), F.col(f"{PARSED}.{CORRUPT}")).otherwise(F.col(arrays.RECORD))
        kept = [F.col(PARSED).getField(name).alias(name) for name in names]
        df = df.select(*kept, text.alias(CORRUPT), POSITION[0])
    elif spec.format in STRICT_FORMATS:
        df = _with_file(_reader(spark, spec, with_text, "PERMISSIVE").option(CORRUPT_OPTION, CORRUPT).load(spec.path))
    else:
        df = _reader(spark, spec, None, "PERMISSIVE").load(spec.path)
        df = _with_file(df if CORRUPT in df.columns else df.withColumn(CORRUPT, F.lit(None).cast("string")))
    required = [column(field.name).isNull() for field in spec.schema.fields if not field.nullable]
    if required:
        lacking = reduce(or_, required)
        record = F.to_json(F.struct(*(column(name) for name in names)), {"ignoreNullFields": "false"})
        df = df.withColumn(CORRUPT, F.coalesce(CORRUPT, F.when(lacking, record)))
    write_folder(df, staged)
    table = spark.read.schema(df.schema).parquet(staged)
    rejected = F.col(CORRUPT).isNotNull()
    good = table.where(~rejected).select(*(column(field.name).cast(field.dataType).alias(field.name) for field in schema.fields))
    return good, table.where(rejected).select(POSITION[0], CORRUPT)


def read_entities(spark: SparkSession, specs: Mapping[str, EntitySpec], with_position: bool = False) -> dict[str, DataFrame]:
    return {name: read_entity(spark, spec, with_position) for name, spec in specs.items()}


def _cut(spec: EntitySpec) -> bool:
    return spec.format == "json" and spec.multi_line and spec.schema is not None


def _options(spec: EntitySpec, mode: str) -> dict[str, str]:
    return {"mode": mode, **spec.options}


def _reader(spark: SparkSession, spec: EntitySpec, schema: T.StructType | None, mode: str):
    reader = spark.read.format(spec.format)
    if spec.format in STRICT_FORMATS:
        reader = reader.option("mode", mode)
    if spec.format == "json":
        reader = reader.option("multiLine", spec.multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**spec.options)


def _with_file(df: DataFrame) -> DataFrame:
    """The records with the file each is from, null where the source has none."""
    try:
        file = df.metadataColumn("_metadata").getField("file_path")
        df.select(file).schema
    except AnalysisException:
        file = F.lit(None).cast("string")
    return df.withColumn(POSITION[0], file)


def _positioned(df: DataFrame) -> DataFrame:
    try:
        place = df.metadataColumn("_metadata")
        file, block = place.getField("file_path"), place.getField("file_block_start")
        df.select(file, block).schema
    except AnalysisException:
        return df
    # Within one block a single task reads in order, so the id grows there.
    return df.select(
        "*", file.alias(POSITION[0]), block.alias(POSITION[1]), F.monotonically_increasing_id().alias(POSITION[2])
    )
