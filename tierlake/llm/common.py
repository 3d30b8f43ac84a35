"""Pieces several operators share: stored tables, content locators, ranks."""

from __future__ import annotations

import tempfile
import zipfile
from contextlib import contextmanager
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierlake.sources import files
from tierlake.sources.scratch import scratch_folder

# Fixed value: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Most bytes of file names that are sent to every executor.
BROADCAST_BYTES = 16 << 20


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared folder and read back, which ends its lineage."""
    path = scratch_folder(frame.sparkSession, purpose)
    frame.write.option("maxRecordsPerFile", 0).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Remove the files of stored frames that nothing reads any more."""
    for frame in frames:
        for folder in {path.rpartition("/")[0] for path in frame.inputFiles()}:
            files.remove(frame.sparkSession, folder)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per application."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tierlake-modules-")) / "tierlake.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for module in sorted(package.rglob("*.py")):
            target.write(module, module.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(application)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings that hold inside a with block only."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def fresh(columns: list[str], name: str) -> str:
    """The name, with underscores in front until no column has it."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


@dataclass(frozen=True)
class Located:
    """A frame of stored rows whose columns `file` and `row` say where each row is."""

    frame: DataFrame
    columns: list[str]
    file: str
    row: str
    #: Numbers used if the rows are numbered.
    total: int = 0


def located(docs: DataFrame) -> Located:
    """The rows with their place, which also tells repeated rows apart.

    Rows that don't come straight from Parquet files are stored first.
    """
    file, row = fresh(docs.columns, "_file"), fresh(docs.columns, "_row")

    def places(frame: DataFrame) -> DataFrame:
        meta = frame.metadataColumn("_metadata")
        return frame.withColumns({file: meta.getField("file_path"), row: meta.getField("row_index")})

    try:
        frame = places(docs)
        frame.schema
    except AnalysisException:
        frame = places(stored(docs, "located"))
    return Located(frame, docs.columns, file, row)


def numbered(docs: DataFrame) -> Located:
    """The rows with a number from 0 in `row` that is unique and stays the same on every read of these files.

    The table of first numbers has a row per file. It is broadcast up to
    BROADCAST_BYTES and joined as any other table beyond, which moves the rows.
    """
    rows = located(docs)
    sizes = rows.frame.groupBy(rows.file).agg(F.max(rows.row) + 1)
    paths, firsts, total = [], [], 0
    for path, size in sorted(tuple(row) for row in sizes.collect()):
        paths.append(path)
        firsts.append(total)
        total += size
    first = fresh([*rows.columns, rows.file, rows.row], "_first")
    # From Arrow, as rows of Python objects would start Python workers of their own, which stay.
    table = pa.table([pa.array(paths, pa.string()), pa.array(firsts, pa.int64())], [rows.file, first])
    files = docs.sparkSession.createDataFrame(table)
    if sum(len(path) + 16 for path in paths) <= BROADCAST_BYTES:
        files = F.broadcast(files)
    frame = rows.frame.join(files, rows.file).withColumn(rows.row, F.col(first) + F.col(rows.row))
    return Located(frame.select(*rows.columns, rows.file, rows.row), rows.columns, rows.file, rows.row, total)


def spelled(column: str) -> Column:
    """An identifier on its way through pandas, which would round large ones beside nulls; to be cast back."""
    return F.col(column).cast("string").alias("doc_id")


def plain_text(column: str) -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def ranked(frame: DataFrame, groups: list[str], order: list[str], name: str, purpose: str) -> DataFrame:
    """The frame with each row's rank from 0 within its group.

    The rows are sorted by ranges over the whole table, so a group as large as a
    third of the table is dealt over many tasks if `order` ends in a unique key.
    A row's rank is its place in its sorted file plus what earlier files hold.
    Group columns must not be null.
    """
    sorted_rows = stored(frame.orderBy(*groups, *order), purpose)
    meta = sorted_rows.metadataColumn("_metadata")
    part, place = fresh(frame.columns, "_part"), fresh(frame.columns, "_place")
    number = F.regexp_extract(meta.getField("file_name"), r"part-(\d+)", 1).cast("int")
    rows = sorted_rows.withColumns({part: number, place: meta.getField("row_index")})
    runs = rows.groupBy(*groups, part).agg(F.min(place).alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *groups, part, (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    return rows.join(runs, [*groups, part]).select(
        *frame.columns, (F.col(place) + F.col("_shift")).alias(name)
    )
