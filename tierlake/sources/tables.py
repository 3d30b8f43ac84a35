"""Tables that are replaced as a whole, as versioned folders and a pointer that moves last.

Below the table's path every write makes a folder of its own, ``v-<id>``. Small numbered
files below ``_pointer`` name the folder that holds the table; the highest number counts.
A write that fails half way leaves a folder that no pointer names, so the last good table
stays as it was, and a reader that began on an older version finishes on it: one version
before the current one is kept. Pointers are made by exclusive create under a claim, so
writers at the same time end one after the other and the last one stays.

A folder without pointers is read as it is: tables written by others stay readable.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from tierlake.sources import files, sinks
from tierlake.sources.claims import claimed

POINTERS, VERSION = "_pointer", "v-"
#: Versions that stay besides the current one, and seconds until a folder that no pointer names counts as left over.
KEPT, LEFT_OVER = 1, 24 * 3600.0


@dataclass(frozen=True)
class Version:
    """One state of a table."""

    number: int
    folder: str
    rows: int


def _pointer(path: str, number: int) -> str:
    return f"{path}/{POINTERS}/{number:012d}.json"


def versions(spark: SparkSession, path: str) -> list[Version]:
    """All versions that pointers name, oldest first. A pointer that is still being written is none yet."""
    found = []
    for name in files.children(spark, f"{path}/{POINTERS}"):
        number, dot, kind = name.partition(".")
        if kind != "json" or not number.isdigit():
            continue
        try:
            content = json.loads(files.read_text(spark, _pointer(path, int(number))))
            found.append(Version(int(number), content["folder"], content["rows"]))
        except (ValueError, KeyError):
            continue
    return found


def current(spark: SparkSession, path: str) -> Version | None:
    return (versions(spark, path) or [None])[-1]


def folder(spark: SparkSession, path: str) -> str:
    """Where the files of the table are now."""
    found = current(spark, path)
    return f"{path}/{found.folder}" if found else path


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The table as the last finished write left it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(folder(spark, path))


def replace_table(df: DataFrame, path: str, *metrics: Column) -> dict[str, int]:
    """Write a new version of the whole table and move the pointer to it; the row count and metrics of the write."""
    spark, name = df.sparkSession, f"{VERSION}{uuid.uuid4().hex}"
    try:
        found = sinks.write_folder(df, f"{path}/{name}", *metrics)
    except BaseException:
        files.remove(spark, f"{path}/{name}")
        raise
    with claimed(spark, f"{path}/{POINTERS}/claim"):
        known = versions(spark, path)
        taken = [int(x.partition(".")[0]) for x in files.children(spark, f"{path}/{POINTERS}") if x.endswith(".json")]
        content = json.dumps({"folder": name, "rows": found[sinks.ROWS]})
        if not files.create(spark, _pointer(path, max(taken, default=0) + 1), content):
            raise RuntimeError(f"{path}: a pointer was made without the claim")
        _tidy(spark, path, known, name)
    return found


def _tidy(spark: SparkSession, path: str, known: list[Version], name: str) -> None:
    """Remove versions that are too old, and what failed writes or another layout left behind."""
    old, kept = known[: len(known) - KEPT], known[len(known) - KEPT :] if KEPT else []
    for version in old:
        files.remove(spark, f"{path}/{version.folder}")
        files.remove(spark, _pointer(path, version.number))
    wanted = {name, POINTERS, *(version.folder for version in kept)}
    for other in files.children(spark, path):
        unnamed = other.startswith(VERSION) and files.age(spark, f"{path}/{other}") > LEFT_OVER
        plain = other.startswith(("part-", "_SUCCESS"))
        if other not in wanted and (unnamed or plain):
            files.remove(spark, f"{path}/{other}")
