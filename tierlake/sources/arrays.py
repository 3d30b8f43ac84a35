"""JSON arrays that span lines, cut into records once so that what follows can split them."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.sources.scratch import scratch_folder

#: Bytes of records that are read together at least, and so the least piece of a cut file.
PIECE_BYTES = 8 << 20
#: Characters of records that leave the cutter at once.
TOGETHER = 1 << 22
FILE, NUMBER, RECORD, WHOLE = "file", "number", "record", "whole"

DECODER = json.JSONDecoder()
#: White space, strings of either quote, brackets: what tells where a value ends.
SPACE = re.compile("[\\s\ufeff]*")
AFTER = re.compile("[\\s\ufeff]*([,\\]]?)[\\s\ufeff]*")
MARKS = re.compile(r"\"(?:[^\"\\]|\\.)*\"|'(?:[^'\\]|\\.)*'|[\[\]{},\"']", re.S)


def value_end(text: str, start: int) -> int:
    """Where the JSON value from `start` on ends; -1 if it doesn't.

    The decoder is fast and strict. What it refuses may still be a record to Spark (single
    quotes, for one), so its end is looked for by its brackets.
    """
    try:
        return DECODER.scan_once(text, start)[1]
    except (ValueError, StopIteration):
        pass
    depth = 0
    for mark in MARKS.finditer(text, start):
        found = mark.group()
        if found in "{[":
            depth += 1
        elif found in "}]" and depth:
            depth -= 1
            if not depth:
                return mark.end()
        elif found in "\"'" or depth == 0 and len(found) == 1:
            # A string without end, or a comma or bracket where a value should be.
            return mark.start() if found in ",]" and text[start : mark.start()].strip() else -1
    return -1


def elements(text: str) -> Iterator[tuple[str, bool]]:
    """The texts of an array's elements, or of a lone value; false with what is left where the form breaks off."""
    at = SPACE.match(text).end()
    if at == len(text):
        return
    array = text[at] == "["
    at = SPACE.match(text, at + array).end()
    if array and text[at : at + 1] == "]":
        at += 1
    else:
        while True:
            end = value_end(text, at)
            if end < 0:
                yield text[at:], False
                return
            yield text[at:end], True
            if not array:
                at = end
                break
            after = AFTER.match(text, end)
            at = after.end()
            if not after[1]:
                yield text[end:], False
                return
            if after[1] == "]":
                break
    rest = SPACE.match(text, at).end()
    if rest < len(text):
        yield text[rest:], False


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, number, record and whole: the text of every element of the arrays, as it stands in its file.

    Each file is one task's work here and nowhere later: the records are stored in pieces
    that are read apart. Files are cut side by side. A file that is no array is one record.
    Where a file breaks off, what is left of it is a record that is not whole.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def together(file: str, end: int, found: list[str], whole: list[bool]) -> pa.RecordBatch:
            columns = [pa.repeat(file, len(found)), pa.array(range(end - len(found), end), pa.int64()), pa.array(found, pa.string()), pa.array(whole, pa.bool_())]
            return pa.RecordBatch.from_arrays(columns, [FILE, NUMBER, RECORD, WHOLE])

        for batch in batches:
            for file, text in zip(batch.column(FILE), batch.column("value"), strict=True):
                found, flags, size, number = [], [], 0, 0
                for number, (record, whole) in enumerate(elements(text.as_py()), 1):
                    found.append(record)
                    flags.append(whole)
                    size += len(record)
                    if size > TOGETHER:
                        yield together(file.as_py(), number, found, flags)
                        found, flags, size = [], [], 0
                if found:
                    yield together(file.as_py(), number, found, flags)

    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias(FILE), "value")
    found = texts.mapInArrow(cut, f"{FILE} string, {NUMBER} bigint, {RECORD} string, {WHOLE} boolean")
    target = scratch_folder(spark, "records")
    found.write.option("parquet.block.size", PIECE_BYTES).parquet(target)
    return spark.read.schema(found.schema).parquet(target)
