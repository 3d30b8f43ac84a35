"""What files a lake holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.sources import tables
from tierlake.sources.files import children, qualified

LAYERS = ("bronze", "silver", "gold", "quality_reports")


def lake_inventory(spark: SparkSession, base: str) -> DataFrame:
    """Layer below the base, path below that and size of every data file.

    Of tables that are replaced as a whole only the current version is listed, under the
    path of the table. Only names and lengths are selected, so no file is opened.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(base)
        .select("path", "length")
    )
    inside = F.substring("path", len(qualified(spark, base)) + 2, 1 << 30)
    parts = f"^({'|'.join(LAYERS)})/(.*)$"
    below = F.regexp_extract(inside, parts, 2)
    listed = files.select(
        F.nullif(F.regexp_extract(inside, parts, 1), F.lit("")).alias("layer"),
        F.regexp_extract(below, "^([^/]+)", 1).alias("dataset"),
        below.alias("file"),
        F.col("length").alias("bytes"),
    )
    version = F.regexp_extract("file", f"^[^/]+/({tables.VERSION}[0-9a-f]{{32}})/", 1)
    # A table is a folder of a layer, so there are few of them.
    shown = F.col("layer").isNull() | (version == "") | F.concat_ws("/", "layer", "dataset", version).isin(_current(spark, base))
    plain = F.when(version == "", F.col("file")).otherwise(F.replace("file", F.concat(version, F.lit("/")), F.lit("")))
    return listed.where(shown).withColumn("file", plain)


def _current(spark: SparkSession, base: str) -> list[str]:
    """Layer, table and folder of the versions that count."""
    found = []
    for layer in LAYERS:
        for name in children(spark, f"{base}/{layer}"):
            version = tables.current(spark, f"{base}/{layer}/{name}")
            found += [f"{layer}/{name}/{version.folder}"] if version else []
    return found
