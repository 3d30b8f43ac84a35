"""Layer writes. Each is safe to repeat: it replaces what the same run wrote."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions.keys import DATE_PARTS

ROWS = "rows"
SNAPSHOT_PARTITION = "_ingestion_timestamp"


def write_folder(df: DataFrame, path: str, *metrics: Column) -> dict[str, int]:
    """Fill a folder that nothing else uses; tables that others read are replaced by `tables.replace_table`."""
    return _observed_write(df, metrics, lambda out: out.write.mode("overwrite").parquet(path))


def write_partitions(
    df: DataFrame, path: str, *metrics: Column, by: Sequence[str] = tuple(DATE_PARTS), rebalance: bool = True
) -> dict[str, int]:
    """Replace only the partitions present in ``df``.

    Rows are brought together by partition first, so each gets few files; a
    partition far above the others is spread over several tasks at run time.
    Switch ``rebalance`` off when all rows go to one partition: then every
    task writes its own part and nothing need move.
    """
    if rebalance:
        df = df.hint("rebalance", *[F.col(name) for name in by])

    def write(out: DataFrame) -> None:
        _dynamic(out, by).parquet(path)

    return _observed_write(df, metrics, write)


def write_snapshot(df: DataFrame, path: str) -> dict[str, int]:
    """Add one run's snapshot beside the earlier ones."""
    return write_partitions(df, path, by=(SNAPSHOT_PARTITION,), rebalance=False)


def write_reports(reports: DataFrame, path: str) -> None:
    """One JSON report per entity and layer; others stay as they are."""
    _dynamic(reports, ("entity", "layer")).json(path)


def read_partitions(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    by: Sequence[str] = tuple(DATE_PARTS),
    only: Mapping[str, str] | None = None,
) -> DataFrame:
    """A partitioned table with its partition columns as the strings written.

    Without a declared schema Spark would read the month ``01`` as 1. With
    ``only``, leading partition values, no other folder is even listed.
    """
    folders = [f"{name}={value}" for name, value in (only or {}).items()]
    reader, source = spark.read.option("basePath", path), "/".join([path, *folders])
    if schema is None:
        found = reader.parquet(source).schema
        schema = T.StructType(
            [T.StructField(f.name, T.StringType()) if f.name in by else f for f in found.fields]
        )
    return reader.schema(schema).parquet(source)


def read_snapshot(spark: SparkSession, path: str, stamp: str) -> DataFrame:
    """One run's snapshot."""
    by = (SNAPSHOT_PARTITION,)
    return read_partitions(spark, path, by=by, only={SNAPSHOT_PARTITION: stamp})


def _dynamic(df: DataFrame, by: Sequence[str]):
    # On the write and not on the session, which would change other writes.
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)


def _observed_write(df: DataFrame, metrics: Sequence[Column], write) -> dict[str, int]:
    """Write, and return the row count and metrics gathered by the same pass.

    The observation sits above every shuffle, in the tasks that write. Spark
    counts each of those once even when executors are lost and tasks rerun.
    """
    observation = Observation()
    write(df.observe(observation, F.count(F.lit(1)).alias(ROWS), *metrics))
    return observation.get
