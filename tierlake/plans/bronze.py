"""Bronze: data as landed, with lineage and a hash, in two layouts."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions.keys import DATE_PARTS
from tierlake.operators.columns import (
    flatten,
    with_date_parts,
    with_job_lineage,
    with_record_hash,
    with_snapshot_lineage,
)
from tierlake.plans.parallel import side_by_side
from tierlake.quality.gate import enforce
from tierlake.quality.rulesets import BRONZE_CHECKS
from tierlake.quality.rulesets import bronze as bronze_suite
from tierlake.run import RunInfo
from tierlake.sources import files, sinks
from tierlake.sources.claims import stamped
from tierlake.sources.entities import EntitySpec, read_entity
from tierlake.sources.publish import Place

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class BronzeWrite:
    """What a bronze job wrote, and the rule results that let it through."""

    path: str
    rows: int
    schema: T.StructType
    partition: Mapping[str, str]
    results: Sequence[Row] = ()

    def read(self, spark: SparkSession) -> DataFrame:
        """Exactly the partition written; an empty write has left no folder."""
        if not self.rows:
            return spark.createDataFrame([], self.schema)
        return sinks.read_partitions(spark, self.path, self.schema, only=self.partition)


def snapshot(records: DataFrame, spec: EntitySpec, run: RunInfo) -> DataFrame:
    """Nested records with snapshot lineage; one snapshot per run is kept."""
    return with_snapshot_lineage(with_record_hash(records), run, spec.url, spec.source_system)


def dated(records: DataFrame, spec: EntitySpec, run: RunInfo) -> DataFrame:
    """Flattened records with job lineage, keyed by the day of the run."""
    hashed = with_record_hash(flatten(records))
    stamped = with_job_lineage(hashed, run, spec.url, spec.name)
    return with_date_parts(stamped, F.to_date(F.lit(run.date)))


def write_snapshots(spark: SparkSession, specs: Mapping[str, EntitySpec], base: str, run: RunInfo) -> dict[str, BronzeWrite]:
    """Ingest every entity as this run's snapshot below ``<base>/bronze``.

    Each run has a snapshot of its own, also if another one began in the same second;
    a repeated run replaces its own.
    """
    return side_by_side(spark, {name: partial(_write_snapshot, spark, spec, base, run) for name, spec in specs.items()})


def _write_snapshot(spark: SparkSession, spec: EntitySpec, base: str, run: RunInfo) -> BronzeWrite:
    path = f"{base}/bronze/{spec.name}"
    run = stamped(spark, f"{path}/_stamps", run)
    records = snapshot(read_entity(spark, spec, with_position=True), spec, run)
    rows = sinks.write_snapshot(records, path)[sinks.ROWS]
    log.info("%s: %d records at %s", spec.name, rows, path)
    return BronzeWrite(path, rows, records.schema, {sinks.SNAPSHOT_PARTITION: run.stamp})


def run_bronze_job(
    spark: SparkSession,
    spec: EntitySpec,
    base: str,
    run: RunInfo,
    checks: Mapping[str, list[dict]] = BRONZE_CHECKS,
    with_position: bool = False,
    publish: str | None = None,
) -> BronzeWrite:
    """Ingest one entity into its day partition, behind the quality gate.

    The landing files are parsed and written once, into a staging folder of
    this run alone; the row rules are measured by that same write. Only when no
    critical rule failed is the day published, so a stopped run leaves the
    target as it was, and what is published is exactly what was checked,
    whatever lands or runs meanwhile. Runs that publish one day take turns, the
    last one stays; a day that a dead run left half published is mended first.

    ``publish`` is ``rename``, which moves the day's folder and writes nothing,
    or ``rewrite``, which reads and writes it again, for stores where a move is
    a copy; by default the file system decides. An entity without rules is
    published unchecked.
    """
    target = f"{base}/bronze/{spec.name}"
    how = publish or ("rename" if files.renames_folders(spark, target) else "rewrite")
    if how not in ("rename", "rewrite"):
        raise ValueError(f"publish is rename or rewrite, not {how}")
    records = dated(read_entity(spark, spec, with_position), spec, run)
    place, rewrite = _place(spark, base, spec.name, run), _rewriting(spark, records.schema, target, run)
    place.recover(rewrite)
    staging = f"{base}/_staging/bronze/{spec.name}/{run.stamp}-{uuid.uuid4().hex}"
    suite, results = None, []
    if checks.get(spec.name):
        suite = bronze_suite(spec.name, checks[spec.name])
    else:
        log.warning("%s: no rules defined, nothing checked", spec.name)
    try:
        # All rows share the run's day: each task writes its part, none moves.
        metrics = sinks.write_partitions(records, staging, *(suite.row_metrics(records) if suite else ()), rebalance=False)
        staged = BronzeWrite(staging, metrics[sinks.ROWS], records.schema, day_partition(run))
        if suite:
            results = enforce(suite.evaluate_observed(staged.read(spark), metrics))
        _publish(place, staged, how, rewrite)
    finally:
        # A rewrite that broke off needs what it read; the next run of the day finishes it.
        if not files.exists(spark, place.pending):
            files.remove(spark, staging)
    return BronzeWrite(target, staged.rows, records.schema, day_partition(run), results)


def _place(spark: SparkSession, base: str, name: str, run: RunInfo) -> Place:
    day = "/".join(f"{part}={value}" for part, value in day_partition(run).items())
    return Place(spark, f"{base}/bronze/{name}/{day}", f"{base}/_claims/bronze/{name}/{run.date}")


def _rewriting(spark: SparkSession, schema: T.StructType, target: str, run: RunInfo) -> Callable[[str], None]:
    """Write the day that a staging folder holds at the target, every row of it."""

    def rewrite(staging: str) -> None:
        staged = sinks.read_partitions(spark, staging, schema, only=day_partition(run))
        checked = staged.count()
        rows = sinks.write_partitions(staged, target, rebalance=False)[sinks.ROWS]
        if rows != checked:
            raise RuntimeError(f"{target}: {rows} rows published, {checked} checked")

    return rewrite


def _publish(place: Place, staged: BronzeWrite, how: str, rewrite: Callable[[str], None]) -> None:
    """Put the staged day in the place of the target's; an empty one changes nothing."""
    if not staged.rows:
        return
    if how == "rename":
        day = "/".join(f"{name}={value}" for name, value in staged.partition.items())
        place.publish_by_rename(f"{staged.path}/{day}", rewrite)
    else:
        place.publish_by_rewrite(staged.path, rewrite)


def day_partition(run: RunInfo) -> dict[str, str]:
    return dict(zip(DATE_PARTS, run.date.split("-")))


def read_day(spark: SparkSession, path: str, run: RunInfo) -> DataFrame:
    """The partition of the run's day."""
    return sinks.read_partitions(spark, path, only=day_partition(run))
