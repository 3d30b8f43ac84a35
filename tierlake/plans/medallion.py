"""Whole runs: landing files to gold tables and quality reports.

Every layer is written and read back before the next one starts: lineage stays
short, and a lost executor costs tasks and not the run. Each finished table is
noted in the run's ledger. A run that was stopped goes on after its last finished
table (``resume=True``), and a layer can be made again alone, with what follows
from it, from the layers below as that run left them (``again_from="gold"``).
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.plans import bronze, gold, ledger, silver
from tierlake.plans.parallel import side_by_side
from tierlake.quality import report, rulesets
from tierlake.quality.rulesets import BRONZE_CHECKS
from tierlake.run import RunInfo
from tierlake.sources import files, sinks, tables
from tierlake.sources.claims import stamped
from tierlake.sources.entities import EntitySpec, landed
from tierlake.sources.inventory import lake_inventory

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Lake:
    """The tables of a lake, all read from storage; counts are those of one run, the latest if none is named."""

    spark: SparkSession
    base: str
    stamp: str | None = None

    def table(self, layer: str, name: str) -> DataFrame:
        return tables.read_table(self.spark, self._path(layer, name))

    def users(self) -> DataFrame:
        return self.table("silver", "users")

    def posts(self) -> DataFrame:
        return self.table("silver", "posts")

    def todos(self) -> DataFrame:
        return self.table("silver", "todos")

    def profile(self) -> DataFrame:
        return self.table("gold", "user_profile")

    def cities(self) -> DataFrame:
        return self.table("gold", "city_analysis")

    def kpis(self) -> DataFrame:
        return gold.global_kpis(self.profile())

    def reports(self) -> DataFrame:
        return report.read_reports(self.spark, f"{self.base}/quality_reports")

    def summary(self) -> DataFrame:
        return report.summary(self.reports())

    def inventory(self) -> DataFrame:
        return lake_inventory(self.spark, self.base)

    def ledger(self) -> ledger.Ledger:
        stamp = self.stamp or (ledger.runs(self.spark, self.base) or [""])[-1]
        return ledger.Ledger(self.spark, self.base, stamp)

    def all_counts(self) -> DataFrame:
        """Run, entity, rows ingested, kept in silver and removed, of every run of this lake."""
        return ledger.counts(ledger.stored(self.spark, self.base))

    def counts(self) -> DataFrame:
        """Entity, rows ingested, kept in silver and removed, as counted by the run's writes."""
        own = ledger.stored(self.spark, self.base).where(F.col("run") == self.ledger().stamp)
        return ledger.counts(own).drop("run")

    def totals(self) -> DataFrame:
        """Entities and records ingested by the run."""
        return self.counts().selectExpr("count(*) AS entities", "coalesce(sum(ingested), 0) AS records")

    def write(self, df: DataFrame, layer: str, name: str) -> DataFrame:
        """Replace a table, note it, and give what was written as read from storage."""
        path = self._path(layer, name)
        rows = tables.replace_table(df, path)[sinks.ROWS]
        folder = tables.folder(self.spark, path)
        self.ledger().record(ledger.Entry(layer, name, path, rows, folder, schema=df.schema.json()))
        return self.spark.read.schema(df.schema).parquet(folder)

    def made(self, layer: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The table as this run left it; it is written only if the run has not finished it."""
        done = self.ledger().entries().get((layer, name))
        if done and files.exists(self.spark, done.folder):
            log.info("%s %s: finished by an earlier attempt", layer, name)
            return self.spark.read.schema(done.struct()).parquet(done.folder)
        return self.write(make(), layer, name)

    def _path(self, layer: str, name: str) -> str:
        return f"{self.base}/{layer}/{name}"


def run_medallion(
    spark: SparkSession, specs: Mapping[str, EntitySpec], base: str, run: RunInfo,
    resume: bool = False, again_from: str | None = None,
) -> Lake:
    """Snapshot bronze, silver, gold and reports; quality reports, never blocks."""
    run = stamped(spark, f"{base}/_runs/_stamps", run)
    lake = _begun(spark, base, run, resume, again_from)
    written = _ingested(lake, specs, lambda todo: bronze.write_snapshots(spark, todo, base, run))
    return _refine(lake, written, run)


def run(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    run_info: RunInfo,
    specs: Mapping[str, EntitySpec] | None = None,
    checks: Mapping[str, list[dict]] = BRONZE_CHECKS,
    resume: bool = False,
    again_from: str | None = None,
) -> Lake:
    """Raw folder to processed lake: gated, dated bronze, then the layers above.

    With ``resume`` the run of this stamp goes on after its last finished table. With
    ``again_from`` the tables of that layer and the later ones are made again.
    """
    specs = specs or landed(raw_dir)
    run_info = stamped(spark, f"{out_dir}/_runs/_stamps", run_info)
    lake = _begun(spark, out_dir, run_info, resume, again_from)

    def gated(todo: Mapping[str, EntitySpec]) -> dict[str, bronze.BronzeWrite]:
        return side_by_side(spark, {
            name: partial(bronze.run_bronze_job, spark, spec, out_dir, run_info, checks, with_position=True)
            for name, spec in todo.items()
        })

    return _refine(lake, _ingested(lake, specs, gated), run_info)


def _begun(spark: SparkSession, base: str, run: RunInfo, resume: bool, again_from: str | None) -> Lake:
    lake = Lake(spark, base, run.stamp)
    if again_from or not resume:
        lake.ledger().forget(again_from or ledger.LAYERS[0])
    return lake


def _ingested(
    lake: Lake, specs: Mapping[str, EntitySpec], ingest: Callable[[Mapping[str, EntitySpec]], dict[str, bronze.BronzeWrite]]
) -> dict[str, bronze.BronzeWrite]:
    """What bronze holds of every entity; those that the run has finished are not ingested again."""
    done = {name: entry for (layer, name), entry in lake.ledger().entries().items() if layer == "bronze" and name in specs}
    found = {
        name: bronze.BronzeWrite(entry.path, entry.rows, entry.struct(), entry.partition) for name, entry in done.items()
    }
    # Each is noted on its own, so one that fails costs no other its place.
    todo = {name: partial(_ingest_one, lake, name, spec, ingest) for name, spec in specs.items() if name not in found}
    return found | side_by_side(lake.spark, todo)


def _ingest_one(lake: Lake, name: str, spec: EntitySpec, ingest: Callable) -> bronze.BronzeWrite:
    write = ingest({name: spec})[name]
    lake.ledger().record(ledger.Entry(
        "bronze", name, write.path, write.rows, partition=dict(write.partition), schema=write.schema.json()
    ))
    return write


def check_quality(lake: Lake, users: DataFrame, posts: DataFrame, profile: DataFrame, run: RunInfo) -> None:
    """Evaluate the shipped suites on the written layers and store the reports."""
    suites = [
        (rulesets.users_silver(), users),
        (rulesets.posts_silver(users), posts),
        (rulesets.profile_gold(), profile),
    ]
    reports = [
        report.report(suite.evaluate(table), suite.entity, suite.layer, run)
        for suite, table in suites
    ]
    sinks.write_reports(report.union_reports(reports), f"{lake.base}/quality_reports")


def _refine(lake: Lake, written: Mapping[str, bronze.BronzeWrite], run: RunInfo) -> Lake:
    landed_tables = {name: write.read(lake.spark) for name, write in written.items()}
    cleaned = {
        "users": lambda: silver.silver_users(landed_tables["users"], run),
        "posts": lambda: silver.silver_posts(landed_tables["posts"], run),
        "todos": lambda: silver.silver_todos(landed_tables["todos"], run),
    }
    stored = side_by_side(lake.spark, {name: partial(lake.made, "silver", name, make) for name, make in cleaned.items()})
    profile = lake.made(
        "gold", "user_profile", lambda: gold.user_profile(stored["users"], stored["posts"], stored["todos"], run)
    )
    side_by_side(lake.spark, {
        "cities": partial(lake.made, "gold", "city_analysis", lambda: gold.city_analysis(profile, run)),
        "quality": partial(_reported, lake, stored["users"], stored["posts"], profile, run),
    })
    return lake


def _reported(lake: Lake, users: DataFrame, posts: DataFrame, profile: DataFrame, run: RunInfo) -> None:
    if ("quality_reports", "all") in lake.ledger().entries():
        return
    check_quality(lake, users, posts, profile, run)
    lake.ledger().record(ledger.Entry("quality_reports", "all", f"{lake.base}/quality_reports"))
