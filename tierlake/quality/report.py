"""Scores, reports and the summary over reports."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake import schemas
from tierlake.functions.numbers import percent, round_half_even
from tierlake.quality.rules import FAIL, PASS, WARN
from tierlake.run import RunInfo

# Lower bounds of the score bands.
GREEN_FROM, YELLOW_FROM = 80, 60


def score(passed: Column, total: Column) -> Column:
    """Share of passed rules in percent, one decimal; 0 without rules."""
    return F.coalesce(round_half_even(percent(passed, total), 1), F.lit(0.0))


def band(value: Column) -> Column:
    return F.when(value >= GREEN_FROM, "GREEN").when(value >= YELLOW_FROM, "YELLOW").otherwise("RED")


def report(results: DataFrame, entity: str, layer: str, run: RunInfo) -> DataFrame:
    """The results of one suite as one nested row; also for a suite without rules."""
    of_status = {"passed": PASS, "failed": FAIL, "warnings": WARN}
    counts = [F.count_if(F.col("status") == word).alias(name) for name, word in of_status.items()]
    checks = F.collect_list(
        F.struct("position", "check", "dimension", "status", "details", "severity", "failing")
    )
    in_order = F.transform(F.array_sort(checks), lambda check: check.dropFields("position"))
    row = results.agg(F.count(F.lit(1)).alias("total"), *counts, in_order.alias("checks"))
    return row.select(
        F.lit(entity).alias("entity"),
        F.lit(layer).alias("layer"),
        score(F.col("passed"), F.col("total")).alias("score"),
        F.lit(run.started_at.isoformat()).alias("timestamp"),
        F.struct(*of_status).alias("summary"),
        "checks",
    )


def union_reports(reports: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.REPORT).json(path)


def summary(reports: DataFrame) -> DataFrame:
    """One line per entity and layer: score, band and the three counts."""
    return reports.select("entity", "layer", "score", band(F.col("score")).alias("band"), "summary.*")
