"""The gate: a failed critical rule stops the run before the write."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tierlake.quality.report import score
from tierlake.quality.rules import FAIL, PASS

log = logging.getLogger(__name__)


class QualityGateError(RuntimeError):
    def __init__(self, failed: list[Row]):
        names = ", ".join(row["check"] for row in failed)
        super().__init__(f"{len(failed)} critical rules failed: {names}")
        self.failed = failed


def outcome(results: DataFrame) -> DataFrame:
    """One row: the score, the counts and whether the gate is shut."""
    counted = results.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("status") == PASS).alias("passed"),
        F.count_if(F.col("status") == FAIL).alias("critical"),
    )
    return counted.select(
        score(F.col("passed"), F.col("checks")).alias("score"),
        "passed",
        (F.col("checks") - F.col("passed")).alias("failed"),
        "critical",
        (F.col("critical") > 0).alias("blocked"),
    )


def enforce(results: DataFrame) -> list[Row]:
    """Evaluate the rules, once, and raise if a critical one failed.

    Only the results come to the driver: a row per rule.
    """
    rows = sorted(results.collect(), key=lambda row: row["position"])
    for row in rows:
        level = logging.INFO if row["status"] == PASS else logging.WARNING
        log.log(level, "%s %s: %s", row["status"], row["check"], row["details"])
    failed = [row for row in rows if row["status"] == FAIL]
    if failed:
        raise QualityGateError(failed)
    return rows
