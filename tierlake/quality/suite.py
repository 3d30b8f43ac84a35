"""Suites: rules for one table, compiled into as few passes as possible."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake import schemas
from tierlake.functions.numbers import percent, round_half_even
from tierlake.operators.columns import literal_rows
from tierlake.quality import rules as r
from tierlake.sources.sinks import ROWS


@dataclass(frozen=True)
class Suite:
    """An immutable list of rules; every builder call gives a longer suite."""

    entity: str
    layer: str
    rules: tuple[r.Rule, ...] = ()

    def having(self, *rules: r.Rule) -> Suite:
        return replace(self, rules=self.rules + rules)

    def row_count(self, minimum: int, severity: str = r.ERROR) -> Suite:
        return self.having(r.MinRows(minimum, severity=severity))

    def not_null(self, columns: Iterable[str], severity: str = r.ERROR) -> Suite:
        return self.having(*[r.NotNull(name, severity=severity) for name in columns])

    def unique(self, columns: Iterable[str], severity: str = r.ERROR) -> Suite:
        return self.having(*[r.Unique(name, severity=severity) for name in columns])

    def regex(self, column: str, pattern: str, description: str, severity: str = r.WARNING) -> Suite:
        return self.having(r.Matches(column, pattern, description, severity=severity))

    def in_range(self, column: str, minimum: float | None = None, maximum: float | None = None,
                 severity: str = r.WARNING) -> Suite:
        return self.having(r.InRange(column, minimum, maximum, severity=severity))

    def references(self, column: str, parents: DataFrame, parent_column: str,
                   severity: str = r.ERROR) -> Suite:
        return self.having(r.References(column, parents, parent_column, severity=severity))

    def row_metrics(self, df: DataFrame) -> list[Column]:
        """The row rules as named aggregates, to be observed on a write."""
        return [
            rule.failing(df).alias(_metric(position))
            for position, rule in self._resolved(df)
            if isinstance(rule, r.RowRule)
        ]

    def evaluate(self, df: DataFrame) -> DataFrame:
        """One row per rule. One scan for all row rules, one for all unique rules, one per table rule.

        Each scan reads the columns of its rules only, so evaluate tables that
        are written to a columnar layer rather than the plan that makes them.
        """
        metrics = self.row_metrics(df)
        counted = df.agg(F.count(F.lit(1)).alias(ROWS), *metrics) if metrics else _values(df.sparkSession)
        return self._results(df, counted)

    def evaluate_observed(self, df: DataFrame, metrics: Mapping[str, int]) -> DataFrame:
        """As ``evaluate``, with the row rules already measured by a write."""
        return self._results(df, _values(df.sparkSession, **metrics))

    def _resolved(self, df: DataFrame) -> list[tuple[int, r.Rule]]:
        resolved = [r.resolve(rule, df) for rule in self.rules]
        return [(i, rule) for i, rule in enumerate(resolved) if rule is not None]

    def _results(self, df: DataFrame, counted: DataFrame) -> DataFrame:
        rules = dict(self._resolved(df))
        if not rules:
            return df.sparkSession.createDataFrame([], schemas.RESULT)
        shared = [
            f"{position}, {_metric(position) if isinstance(rule, r.RowRule) else 'CAST(NULL AS BIGINT)'}"
            for position, rule in rules.items()
            if not isinstance(rule, r.TableRule)
        ]
        unique = {position: rule for position, rule in rules.items() if isinstance(rule, r.Unique) and rule.fused(df)}
        frames = [
            rule.failing_table(df).selectExpr("CAST(NULL AS BIGINT) AS rows", f"{position} AS position", r.FAILING)
            for position, rule in rules.items()
            if isinstance(rule, r.TableRule) and position not in unique
        ]
        if unique:
            surplus = df.agg(*[rule.failing(df).alias(_metric(position)) for position, rule in unique.items()])
            pairs = [f"{position}, {_metric(position)}" for position in unique]
            frames.insert(0, surplus.selectExpr("CAST(NULL AS BIGINT) AS rows", _stacked(pairs)))
        if shared:
            frames.insert(0, counted.selectExpr(ROWS, _stacked(shared)))
        return self._described(reduce(DataFrame.union, frames), rules)

    def _described(self, measured: DataFrame, rules: Mapping[int, r.Rule]) -> DataFrame:
        """Names, status and details to (rows, position, failing).

        What is known of the rules goes into the plan as one literal.
        """
        known = [_fact(rules.get(position)) for position in range(max(rules) + 1)]
        facts = literal_rows(known, _FACT)
        failing, rows = F.col(r.FAILING), F.col(ROWS)
        share = F.format_string("%.1f", F.coalesce(round_half_even(percent(failing, rows), 1), F.lit(float("nan"))))
        measured_values = {r.FAILED: failing, r.ROWS: rows, r.SHARE: share}

        def spelled(part: Column) -> Column:
            text = part.getField("text")
            for kind, value in measured_values.items():
                text = F.when(part.getField("measured") == kind.value, value.cast("string")).otherwise(text)
            return F.coalesce(text, F.lit(""))

        details = F.array_join(F.transform("fact.details", spelled), "")
        status = (
            F.when(failing == 0, r.PASS).when(F.col("fact.severity") == r.WARNING, r.WARN).otherwise(r.FAIL)
        )
        return measured.withColumn("fact", F.element_at(facts, F.col("position") + 1)).select(
            F.lit(self.entity).alias("entity"), F.lit(self.layer).alias("layer"), "position",
            "fact.check", "fact.dimension", status.alias("status"), details.alias("details"),
            "fact.severity", r.FAILING,
        )


_PART = schemas.fields(text=schemas.TEXT, measured=schemas.TEXT)
_FACT = schemas.fields(
    check=schemas.TEXT, dimension=schemas.TEXT, severity=schemas.TEXT, details=T.ArrayType(_PART)
)


def _fact(rule: r.Rule | None) -> dict | None:
    """What is known of a rule; its message in parts, so that its own texts are never searched."""
    if rule is None:
        return None
    parts = [
        {"text": None, "measured": part.value} if isinstance(part, r.Measured) else {"text": part, "measured": None}
        for part in rule.details
    ]
    return {"check": rule.check, "dimension": rule.dimension, "severity": rule.severity, "details": parts}


def _stacked(pairs: list[str]) -> str:
    return f"stack({len(pairs)}, {', '.join(pairs)}) AS (position, failing)"


def _metric(position: int) -> str:
    return f"rule_{position}"


def _values(spark: SparkSession, **metrics: int) -> DataFrame:
    """One row of measured counts, for when there is nothing to scan."""
    named = {ROWS: "NULL", **metrics}
    return spark.range(1).selectExpr(*[f"CAST({value} AS BIGINT) AS {name}" for name, value in named.items()])
