"""Quality rules as data, each compiled to one failing-row count.

Row rules become aggregates that share one scan. Table rules need rows with
equal keys together and have a small plan of their own.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from decimal import Decimal
from enum import Enum
from math import ceil, isfinite
from numbers import Real
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions.numbers import missing
from tierlake.functions.text import matches_from_start
from tierlake.operators.columns import column, quoted
from tierlake.operators.dedup import counts_distinct, duplicate_count, duplicates_of
from tierlake.operators.membership import orphan_count

# The words written to results and reports.
ERROR, WARNING = "ERROR", "WARNING"
PASS, WARN, FAIL = "PASS", "WARN", "FAIL"
COMPLETENESS, UNIQUENESS = "COMPLETENESS", "UNIQUENESS"
VALIDITY, CONSISTENCY = "VALIDITY", "CONSISTENCY"

FAILING = "failing"


class Measured(Enum):
    """What a message says that only the evaluation knows."""

    FAILING = "failing"
    ROWS = "rows"
    SHARE = "share"


FAILED, ROWS, SHARE = Measured.FAILING, Measured.ROWS, Measured.SHARE

#: A message: texts and measured values in order.
Details = tuple[str | Measured, ...]


@dataclass(frozen=True, kw_only=True)
class Rule:
    """``strict`` rules fail on a missing column, others are left out."""

    severity: str = ERROR
    strict: bool = False

    @property
    def needs(self) -> str | None:
        return getattr(self, "column", None)


class RowRule(Rule):
    def failing(self, df: DataFrame) -> Column:
        """An aggregate over ``df``: how many rows fail."""
        raise NotImplementedError


class TableRule(Rule):
    def failing_table(self, df: DataFrame) -> DataFrame:
        """A one-row table with the failing count."""
        raise NotImplementedError


@dataclass(frozen=True)
class NotNull(RowRule):
    column: str
    dimension = COMPLETENESS
    details = (FAILED, " nulls (", SHARE, "%)")

    @property
    def check(self) -> str:
        return f"not_null:{self.column}"

    def failing(self, df: DataFrame) -> Column:
        return F.count_if(missing(quoted(self.column), _type_of(df, self.column)))


@dataclass(frozen=True)
class MinRows(RowRule):
    minimum: float
    dimension = COMPLETENESS
    check = "row_count"

    @property
    def details(self) -> Details:
        return (ROWS, f" rows (minimum {self.minimum})")

    def failing(self, df: DataFrame) -> Column:
        shortfall = F.lit(ceil(self.minimum)).cast("bigint") - F.count(F.lit(1))
        return F.greatest(shortfall, F.lit(0).cast("bigint"))


@dataclass(frozen=True)
class Matches(RowRule):
    column: str
    pattern: str
    description: str
    dimension = VALIDITY

    @property
    def check(self) -> str:
        return f"regex:{self.column}"

    @property
    def details(self) -> Details:
        return (FAILED, f" not valid ({self.description})")

    def failing(self, df: DataFrame) -> Column:
        return F.count_if(~matches_from_start(column(self.column), self.pattern))


@dataclass(frozen=True)
class InRange(RowRule):
    column: str
    minimum: float | None = None
    maximum: float | None = None
    dimension = VALIDITY

    @property
    def check(self) -> str:
        return f"range:{self.column}"

    @property
    def details(self) -> Details:
        return (FAILED, f" outside [{self.minimum}, {self.maximum}]")

    def failing(self, df: DataFrame) -> Column:
        value = column(self.column)
        here = ~missing(quoted(self.column), _type_of(df, self.column))
        outside = F.lit(0).cast("bigint")
        if self.minimum is not None:
            outside = outside + F.count_if(here & (value < self.minimum))
        if self.maximum is not None:
            outside = outside + F.count_if(here & (value > self.maximum))
        return outside


@dataclass(frozen=True)
class Unique(TableRule):
    """The unique rules of a suite are counted together, but for types Spark doesn't count distinct."""

    column: str
    dimension = UNIQUENESS
    details = (FAILED, " duplicates")

    @property
    def check(self) -> str:
        return f"unique:{self.column}"

    def fused(self, df: DataFrame) -> bool:
        return counts_distinct(_type_of(df, self.column))

    def failing(self, df: DataFrame) -> Column:
        return duplicates_of(self.column)

    def failing_table(self, df: DataFrame) -> DataFrame:
        return duplicate_count(df, [self.column], FAILING)


@dataclass(frozen=True)
class References(TableRule):
    column: str
    parents: DataFrame
    parent_column: str
    dimension = CONSISTENCY
    details = (FAILED, " orphans")

    @property
    def check(self) -> str:
        return f"referential:{self.column}→{self.parent_column}"

    def failing_table(self, df: DataFrame) -> DataFrame:
        return orphan_count(df, self.column, self.parents, self.parent_column, FAILING)


@dataclass(frozen=True)
class Broken(Rule):
    """A rule that cannot be evaluated, and so fails."""

    check: str
    dimension: str
    details: Details


def _type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def resolve(rule: Rule, df: DataFrame) -> Rule | None:
    """The rule as it applies to the table: itself, broken, or nothing."""
    name = rule.needs
    if name is not None and name not in df.columns:
        if rule.strict or isinstance(rule, NotNull):
            return _broken(rule, f"no column {name}")
        return None
    return _tried(rule, df) if rule.strict else rule


def _tried(rule: Rule, df: DataFrame) -> Rule:
    """The rule, or broken where Spark refuses it for the column's type."""
    try:
        if isinstance(rule, TableRule):
            rule.failing_table(df)
        elif isinstance(rule, RowRule):
            df.agg(rule.failing(df))
    except AnalysisException as error:
        return _broken(rule, f"cannot be evaluated: {error.getCondition()}")
    return rule


def _broken(rule: Rule, details: str) -> Broken:
    return Broken(rule.check, rule.dimension, (details,), severity=rule.severity)


def rules_from_dicts(checks: Iterable[Mapping[str, Any]]) -> list[Rule]:
    """Rules from the declarative form with the keys tipo, coluna, valor, critico.

    A rule is critical unless it says otherwise. Unknown kinds and lacking
    parameters give failing rules, not exceptions.
    """
    return [_rule_from_dict(check) for check in checks]


def _rule_from_dict(check: Mapping[str, Any]) -> Rule:
    kind, name, value = check.get("tipo"), check.get("coluna"), check.get("valor")
    common = {"severity": ERROR if check.get("critico", True) else WARNING, "strict": True}
    if kind == "min_count":
        if isinstance(value, (Real, Decimal)) and not isinstance(value, bool) and isfinite(value):
            return MinRows(value, **common)
        return Broken("row_count", COMPLETENESS, (f"not a minimum: {value}",), **common)
    keyed = {"not_null": NotNull, "unique": Unique}.get(kind)
    if keyed is None:
        return Broken(f"{kind}:{name}", VALIDITY, ("unknown kind of rule",), **common)
    if name is None:
        return Broken(f"{kind}:{name}", keyed.dimension, ("no column given",), **common)
    return keyed(name, **common)
