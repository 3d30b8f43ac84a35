"""Foreign keys without a parent. Null equals null, and is an orphan otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.operators.columns import column

_PARENT = "__parent"


def orphan_rows(df: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """The rows whose key is not among the parents.

    The parent side is reduced to distinct keys, so it cannot be the skewed
    side; a hot key on the row side is split by adaptive execution. Whether the
    parents are broadcast is left to Spark, which knows their size.
    """
    known = parents.select(column(parent_key).alias(_PARENT)).distinct()
    return df.join(known, column(key).eqNullSafe(F.col(_PARENT)), "left_anti")


def orphan_count(df: DataFrame, key: str, parents: DataFrame, parent_key: str, name: str = "orphans") -> DataFrame:
    """How many rows ``orphan_rows`` would give, as a one-row table.

    Both sides go into one aggregation by key, so rows are counted inside the
    map tasks and only distinct keys are shuffled, however hot a key is.
    """
    children = df.select(column(key).alias("__key"), F.lit(1).alias("__rows"), F.lit(False).alias("__known"))
    known = parents.select(column(parent_key).alias("__key"), F.lit(0).alias("__rows"), F.lit(True).alias("__known"))
    per_key = children.unionByName(known).groupBy("__key").agg(
        F.sum("__rows").alias("__rows"), F.bool_or("__known").alias("__known")
    )
    orphans = F.sum(F.when(~F.col("__known"), F.col("__rows")))
    return per_key.agg(F.coalesce(orphans, F.lit(0).cast("bigint")).alias(name))
