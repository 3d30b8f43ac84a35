"""Shape, null counts and totals, one pass per table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.functions.numbers import missing
from tierlake.operators.columns import literal_rows, quoted
from tierlake.schemas import TEXT, fields as schema_of

_COLUMN = schema_of(column_name=TEXT, data_type=TEXT)


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: its type and nulls, beside the shape of the table."""
    fields = df.schema.fields
    counts = [f"__nulls{i}" for i in range(len(fields))]
    nulls = [
        F.count_if(missing(quoted(field.name), field.dataType)).alias(name)
        for field, name in zip(fields, counts)
    ]
    unpivoted = ", ".join(f"{i + 1}, {name}" for i, name in enumerate(counts))
    profile = df.agg(F.count(F.lit(1)).alias("row_count"), *nulls).selectExpr(
        "row_count",
        f"CAST({len(fields)} AS BIGINT) AS column_count",
        f"{' + '.join(counts)} AS total_nulls",
        f"stack({len(fields)}, {unpivoted}) AS (place, null_count)",
    )
    described = [{"column_name": f.name, "data_type": f.dataType.simpleString()} for f in fields]
    known = F.element_at(literal_rows(described, _COLUMN), F.col("place"))
    return profile.withColumn("known", known).select(
        "known.*", "null_count", "row_count", "column_count", "total_nulls"
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Records per entity."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("entity"), "records")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def ingest_totals(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Number of entities and of records over all of them."""
    return row_counts(tables).agg(
        F.count("entity").alias("entities"), F.sum("records").alias("records")
    )


def preview(df: DataFrame, rows: int = 3, *order_by) -> DataFrame:
    """The first rows, by an order where one is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(rows)
