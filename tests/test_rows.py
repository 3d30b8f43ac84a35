"""Deduplication, membership and profiles, with hot keys and nulls."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tierlake.operators.dedup import duplicate_count, duplicates_of, keep_first
from tierlake.operators.membership import orphan_count, orphan_rows
from tierlake.operators.profile import ingest_totals, preview, row_counts, table_profile

HOT = 3000


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, another ninth has none."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit(7))
        .when(F.col("id") % 9 == 1, F.lit(None))
        .otherwise(F.col("id") % 500)
    )
    return spark.range(0, HOT * 3, numPartitions=6).select(key.alias("k"), F.col("id").alias("v"))


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_keep_first_against_brute_force(skewed):
    first = {}
    for k, v in sorted(rows_of(skewed), key=lambda r: r[1]):
        first.setdefault(k, v)
    kept = keep_first(skewed.repartition(5), ["k"], ["v"])
    assert kept.columns == ["k", "v"]
    assert dict(rows_of(kept)) == first
    assert kept.count() == len(first)


def test_keep_first_orders_by_all_other_columns_by_default(spark):
    df = spark.createDataFrame([(1, "b", 0), (1, "a", 9), (2, None, 1), (2, "a", 1)], "k int, a string, b int")
    assert sorted(rows_of(keep_first(df, ["k"])), key=repr) == [(1, "a", 9), (2, None, 1)]


def test_keep_first_of_bare_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int")
    assert keep_first(df, ["k"]).count() == 2


def test_duplicate_count_counts_repeated_nulls(skewed, spark):
    keys = Counter(k for k, _ in rows_of(skewed))
    assert duplicate_count(skewed, ["k"]).first()[0] == sum(n - 1 for n in keys.values())
    assert duplicate_count(spark.createDataFrame([], "k int"), ["k"]).first()[0] == 0


@pytest.mark.parametrize("letters", [5, 200])
def test_duplicates_follow_the_collation_whatever_the_length(spark, letters):
    df = spark.createDataFrame([("a" * letters,), ("A" * letters,)], "t string").selectExpr("t COLLATE UTF8_LCASE AS t")
    assert df.groupBy("t").count().count() == 1
    assert duplicate_count(df, ["t"]).first()[0] == 1
    assert df.agg(duplicates_of("t")).first()[0] == 1


def test_duplicates_of_counts_a_repeated_null(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (None,), (2,)], "k int")
    assert df.agg(duplicates_of("k")).first()[0] == 3
    assert df.limit(0).agg(duplicates_of("k")).first()[0] == 0


def test_keep_first_orders_maps_by_their_text(spark):
    rows = [(1, {"b": 1, "a": 2}, None), (1, {"a": 1}, {"x": {"y": 1}}), (2, None, None)]
    df = spark.createDataFrame(rows, "k int, m map<string, int>, n map<string, map<string, int>>")
    kept = {row.k: row.m for row in keep_first(df, ["k"]).collect()}
    assert kept == {1: {"a": 1}, 2: None}


def test_duplicate_count_of_long_and_short_texts(spark):
    texts = ["a", "a", "", "", None, None, "é" * 200, "é" * 200, "x" * 5000, "x" * 5000, "x" * 4999 + "y", "x" * 128]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert duplicate_count(df, ["t"]).first()[0] == len(texts) - len(set(texts))


@pytest.mark.parametrize(
    "children, parents, orphans",
    [
        ([1, None, 5, 5], [1, 2], [None, 5, 5]),
        ([1, None, 5], [1, None], [5]),
        ([1, 1], [1, 1, 1], []),
        ([], [1], []),
        ([3, None], [], [3, None]),
    ],
)
def test_orphans_as_set_membership(spark, children, parents, orphans):
    child = spark.createDataFrame([(c,) for c in children], "fk long")
    parent = spark.createDataFrame([(p,) for p in parents], "pk int")
    assert orphan_count(child, "fk", parent, "pk").first()[0] == len(orphans)
    found = [r[0] for r in orphan_rows(child, "fk", parent, "pk").collect()]
    assert Counter(found) == Counter(orphans)


def test_orphans_of_a_hot_key(skewed, spark):
    parents = spark.range(100).withColumn("id", F.when(F.col("id") != 7, F.col("id")))
    known = set(r[0] for r in parents.collect())
    wanted = [v for k, v in rows_of(skewed) if k not in known]
    assert len(wanted) > HOT
    assert orphan_count(skewed, "k", parents, "id").first()[0] == len(wanted)
    assert sorted(r.v for r in orphan_rows(skewed, "k", parents, "id").collect()) == sorted(wanted)


def test_orphans_within_one_table(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 9)], "id long, boss long")
    assert orphan_count(df, "boss", df, "id").first()[0] == 2
    assert sorted(r.id for r in orphan_rows(df, "boss", df, "id").collect()) == [1, 3]


def test_table_profile(spark):
    df = spark.createDataFrame([(1, None, float("nan")), (None, None, 1.0)], "a int, b string, `c.d` double")
    rows = {r.column_name: r for r in table_profile(df).collect()}
    assert {n: r.null_count for n, r in rows.items()} == {"a": 1, "b": 2, "c.d": 1}
    assert {n: r.data_type for n, r in rows.items()} == {"a": "int", "b": "string", "c.d": "double"}
    assert {(r.row_count, r.column_count, r.total_nulls) for r in rows.values()} == {(2, 3, 4)}


def test_counts_and_preview(spark):
    tables = {"a": spark.range(3), "b": spark.range(5), "c": spark.range(0)}
    assert {r.entity: r.records for r in row_counts(tables).collect()} == {"a": 3, "b": 5, "c": 0}
    assert tuple(ingest_totals(tables).first()) == (3, 8)
    assert [r.id for r in preview(spark.range(50), 3, F.col("id").desc()).collect()] == [49, 48, 47]
    assert preview(spark.range(50)).count() == 3
