"""Every registered query against its SQL, on whole tables."""

import math
from glob import glob
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from tierlake.queries import ORACLES, QUERIES, tables


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for path in glob(f"{sf_dir}/*.parquet"):
        connection.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain_rows = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain_rows, key=repr)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, database, name):
    found = QUERIES[name](spark, sf_dir)
    cursor = database.execute(ORACLES[name])
    wanted_columns = [column[0] for column in cursor.description]
    wanted = sorted_rows(wanted_columns, cursor.fetchall())
    got = sorted_rows(found.columns, [tuple(row) for row in found.collect()])
    assert got[0] == wanted[0]
    assert len(got[1]) == len(wanted[1])
    assert got[1] == wanted[1]


@pytest.mark.parametrize("name", ["bronze_gated_job", "bronze_snapshot_roundtrip"])
def test_balances_near_zero_keep_plain_text(spark, sf_dir, tmp_path, name):
    balance = F.element_at(F.array(*[F.lit(x) for x in (-0.09, 0.01, 0.04, 0.07, 0.0)]), (F.col("c_custkey") % 5 + 1).cast("int"))
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").withColumn("c_acctbal", balance)
    customer.write.parquet(f"{tmp_path}/customer.parquet")
    spark.read.parquet(f"{sf_dir}/nation.parquet").write.parquet(f"{tmp_path}/nation.parquet")
    connection = duckdb.connect()
    for table in ("customer", "nation"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    found = QUERIES[name](spark, str(tmp_path))
    cursor = connection.execute(ORACLES[name])
    wanted = sorted_rows([column[0] for column in cursor.description], cursor.fetchall())
    assert sorted_rows(found.columns, [tuple(row) for row in found.collect()]) == wanted


def test_inventory_agrees_on_files_without_rows(spark, sf_dir):
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1000)
    try:
        # The one row group belongs to a later split, so the first task writes a file without rows.
        found = QUERIES["lake_inventory"](spark, sf_dir).where("layer = 'silver'").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [tuple(row) for row in found] == [("silver", "customer", "customer", True, True)]


def test_more_records_land_in_more_arrays(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "ARRAY_RECORDS", 100)
    tables.land_arrays(spark.range(3000), f"{tmp_path}/landing")
    sizes = [text.count("\n") - 1 for text in (path.read_text().strip() for path in tmp_path.glob("landing/*.txt"))]
    assert sum(sizes) == 3000 and len(sizes) == 30 and max(sizes) < 300
