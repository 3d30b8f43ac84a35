from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tierlake.operators import columns
from tierlake.run import RunInfo

RUN = RunInfo(datetime(2024, 1, 5, 6, 7, 8, tzinfo=timezone.utc), job_name="job")

NESTED = (
    "id long, address struct<city: string, geo: struct<lat: string, lng: string>>,"
    " company struct<name: string, `catchPhrase`: string, `Legal Form`: string>, tags array<string>"
)


@pytest.fixture(scope="module")
def nested(spark):
    rows = [
        (1, ("Rio", ("1", "2")), ("A", "phrase", "Ltd"), ["x", "y"]),
        (2, None, ("B", None, None), []),
    ]
    return spark.createDataFrame(rows, NESTED)


def test_flatten_names_leaves_by_path_and_keeps_arrays(nested):
    flat = columns.flatten(nested)
    assert flat.columns == [
        "id", "address.city", "address.geo.lat", "address.geo.lng",
        "company.name", "company.catchPhrase", "company.Legal Form", "tags",
    ]
    rows = flat.orderBy("id").collect()
    assert tuple(rows[0]) == (1, "Rio", "1", "2", "A", "phrase", "Ltd", ["x", "y"])
    assert tuple(rows[1]) == (2, None, None, None, "B", None, None, [])


@pytest.mark.parametrize("flat_first", [False, True])
def test_expand_nested_gives_the_same_from_structs_and_flat_columns(nested, flat_first):
    df = columns.flatten(nested) if flat_first else nested
    df = columns.expand_nested(df, "address", "addr_", separators=".")
    df = columns.expand_nested(df, "company", "company_", separators=" ")
    assert df.columns == [
        "id", "tags", "addr_city", "addr_geo_lat", "addr_geo_lng",
        "company_name", "company_catchphrase", "company_legal_form",
    ]
    assert df.orderBy("id").first()["addr_geo_lng"] == "2"


def test_expand_nested_is_a_projection(nested, capsys):
    columns.expand_nested(nested, "address", "addr_", separators=".").explain()
    plan = capsys.readouterr().out
    assert "Join" not in plan and "Exchange" not in plan


def test_clashing_names_are_refused(spark):
    df = spark.sql("SELECT named_struct('a', 1, 'A', 2) AS s")
    with pytest.raises(ValueError, match="s_a"):
        columns.expand_nested(df, "s", "s_", separators=".")


def test_record_hash_ignores_metadata_and_sees_nulls(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, "x", None), (1, None, "x")], "a int, b string, c string")
    first = columns.with_job_lineage(df, RUN, "url", "e")
    other = columns.with_snapshot_lineage(df, RUN, "elsewhere", "system")
    hashes = [r._record_hash for r in columns.with_record_hash(first).collect()]
    assert hashes == [r._record_hash for r in columns.with_record_hash(other).collect()]
    assert hashes[0] == hashes[2] != hashes[1]
    assert all(len(h) == 32 for h in hashes)


def test_record_hash_of_dotted_columns(nested):
    assert columns.with_record_hash(columns.flatten(nested)).select("_record_hash").distinct().count() == 2


def test_lineage_and_stamps(spark):
    df = columns.with_job_lineage(spark.range(1), RUN, "file:/x", "users")
    df = columns.with_process_stamp(df, "silver", RUN, version=True)
    row = columns.with_date_parts(df, F.to_date("_ingestion_date")).first().asDict()
    assert row["_ingestion_timestamp"] == "20240105_060708"
    assert row["_ingestion_date"] == "2024-01-05"
    assert (row["_source_url"], row["_source_entity"], row["_job_name"]) == ("file:/x", "users", "job")
    assert (row["ano"], row["mes"], row["dia"]) == ("2024", "01", "05")
    assert row["_pipeline_version"] == "v1.0"
    assert row["_silver_processed_at"] == datetime(2024, 1, 5, 6, 7, 8)


def test_metadata_is_dropped_by_prefix(spark):
    df = columns.with_snapshot_lineage(spark.range(1), RUN, "u", "s")
    assert columns.drop_metadata(df).columns == columns.business_columns(df) == ["id"]


def test_run_needs_a_time_zone():
    with pytest.raises(ValueError):
        RunInfo(datetime(2024, 1, 1))


def test_hash_is_the_same_in_every_session(spark):
    df = spark.sql(
        "SELECT timestamp_micros(1704434828123456) AS t, timestamp_ntz'2024-01-05 06:07:08.5' AS n, date'2024-01-05' AS d,"
        " 1e10D AS x, 0.1D AS y, 1.50BD AS e, named_struct('a', timestamp_micros(1)) AS s, map('k', timestamp_micros(2)) AS m"
    )
    hashes = set()
    for zone in ["UTC", "America/Sao_Paulo", "Asia/Tokyo"]:
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            hashes.add(columns.with_record_hash(df).first()._record_hash)
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert len(hashes) == 1
    later = df.withColumn("t", F.timestamp_micros(F.lit(1704434828123457)))
    assert columns.with_record_hash(later).first()._record_hash not in hashes
