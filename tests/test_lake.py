"""Sources, sinks, the gated job and whole runs."""

from datetime import timedelta
from dataclasses import replace

import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

import fixtures
from test_columns import RUN
from tierlake import schemas
from tierlake.__main__ import main as command
from tierlake.operators.columns import with_date_parts
from tierlake.plans import bronze, medallion
from tierlake.quality.gate import QualityGateError
from tierlake.sources import sinks
from tierlake.sources.entities import EntitySpec, landed, read_entity, read_tolerant
from tierlake.sources.inventory import lake_inventory
from tierlake.sources.scratch import scratch_folder

NEXT_DAY = replace(RUN, started_at=RUN.started_at + timedelta(days=1))


@pytest.fixture
def landing(tmp_path):
    return fixtures.land(tmp_path / "landing")


def test_read_entity_orders_rows_as_in_the_files(spark, landing):
    df = read_entity(spark, landed(landing)["posts"], with_position=True)
    rows = df.orderBy("_source_file", "_source_block", "_source_row").collect()
    assert [r.title for r in rows] == [p["title"] for p in fixtures.POSTS]


def test_position_survives_split_files(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.range(20_000).select(F.col("id"), F.lit("x" * 50).alias("pad")).coalesce(1).write.json(path)
    spec = EntitySpec("lines", path, schemas.fields(id=schemas.LONG, pad=schemas.TEXT), multi_line=False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200kb")
    try:
        df = read_entity(spark, spec, with_position=True)
        assert df.rdd.getNumPartitions() > 2
        ids = [r.id for r in df.orderBy("_source_file", "_source_block", "_source_row").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ids == list(range(20_000))


def test_malformed_record_stops_a_strict_read(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"id": 1}\n{"id": \n')
    spec = EntitySpec("bad", str(tmp_path / "bad.json"), schemas.fields(id=schemas.LONG), multi_line=False)
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
        read_entity(spark, spec).collect()


def test_malformed_csv_stops_a_strict_read(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("1,2\nx,6\n")
    spec = EntitySpec("bad", str(tmp_path / "bad.csv"), schemas.fields(id=schemas.LONG, n=schemas.LONG), format="csv")
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
        read_entity(spark, spec).collect()


def test_arrays_that_span_lines_are_read_on_request_only(spark, tmp_path):
    (tmp_path / "all.json").write_text('[\n {"id": 1},\n {"id": 2}\n]\n')
    spec = EntitySpec("all", str(tmp_path / "all.json"), schemas.fields(id=schemas.LONG))
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
        read_entity(spark, spec).collect()
    assert read_entity(spark, replace(spec, multi_line=True)).count() == 2


class Posts(DataSource):
    """A source without files."""

    @classmethod
    def name(cls):
        return "made_posts"

    def schema(self):
        return "userId bigint, id bigint, title string, body string"

    def reader(self, schema):
        return PostsReader()


class PostsReader(DataSourceReader):
    def read(self, partition):
        yield (1, 10, " first", "body")
        yield (1, 10, "again", "body")


def test_sources_without_files_are_ingested(spark, landing, tmp_path):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(Posts)
    specs = landed(landing) | {"posts": EntitySpec("posts", "made", schemas.POSTS, format="made_posts")}
    lake = medallion.run(spark, landing, str(tmp_path / "lake"), RUN, specs, checks={})
    assert {r.entity: (r.ingested, r.kept, r.removed) for r in lake.counts().collect()} == {
        "users": (5, 4, 1), "posts": (2, 1, 1), "todos": (4, 4, 0), "comments": (1, None, None),
    }
    assert tuple(lake.totals().first()) == (4, 12)


def test_tolerant_read_routes_rejects(spark, tmp_path):
    (tmp_path / "mixed.json").write_text('{"id": 1, "n": 2}\n{"id": \n{"id": 3, "n": "x"}\n')
    spec = EntitySpec(
        "mixed", str(tmp_path / "mixed.json"), schemas.fields(id=schemas.LONG, n=schemas.LONG), multi_line=False
    )
    good, rejects = read_tolerant(spark, spec, str(tmp_path / "staged"))
    assert [tuple(r) for r in good.collect()] == [(1, 2)]
    assert good.select("id").count() == 1
    found = rejects.collect()
    assert sorted(r._corrupt_record for r in found) == ['{"id": ', '{"id": 3, "n": "x"}']
    assert all(r._source_file.endswith("mixed.json") for r in found)


def test_schema_can_be_inferred(spark, landing):
    spec = replace(landed(landing)["users"], schema=None)
    assert set(read_entity(spark, spec).columns) == set(schemas.USERS.fieldNames())


def test_other_formats_by_spec(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "p"))
    assert read_entity(spark, EntitySpec("p", str(tmp_path / "p"), format="parquet")).count() == 3


def dated_rows(spark, days, label):
    rows = [(f"2024-01-{day:02d}", label) for day in days]
    df = spark.createDataFrame(rows, "d string, label string")
    return with_date_parts(df, F.to_date("d"))


def test_partition_write_replaces_only_the_days_present(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.write_partitions(dated_rows(spark, [3, 3, 4, 15], "old"), path)["rows"] == 4
    assert sinks.write_partitions(dated_rows(spark, [4, 4, 20], "new"), path, rebalance=False)["rows"] == 3
    table = sinks.read_partitions(spark, path)
    assert dict(table.dtypes)["mes"] == "string"
    found = sorted((r.ano, r.mes, r.dia, r.label) for r in table.collect())
    assert found == [
        ("2024", "01", "03", "old"), ("2024", "01", "03", "old"), ("2024", "01", "04", "new"),
        ("2024", "01", "04", "new"), ("2024", "01", "15", "old"), ("2024", "01", "20", "new"),
    ]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_hot_day_is_written_by_several_tasks(spark, tmp_path):
    """Ninety-nine in a hundred rows on one day: that day is split.

    Small days stay whole unless they hash to the partition of the hot one.
    """
    path = str(tmp_path / "t")
    day = F.when(F.col("id") % 100 == 0, F.col("id") / 100 % 5 + 2).otherwise(F.lit(1))
    df = spark.range(200_000, numPartitions=8).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("pad"),
        F.make_date(F.lit(2024), F.lit(1), day.cast("int")).alias("d"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1mb")
    try:
        sinks.write_partitions(with_date_parts(df, F.col("d")), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = lambda dia: len(list((tmp_path / "t/ano=2024/mes=01" / f"dia={dia}").glob("*.parquet")))
    assert files("01") > 3
    assert min(files(f"{day:02d}") for day in range(2, 7)) == 1
    assert sinks.read_partitions(spark, path).count() == 200_000


def test_snapshots_keep_history_and_can_be_repeated(spark, landing, tmp_path):
    base, specs = str(tmp_path / "lake"), landed(landing)
    for run in (RUN, NEXT_DAY, NEXT_DAY):
        written = bronze.write_snapshots(spark, specs, base, run)
    assert {name: w.rows for name, w in written.items()} == {n: len(r) for n, r in fixtures.RECORDS.items()}
    path = written["posts"].path
    assert sinks.read_partitions(spark, path, by=("_ingestion_timestamp",)).count() == 2 * len(fixtures.POSTS)
    assert sinks.read_snapshot(spark, path, RUN.stamp).count() == len(fixtures.POSTS)
    assert written["posts"].read(spark).select("_ingestion_timestamp").distinct().first()[0] == NEXT_DAY.stamp
    assert written["posts"].read(spark).columns[-1] == "_ingestion_timestamp"


def test_empty_entity_reads_back_empty(spark, tmp_path):
    landing = fixtures.land(tmp_path / "l", {"comments": []})
    spec = landed(landing)["comments"]
    written = bronze.write_snapshots(spark, {"comments": spec}, str(tmp_path / "a"), RUN)["comments"]
    assert written.rows == 0 and written.read(spark).count() == 0
    written = bronze.run_bronze_job(spark, spec, str(tmp_path / "b"), RUN)
    assert written.rows == 0 and "dia" in written.read(spark).columns


def posts_without_null_keys():
    return {"posts": [p for p in fixtures.POSTS if p["userId"] is not None]}


def test_bronze_job_replaces_its_day_only(spark, tmp_path):
    landing, base = fixtures.land(tmp_path / "l", posts_without_null_keys()), str(tmp_path / "lake")
    spec = landed(landing)["posts"]
    for run in (RUN, NEXT_DAY, RUN):
        written = bronze.run_bronze_job(spark, spec, base, run)
    assert written.rows == 5
    assert [r.status for r in written.results] == ["PASS"] * 3
    table = sinks.read_partitions(spark, written.path)
    assert table.columns == [
        "userId", "id", "title", "body", "_record_hash", "_ingestion_timestamp", "_ingestion_date",
        "_source_url", "_source_entity", "_job_name", "ano", "mes", "dia",
    ]
    assert table.groupBy("ano", "mes", "dia").count().count() == 2
    assert table.count() == 10
    assert bronze.read_day(spark, written.path, RUN).count() == 5


def test_failed_gate_leaves_the_target_untouched(spark, landing, tmp_path):
    base = str(tmp_path / "lake")
    good = fixtures.land(tmp_path / "good", posts_without_null_keys())
    path = bronze.run_bronze_job(spark, landed(good)["posts"], base, RUN).path
    before = sorted(r._record_hash for r in sinks.read_partitions(spark, path).collect())
    with pytest.raises(QualityGateError, match="not_null:userId"):
        bronze.run_bronze_job(spark, landed(landing)["posts"], base, RUN)
    assert sorted(r._record_hash for r in sinks.read_partitions(spark, path).collect()) == before


def all_files(folder):
    return sorted(str(path.relative_to(folder)) for path in folder.rglob("*.parquet"))


@pytest.mark.parametrize("publish", ["rename", "rewrite"])
def test_overlapping_runs_publish_their_own_rows(spark, landing, tmp_path, monkeypatch, publish):
    """A bad run of the next day between this run's staging and its gate: each keeps to itself."""
    base = tmp_path / "lake"
    good = landed(fixtures.land(tmp_path / "good", posts_without_null_keys()))["posts"]
    bad, gate = landed(landing)["posts"], bronze.enforce

    def interrupted(results):
        monkeypatch.setattr(bronze, "enforce", gate)
        with pytest.raises(QualityGateError):
            bronze.run_bronze_job(spark, bad, str(base), NEXT_DAY, publish=publish)
        return gate(results)

    monkeypatch.setattr(bronze, "enforce", interrupted)
    written = bronze.run_bronze_job(spark, good, str(base), RUN, publish=publish)
    assert written.rows == written.read(spark).count() == 5
    assert sinks.read_partitions(spark, written.path).where("userId IS NULL").count() == 0
    assert all(name.startswith("bronze/posts/ano=2024/mes=01/dia=05/") for name in all_files(base))


def test_a_blocked_run_after_the_gate_leaves_this_run_alone(spark, landing, tmp_path, monkeypatch):
    base = tmp_path / "lake"
    good = landed(fixtures.land(tmp_path / "good", posts_without_null_keys()))["posts"]
    publish = bronze._publish

    def interrupted(*arguments):
        with pytest.raises(QualityGateError):
            bronze.run_bronze_job(spark, landed(landing)["posts"], str(base), NEXT_DAY)
        publish(*arguments)

    monkeypatch.setattr(bronze, "_publish", interrupted)
    assert bronze.run_bronze_job(spark, good, str(base), RUN).read(spark).count() == 5
    assert {name.split("/")[0] for name in all_files(base)} == {"bronze"}


def test_a_gated_entity_is_written_once(spark, tmp_path, monkeypatch):
    spec = landed(fixtures.land(tmp_path / "l", posts_without_null_keys()))["posts"]
    writes, write = [], sinks._observed_write
    monkeypatch.setattr(sinks, "_observed_write", lambda *arguments: writes.append(1) or write(*arguments))
    for checks in ({}, bronze.BRONZE_CHECKS):
        writes.clear()
        bronze.run_bronze_job(spark, spec, str(tmp_path / "a"), RUN, checks)
        assert len(writes) == 1
    bronze.run_bronze_job(spark, spec, str(tmp_path / "b"), RUN, publish="rewrite")
    assert len(writes) == 3


def test_gate_with_unique_rule_and_no_earlier_target(spark, landing, tmp_path):
    checks = {"posts": [{"tipo": "unique", "coluna": "id"}]}
    with pytest.raises(QualityGateError, match="unique:id"):
        bronze.run_bronze_job(spark, landed(landing)["posts"], str(tmp_path / "lake"), RUN, checks)
    assert not (tmp_path / "lake" / "bronze").exists()


def test_entity_without_rules_is_written_unchecked(spark, landing, tmp_path, caplog):
    written = bronze.run_bronze_job(spark, landed(landing)["comments"], str(tmp_path / "lake"), RUN)
    assert (written.rows, list(written.results)) == (1, [])
    assert "no rules defined" in caplog.text


def test_snapshot_run_end_to_end(spark, landing, tmp_path):
    base = str(tmp_path / "lake")
    lake = medallion.run_medallion(spark, landed(landing), base, RUN)
    assert {r.user_id: r.engagement_level for r in lake.profile().collect()} == {1: "MEDIUM", 2: "LOW", 3: "LOW", 4: "LOW"}
    assert lake.cities().count() == 2
    assert tuple(lake.kpis().first()) == (4, 3, 33.4, 0)
    summary = {r.entity: tuple(r)[2:] for r in lake.summary().collect()}
    # users: too few rows, a null e-mail, a bad e-mail, latitude and longitude out of range.
    assert summary["users"] == (50.0, "RED", 5, 2, 3)
    # posts: too few rows, a null user, two orphans.
    assert summary["posts"] == (57.1, "RED", 4, 3, 0)
    # profile: a null e-mail, users without posts, users without tasks.
    assert summary["user_profile"] == (62.5, "YELLOW", 5, 3, 0)
    layers = {r.layer for r in lake.inventory().select("layer").distinct().collect()}
    assert layers == {"bronze", "silver", "gold", "quality_reports"}
    again = medallion.run_medallion(spark, landed(landing), base, RUN)
    assert again.users().count() == 4 and again.reports().count() == 3


def test_gated_run_stops_before_silver(spark, landing, tmp_path):
    with pytest.raises(QualityGateError):
        medallion.run(spark, landing, str(tmp_path / "lake"), RUN)
    assert not (tmp_path / "lake" / "silver").exists()


def test_command_runs_raw_to_processed(spark, tmp_path, capsys):
    clean = {**fixtures.RECORDS, "users": [u for u in fixtures.USERS if u["email"]], **posts_without_null_keys()}
    raw = fixtures.land(tmp_path / "raw", clean)
    command([raw, str(tmp_path / "out"), "--job-name", "nightly"])
    assert "user_profile" in capsys.readouterr().out
    bronze_users = sinks.read_partitions(spark, str(tmp_path / "out" / "bronze" / "users"))
    assert bronze_users.select("_job_name").distinct().first()[0] == "nightly"


def test_gated_run_equals_snapshot_run(spark, landing, tmp_path):
    gated = medallion.run(spark, landing, str(tmp_path / "a"), RUN, checks={})
    plain = medallion.run_medallion(spark, landed(landing), str(tmp_path / "b"), RUN)
    for one, two in [(gated.profile(), plain.profile()), (gated.cities(), plain.cities())]:
        assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_inventory_lists_files_with_sizes(spark, tmp_path):
    base = tmp_path / "lake"
    spark.range(10).coalesce(1).write.parquet(str(base / "silver" / "users"))
    found = lake_inventory(spark, str(base)).collect()
    part = next((base / "silver" / "users").glob("part-*.parquet"))
    assert [tuple(r) for r in found] == [("silver", "users", f"users/{part.name}", part.stat().st_size)]


def test_inventory_knows_layers_below_its_base_only(spark, tmp_path):
    base = tmp_path / "gold" / "lake"
    spark.range(3).coalesce(1).write.parquet(str(base / "bronze" / "users"))
    spark.range(3).coalesce(1).write.parquet(str(base / "other" / "silver" / "x"))
    found = {(r.layer, r.dataset) for r in lake_inventory(spark, str(base)).collect()}
    assert found == {("bronze", "users"), (None, "")}


class SharedSession:
    """A cluster session, as far as the choice of a folder goes."""

    def __init__(self, folder):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master = "yarn"

    def getCheckpointDir(self):
        return None


def test_scratch_folder_is_the_shared_one_on_a_cluster(spark):
    one, two = (scratch_folder(SharedSession("s3://shared/tmp/"), "x") for _ in range(2))
    assert one != two and one.startswith("s3://shared/tmp/tierlake/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_folder(SharedSession(None), "x")
    assert scratch_folder(spark, "x") != scratch_folder(spark, "x")
