"""Tables replaced as a whole, the ledger of a run, and runs that go on."""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

import fixtures
from test_columns import RUN
from tierlake.plans import ledger, medallion
from tierlake.plans.medallion import Lake
from tierlake.quality.gate import QualityGateError
from tierlake.sources import files, sinks, tables
from tierlake.sources.entities import landed
from tierlake.sources.inventory import lake_inventory

LATER = replace(RUN, started_at=RUN.started_at + timedelta(hours=1))


def ids(spark, path):
    return sorted(row.id for row in tables.read_table(spark, path).collect())


def failing(spark, rows):
    return spark.range(rows).select(F.when(F.col("id") < rows - 1, F.col("id")).otherwise(F.raise_error(F.lit("broken"))).alias("id"))


def test_a_failed_rewrite_leaves_the_last_good_table(spark, tmp_path):
    path = str(tmp_path / "silver" / "t")
    assert tables.replace_table(spark.range(5), path) == {"rows": 5}
    with pytest.raises(Exception, match="broken"):
        tables.replace_table(failing(spark, 1000), path)
    assert ids(spark, path) == [0, 1, 2, 3, 4]
    assert len(list((tmp_path / "silver" / "t").glob("v-*"))) == 1
    tables.replace_table(spark.range(3), path)
    assert ids(spark, path) == [0, 1, 2]


def test_a_reader_of_the_version_before_finishes_on_it(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(4), path)
    begun = tables.read_table(spark, path)
    tables.replace_table(begun.where("id > 1"), path)
    assert begun.count() == 4 and ids(spark, path) == [2, 3]
    for n in range(3):
        tables.replace_table(spark.range(n), path)
    assert len(list((tmp_path / "t").glob("v-*"))) == 2 == len(tables.versions(spark, path))


def test_a_half_written_pointer_is_no_pointer(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(4), path)
    files.create(spark, f"{path}/_pointer/000000000002.json", "")
    assert ids(spark, path) == [0, 1, 2, 3]
    tables.replace_table(spark.range(2), path)
    assert ids(spark, path) == [0, 1]


def test_writers_at_the_same_time_leave_one_of_their_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: tables.replace_table(spark.range(n), path), range(1, 9)))
    assert ids(spark, path) == list(range(tables.current(spark, path).rows))


def test_plain_folders_are_read_and_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    assert ids(spark, path) == [0, 1, 2]
    tables.replace_table(spark.range(2), path)
    assert ids(spark, path) == [0, 1] and not list((tmp_path / "t").glob("part-*"))


def test_inventory_follows_the_pointer(spark, tmp_path):
    base = tmp_path / "lake"
    for rows in (9, 5):
        tables.replace_table(spark.range(rows).coalesce(1), str(base / "gold" / "t"))
    found = lake_inventory(spark, str(base)).collect()
    part = next((base / "gold" / "t" / tables.current(spark, str(base / "gold" / "t")).folder).glob("part-*.parquet"))
    assert [tuple(r) for r in found] == [("gold", "t", f"t/{part.name}", part.stat().st_size)]


@pytest.fixture
def landing(tmp_path):
    return fixtures.land(tmp_path / "landing")


@pytest.fixture
def writes(monkeypatch):
    """The paths of all observed writes."""
    done = []
    for name in ("write_folder", "write_partitions"):
        write = getattr(sinks, name)
        monkeypatch.setattr(sinks, name, lambda df, path, *m, _write=write, **o: done.append(path) or _write(df, path, *m, **o))
    return done


def layers(writes, base):
    return sorted("/".join(path.removeprefix(str(base)).split("/")[1:3]) for path in writes)


def stop_at(monkeypatch, name):
    make = getattr(medallion.gold, name)
    monkeypatch.setattr(medallion.gold, name, lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    return lambda: monkeypatch.setattr(medallion.gold, name, make)


@pytest.mark.parametrize("plain", [True, False])
def test_a_run_stopped_after_silver_goes_on_from_silver(spark, landing, tmp_path, monkeypatch, writes, plain):
    base = tmp_path / "lake"

    def go(**options):
        if plain:
            return medallion.run_medallion(spark, landed(landing), str(base), RUN, **options)
        return medallion.run(spark, landing, str(base), RUN, checks={}, **options)

    mended = stop_at(monkeypatch, "user_profile")
    with pytest.raises(RuntimeError, match="stopped"):
        go()
    mended()
    assert len(writes) == 7  # four entities, three silver tables
    writes.clear()
    lake = go(resume=True)
    assert layers(writes, base) == ["gold/city_analysis", "gold/user_profile"]
    assert lake.profile().count() == 4 and lake.reports().count() == 3
    writes.clear()
    go(resume=True)
    assert writes == []
    go(again_from="gold")
    assert layers(writes, base) == ["gold/city_analysis", "gold/user_profile"]
    writes.clear()
    go()
    assert len(writes) == 9


def test_an_entity_that_the_gate_stopped_is_the_only_one_ingested_again(spark, landing, tmp_path, writes):
    base = tmp_path / "lake"
    with pytest.raises(QualityGateError):
        medallion.run(spark, landing, str(base), RUN)
    done = {name for _, name in Lake(spark, str(base)).ledger().entries()}
    assert done == {"todos", "comments"}
    writes.clear()
    medallion.run(spark, landing, str(base), RUN, checks={}, resume=True)
    assert sorted(path.split("/_staging/")[1].split("/")[1] for path in writes if "_staging" in path) == ["posts", "users"]


def test_counts_outlive_the_session_that_made_them(spark, landing, tmp_path):
    base = str(tmp_path / "lake")
    made = medallion.run(spark, landing, base, RUN, checks={})
    fewer = fixtures.land(tmp_path / "fewer", {**fixtures.RECORDS, "users": fixtures.USERS[:1]})
    medallion.run(spark, fewer, base, LATER, checks={})
    wanted = {"users": (5, 4, 1), "posts": (6, 5, 1), "todos": (4, 4, 0), "comments": (1, None, None)}
    for lake in (made, Lake(spark, base, RUN.stamp)):
        assert {r.entity: (r.ingested, r.kept, r.removed) for r in lake.counts().collect()} == wanted
    latest = Lake(spark, base)
    assert {r.entity: r.ingested for r in latest.counts().collect()} == {"users": 1, "posts": 6, "todos": 4, "comments": 1}
    assert tuple(latest.totals().first()) == (4, 12)
    assert latest.all_counts().groupBy("run").count().orderBy("run").collect() == [(RUN.stamp, 4), (LATER.stamp, 4)]
    assert ledger.runs(spark, base) == [RUN.stamp, LATER.stamp]


def test_a_lake_without_runs_has_no_counts(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    assert lake.counts().count() == 0 and lake.all_counts().columns == ["run", "entity", "ingested", "kept", "removed"]
    with pytest.raises(ValueError, match="a layer is one of"):
        lake.ledger().forget("copper")
