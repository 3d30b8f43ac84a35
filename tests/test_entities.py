"""Rejects from any source, arrays cut into records, canonical maps and stamps of runs."""

import sys
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import datetime, timezone

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader

import fixtures
from test_columns import RUN
from tierlake import schemas
from tierlake.functions.keys import canonical, holds_map
from tierlake.operators.columns import with_record_hash
from tierlake.plans import bronze, medallion
from tierlake.run import RunInfo
from tierlake.sources import arrays, sinks
from tierlake.sources.claims import stamped
from tierlake.sources.entities import EntitySpec, landed, read_entity, read_tolerant

REQUIRED = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("title", T.StringType())])


# Rejects


class Tickets(DataSource):
    """A source without files that has records without a number."""

    @classmethod
    def name(cls):
        return "made_tickets"

    def schema(self):
        return "id bigint, title string"

    def reader(self, schema):
        return TicketsReader()


class TicketsReader(DataSourceReader):
    def read(self, partition):
        yield (1, "good")
        yield (None, "no number")
        yield (2, None)


class Telling(Tickets):
    """A source that offers the text of what it could not read."""

    @classmethod
    def name(cls):
        return "telling_tickets"

    def schema(self):
        return "id bigint, title string, _corrupt_record string"

    def reader(self, schema):
        return TellingReader()


class TellingReader(DataSourceReader):
    def read(self, partition):
        yield (1, "good", None)
        yield (None, None, "<ticket")


@pytest.fixture(scope="module")
def made_sources(spark):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    for source in (Tickets, Telling):
        spark.dataSource.register(source)


@pytest.mark.parametrize("source, good, rejects", [
    ("made_tickets", [(1, "good"), (2, None)], [(None, '{"id":null,"title":"no number"}')]),
    ("telling_tickets", [(1, "good")], [(None, "<ticket")]),
])
def test_rejects_of_sources_without_files(spark, made_sources, tmp_path, source, good, rejects):
    found, bad = read_tolerant(spark, EntitySpec("tickets", "made", REQUIRED, format=source), str(tmp_path / "staged"))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == good and found.columns == ["id", "title"]
    assert [tuple(r) for r in bad.collect()] == rejects


def test_rejects_of_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text("1,a\nx,b\n,c\n4,d,e\n5,f\n")
    good, bad = read_tolerant(spark, EntitySpec("t", str(tmp_path / "t.csv"), REQUIRED, format="csv"), str(tmp_path / "staged"))
    assert [tuple(r) for r in good.orderBy("id").collect()] == [(1, "a"), (5, "f")]
    assert sorted(r._corrupt_record for r in bad.collect()) == sorted(["x,b", '{"id":null,"title":"c"}', "4,d,e"])
    assert all(r._source_file.endswith("t.csv") for r in bad.collect())


def test_rejects_of_parquet(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (None, "b")], "id bigint, title string").write.parquet(str(tmp_path / "p"))
    good, bad = read_tolerant(spark, EntitySpec("p", str(tmp_path / "p"), REQUIRED, format="parquet"), str(tmp_path / "staged"))
    assert good.count() == 1
    row = bad.first()
    assert row._corrupt_record == '{"id":null,"title":"b"}' and "/p/part-" in row._source_file


# Arrays


def array_file(folder, text, name="all.json"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf8")
    return EntitySpec("all", str(folder), schemas.fields(id=schemas.LONG, note=schemas.TEXT), multi_line=True)


ODD = '\ufeff \n[\n {"id": 1,\n  "note": "a ] , } \\" {"},\n{"id": 2, "note": null}, {"note": "é\\n😀", "id": 3,\n "more": [{}, [1]]}\n]\n'


def test_arrays_are_cut_at_records_and_keep_their_order(spark, tmp_path):
    spec = array_file(tmp_path / "in", ODD)
    rows = read_entity(spark, spec, with_position=True).orderBy("_source_file", "_source_block", "_source_row").collect()
    assert [(r.id, r.note) for r in rows] == [(1, 'a ] , } " {'), (2, None), (3, "é\n😀")]
    assert [r._source_row for r in rows] == [0, 1, 2] and rows[0]._source_file.endswith("all.json")
    assert read_entity(spark, spec).columns == ["id", "note"]


@pytest.mark.parametrize("text, rows", [("[]", 0), ('{"id": 7}', 1), ("[{}]", 1), (' [ {"id":1} , {"id":2} ] ', 2)])
def test_short_arrays(spark, tmp_path, text, rows):
    assert read_entity(spark, array_file(tmp_path / "in", text)).count() == rows


@pytest.mark.parametrize("text, found", [
    ("[{'id': 1, 'note': 'it]s'}, {\"id\": 1.00}]", [("{'id': 1, 'note': 'it]s'}", True), ('{"id": 1.00}', True)]),
    ("[1, nan, null, \"a\"]", [("1", True), ("nan", True), ("null", True), ('"a"', True)]),
    ("", []), (" \n", []), ("[1,]", [("1", True), ("]", False)]), ("[,1]", [(",1]", False)]), ('["a', [('"a', False)]),
    ("[{'a': [1, {'b': 2}]}]", [("{'a': [1, {'b': 2}]}", True)]),
])
def test_elements_of_a_text(text, found):
    assert list(arrays.elements(text)) == found


@pytest.mark.parametrize("text", ['[{"id": 1}, {"id": ', '[{"id": 1}, {"id": "x"}]', "[nothing", '[{"id": 1} {"id": 2}]', '{"id": 1}\n{"id": 2}', '[{"id": 1}]]'])
def test_a_malformed_array_stops_a_strict_read(spark, tmp_path, text):
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
        read_entity(spark, array_file(tmp_path / "in", text)).collect()


def test_rejects_of_arrays(spark, tmp_path):
    spec = array_file(tmp_path / "in", '[{"id": 1}, {"id": "x", "note": "n"}, {"id": 3}]')
    array_file(tmp_path / "in", '[{"id": 4}, {"id": ', "cut.json")
    good, bad = read_tolerant(spark, spec, str(tmp_path / "staged"))
    assert sorted(r.id for r in good.collect()) == [1, 3, 4]
    texts = {r._source_file.rsplit("/", 1)[1]: r._corrupt_record for r in bad.collect()}
    assert texts == {"all.json": '{"id": "x", "note": "n"}', "cut.json": '{"id": '}


def test_a_large_array_is_split_after_the_cut(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(arrays, "PIECE_BYTES", 1 << 20)
    pad = "0123456789abcdef" * 4
    made = ",\n".join(f'{{"id": {k}, "note": "{k * 7919 % 99991}{pad[k % 16:]}"}}' for k in range(150_000))
    spec = array_file(tmp_path / "in", f"[{made}]")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1mb")
    try:
        df = read_entity(spark, spec, with_position=True)
        sizes = [row["count"] for row in df.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 150_000 and len(sizes) >= 3 and max(sizes) < 75_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_run_on_arrays_equals_one_on_lines(spark, tmp_path):
    import json

    lines = fixtures.land(tmp_path / "lines")
    for name, rows in fixtures.RECORDS.items():
        array_file(tmp_path / "arrays" / name, json.dumps(rows, indent=1, ensure_ascii=False))
    one = medallion.run(spark, lines, str(tmp_path / "a"), RUN, checks={})
    two = medallion.run(spark, str(tmp_path / "arrays"), str(tmp_path / "b"), RUN, landed(str(tmp_path / "arrays"), multi_line=True), checks={})
    for mine, other in ((one.profile(), two.profile()), (one.cities(), two.cities())):
        assert mine.exceptAll(other).count() == 0 and other.exceptAll(mine).count() == 0


# Hashes of maps


def hash_of(spark, expression):
    return with_record_hash(spark.range(1).selectExpr(f"{expression} AS x")).first()._record_hash


@pytest.mark.parametrize("one, other", [
    ("map('a', 1, 'b', 2)", "map('b', 2, 'a', 1)"),
    ("array(map('a', map(2, 'x', 1, 'y')))", "array(map('a', map(1, 'y', 2, 'x')))"),
    ("named_struct('m', map(1, array(1, 2), 0, null), 'n', 5)", "named_struct('m', map(0, null, 1, array(1, 2)), 'n', 5)"),
    ("map(named_struct('k', 2), 1, named_struct('k', 1), 1)", "map(named_struct('k', 1), 1, named_struct('k', 2), 1)"),
])
def test_equal_maps_have_equal_hashes(spark, one, other):
    assert hash_of(spark, one) == hash_of(spark, other)


def test_other_maps_have_other_hashes(spark):
    kinds = ["map('a', 1, 'b', 2)", "map('a', 2, 'b', 1)", "map('a', 1)", "map('a', 1, 'b', null)", "cast(null AS map<string,int>)", "cast(map() AS map<string,int>)"]
    assert len({hash_of(spark, kind) for kind in kinds}) == len(kinds)
    structs = ["named_struct('m', cast(null AS map<int,int>))", "cast(null AS struct<m:map<int,int>>)"]
    assert len({hash_of(spark, kind) for kind in structs}) == 2


def test_values_without_maps_are_hashed_as_they_are(spark):
    kind = T._parse_datatype_string("struct<a:array<int>,b:struct<c:string>>")
    column = F.col("x")
    assert not holds_map(kind) and canonical(column, kind) is column


# Stamps


def test_runs_of_one_second_have_snapshots_of_their_own(spark, tmp_path):
    base, specs = str(tmp_path / "lake"), landed(fixtures.land(tmp_path / "l"))
    other = replace(RUN, identity="other")
    runs = [RUN, other, RUN, other]
    written = [bronze.write_snapshots(spark, specs, base, run)["posts"] for run in runs]
    stamps = [write.partition["_ingestion_timestamp"] for write in written]
    assert stamps == [RUN.stamp, f"{RUN.stamp}_01"] * 2
    table = sinks.read_partitions(spark, written[0].path, by=("_ingestion_timestamp",))
    assert {r._ingestion_timestamp: r["count"] for r in table.groupBy("_ingestion_timestamp").count().collect()} == dict.fromkeys(stamps, 6)


def test_whole_runs_of_one_second_keep_their_counts(spark, tmp_path):
    raw, base = fixtures.land(tmp_path / "l"), str(tmp_path / "lake")
    fewer = fixtures.land(tmp_path / "f", {**fixtures.RECORDS, "posts": fixtures.POSTS[:1]})
    first = medallion.run_medallion(spark, landed(raw), base, RUN)
    second = medallion.run_medallion(spark, landed(fewer), base, replace(RUN, identity="other"))
    assert {r.entity: r.ingested for r in first.counts().collect()}["posts"] == 6
    assert {r.entity: r.ingested for r in second.counts().collect()}["posts"] == 1


def test_stamps_are_claimed_once(spark, tmp_path):
    moment = datetime(2024, 1, 5, 6, 7, 8, tzinfo=timezone.utc)
    runs = [RunInfo(moment, identity=f"run {k % 6}") for k in range(12)]
    with ThreadPoolExecutor(6) as pool:
        found = list(pool.map(lambda run: stamped(spark, str(tmp_path / "stamps"), run), runs))
    assert len({run.stamp for run in found}) == 6
    assert all(found[k].stamp == found[k + 6].stamp for k in range(6))
    assert RunInfo.now().identity != RunInfo.now().identity
    assert RunInfo(moment).identity == RunInfo(moment).identity
