"""Silver and gold on the hand-written records, expected rows by hand."""

import pytest
from pyspark.sql import functions as F

import fixtures
from test_columns import RUN
from tierlake.operators.columns import drop_metadata
from tierlake.plans import bronze, gold, silver
from tierlake.sources.entities import landed, read_entities


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    return fixtures.land(tmp_path_factory.mktemp("landing"))


@pytest.fixture(scope="module", params=["nested", "flattened"])
def tables(request, spark, landing):
    specs = landed(landing)
    shape = bronze.snapshot if request.param == "nested" else bronze.dated
    records = read_entities(spark, specs, with_position=True)
    return {name: shape(df, specs[name], RUN) for name, df in records.items()}


@pytest.fixture(scope="module")
def users(tables):
    return silver.silver_users(tables["users"], RUN).cache()


@pytest.fixture(scope="module")
def posts(tables):
    return silver.silver_posts(tables["posts"], RUN).cache()


@pytest.fixture(scope="module")
def todos(tables):
    return silver.silver_todos(tables["todos"], RUN).cache()


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_silver_users(users):
    rows = by(users, "user_id")
    assert sorted(rows) == [1, 2, 3, 4]
    ann = rows[1]
    assert (ann.name, ann.username, ann.email) == ("O'Neil Mc-Donald 3Rd", "ann", "a.b@c.co")
    assert ann.phone == "1-770-736 x56442 ()"
    assert (ann.addr_city, ann.geo_lat, ann.geo_lng) == ("Rio", 12.0, -1.5)
    assert (ann.company_name, ann.company_catchphrase, ann.company_bs) == ("Ada", "Phrase", "b")
    assert (rows[2].name, rows[2].phone) == ("Sséla École", "+55 (11) 99")
    assert (rows[2].geo_lat, rows[2].geo_lng) == (None, None)
    assert (rows[3].geo_lat, rows[3].geo_lng, rows[3].company_name) == (None, None, None)
    assert (rows[4].geo_lat, rows[4].geo_lng, rows[4].email) == (float("inf"), 200.0, None)
    assert ann._pipeline_version == "v1.0" and ann._silver_processed_at is not None


def test_silver_users_columns(users):
    lineage = [c for c in users.columns if c.startswith("_")]
    assert [c for c in users.columns if not c.startswith("_")] == [
        "user_id", "name", "username", "email", "phone", "website", "addr_street", "addr_suite",
        "addr_city", "addr_zipcode", "geo_lat", "geo_lng", "company_name", "company_catchphrase", "company_bs",
    ]
    assert {"_ingestion_timestamp", "_record_hash"} <= set(lineage)


def test_silver_posts(posts):
    rows = by(posts, "post_id")
    assert sorted(rows) == [10, 11, 12, 13, 14]
    first = rows[10]
    assert (first.title, first.body) == ("First Post", "line one line  two")
    assert (first.title_word_count, first.body_word_count, first.body_length) == (2, 4, 18)
    assert (rows[11].title, rows[11].body_word_count, rows[11].body_length) == ("O'Clock", 0, 0)
    assert (rows[12].body, rows[12].body_word_count) == ("", 0)
    assert rows[13].user_id is None
    assert rows[14].body_length == 2


def test_silver_todos_keeps_repeated_records(todos, tables):
    assert sorted((r.todo_id, r.title, r.completed, r.status) for r in todos.collect()) == [
        (20, "Do It", True, "COMPLETED"), (20, "Do It", True, "COMPLETED"),
        (21, "Undone", False, "PENDING"), (22, "Unknown", False, None),
    ]
    assert silver.silver_todos(tables["todos"], RUN, dedup_on=["id"]).count() == 3


def test_user_profile(users, posts, todos):
    profile = gold.user_profile(users, posts, todos, RUN)
    rows = by(profile, "user_id")
    metrics = {
        k: (r.total_posts, r.avg_title_words, r.avg_body_length, r.total_tasks, r.completed_tasks,
            r.pending_tasks, r.completion_rate_pct, r.engagement_level)
        for k, r in rows.items()
    }
    assert metrics == {
        1: (2, 1.5, 9.0, 3, 2, 1, 66.7, "MEDIUM"),
        2: (1, 3.0, 0.0, None, None, None, None, "LOW"),
        3: (None, None, None, None, None, None, None, "LOW"),
        4: (None, None, None, 1, 0, 1, 0.0, "LOW"),
    }
    assert rows[1]._gold_processed_at is not None


def test_city_analysis_and_kpis(users, posts, todos):
    profile = gold.user_profile(users, posts, todos, RUN)
    cities = drop_metadata(gold.city_analysis(profile, RUN)).collect()
    assert [tuple(r) for r in cities] == [("Rio", 2, 2, 66.7, 0), ("Lima", 1, 0, 0.0, 0)]
    assert tuple(gold.global_kpis(profile).first()) == (4, 3, 33.4, 0)


def test_city_without_any_rate_comes_last(spark):
    profile = spark.createDataFrame(
        [("b", 1, None, None, "LOW"), ("a", 2, None, None, "LOW"), ("z", 3, 1, 0.0, "HIGH"), (None, 4, 9, 99.0, "HIGH")],
        "addr_city string, user_id long, total_posts long, completion_rate_pct double, engagement_level string",
    )
    rows = drop_metadata(gold.city_analysis(profile, RUN)).collect()
    assert [tuple(r) for r in rows] == [("z", 1, 1, 0.0, 1), ("a", 1, 0, None, 0), ("b", 1, 0, None, 0)]


def test_means_round_to_even(spark):
    posts = spark.createDataFrame(
        [(1, i, int(i == 0), 2) for i in range(8)],
        "user_id long, post_id long, title_word_count int, body_length int",
    )
    assert gold.post_metrics(posts).first().avg_title_words == 0.12


@pytest.mark.parametrize(
    "pct, posts, level",
    [
        (70.0, 10, "HIGH"), (69.9, 10, "MEDIUM"), (70.0, 9, "MEDIUM"), (40.0, 0, "MEDIUM"), (39.9, 5, "MEDIUM"),
        (39.9, 4, "LOW"), (None, 5, "MEDIUM"), (None, None, "LOW"), (90.0, None, "MEDIUM"), (None, 50, "MEDIUM"),
    ],
)
def test_engagement_boundaries(spark, pct, posts, level):
    df = spark.createDataFrame([(pct, posts)], "pct double, posts long")
    assert df.select(gold.engagement_level(F.col("pct"), F.col("posts"))).first()[0] == level


def test_hash_is_of_business_values(spark, landing):
    specs = landed(landing)
    posts = read_entities(spark, specs, with_position=True)["posts"]
    again = posts.withColumn("_source_file", F.lit("moved"))
    one, two = (bronze.snapshot(df, specs["posts"], RUN) for df in (posts, again))
    assert one.select("_record_hash").exceptAll(two.select("_record_hash")).count() == 0
