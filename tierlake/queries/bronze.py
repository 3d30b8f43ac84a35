"""Bronze columns, sinks and sources, and whole runs, on the given data."""

from __future__ import annotations

from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake import schemas
from tierlake.functions.keys import record_hash, run_stamp
from tierlake.operators.columns import (
    drop_metadata,
    normalised_name,
    with_date_parts,
    with_job_lineage,
    with_process_stamp,
    with_record_hash,
)
from tierlake.operators.profile import ingest_totals, preview, table_profile
from tierlake.plans import medallion
from tierlake.plans.bronze import read_day, run_bronze_job, write_snapshots
from tierlake.plans.parallel import side_by_side
from tierlake.quality.gate import QualityGateError
from tierlake.queries import sql, tables
from tierlake.queries.gold import PROFILE_SQL
from tierlake.queries.tables import COLUMNS, LATER_RUN, RUN, table
from tierlake.sources import sinks
from tierlake.sources.entities import CORRUPT, EntitySpec, landed, read_tolerant
from tierlake.sources.inventory import lake_inventory
from tierlake.sources.scratch import scratch_folder
from tierlake.sources.tables import VERSION, read_table, replace_table

HASHED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata does not change the hash; a null keeps its place in it."""
    orders = table(spark, sf_dir, "orders").select(*HASHED)
    urgent = F.when(F.col("o_orderpriority").startswith("1"), None).otherwise(F.col("o_orderpriority"))
    stamped = with_job_lineage(orders.withColumn("o_orderpriority", urgent), RUN, "orders", "orders")
    plain = record_hash([F.col(name) for name in HASHED])
    return with_record_hash(stamped).select(
        "o_orderkey", F.col("_record_hash").alias("record_hash"),
        (F.col("_record_hash") == plain).alias("business_only"),
    )


def map_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a map of properties, also inside a struct and an array, built in two orders."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    pairs = [(F.lit("type"), F.col("event_type")), (F.lit("user"), F.col("user_id").cast("string"))]
    made = []
    for built, order in (("forward", pairs), ("backward", pairs[::-1])):
        tags = F.create_map(*[part for pair in order for part in pair])
        rows = events.select("event_id", tags.alias("tags"), F.struct(F.array(tags).alias("list")).alias("inside"))
        made.append(with_record_hash(rows).select("event_id", F.lit(built).alias("built"), F.col("_record_hash").alias("record_hash")))
    return made[0].unionByName(made[1])


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    stamped = with_job_lineage(events, RUN, "landing/events", "events")
    dated = with_date_parts(stamped, F.col("ts"))
    processed = with_process_stamp(dated, "silver", RUN, version=True).withColumn("stamp", run_stamp(F.col("ts")))
    return processed.withColumn("_silver_processed_at", F.unix_micros("_silver_processed_at")).drop("ts")


def partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by day; the first day is written again with its values negated."""
    path = scratch_folder(spark, "events-by-day")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    sinks.write_partitions(with_date_parts(events, F.col("ts")), path)
    first_day = events.agg(F.to_date(F.min("ts"))).scalar()
    corrected = events.where(F.to_date("ts") == first_day).withColumn("value", -F.col("value"))
    sinks.write_partitions(with_date_parts(corrected, F.col("ts")), path, rebalance=False)
    return sinks.read_partitions(spark, path).drop("ts")


def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested users ingested by three runs, the second one twice: three snapshots stay, nested as landed."""
    base = scratch_folder(spark, "snapshots")
    tables.raw_users(spark, sf_dir).write.json(f"{base}/landing/users")
    specs = landed(f"{base}/landing", {"users": schemas.USERS})
    # The third is another run of the second's second, so it has a snapshot of its own.
    for run in (RUN, LATER_RUN, LATER_RUN, replace(LATER_RUN, identity="another")):
        written = write_snapshots(spark, specs, base, run)
    path = written["users"].path
    snapshots = sinks.read_partitions(spark, path, by=(sinks.SNAPSHOT_PARTITION,))
    geo = F.col("address.geo")
    return snapshots.select(
        "id", "name", F.col("address.street").alias("street"), F.col("address.city").alias("city"),
        geo.getField("lat").alias("lat"), geo.getField("lng").alias("lng"),
        F.col("company.catchPhrase").alias("phrase"), F.typeof("address").alias("address_type"),
        F.typeof("company").alias("company_type"),
        F.col(sinks.SNAPSHOT_PARTITION).alias("run"), "_source_system",
    )


def gated_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested users through the gated bronze job, read back from their day."""
    base = scratch_folder(spark, "gated")
    tables.raw_users(spark, sf_dir).write.json(f"{base}/landing/users")
    spec = landed(f"{base}/landing", {"users": schemas.USERS}, multi_line=False)["users"]
    written = run_bronze_job(spark, spec, f"{base}/lake", RUN)
    users = read_day(spark, written.path, RUN)
    users = users.toDF(*[normalised_name(name, "", ".") for name in users.columns])
    return users.drop("_source_url", "_record_hash").withColumn("written", F.lit(written.rows).cast("bigint"))


def gate_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A good day, then a bad load of the same day that the gate stops: the target's rows and the failed checks."""
    base = scratch_folder(spark, "blocked")
    posts = tables.raw_posts(spark, sf_dir)
    posts.write.json(f"{base}/good/posts")
    nobody = F.when(F.col("id") % 7 == 0, None).otherwise(F.col("userId"))
    posts.withColumns({"userId": nobody, "title": F.lit("bad")}).write.json(f"{base}/bad/posts")
    good, bad = (landed(f"{base}/{load}", {"posts": schemas.POSTS})["posts"] for load in ("good", "bad"))
    written = run_bronze_job(spark, good, f"{base}/lake", RUN)
    failed = ""
    try:
        run_bronze_job(spark, bad, f"{base}/lake", RUN)
    except QualityGateError as error:
        failed = ",".join(sorted(row["check"] for row in error.failed))
    day = read_day(spark, written.path, RUN)
    return day.select("userId", "id", "title", "body").withColumn("failed", F.lit(failed))


def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed records with repeated ones among them: what the run ingested, kept and removed."""
    base = scratch_folder(spark, "counts")
    tables.land(spark, sf_dir, f"{base}/landing", repeated={"users": "id % 3 = 0", "posts": "id % 5 = 0"})
    medallion.run(spark, f"{base}/landing", f"{base}/lake", RUN, landed(f"{base}/landing"), checks={})
    # Another view of the lake knows the counts too: they are stored.
    return medallion.Lake(spark, f"{base}/lake").counts()


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines, those of errors cut off: the good records and the texts of the rejects."""
    path = scratch_folder(spark, "rejects")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    line = F.to_json(F.struct(*events.columns))
    broken = F.when(F.col("event_type") == "error", F.regexp_replace(line, "}$", "")).otherwise(line)
    events.select(broken.alias("value")).write.text(f"{path}/landing")
    spec = EntitySpec("events", f"{path}/landing", events.schema, multi_line=False)
    good, bad = read_tolerant(spark, spec, f"{path}/staged")
    records = good.select(*events.columns, F.lit(None).cast("string").alias("rejected"))
    texts = bad.select(*[F.lit(None).cast(kind).alias(name) for name, kind in events.dtypes], F.col(CORRUPT).alias("rejected"))
    return records.unionByName(texts)


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as CSV lines; of errors the number is spoilt, of purchases the user is missing, whom the schema requires."""
    path = scratch_folder(spark, "rejects")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    number = F.when(F.col("event_type") == "error", F.concat(F.lit("no "), "event_id")).otherwise(F.col("event_id").cast("string"))
    user = F.when(F.col("event_type") == "purchase", "").otherwise(F.col("user_id").cast("string"))
    events.select(F.concat_ws(",", number, user, "event_type").alias("value")).write.text(f"{path}/landing")
    schema = T.StructType([T.StructField(f.name, f.dataType, f.name != "user_id") for f in events.schema.fields])
    good, bad = read_tolerant(spark, EntitySpec("events", f"{path}/landing", schema, format="csv"), f"{path}/staged")
    records = good.select(*events.columns, F.lit(None).cast("string").alias("rejected"))
    texts = bad.where("_source_file LIKE '%/landing/%'").select(
        *[F.lit(None).cast(kind).alias(name) for name, kind in events.dtypes], F.col(CORRUPT).alias("rejected")
    )
    return records.unionByName(texts)


def _all_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: table(spark, sf_dir, name) for name in COLUMNS}


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = [
        table_profile(df).withColumn("table_name", F.lit(name))
        for name, df in _all_tables(spark, sf_dir).items()
    ]
    return reduce(DataFrame.unionByName, made)


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_totals(_all_tables(spark, sf_dir))


def top_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return preview(orders, 3, F.col("o_totalprice").desc_nulls_last(), "o_orderkey")


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of bronze events and the silver customers, written twice, by the files of the current tables."""
    base = scratch_folder(spark, "inventory")
    events = with_date_parts(table(spark, sf_dir, "events"), F.col("ts"))
    sinks.write_partitions(events, f"{base}/bronze/events")
    for _ in range(2):
        replace_table(table(spark, sf_dir, "customer"), f"{base}/silver/customer")
    # A second source: the files that the readers of the tables go by, and the sizes that their rows
    # tell. A file may hold no rows: the first task of a write makes one even if it has none.
    readers = (spark.read.parquet(f"{base}/bronze/events"), read_table(spark, f"{base}/silver/customer"))
    names = spark.createDataFrame([(name,) for df in readers for name in df.inputFiles()], "path string")
    sizes = reduce(DataFrame.union, [
        df.select(_below_layer("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")) for df in readers
    ]).distinct()
    known = names.select(_below_layer("path").alias("file"), F.lit(True).alias("known")).join(sizes, "file", "left")
    agrees = F.col("known").isNotNull() & F.col("bytes").isNotNull() & F.coalesce(F.col("size") == F.col("bytes"), F.lit(True))
    return lake_inventory(spark, base).join(known, "file", "full").groupBy(
        "layer", "dataset", F.regexp_replace("file", "/?[^/]+$", "").alias("folder")
    ).agg(F.bool_and(F.coalesce(F.col("bytes") > 0, F.lit(False))).alias("filled"), F.bool_and(agrees).alias("agrees"))


def _below_layer(path: str) -> Column:
    """What of a file's path is below its layer, without the folder of a version."""
    return F.regexp_replace(F.regexp_extract(path, "^.*/(?:bronze|silver)/((?:events|customer)/.*)$", 1), f"/{VERSION}[0-9a-f]{{32}}/", "/")


def raw_to_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed JSON through the gated run, to the gold profile read from the lake."""
    base = scratch_folder(spark, "raw")
    tables.land(spark, sf_dir, f"{base}/landing")
    lake = medallion.run(
        spark, f"{base}/landing", f"{base}/lake", RUN, landed(f"{base}/landing", multi_line=False)
    )
    return drop_metadata(lake.profile())


def arrays_to_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from JSON arrays that span lines, cut into records before they are parsed."""
    base = scratch_folder(spark, "arrays")
    side_by_side(spark, {
        name: partial(tables.land_arrays, make(spark, sf_dir), f"{base}/landing/{name}") for name, make in tables.RAW.items()
    })
    lake = medallion.run(
        spark, f"{base}/landing", f"{base}/lake", RUN, landed(f"{base}/landing", multi_line=True)
    )
    return drop_metadata(lake.profile())


def full_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed JSON through the snapshot run, to the summary of its stored reports."""
    base = scratch_folder(spark, "full")
    tables.land(spark, sf_dir, f"{base}/landing")
    specs = landed(f"{base}/landing", schemas.ENTITIES, multi_line=False)
    return medallion.run_medallion(spark, specs, f"{base}/lake", RUN).summary()


QUERIES = {
    "record_hash": hashes,
    "record_hash_maps": map_hashes,
    "bronze_metadata": metadata,
    "bronze_partition_roundtrip": partition_roundtrip,
    "bronze_snapshot_roundtrip": snapshot_roundtrip,
    "bronze_gated_job": gated_users,
    "bronze_gate_blocks": gate_blocks,
    "run_counts": run_counts,
    "ingest_rejects": rejects,
    "ingest_rejects_csv": csv_rejects,
    "table_profile": profiles,
    "ingest_totals": totals,
    "preview_top": top_orders,
    "lake_inventory": inventory,
    "raw_to_processed": raw_to_processed,
    "arrays_to_processed": arrays_to_processed,
    "full_run_summary": full_run_summary,
}


def _profile_sql() -> str:
    parts = []
    for name, ddl in COLUMNS.items():
        fields = [tuple(field.split()) for field in ddl.split(", ")]
        total = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c, _ in fields)
        parts += [
            f"SELECT '{name}' AS table_name, '{column}' AS column_name, '{kind}' AS data_type,"
            f" count(*) FILTER (WHERE {column} IS NULL) AS null_count, count(*) AS row_count,"
            f" CAST({len(fields)} AS BIGINT) AS column_count, {total} AS total_nulls FROM {name}"
            for column, kind in fields
        ]
    return " UNION ALL ".join(parts)


_TAGS = """'[{"key":"type","value":"' || event_type || '"},{"key":"user","value":"' || user_id || '"}]'"""
_DAY = "strftime(ts, 'ano=%Y/mes=%m/dia=%d')"

ORACLES = {
    "record_hash": """
SELECT o_orderkey, true AS business_only,
       md5('{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey
           || ',"o_orderstatus":"' || o_orderstatus || '","o_totalprice":' || CAST(o_totalprice AS VARCHAR)
           || ',"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') || '","o_orderpriority":'
           || (CASE WHEN starts_with(o_orderpriority, '1') THEN 'null'
               ELSE '"' || o_orderpriority || '"' END) || '}') AS record_hash
FROM orders""",
    "record_hash_maps": f"""
SELECT event_id, built, md5('{{"event_id":' || event_id || ',"tags":' || tags || ',"inside":{{"list":[' || tags || ']}}}}') AS record_hash
FROM (SELECT event_id, {_TAGS} AS tags FROM events) CROSS JOIN (VALUES ('forward'), ('backward')) AS orders(built)""",
    "ingest_rejects_csv": """
SELECT CASE WHEN good THEN event_id END AS event_id, CASE WHEN good THEN user_id END AS user_id,
       CASE WHEN good THEN event_type END AS event_type,
       CASE WHEN event_type = 'error' THEN 'no ' || event_id || ',' || user_id || ',' || event_type
            WHEN event_type = 'purchase' THEN '{"event_id":' || event_id || ',"user_id":null,"event_type":"purchase"}' END AS rejected
FROM (SELECT *, event_type NOT IN ('error', 'purchase') AS good FROM events)""",
    "bronze_metadata": """
SELECT event_id, '20240203_040506' AS _ingestion_timestamp, '2024-02-03' AS _ingestion_date,
       'landing/events' AS _source_url, 'events' AS _source_entity, 'queries' AS _job_name,
       strftime(ts, '%Y') AS ano, strftime(ts, '%m') AS mes, strftime(ts, '%d') AS dia,
       strftime(ts, '%Y%m%d_%H%M%S') AS stamp, epoch_us(TIMESTAMP '2024-02-03 04:05:06') AS _silver_processed_at, 'v1.0' AS _pipeline_version
FROM events""",
    "bronze_partition_roundtrip": """
SELECT event_id, CASE WHEN CAST(ts AS DATE) = (SELECT CAST(min(ts) AS DATE) FROM events)
                      THEN -value ELSE value END AS value,
       strftime(ts, '%Y') AS ano, strftime(ts, '%m') AS mes, strftime(ts, '%d') AS dia
FROM events""",
    "bronze_snapshot_roundtrip": f"""WITH {sql.USERS}
SELECT user_id AS id, name, 'Street ' || CAST(user_id AS VARCHAR) AS street, addr_city AS city,
       CAST(geo_lat AS VARCHAR) AS lat, CAST(geo_lng AS VARCHAR) AS lng, 'We do ' || company_name AS phrase,
       'struct<street:string,suite:string,city:string,zipcode:string,geo:struct<lat:string,lng:string>>' AS address_type,
       'struct<name:string,catchPhrase:string,bs:string>' AS company_type,
       run, 'landing_files' AS _source_system
FROM users CROSS JOIN (VALUES ('20240203_040506'), ('20240204_040506'), ('20240204_040506_01')) AS runs(run)""",
    "bronze_gate_blocks": """
SELECT o_custkey AS "userId", o_orderkey AS id, o_orderpriority AS title,
       o_orderstatus || ' ' || o_orderpriority AS body,
       CASE WHEN (SELECT count(*) FROM orders WHERE o_orderkey % 7 = 0) > 0 THEN 'not_null:userId' ELSE '' END AS failed
FROM orders""",
    "run_counts": """
SELECT 'users' AS entity, count(*) + count(*) FILTER (WHERE c_custkey % 3 = 0) AS ingested, count(*) AS kept,
       count(*) FILTER (WHERE c_custkey % 3 = 0) AS removed FROM customer
UNION ALL SELECT 'posts', count(*) + count(*) FILTER (WHERE o_orderkey % 5 = 0), count(*),
       count(*) FILTER (WHERE o_orderkey % 5 = 0) FROM orders
UNION ALL SELECT 'todos', count(*), count(*), 0 FROM events
UNION ALL SELECT 'comments', count(*), NULL, NULL FROM conversations""",
    "bronze_gated_job": f"""WITH {sql.USERS}
SELECT user_id AS id, name, username, email,
       'Street ' || CAST(user_id AS VARCHAR) AS address_street,
       'Suite ' || CAST(c_nationkey AS VARCHAR) AS address_suite,
       addr_city AS address_city, addr_zipcode AS address_zipcode,
       CAST(geo_lat AS VARCHAR) AS address_geo_lat, CAST(geo_lng AS VARCHAR) AS address_geo_lng,
       'tel. +' || CAST(c_nationkey AS VARCHAR) || ' (0) ' || CAST(user_id AS VARCHAR) || '-x1' AS phone,
       lower(company_name) || '.example' AS website, company_name,
       'We do ' || company_name AS company_catchphrase, lower(company_name) AS company_bs,
       '20240203_040506' AS _ingestion_timestamp, '2024-02-03' AS _ingestion_date,
       'users' AS _source_entity, 'queries' AS _job_name, '2024' AS ano, '02' AS mes, '03' AS dia,
       count(*) OVER () AS written
FROM users JOIN customer ON user_id = c_custkey""",
    "ingest_rejects": """
SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
       CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
       CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
       CASE WHEN event_type = 'error' THEN '{"event_id":' || event_id || ',"user_id":' || user_id
            || ',"event_type":"' || event_type || '"' END AS rejected
FROM events""",
    "table_profile": _profile_sql(),
    "ingest_totals": "SELECT count(*) AS entities, CAST(sum(n) AS BIGINT) AS records FROM ("
    + " UNION ALL ".join(f"SELECT count(*) AS n FROM {name}" for name in COLUMNS) + ")",
    "preview_top": """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3""",
    "lake_inventory": f"""
SELECT DISTINCT 'bronze' AS layer, 'events' AS dataset, 'events/' || {_DAY} AS folder, true AS filled, true AS agrees FROM events
UNION ALL SELECT DISTINCT 'silver', 'customer', 'customer', true, true FROM customer""",
    "raw_to_processed": PROFILE_SQL,
    "arrays_to_processed": PROFILE_SQL,
}
